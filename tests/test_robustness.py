"""Inputs that once gave wrong or missing results, or none."""

import math
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from clientincome.operators import copies, report, training
from clientincome.operators.quantiles import exact_quantiles
from clientincome.operators.services import WEIGHT, trimmed_totals
from clientincome.semantics import REFERENCE, RunParams
from clientincome.sources import io, schemas

PARAMS = RunParams(mes=200012, historia=6, seed=123)


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("read", [io.read_csv, io.read_csv_options])
def test_csv_binds_by_name(spark, tmp_path, read):
    path = write(tmp_path / "a.csv", "b,extra,a\n7,x,1\n,y,2\n")
    assert [tuple(r) for r in read(spark, path, "a INT, b DECIMAL(18,2)").collect()] == [(1, 7), (2, None)]
    with pytest.raises(PySparkException):
        read(spark, write(tmp_path / "b.csv", "a,b\n1,x\n"), "a INT, b INT").collect()
    with pytest.raises(PySparkException):
        read(spark, write(tmp_path / "c.csv", "a\n1\n"), "a INT, b INT").collect()


def test_census_under_its_published_headers(spark, tmp_path):
    head = "Población 2019,Código Postal,Nivel,Familias,Ingreso familiar promedio $,Población Económicamente Inactiva (PEI),Nota"
    got = schemas.read_census_csv(spark, write(tmp_path / "c.csv", head + "\n400,1000,Código postal,100,2500.50,150,z\n"))
    assert got.schema.names == schemas.SCHEMAS["census"].names
    assert got.selectExpr("nivel", "cod_postal", "familias", "double(ingreso_familiar)", "poblacion", "pei").first() == (
        "Código postal", 1000, 100, 2500.5, 400, 150,
    )


def test_input_views_keep_every_row(spark):
    from clientincome.sources.fixtures import load_inputs

    i = load_inputs(spark, "/root/testdata/sf0.01")
    kinds = ("num_pag_rem", "num_env_rem", "num_pag_dex", "num_env_dex")
    counted = i.transfer_hist.select(sum(F.coalesce(c, F.lit(0)) for c in kinds).alias("n")).agg(F.sum("n")).first()[0]
    events = spark.table("events").where("event_type in ('purchase', 'error', 'signup', 'click')").count()
    assert counted == events
    assert i.census.where("nivel <> 'Estado'").agg(F.sum("familias")).first()[0] == spark.table("customer").count()


def test_factor_is_one_row(spark, tmp_path):
    for n, values in enumerate(([], [1.0, 2.0], [None])):
        path = str(tmp_path / f"f{n}")
        io.save_factor(spark.createDataFrame([(v,) for v in values], "factor double"), path)
        with pytest.raises(ValueError):
            io.load_factor(spark, path)


def test_report_without_any_income(spark):
    rows = spark.createDataFrame([("g", "i", None), ("g", "j", None)], "cod_grupo_renta string, cod_ingreso_renta string, ing_renta_indirecta double")
    got = report.report(rows).collect()
    assert [(r["count"], r["prop"], r["mean"]) for r in got] == [(0, None, None)] * 2


def test_metrics_equal_sparks_evaluator(spark):
    pred = spark.createDataFrame([(1.0, 4.5), (2.5, 1.0), (7.0, 6.0), (3.0, 9.5)], "y double, prediction double")
    got = training.regression_metrics(pred, "y").first()
    names = {"rmse": "rmse", "mse": "mse", "mae": "mae", "r2": "r2", "explained_variance": "var"}
    for ours, theirs in names.items():
        want = RegressionEvaluator(labelCol="y", metricName=theirs).evaluate(pred)
        assert math.isclose(got[ours], want, rel_tol=1e-12), ours


def test_layout_ignores_tuning(spark):
    rows = spark.range(500).selectExpr("id AS saldo", "id * 2 AS potencial", "id % 7 AS recorrido", "20 + id % 50 AS edad", "double(id) AS y")
    layouts = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("3", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            layouts.append(training.fixed_layout(rows, "y").withColumn("part", F.spark_partition_id()).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert layouts[0] == layouts[1]


def test_huge_weights_plan_in_bounded_arrays(spark):
    one = spark.createDataFrame([(1, 3_000_000_000)], f"id_master long, {copies.WEIGHT} long")
    assert len(copies.expand(one).limit(5).collect()) == 5
    few = spark.createDataFrame([(i, w) for i, w in enumerate((1, 9, 10, 11, 25))], f"id_master long, {copies.WEIGHT} long")
    assert sorted(r[0] for r in copies.expand(few, chunk=10).collect()) == [i for i, w in enumerate((1, 9, 10, 11, 25)) for _ in range(w)]


def test_trimmed_totals_of_a_client_with_many_rows(spark):
    def run(clients, each):
        rows = spark.range(clients * each).select(
            (F.col("id") % clients).alias("id_master"), F.floor(F.col("id") / clients).cast("decimal(18,2)").alias("x"),
            F.lit(1).cast("bigint").alias(WEIGHT),
        )
        began = time.time()
        got = trimmed_totals(rows, {"x": "t"}, PARAMS, REFERENCE).collect()
        assert len(got) == clients and len({r["t"] for r in got}) == 1
        return time.time() - began

    run(100, 10)
    assert run(1, 100_000) < run(10_000, 10) + 10


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40, 1000, 60_000])
def test_quantiles_of_any_size(spark, n):
    values = [(i * 7919 % 104729) / 3 for i in range(n)]
    got = exact_quantiles(spark.createDataFrame([(v,) for v in values], "x double"), "x", [0.0, 0.01, 0.5, 0.9, 1.0], accuracy=100).first()
    s = sorted(values)
    for p, g in zip((0.0, 0.01, 0.5, 0.9, 1.0), got, strict=True):
        h = p * (n - 1)
        low = math.floor(h)
        want = s[low] + (s[min(low + 1, n - 1)] - s[low]) * (h - low)
        assert math.isclose(g, want, rel_tol=1e-12, abs_tol=1e-12)
