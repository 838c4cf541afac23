import glob
import os

from clientincome.sources import io


def test_csv_sinks_and_declared_schema(spark, tmp_path):
    df = spark.range(0, 1000, 1, 4).selectExpr(
        "id AS id_master", "CAST(id % 7 AS INT) AS k", "CAST(id / 3 AS DECIMAL(18,2)) AS amount"
    )
    many, one = str(tmp_path / "many"), str(tmp_path / "one")
    io.write_csv(df, many)
    io.write_csv(df.groupBy("k").count(), one, single_file=True)
    assert len(glob.glob(os.path.join(many, "part-*.csv"))) > 1   # no funnel through one task
    assert len(glob.glob(os.path.join(one, "part-*.csv"))) == 1   # bounded output: one file
    back = io.read_csv(spark, many, df.schema)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in df.schema]
    assert sorted(back.collect()) == sorted(df.collect())
    back2 = io.read_csv_options(spark, many, df.schema)
    assert back2.count() == 1000


def test_parquet_sink_partitioned(spark, tmp_path):
    df = spark.range(100).selectExpr("id AS id_master", "CAST(200007 + id % 6 AS INT) AS num_periodo_mes")
    path = str(tmp_path / "p")
    io.write_parquet(df, path, partition_by=["num_periodo_mes"])
    back = spark.read.parquet(path).where("num_periodo_mes = 200012")
    assert back.count() == sum(1 for i in range(100) if 200007 + i % 6 == 200012)
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan  # month predicate prunes partitions
