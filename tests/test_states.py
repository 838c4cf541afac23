"""Monthly states, month-partitioned extracts, the runtime filter, quarantine and sketches."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from clientincome.operators import deposits, populations, services, sketches, states, unify
from clientincome.plans import inference as plan
from clientincome.semantics import CORRECTED, REFERENCE, RunParams
from clientincome.sources import io, schemas

P = RunParams(200012, 6)
BEFORE = RunParams(200011, 6)


@contextmanager
def conf(spark, **settings):
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.fixture(scope="module")
def extracts(spark, inputs_small, tmp_path_factory):
    """The inputs as month-partitioned extracts of the two windows."""
    root = str(tmp_path_factory.mktemp("extracts"))
    return schemas.read_inputs_parquet(spark, schemas.write_inputs(inputs_small, root, window=(BEFORE.start, P.mes)))


def rows(df):
    return sorted(map(str, df.collect()))


def full(i, params, sem):
    cap, env, div = plan.populations_of(i, params, sem)
    return (
        deposits.deposit_features(i.account_hist, cap, params, sem), services.transfer_features(env, i.calendar, i.transfer_hist, params, sem),
        services.fx_features(div, i.calendar, i.fx_hist, params, sem),
    )


def from_states(kept, i, params, sem):
    cap, env, div = plan.populations_of(i, params, sem)
    return kept.deposit_features(cap, params), kept.transfer_features(env, i.calendar, params), kept.fx_features(div, i.calendar, params)


@pytest.mark.parametrize("sem", [REFERENCE, CORRECTED], ids=["reference", "corrected"])
def test_two_months_from_states_equal_the_full_computation(spark, extracts, tmp_path, sem):
    kept = states.States(spark, str(tmp_path), buckets=3, sem=sem)
    assert kept.roll(extracts, BEFORE)["deposits"] == [200006, 200007, 200008, 200009, 200010, 200011]
    for a, b in zip(from_states(kept, extracts, BEFORE, sem), full(extracts, BEFORE, sem), strict=True):
        assert rows(a) == rows(b)
    assert set(map(tuple, kept.roll(extracts, P).values())) == {(200012,)}  # the new month alone
    for a, b in zip(from_states(kept, extracts, P, sem), full(extracts, P, sem), strict=True):
        assert rows(a) == rows(b)
    assert all(v == [] for v in kept.roll(extracts, P).values())


def scan_of(df, what):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text, [line for line in text.splitlines() if "Scan" in line and what in line]


def test_a_new_month_scans_one_month(spark, extracts):
    for state in (states.deposit_state(extracts.account_hist, 200012), states.service_state(extracts.fx_hist, 200012, services.FX_VALUES)):
        _, scans = scan_of(state, "parquet")
        assert len(scans) == 1 and "(num_periodo_mes" in scans[0].split("PartitionFilters")[1].split("]")[0]
        assert "= 200012" in scans[0].split("PartitionFilters")[1].split("PushedFilters")[0]


def test_window_filters_partitions_of_the_extract(spark, extracts):
    _, scans = scan_of(deposits.account_months(extracts.account_hist, P), "parquet")
    filters = scans[0].split("PartitionFilters")[1].split("PushedFilters")[0]
    assert ">= 200007" in filters and "<= 200012" in filters


def test_no_exchange_on_a_history_side(spark, extracts, tmp_path):
    """Unification from states: between a state's scan and the join above it lies no exchange."""
    kept = states.States(spark, str(tmp_path))
    kept.roll(extracts, P)
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        dep, env, fx = from_states(kept, extracts, P, REFERENCE)
        u = unify.unify(deposits.enrich(dep, extracts.income, extracts.journey, P), fx, env)
        text = u._jdf.queryExecution().executedPlan().toString()
    lines = text.splitlines()
    depth = [re.search(r"[A-Za-z*]", x).start() for x in lines]
    scans = [k for k, x in enumerate(lines) if "Scan parquet" in x and "state_" in x]
    assert len(scans) == 3
    for k in scans:
        assert "Bucketed: true" in lines[k], lines[k]
    for k in scans:
        at = depth[k]
        for j in range(k, -1, -1):
            if depth[j] < at:
                at = depth[j]
                assert "Exchange" not in lines[j], lines[j]
                if "Join" in lines[j]:
                    break
        else:
            raise AssertionError("no join above the scan")


def test_runtime_filter_above_the_account_scan(spark, extracts):
    pop = plan.filtered_by(plan.cut(populations.deposit_population_counted(extracts.deposit_hist, extracts.income, P)))
    name = "spark.sql.optimizer.runtime.bloomFilter."
    settings = {name + "enabled": "true", name + "applicationSideScanSizeThreshold": "0", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    with conf(spark, **settings):
        df = deposits.deposit_features(extracts.account_hist, pop, P)
        text = df._jdf.queryExecution().optimizedPlan().toString()
        lines = text.splitlines()
        at = next(k for k, x in enumerate(lines) if "might_contain" in x)
        join = next(k for k, x in enumerate(lines) if "Join Inner" in x)
        assert "Filter" in lines[at] and sum("Aggregate" in x for x in lines[join:at]) == 2  # below both aggregates
        assert any("Relation" in x and "mto_dep_transferencia" in x for x in lines[at:])
        got = rows(df)
    assert got == rows(deposits.deposit_features(extracts.account_hist, populations.deposit_population_counted(extracts.deposit_hist, extracts.income, P), P))


def test_quarantine_of_cells_and_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,a,x\n1.50,7,u\nn/a,8,v\n2.00,eight,w\nbad,worse,z\n3.00\n4.00,9,y,more\n,,\n")
    good, bad = io.read_csv_apart(spark, str(tmp_path / "a.csv"), "a INT, b DECIMAL(9,2)")
    assert sorted(((r["a"], r["b"]) for r in good.collect()), key=str) == sorted([(7, __import__("decimal").Decimal("1.50")), (None, None)], key=str)
    got = sorted((r["column"] or "", r["cell"] or "", r["record"]) for r in bad.collect())
    assert got == [
        ("", "", "3.00"), ("", "", "4.00,9,y,more"), ("a", "eight", "2.00,eight,w"), ("a", "worse", "bad,worse,z"), ("b", "bad", "bad,worse,z"),
        ("b", "n/a", "n/a,8,v"),
    ]
    kept = io.read_csv_quarantined(spark, str(tmp_path / "a.csv"), "a INT, b DECIMAL(9,2)", str(tmp_path / "side"))
    assert kept.count() == 2 and spark.read.parquet(str(tmp_path / "side")).count() == 6


def test_sketches_merge_over_months(spark):
    data = spark.range(60_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 2).alias("m"), (F.col("id") * 7919 % 104729).cast("double").alias("x"))
    data = data.unionByName(spark.createDataFrame([(9, 0, None), (None, 1, 5.0)], "g long, m long, x double"))
    probs, names = [0.01, 0.5, 0.9], ["p1", "p50", "p90"]
    monthly = sketches.sketch_state(data, "x", ["g", "m"], 2000)
    one = sketches.quantiles(sketches.merged(monthly, ["g"], 2000), probs, names)
    got = {r["g"]: r for r in sketches.rank_errors(data, "x", ["g"], one, probs, names).collect()}
    assert {g: r["count"] for g, r in got.items()} == {0: 20_000, 1: 20_000, 2: 20_000, 9: 0, None: 1}
    assert all(r["worst"] <= 0.01 for r in got.values())
    assert one.where("g = 9").first()["p50"] is None
    text = sketches.sketch_state(data, "x", ["g"])._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("partial_kll_sketch", text)) >= 1
