import numpy as np
import pytest
from pyspark.sql import functions as F

from clientincome.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.01, 0.1, 0.25, 0.5, 0.6, 0.9, 0.99, 1.0]


def _numpy(vals, p):
    v = np.array([x for x in vals if x is not None], dtype=float)
    if len(v) == 0:
        return None
    return float(np.quantile(v, p, method="linear"))


@pytest.mark.parametrize("accuracy", [20, 10000])
def test_grouped_exact_against_numpy(spark, accuracy):
    """accuracy=20 puts groups over 80 rows on the sketch-bracket path."""
    rng = np.random.default_rng(7)
    rows = []
    for g, n in (("a", 1), ("b", 2), ("c", 57), ("d", 400), ("e", 1500)):
        vals = rng.normal(100, 40, n).round(2)
        if g == "e":
            vals[: n // 3] = 0.0  # a third of the group is one tied value
        rows += [(g, float(x)) for x in vals]
    rows += [("d", None), ("f", None)]
    df = spark.createDataFrame(rows, "g STRING, x DOUBLE").repartition(5)
    out = {r["g"]: r for r in exact_quantiles(df, "x", PROBS, ["g"], accuracy=accuracy).collect()}
    assert set(out) == {"a", "b", "c", "d", "e", "f"}
    for g in "abcde":
        vals = [x for gg, x in rows if gg == g]
        for i, p in enumerate(PROBS):
            exp = _numpy(vals, p)
            assert out[g][f"q{i}"] == pytest.approx(exp, rel=1e-12, abs=1e-9), (g, p)
    assert all(out["f"][f"q{i}"] is None for i in range(len(PROBS)))


def test_ungrouped_and_null_keys(spark):
    rng = np.random.default_rng(3)
    vals = [float(v) for v in rng.integers(0, 50, 300)]
    df = spark.createDataFrame([(None if i % 2 else "k", v) for i, v in enumerate(vals)], "g STRING, x DOUBLE")
    whole = exact_quantiles(df, "x", [0.5, 0.75], accuracy=20).collect()[0]
    assert whole["q0"] == pytest.approx(_numpy(vals, 0.5))
    assert whole["q1"] == pytest.approx(_numpy(vals, 0.75))
    grouped = {r["g"]: r for r in exact_quantiles(df, "x", [0.5], ["g"], accuracy=20).collect()}
    odd = [v for i, v in enumerate(vals) if i % 2]
    assert grouped[None]["q0"] == pytest.approx(_numpy(odd, 0.5))


def test_empty_table_gives_null_row(spark):
    df = spark.createDataFrame([], "x DOUBLE")
    r = exact_quantiles(df, "x", [0.5]).collect()
    assert len(r) == 1 and r[0]["q0"] is None


def test_no_group_is_collected(spark):
    """The plan holds no collect_list/percentile aggregate over raw rows."""
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), F.col("id").cast("double").alias("x"))
    plan = exact_quantiles(df, "x", [0.5], ["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "percentile(" not in plan
