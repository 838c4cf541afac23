"""The percentile report from sketches (opt-in, approximate).

Each group keeps one KLL sketch, a binary column: built with partial
aggregation in one read of the scored table, mergeable with the sketches of
other months, and a few kilobytes whatever the group's size.  A quantile read
from it has a rank within about ``2.3 / k**0.9`` of the one asked for (99 %
of the time).  Groups of up to ``k`` values are exact up to interpolation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 4000
SKETCH = "sketch"


def sketch_state(df: DataFrame, value: str, keys: Sequence[str], k: int = K) -> DataFrame:
    """(keys, count, sketch) of the non-null values; groups without any keep a null sketch."""
    x = F.col(value).cast("double")
    return df.groupBy(*keys).agg(F.count(x).alias("count"), F.kll_sketch_agg_double(x, F.lit(k)).alias(SKETCH))


def merged(states: DataFrame, keys: Sequence[str], k: int = K) -> DataFrame:
    """The states of several months (or any parts) as one for each of ``keys``."""
    return states.groupBy(*keys).agg(F.sum("count").alias("count"), F.kll_merge_agg_double(SKETCH, F.lit(k)).alias(SKETCH))


def quantiles(states: DataFrame, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """``states`` with a column for each probability in place of the sketch; null without values."""
    read = [F.when(F.col("count") > 0, F.kll_sketch_get_quantile_double(SKETCH, F.lit(float(p)))).alias(n) for p, n in zip(probs, names, strict=True)]
    return states.select(*[c for c in states.columns if c != SKETCH], *read)


def rank_errors(df: DataFrame, value: str, keys: Sequence[str], approx: DataFrame, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """(keys, count, worst): of each group the largest distance between a probability and the ranks that its quantile has in ``df``.

    ``approx``: one row for each group, of a number that the caller can prove small; it is broadcast.
    """
    x = F.col(value).cast("double")
    shown = approx.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "count", *names)
    met = df.select(*keys, x.alias("_x")).join(F.broadcast(shown), [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    n = F.max("count")
    errors = []
    for p, name in zip(probs, names, strict=True):
        below = F.try_divide(F.sum(F.when(F.col("_x") < F.col(name), 1).otherwise(0)), n)
        upto = F.try_divide(F.sum(F.when(F.col("_x") <= F.col(name), 1).otherwise(0)), n)
        errors.append(F.greatest(below - F.lit(p), F.lit(p) - upto, F.lit(0.0)))  # 0 without values
    return met.groupBy(*keys).agg(n.alias("count"), F.greatest(*errors).alias("worst"))
