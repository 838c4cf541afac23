"""Exact grouped quantiles (linear interpolation) without collecting a group.

``percentile``/``median`` keep every distinct value of a group in one task,
which breaks when one group holds a third of a 100 TB table.  This operator
stays exact and distributed:

1. one partial-combining aggregate per group gives the non-null count, min,
   max and a ``percentile_approx`` sketch (rank error at most n/accuracy)
   read at p -+ d * 2**k, k = 0, 1, ..; each group takes the narrowest bracket
   whose margin covers the sketch's error and two ranks, 3/accuracy + 2/n (its
   ends are open where the margin passes 0 or 1);
2. one pass over the rows groups them by the value if it is inside a bracket,
   and the rest of a group together, with plain sums of the values below each
   bracket (no row is replicated, ties and the rest collapse map-side);
3. a running count over each small bracketed set finds the values at ranks
   floor(h) and floor(h)+1, h = p*(n-1), and interpolates.

Step 3 sees a few times ``2 * d * n + 4`` values (d = 3/accuracy), so no task
holds a whole large group.  A bracket that missed its order statistics would
raise an error, never give NULL or a wrong number.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_ACCURACY = 10000


def _join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join on ``keys`` keeping the left key columns."""
    if not keys:
        return left.crossJoin(F.broadcast(right))  # right is one row here
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys]
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    group_cols: Sequence[str] = (),
    accuracy: int = DEFAULT_ACCURACY,
    names: Sequence[str] | None = None,
    max_groups: int | None = None,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One row per group (all groups of ``df``) and one DOUBLE per probability.

    Semantics of ``quantile_cont`` / pandas ``quantile``: over the non-null
    values sorted ascending, h = p*(n-1); result = x[floor h] +
    (x[floor h + 1] - x[floor h]) * (h - floor h).  NULL when n = 0.

    ``max_groups``: a bound on the number of groups that the caller can prove
    (e.g. a fixed label vocabulary).  The per-group bracket table is then
    broadcast into the pass over the rows, so rows are never shuffled by a
    (possibly skewed) group key.  Without it, AQE decides at runtime from the
    bracket table's measured size.

    ``extra``: named aggregates of the value (column ``_x``) that the first
    pass shall also compute; they follow the group's columns.
    """
    keys = list(group_cols)
    probs = [float(p) for p in probs]
    names = list(names) if names else [f"q{i}" for i in range(len(probs))]
    n_p = len(probs)
    d = 3.0 / accuracy
    steps = range(max(1, math.ceil(math.log2(1 / d)) + 1))

    x = df.select(*keys, F.col(value).cast("double").alias("_x"))

    # 1. per-group count, range and sketch brackets
    stats = x.groupBy(*keys).agg(
        *extra,
        F.count("_x").alias("_n"),
        F.min("_x").alias("_min"),
        F.max("_x").alias("_max"),
        F.percentile_approx("_x", [max(0.0, p - d * 2**k) for p in probs for k in steps], accuracy).alias("_plo"),
        F.percentile_approx("_x", [min(1.0, p + d * 2**k) for p in probs for k in steps], accuracy).alias("_phi"),
    )
    inf = F.lit(float("inf"))
    # the step whose margin is enough for a group of this size
    k = F.least(F.lit(len(steps) - 1), F.ceil(F.log2(F.lit(1.0) + F.lit(2.0 / d) / F.greatest(F.lit(1), F.col("_n")))).cast("int"))
    margin = F.lit(d) * F.pow(F.lit(2.0), k)
    at = [(i * len(steps), F.lit(p)) for i, p in enumerate(probs)]
    lo = [F.when(p <= margin, -inf).otherwise(F.try_element_at("_plo", k + i + 1)) for i, p in at]
    hi = [F.when(p + margin >= 1, inf).otherwise(F.try_element_at("_phi", k + i + 1)) for i, p in at]
    brackets = stats.select(*keys, "_n", F.array(*lo).alias("_lo"), F.array(*hi).alias("_hi"))

    # 2. one pass: counts below each bracket, and bracketed values
    if keys and max_groups is not None:
        brackets = F.broadcast(brackets)
    j = _join_on(x.where(F.col("_x").isNotNull()), brackets, keys)
    idx = F.array(*[F.lit(i) for i in range(n_p)])

    def holding(v: str) -> Column:
        return F.filter(idx, lambda i: (F.col(v) >= F.element_at(F.col("_lo"), i + 1)) & (F.col(v) <= F.element_at(F.col("_hi"), i + 1)))

    grouped = j.groupBy(*keys, F.when(F.size(holding("_x")) > 0, F.col("_x")).alias("_v")).agg(
        F.count(F.lit(1)).alias("_c"),
        *[F.sum(F.when(F.col("_x") < F.col("_lo")[i], 1).otherwise(0)).alias(f"_b{i}") for i in range(n_p)],
    )
    below = grouped.groupBy(*keys).agg(*[F.sum(f"_b{i}").alias(f"_b{i}") for i in range(n_p)])
    inside = _join_on(grouped.where(F.col("_v").isNotNull()).select(*keys, "_v", "_c"), brackets, keys).select(
        *keys, F.col("_v").alias("_x"), "_c", F.explode(holding("_v")).alias("_i")
    )

    # targets: one row per (group, p) with rank position and count below
    tgt = _join_on(stats.select(*keys, "_n"), below, keys, "left").select(
        *keys,
        "_n",
        F.explode(
            F.arrays_zip(
                idx.alias("i"),
                F.array(*[F.lit(p) for p in probs]).alias("p"),
                F.array(*[F.coalesce(F.col(f"_b{i}"), F.lit(0)) for i in range(n_p)]).alias("b"),
            )
        ).alias("t"),
    ).select(*keys, "_n", F.col("t.i").alias("_i"), (F.col("t.p") * (F.col("_n") - 1)).alias("_h"),
             F.col("t.b").alias("_below"))

    # 3. running counts inside each bracket
    w = Window.partitionBy(*keys, "_i").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = _join_on(inside, tgt, keys + ["_i"]) if keys else inside.join(F.broadcast(tgt), "_i")
    ranked = ranked.withColumn("_end", F.col("_below") + F.sum("_c").over(w)).withColumn(
        "_start", F.col("_end") - F.col("_c")
    )
    k0 = F.floor(F.col("_h"))
    k1 = F.least(k0 + 1, F.col("_n") - 1)
    picked = ranked.groupBy(*keys, "_i").agg(
        F.max(F.when((k0 >= F.col("_start")) & (k0 < F.col("_end")), F.col("_x"))).alias("_x0"),
        F.max(F.when((k1 >= F.col("_start")) & (k1 < F.col("_end")), F.col("_x"))).alias("_x1"),
        F.first("_h").alias("_h"),
    )
    frac = F.col("_h") - F.floor(F.col("_h"))
    missed = F.col("_x0").isNull() | ((frac > 0) & F.col("_x1").isNull())
    q = F.when(missed, F.raise_error(F.lit("quantile bracket missed its ranks")).cast("double"))
    q = q.when(frac == 0, F.col("_x0")).otherwise(F.col("_x0") + (F.col("_x1") - F.col("_x0")) * frac)
    wide = picked.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_i") == i, q)).alias(n) for i, n in enumerate(names)]
    )
    shown = [c for c in stats.columns if c not in (*keys, "_n", "_min", "_max", "_plo", "_phi")]
    out = _join_on(stats.select(*keys, *shown), wide, keys, "left") if keys else None
    if not keys:
        # a table with no non-null value still yields one row of NULLs
        out = _one_row(stats.select(*shown), wide, names)
    return out.select(*keys, *shown, *names)


def _one_row(stats: DataFrame, wide: DataFrame, names: Sequence[str]) -> DataFrame:
    base = stats.select("*", F.lit(1).alias("_k"))
    w = wide.select(F.lit(1).alias("_k"), *names)
    return base.join(w, "_k", "left").drop("_k")
