"""Numeric column helpers shared by the feature and scoring operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def dbl(x) -> Column:
    return _c(x).cast("double")


def ieee_div(n, d) -> Column:
    """Float division with IEEE results instead of ANSI errors.

    ``x/0`` is +/-Infinity by the sign of ``x``; ``0/0`` is NULL (missing is
    NULL, never NaN, so that ordering and comparisons stay well defined).
    """
    n, d = dbl(n), dbl(d)
    return (
        F.when(d != 0, n / d)
        .when(n > 0, F.lit(float("inf")))
        .when(n < 0, F.lit(float("-inf")))
    )


def round4(x) -> Column:
    """Half-even rounding to 4 decimals as ``rint(x*1e4)/1e4``.

    This is the float rounding of the original output (0.12345 -> 0.1234);
    ``round`` is half-up and ``bround`` works on the decimal expansion.
    """
    return F.rint(dbl(x) * F.lit(10000.0)) / F.lit(10000.0)


def floor_small(total, threshold: float = 100.0) -> Column:
    """``0`` when ``|total| < threshold`` else ``|total|``."""
    t = _c(total)
    return F.when(F.abs(t) < threshold, F.lit(0)).otherwise(F.abs(t))


def sum_nullable(*cols, fill: bool = False) -> Column:
    """Column sum; NULL-propagating unless ``fill`` treats NULL as 0."""
    cs = [F.coalesce(_c(c), F.lit(0)) if fill else _c(c) for c in cols]
    out = cs[0]
    for c in cs[1:]:
        out = out + c
    return out


def trimmed_sum(values: Column, first: int, count: int, dtype: str = "decimal(38,2)") -> Column:
    """Sum of the ``first``..``first+count-1`` smallest values of a list.

    ``values`` is an array of structs with one field ``v``; NULL ``v`` sorts
    first (as in an ascending window order) and adds nothing.  The array is
    the per-client list of monthly amounts, so its size is bounded by the
    history length and the sort stays inside one row.
    """
    picked = F.slice(F.sort_array(values, asc=True), first, count)
    zero = F.lit(0).cast(dtype)
    return F.aggregate(
        picked, zero, lambda acc, s: (acc + F.coalesce(s["v"].cast(dtype), zero)).cast(dtype)
    )


def weighted_trimmed_sum(
    items: Column, first: int, count: int, dtype: str = "decimal(38,2)"
) -> Column:
    """``trimmed_sum`` over a list in which each value stands for ``w`` copies.

    ``items`` is an array of structs ``(v, w)``: value ``v`` repeated ``w``
    times (``w`` >= 1).  The result equals ``trimmed_sum`` over the expanded
    list, computed from the distinct entries only: sort, running totals of
    the weights, then the entry covering each rank ``first..first+count-1``.
    A client whose rows are copied millions of times still costs one entry
    per distinct (month, value).
    """
    arr = F.sort_array(items, asc=True)
    zero_w = F.lit(0).cast("bigint")
    ends = F.transform(
        arr, lambda x, i: F.aggregate(F.slice(arr, 1, i + 1), zero_w, lambda a, y: a + y["w"])
    )
    ranked = F.arrays_zip(arr.alias("e"), ends.alias("end"))
    zero = F.lit(0).cast(dtype)
    total = zero
    for k in range(first, first + count):
        hit = F.try_element_at(F.filter(ranked, lambda t: t["end"] >= k), F.lit(1))
        total = (total + F.coalesce(hit["e"]["v"].cast(dtype), zero)).cast(dtype)
    return total


def canonical(df: DataFrame) -> DataFrame:
    """Output types at the query boundary: integers as BIGINT, numbers as DOUBLE."""
    out = []
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            out.append(F.col(f.name).cast("bigint").alias(f.name))
        elif isinstance(t, (T.DecimalType, T.FloatType)):
            out.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(t, T.BooleanType):
            out.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
