"""Deterministic one-row-per-key selection.

The original picks a random row per client with ``row_number`` over
``rand(123)``, which changes with the partitioning.  Here the order is a seeded
md5 of the row's identifying columns, so the pick is repeatable on any cluster
layout and expressible in SQL.  The pick is a ``min(struct)`` aggregate: it is
combined map-side before the shuffle, so a client holding a third of all rows
never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def seeded_hash(seed: int, cols: Sequence[str]) -> Column:
    """Hex md5 of ``seed|c1|c2|...`` (NULL fields become empty strings)."""
    parts = [F.lit(str(seed))] + [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def hash_bucket(seed: int, cols: Sequence[str], modulus: int = 100) -> Column:
    """Integer bucket in [0, modulus) from the first 8 hex digits of the md5."""
    h = seeded_hash(seed, cols)
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") % modulus).cast("int")


def one_per_key(
    df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], seed: int = 123
) -> DataFrame:
    """Keep one row per ``keys``: the one with the smallest seeded hash of
    ``keys + order_cols``; remaining columns break hash ties, so the result
    is fully deterministic.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordered = ["_h"] + list(order_cols) + [c for c in rest if c not in order_cols]
    picked = (
        df.withColumn("_h", seeded_hash(seed, keys + list(order_cols)))
        .groupBy(*keys)
        .agg(F.min(F.struct(*ordered)).alias("_best"))
    )
    return picked.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest])


def first_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Deduplicate a dimension by key, keeping the smallest row (deterministic)."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*rest)).alias("_best"))
        .select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest])
    )
