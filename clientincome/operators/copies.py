"""Repeated dimension rows carried as a count instead of as rows.

Under REFERENCE, a dimension key that appears k times (contact, income,
journey) repeats every client row it joins, k times.  Those copies are part
of the result, but they need not travel through the shuffles: the dimension
is reduced to distinct rows with a copy count ``_c`` (a partial-combining
aggregate), joins multiply the counts into a row weight ``_w``, and the rows
are expanded only at the end, by ``expand``, which cuts a row standing for
millions of copies into chunks spread over tasks before it is exploded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WEIGHT = "_w"
COUNT = "_c"
CHUNK = 100_000


def counted_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct rows of ``df`` with their number of copies in ``_c``."""
    return df.groupBy(*keys, *[c for c in df.columns if c not in keys]).agg(
        F.count(F.lit(1)).alias(COUNT)
    )


def weight_of(df: DataFrame, alias: str | None = None) -> Column:
    """The row weight of ``df`` (1 when it carries none)."""
    if WEIGHT in df.columns:
        c = F.col(f"{alias}.{WEIGHT}") if alias else F.col(WEIGHT)
        return F.coalesce(c, F.lit(1).cast("bigint"))
    return F.lit(1).cast("bigint")


def times_count(alias: str) -> Column:
    """Copy count of a left-joined counted dimension (1 when unmatched)."""
    return F.coalesce(F.col(f"{alias}.{COUNT}"), F.lit(1).cast("bigint"))


def expand(df: DataFrame, key: str = "id_master", chunk: int = CHUNK) -> DataFrame:
    """Rows repeated by their weight (dropped).

    A row is first cut into chunks of at most ``chunk`` copies, the chunks are
    spread over partitions by (key, chunk), and only then does each become
    rows: no task makes all copies of a hot client, and no array is longer
    than the chunks of a row or the copies of a chunk.
    """
    if WEIGHT not in df.columns:
        return df
    long = lambda x: F.lit(x).cast("bigint")
    last = F.floor((F.col(WEIGHT) - 1) / F.lit(chunk)).cast("bigint")
    chunks = df.withColumn("_k", F.explode(F.sequence(long(0), last))).repartition(key, "_k")
    copies = F.least(long(chunk), F.col(WEIGHT) - F.col("_k") * chunk)
    return chunks.withColumn("_r", F.explode(F.sequence(long(1), copies))).drop("_r", "_k", WEIGHT)
