"""Cross-site boilerplate lines, by HyperLogLog spread (DataFrame functions only).

Each line of a document (white space at its ends aside) is a 128-bit hash.  One
aggregation builds a HyperLogLog sketch of the sites of each hash; sketches
merge map-side and across tasks, so a line in a third of all documents is a row
for each task.  Estimates well below ``min_sites`` are no boilerplate, those
well above are; lines within ``margin`` of the threshold get the exact number
of distinct sites.

Boilerplate lines are removed, unless a document has no other line with a
word: then the document itself is spread over sites (a copy, left to
near-duplicate removal), and its lines stay.

Nulls: a null text is empty, a null site counts for no line, a null doc_id is
an id like any other.  Empty lines are never removed.  Rows that repeat get the
same lines removed.  Other columns of ``docs`` stay as they are.  An empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientincome.llm.common import written

MIN_SITES = 10
MARGIN = 0.15  # beyond nine standard errors of a sketch with 2**12 registers
LG_K = 12
KEY = ["_ld_h1", "_ld_h2"]
ROW = ["_ld_r1", "_ld_r2"]


def _hashes(names: list[str], *columns: Column) -> list[Column]:
    return [F.xxhash64(*columns).alias(names[0]), F.xxhash64(F.lit("second"), *columns).alias(names[1])]


def _rows(docs: DataFrame, site: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    # equal rows have equal keys, and lose the same lines
    key = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("doc_id").isNull(), text]
    return docs.select(*_hashes(ROW, *key), F.col(site).alias("_ld_site"), text.alias("_ld_text"))


def lines(docs: DataFrame, site: str = "source") -> DataFrame:
    """(row key, site, position, line hash) of every line with a word."""
    exploded = _rows(docs, site).select(*ROW, "_ld_site", F.posexplode(F.split("_ld_text", "\n")).alias("_ld_pos", "_ld_line"))
    bare = F.expr("btrim(_ld_line, ' \\t\\r')")
    return exploded.where(bare != "").select(*ROW, "_ld_site", "_ld_pos", *_hashes(KEY, bare))


def boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, margin: float = MARGIN) -> DataFrame:
    """Hashes of the lines on ``min_sites`` sites or more."""
    each = lines(docs, site)
    spread = written(
        each.groupBy(*KEY)
        .agg(F.hll_sketch_agg("_ld_site", LG_K).alias("_ld_sketch"))
        .select(*KEY, F.hll_sketch_estimate("_ld_sketch").alias("_ld_sites"))
        .where(F.col("_ld_sites") >= min_sites * (1 - margin)),
        "line-spread",
    )
    sure = spread.where(F.col("_ld_sites") > min_sites * (1 + margin)).select(*KEY)
    near = spread.where(F.col("_ld_sites") <= min_sites * (1 + margin)).select(*KEY)
    exact = (
        each.join(near, KEY, "left_semi")
        .groupBy(*KEY)
        .agg(F.count_distinct("_ld_site").alias("_ld_sites"))
        .where(F.col("_ld_sites") >= min_sites)
        .select(*KEY)
    )
    return sure.unionByName(exact)


def dedup_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with boilerplate lines cut from ``text``, and the columns
    ``_ld_lines`` and ``_ld_removed`` (lines before, lines removed)."""
    common = written(boilerplate(docs, site, min_sites), "line-boilerplate")
    removed = (
        lines(docs, site)
        .join(common, KEY, "left_semi")
        .select(*ROW, "_ld_pos")
        .distinct()
        .groupBy(*ROW)
        .agg(F.collect_list("_ld_pos").alias("_ld_drop"))
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    key = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("doc_id").isNull(), text]
    h1, h2 = _hashes(ROW, *key)
    joined = docs.withColumns({ROW[0]: h1, ROW[1]: h2}).join(removed, ROW, "left")
    worded = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(" \t\r")) != "")
    own = F.size("_ld_drop") < F.size(worded)  # lines of its own are left
    rest = F.expr(
        "transform(array(split(text, '\\n')), ls -> "
        "array_join(transform(array_except(sequence(0, size(ls) - 1), _ld_drop), i -> ls[i]), '\\n'))[0]"
    )
    columns = [c for c in docs.columns if c != "text"]
    out = joined.select(
        *[F.col(f"`{c}`") for c in columns],
        F.when(own, rest).otherwise(F.col("text")).alias("text"),
        F.size(F.split(text, "\n")).alias("_ld_lines"),
        F.when(own, F.size("_ld_drop")).otherwise(0).alias("_ld_removed"),
    )
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], "_ld_lines", "_ld_removed")


def drop_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with boilerplate lines cut from ``text`` and n_chars as it then is."""
    out = dedup_lines(docs, site, min_sites)
    if "n_chars" in docs.columns:
        counted = F.when(F.col("_ld_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
        out = out.withColumn("n_chars", counted.otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
