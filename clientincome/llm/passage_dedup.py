"""Exact removal of repeated passages: a suffix order over the whole corpus.

A byte goes if a string of SPAN bytes that covers it also starts earlier in the
corpus (a smaller doc_id, or earlier in its document).  A suffix that begins
such a string is a repeat exactly if, with all suffixes sorted by their first
SPAN bytes and then by place, the one before it agrees on those bytes.  Sorting
every suffix of the corpus would move many times its bytes, so most are settled
through anchors first:

1. Anchors.  Each string of SPAN bytes holds a minimizer: of its GRAM-byte
   grams the one with the smallest hash.  Equal strings have it at the same
   place, so a string whose anchor's gram is found nowhere else is no repeat.
   An anchor stands for a run of neighbouring suffixes; its context is the text
   they cover.
2. Anchor suffixes are range-partitioned (splitters sampled by Spark) by gram,
   context and place, and sorted in their bucket.  Of equal contexts all but
   the first are repeats whole.  A first context whose gram has others beside
   it, or lies at the edge of its bucket, is undecided.
3. Undecided runs are cut in blocks of BLOCK suffixes, by their distance from
   the anchor, and settled in the same way: the bytes that all of a block's
   strings share take the place of the gram.
4. The suffixes of undecided blocks are range-partitioned by their leading
   bytes, fingerprint and place and sorted in their bucket; the first suffix of
   a bucket is compared with the last of the bucket before.

Buckets are sorted by multikey quicksort on eight-byte characters: by the
first column, then only ties by the next.  As the place is the last column, a
string found in every document is spread over many buckets.  Equality rests on
fingerprints of 64 bits beside the 64 bits of the gram or leading bytes.

Nulls: a null text is empty.  Texts shorter than SPAN lose nothing.  Rows that
repeat a doc_id, or have none, are documents one after the other, by hash of
the text, nulls first; rows equal in both are one document and get its result
each.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientincome.llm.common import discard, partitions, small_batches, written

SPAN = 100
GRAM = 24
BLOCK = 8
SLICE = 1 << 20  # bytes hashed together

_RANDOM = np.random.default_rng(7)
_BYTES = _RANDOM.integers(0, 2**64, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_PLACE_BITS = np.uint64(28)


def _powers(x: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, x, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Hashes:
    """Hashes of substrings of a slice, from one running sum."""

    powers = inverse = np.zeros(0, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(_Hashes.powers) < n:
            size = max(n, SLICE + 2 * SPAN)
            _Hashes.powers, _Hashes.inverse = _powers(_BASE, size), _powers(_INVERSE, size)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(_BYTES[data] * _Hashes.powers[: n - 1], out=self.sums[1:])

    def of(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (self.sums[end] - self.sums[first]) * _Hashes.inverse[first]
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
        return x ^ (x >> np.uint64(32))


def _slices(texts: list[bytes], span: int) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int, int]]]]:
    """Texts joined up to SLICE bytes, long ones in parts that overlap by span - 1:
    (bytes, [(text, its byte at the start, where that lies, suffixes)])."""
    held, parts, size = [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, len(text) - span + 1, SLICE):
            part = text[at : at + SLICE + span - 1]
            if size + len(part) > SLICE + span and held:
                yield np.frombuffer(b"".join(held), np.uint8), parts
                held, parts, size = [], [], 0
            parts.append((i, at, size, len(part) - span + 1))
            held.append(part)
            size += len(part)
    if held:
        yield np.frombuffer(b"".join(held), np.uint8), parts


def anchors(texts: list[bytes], span: int = SPAN, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (gram hash, context hash, text, run) of the anchors; see ``packed`` for runs."""
    for data, parts in _slices(texts, span):
        h = _Hashes(data)
        at = np.arange(len(data) - gram + 1)
        grams = h.of(at, at + gram)
        # smallest hash, leftmost among equals: the place fills the low bits
        low = (grams >> _PLACE_BITS << _PLACE_BITS) | at.astype(np.uint64)
        width, reach = span - gram + 1, 1
        least = low
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
        chosen = (least & np.uint64((1 << 28) - 1)).astype(np.int64)
        for i, start, where, n in parts:
            mine = chosen[where : where + n]
            first = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
            count = np.diff(np.r_[first, n])
            context = h.of(first + where, first + where + count + span - 1)
            yield grams[mine[first]], context, np.full(len(first), i), packed(first + start, mine[first] - where - first, count)


def packed(first: np.ndarray, ahead: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A run of ``count`` suffixes from byte ``first``, with its anchor ``ahead`` bytes on, in one number."""
    return (first * 128 + ahead) * 128 + count


def unpacked(run: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return run >> 14, (run >> 7) & 127, run & 127


def multikey_order(columns: list[np.ndarray]) -> np.ndarray:
    """Order of rows by their columns: each column sorts only the ties left by those before."""
    n = len(columns[0])
    order = np.argsort(columns[0], kind="quicksort")
    if n < 2:
        return order
    group = np.cumsum(np.r_[True, columns[0][order][1:] != columns[0][order][:-1]])
    for column in columns[1:]:
        tied = np.flatnonzero(np.r_[False, group[1:] == group[:-1]] | np.r_[group[1:] == group[:-1], False])
        if not len(tied):
            break
        rows, g = order[tied], group[tied]
        by = np.lexsort((column[rows], g))
        order[tied] = rows[by]
        value = column[order]
        group = np.cumsum(np.r_[True, (group[1:] != group[:-1]) | (value[1:] != value[:-1])])
    return order


def _arrays(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
    """The columns of a whole bucket; its size is that of a range partition."""
    held = list(batches)
    return [c.to_numpy() for c in pa.Table.from_batches(held).columns] if held else []


def _documents(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(place, text) of the distinct documents, and ``docs`` as (doc_id, place, text)."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    odd = rows.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    if odd.isEmpty():
        keyed = rows.withColumn("place", F.col("doc_id"))
        return keyed.select("place", "text"), keyed
    hashed = rows.withColumn("_h", F.sha2("text", 256))
    order = hashed.select("doc_id", "_h").distinct().repartitionByRange(partitions(docs.sparkSession), "doc_id", "_h")
    order = written(order.sortWithinPartitions("doc_id", "_h").withColumn("place", F.monotonically_increasing_id()), "pd-places")
    same = order.withColumnsRenamed({"doc_id": "_id", "_h": "_o"})
    keyed = hashed.join(same, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_o"))).select("doc_id", "place", "text")
    return keyed.select("place", "text").dropDuplicates(["place"]), keyed


RUNS = ["core", "context", "place", "run"]


def _anchor_table(texts: DataFrame, span: int, gram: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            place = b.column(0).to_numpy()
            for grams, context, i, run in anchors(b.column(1).to_pylist(), span, gram):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams.view(np.int64)), pa.array(context.view(np.int64)), pa.array(place[i]), pa.array(run)], RUNS
                )

    return texts.mapInArrow(find, "core long, context long, place long, run long")


def _runs(found: DataFrame, buckets: int) -> DataFrame:
    """(place, run, repeat): runs that are repeats whole, or undecided (repeat false).

    ``found``: (core, context, place, run), where equal strings have equal cores.
    """

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = _arrays(batches)
        n = len(columns[0]) if columns else 0
        if not n:
            return
        order = multikey_order(columns)
        core, context, place, run = (c[order] for c in columns)
        repeat = np.r_[False, (core[1:] == core[:-1]) & (context[1:] == context[:-1])]
        first = np.flatnonzero(~repeat)
        near = core[first][1:] == core[first][:-1]  # first contexts of one core
        undecided = np.r_[True, near] | np.r_[near, True]
        for rows, flag in ((np.flatnonzero(repeat), True), (first[undecided], False)):
            for k in range(0, len(rows), 100_000):
                some = rows[k : k + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place[some]), pa.array(run[some]), pa.array(np.full(len(some), flag))], ["place", "run", "repeat"]
                )

    ranged = found.repartitionByRange(buckets, *RUNS)
    return ranged.mapInArrow(settle, "place long, run long, repeat boolean")


def _expanded(texts: DataFrame, undecided: DataFrame, expand, schema: str) -> DataFrame:
    """``expand(bytes, first, ahead, count)`` gives arrays for the undecided runs of a text."""
    runs = undecided.groupBy("place").agg(F.collect_list("run").alias("runs"))
    names = [c.split()[0] for c in schema.split(", ")]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for place, text, held in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                first, ahead, count = unpacked(np.sort(held.values.to_numpy()))
                data, part = np.frombuffer(text, np.uint8), first // SLICE
                for k in np.unique(part):  # a long text is hashed slice by slice
                    mine, low = part == k, int(k) * SLICE
                    near = data[low : low + SLICE + 4 * SPAN]
                    *columns, at = expand(near, first[mine] - low, ahead[mine], count[mine])
                    at = at + (low << 14 if names[-1] == "run" else low)
                    columns = [c.view(np.int64) for c in columns] + [np.full(len(at), place), at]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return texts.join(runs, "place").select("place", "text", "runs").mapInArrow(each, schema)


def _suffixes_of(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of runs, and the number of the run of each."""
    run = np.repeat(np.arange(len(first)), count)
    return first[run] + np.arange(len(run)) - np.r_[0, np.cumsum(count)[:-1]][run], run


def _blocks(span: int):
    """Runs as (core, context, run) of their blocks; the core is what all strings of a whole block share."""

    def expand(data, first, ahead, count):
        at, run = _suffixes_of(first, count)
        anchor = (first + ahead)[run]
        block = (anchor - at) // BLOCK
        begin = np.flatnonzero(np.r_[True, (run[1:] != run[:-1]) | (block[1:] != block[:-1])])
        size = np.diff(np.r_[begin, len(at)])
        h, core = _Hashes(data), (anchor - BLOCK * block)[begin]
        cores = h.of(core, core + span - BLOCK + 1)
        context = h.of(at[begin], at[begin] + size + span - 1)
        return cores, context, packed(at[begin], (anchor - at)[begin], size)

    return expand


def _single(span: int):
    """Runs as (lead, print, first) of their suffixes."""

    def expand(data, first, _, count):
        at, _ = _suffixes_of(first, count)
        lead = np.zeros(len(at), np.uint64)
        for k in range(8):
            lead = lead << np.uint64(8) | data[at + k]
        return lead ^ np.uint64(1 << 63), _Hashes(data).of(at, at + span), at

    return expand


def _repeats(suffixes: DataFrame, buckets: int) -> DataFrame:
    """(place, first) of the suffixes that repeat an earlier one."""
    kinds = "bucket int, edge int, lead long, print long, place long, first long"

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        columns = _arrays(batches)
        n = len(columns[0]) if columns else 0
        if not n:
            return
        order = multikey_order(columns)
        lead, prints, place, first = (c[order] for c in columns)
        repeat = np.r_[False, (lead[1:] == lead[:-1]) & (prints[1:] == prints[:-1])]
        bucket = TaskContext.get().partitionId()
        # edge 1: the first suffix, 2: the last, 0: a repeat
        for rows, edge in ((np.array([0]), 1), (np.array([n - 1]), 2), (np.flatnonzero(repeat), 0)):
            for k in range(0, len(rows), 100_000):
                some = rows[k : k + 100_000]
                full = lambda v, some=some: pa.array(np.full(len(some), v, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [full(bucket), full(edge), *(pa.array(c[some]) for c in (lead, prints, place, first))],
                    ["bucket", "edge", "lead", "print", "place", "first"],
                )

    ranged = suffixes.repartitionByRange(buckets, "lead", "print", "place", "first")
    settled = written(ranged.mapInArrow(settle, kinds), "pd-settled")
    discard(suffixes)
    # two rows for each bucket: does its first suffix repeat the last of the bucket before?
    edges = sorted((r["bucket"], r["edge"], r["lead"], r["print"], r["place"], r["first"]) for r in settled.where("edge > 0").collect())
    across, last = [], None
    for _, edge, lead, prints, place, first in edges:
        if edge == 1 and last == (lead, prints):
            across.append((place, first))
        if edge == 2:
            last = (lead, prints)
    inside = settled.where("edge = 0").select("place", "first")
    return inside.unionByName(_table(inside, across)) if across else inside


def _table(like: DataFrame, rows: list[tuple]) -> DataFrame:
    return like.sparkSession.createDataFrame(rows, like.schema)


def remove_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) for each row of ``docs`` (doc_id, text).

    ``spans``: maximal removed runs of bytes as (first, end); ``kept``: the
    remaining bytes, which need not be whole characters.
    """
    spark = docs.sparkSession
    small_batches(spark)
    buckets = 2 * partitions(spark)
    texts, keyed = _documents(docs)
    schema = "core long, context long, place long, run long"
    whole, undecided = None, _anchor_table(texts, span, gram)
    for level in ("anchors", "blocks"):
        found = written(undecided, f"pd-{level}")
        runs = written(_runs(found, buckets), f"pd-{level}-settled")
        discard(found)
        repeats, left = runs.where("repeat").select("place", "run"), runs.where("not repeat").select("place", "run")
        whole = repeats if whole is None else whole.unionByName(repeats)
        undecided = _expanded(texts, left, _blocks(span), schema)
    suffixes = written(_expanded(texts, left, _single(span), "lead long, print long, place long, first long"), "pd-suffixes")
    single = _repeats(suffixes, buckets).select("place", (F.col("first") * (1 << 14) + 1).alias("run"))
    per_text = written(whole.unionByName(single).groupBy("place").agg(F.collect_list("run").alias("runs")), "pd-spans")
    joined = keyed.join(per_text, "place", "left").select("doc_id", "text", "runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            sizes, spans, kept = [], [], []
            for text, runs in zip(b.column(1).to_pylist(), b.column(2), strict=True):
                sizes.append(len(text))
                if not runs.is_valid:
                    spans.append([])
                    kept.append(text)
                    continue
                first, _, count = unpacked(runs.values.to_numpy())
                change = np.zeros(len(text) + 1, np.int64)
                np.add.at(change, first, 1)
                np.add.at(change, first + count + span - 1, -1)
                gone = np.cumsum(change) > 0
                edges = np.flatnonzero(np.diff(np.r_[False, gone[:-1], False].astype(np.int8))).reshape(-1, 2)
                spans.append([{"first": f, "end": e} for f, e in edges.tolist()])
                kept.append(np.frombuffer(text, np.uint8)[~gone[:-1]].tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"],
            )

    return joined.mapInArrow(cut, "doc_id long, n_bytes long, spans array<struct<first:long,end:long>>, kept binary")
