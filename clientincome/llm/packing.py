"""Best-fit packing after Martello-Toth dominance reduction.

Documents are tokenized, those longer than a sequence are cut, and the pieces
packed into sequences of ``capacity`` tokens.  Lengths are whole numbers up to
the capacity, so the instance is a histogram of at most ``capacity`` rows,
whatever the corpus holds; the reduction and the best fit work on it with
multiplicities, and Spark then deals the pieces to the places planned.

Reduction (``plan``): the largest length s left is considered with everything
that could join it.  A set {s, r} dominates all other sets with s when r fills
the sequence, or when r is the longest that fits and no two lengths left fit
beside s together: in any other bin with s all that joins it can change places
with r.  Alike, s alone dominates when nothing fits.  Such bins are fixed for
as many copies as there are; the rest goes to best fit decreasing.

Nulls: a null text is empty (one end id).  Null and repeated doc_ids are
packed as rows of their own.  An empty table gives no rows.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientincome.llm.common import partitions, small_batches, text_or_empty, written
from clientincome.llm.tokens import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """One row per piece; of a long document the first piece may be shorter."""
    small_batches(docs.sparkSession)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).many, struct.pack("<I", end_id)
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()), strict=True):
                ids += end
                n = len(ids) // 4
                edges = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    rows.append((doc_id, i, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names
            )

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(pieces, PIECES)


class Sizes:
    """The lengths left with their counts, searchable in order."""

    def __init__(self, counts: dict[int, int]):
        self.count = {s: c for s, c in counts.items() if c}
        self.order = sorted(self.count)

    def at_most(self, room: int, without: dict[int, int]) -> int:
        """The longest length <= room of which more are left than ``without`` takes; 0 if none."""
        i = bisect_left(self.order, room + 1) - 1
        while i >= 0 and self.count[self.order[i]] <= without.get(self.order[i], 0):
            i -= 1
        return self.order[i] if i >= 0 else 0

    def shortest(self, n: int, without: dict[int, int]) -> list[int]:
        """The n shortest lengths left, copies counted, beside ``without``."""
        out: list[int] = []
        for s in self.order:
            out += [s] * min(n - len(out), self.count[s] - without.get(s, 0))
            if len(out) >= n:
                break
        return out

    def take(self, s: int, n: int) -> None:
        self.count[s] -= n
        if not self.count[s]:
            del self.count[s]
            self.order.remove(s)


def dominant(left: Sizes, s: int, capacity: int) -> tuple[int, ...] | None:
    """A set with s of at most two that provably dominates every other one, or None."""
    room = capacity - s
    r = left.at_most(room, {s: 1})
    if r == 0 or r == room:
        return (s, r) if r else (s,)
    two = left.shortest(2, {s: 1})
    if len(two) < 2 or sum(two) > room:
        return (s, r)
    return None


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], int]:
    """Bins as (lengths, how many such bins), and how many bins the reduction fixed."""
    left = Sizes(histogram)
    bins: list[tuple[tuple[int, ...], int]] = []
    fixed = 0
    for s in sorted(left.count, reverse=True):
        while left.count.get(s) and (chosen := dominant(left, s, capacity)):
            uses = Counter(chosen)
            n = min(left.count[x] // k for x, k in uses.items())
            for x, k in uses.items():
                left.take(x, n * k)
            bins.append((chosen, n))
            fixed += n
    # best fit decreasing over groups of equal bins
    open_bins: dict[int, list[list]] = {}  # room -> [[lengths, how many], ...]
    rooms: list[int] = []  # ascending

    def put(room: int, lengths: tuple[int, ...], n: int) -> None:
        if room not in open_bins:
            open_bins[room] = []
            rooms.insert(bisect_left(rooms, room), room)
        open_bins[room].append([lengths, n])

    for s in sorted(left.count, reverse=True):
        n = left.count[s]
        while n:
            i = bisect_left(rooms, s)
            if i == len(rooms):
                each = capacity // s
                if n >= each:
                    put(capacity - each * s, (s,) * each, n // each)
                if n % each:
                    put(capacity - n % each * s, (s,) * (n % each), 1)
                n = 0
                continue
            room = rooms[i]
            group = open_bins[room][-1]
            used = min(n, group[1])
            lengths = group[0]
            group[1] -= used
            if not group[1]:
                open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(i)
            put(room - s, (*lengths, s), used)
            n -= used
    bins += [(g[0], g[1]) for groups in open_bins.values() for g in groups]
    return bins, fixed


def places(spark: SparkSession, bins: list[tuple[tuple[int, ...], int]]) -> DataFrame:
    """For each length, which ranks go to which sequences: (length, first_rank, n, first_sequence, offset).

    Rows: one for each distinct pattern slot of the plan, so the table is bounded
    by the capacity and not by the corpus.
    """
    rows, used, sequence = [], Counter(), 0
    for lengths, n in bins:
        offset = 0
        for s in lengths:
            rows.append((s, used[s], n, sequence, offset))
            used[s] += n
            offset += s
        sequence += n
    schema = "length long, first_rank long, n long, first_sequence long, offset long"
    return spark.createDataFrame(rows, schema)


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048, checksums: bool = True) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset)."""
    spark = docs.sparkSession
    pieces = written(cut(docs, tokenizer, end_id, capacity), "pack-pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    if not histogram:
        return spark.createDataFrame([], PIECES + ", sequence_id long, offset long")
    bins, _ = plan(histogram, capacity)

    # rank among equal lengths: place in the sorted table less the shorter pieces
    ordered = pieces.repartitionByRange(partitions(spark), "length", "doc_id", "piece", "ids_crc32")
    ordered = ordered.sortWithinPartitions("length", "doc_id", "piece", "ids_crc32")
    numbered = written(
        ordered.withColumn("_n", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_n", 33))
        .withColumn("_row", F.col("_n").bitwiseAND((1 << 33) - 1))
        .drop("_n"),
        "pack-order",
    )
    parts, at = [], 0  # one row for each partition
    for r in numbered.groupBy("_part").count().orderBy("_part").collect():
        parts.append((r["_part"], at))
        at += r["count"]
    shorter, below = [], 0
    for s in sorted(histogram):
        shorter.append((s, below))
        below += histogram[s]
    ranked = (
        numbered.join(F.broadcast(spark.createDataFrame(parts, "_part long, _first long")), "_part")
        .join(F.broadcast(spark.createDataFrame(shorter, "length long, _below long")), "length")
        .withColumn("_rank", F.col("_first") + F.col("_row") - F.col("_below"))
    )
    slots = F.broadcast(
        places(spark, bins)
        .groupBy("length")
        .agg(F.collect_list(F.struct("first_rank", "n", "first_sequence", "offset")).alias("_slots"))
    )
    return ranked.join(slots, "length").withColumn(
        # the one slot that holds the rank
        "_slot", F.expr("filter(_slots, x -> x.first_rank <= _rank and _rank < x.first_rank + x.n)[0]")
    ).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("_slot.first_sequence") + F.col("_rank") - F.col("_slot.first_rank")).alias("sequence_id"),
        F.col("_slot.offset").alias("offset"),
    )
