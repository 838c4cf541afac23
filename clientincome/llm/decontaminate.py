"""Benchmark decontamination by pigeonhole edit matching.

An item with the error budget e is cut into e + 1 pieces; a passage within e
edits of it leaves one of them untouched, so exact hits of the pieces (an
Aho-Corasick automaton over those of a block of items) give every place worth
a look.  There the item is compared with the text around by Myers'
bit-parallel distance, and counts if at most e edits away.  The pieces are the
leaves of a tree in which k + 1 neighbours may hold k edits: by the same
pigeonhole one hit piece has all nodes above it within their budgets, so the
short ones are compared first and most chance hits end there.

Both sides are compared in lower case, with each run of characters other than
letters and digits as one space.  The budget is ``error_rate`` of an item's
length.  Items with fewer than ``min_chars`` characters have no budget: those of
MIN_WORDS words or more are found as whole words anywhere in a text, the first
such place counts; shorter ones are no evidence within a longer text and match
whole documents only.

The items are the stated query set: they are read in blocks of at most
``BLOCK_CHARS`` characters, each sent to the tasks and matched against all
documents; a larger benchmark takes more passes.

Nulls: null or empty texts match nothing and items without text are none;
items with the same id each count; null and repeated doc_ids are matched row
by row (hits carry the row's doc_id).  An empty table on either side gives no hits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientincome.llm.common import small_batches

ERROR_RATE = 0.08
MIN_CHARS = 24
MIN_WORDS = 4
BLOCK_CHARS = 400_000

HITS = "doc_id long, item_id long, distance int, start long, n_chars long"
_MARKS = re.compile(r"[\W_]+")


def normal(text: str) -> str:
    return _MARKS.sub(" ", text.lower()).strip()


def myers(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """Least edit distance of ``pattern`` to a substring of ``text`` and where that ends; None above ``most``.

    A column of the distance table is held as two bit sets of its vertical
    differences, +1 and -1, one bit for each pattern character.
    """
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, distance = full, 0, m
    best = (most + 1, -1)
    get = masks.get
    for at, c in enumerate(text):
        eq = get(c, 0)
        zero = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | (full & ~(zero | plus))
        down = plus & zero
        if up & high:
            distance += 1
        elif down & high:
            distance -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus = down | (full & ~(zero | up))
        minus = up & zero
        if distance < best[0]:
            best = (distance, at + 1)
    return best if best[0] <= most else None


def nodes(m: int, leaves: int) -> list[list[tuple[int, int, int]]]:
    """For each of the pieces of m characters, (first, end, edits) of it and the nodes above it, the whole last."""
    edges = [i * m // leaves for i in range(leaves + 1)]
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(leaves)]

    def split(low: int, high: int) -> None:
        if high - low > 1:
            middle = (low + high) // 2
            split(low, middle)
            split(middle, high)
        for i in range(low, high):
            out[i].append((edges[low], edges[high], high - low - 1))

    split(0, leaves)
    return out


class Matcher:
    """The pieces of a block of items (item_id, normal text)."""

    def __init__(self, items: list[tuple], error_rate: float, min_chars: int):
        import ahocorasick

        self.items = []
        self.whole: dict[str, list[int]] = {}
        self.words = ahocorasick.Automaton()  # short items, a space on either side
        pieces: dict[str, list[tuple[int, int, list]]] = {}
        for item_id, text in items:
            k, m = len(self.items), len(text)
            errors = int(error_rate * m)
            self.items.append((item_id, text, errors))
            if m < min_chars:
                self.whole.setdefault(text, []).append(k)
                if text.count(" ") + 1 >= MIN_WORDS:
                    self.words.add_word(f" {text} ", text)
                continue
            for i, above in enumerate(nodes(m, errors + 1)):
                a, b, _ = above[0]
                pieces.setdefault(text[a:b], []).append((k, a, above[1:]))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self.automaton.add_word(piece, (len(piece), owners))
        for automaton in (self.automaton, self.words):
            if len(automaton):
                automaton.make_automaton()

    def near(self, text: str, k: int, start: int, above: list) -> tuple[int, int] | None:
        """Distance and end of item k near ``start``, if the nodes above a hit piece keep their budgets."""
        item, got = self.items[k][1], None
        if start >= 0 and text.startswith(item, start):
            return 0, start + len(item)
        for a, b, edits in above:
            low = max(0, start + a - edits)
            got = myers(item[a:b], text[low : start + b + edits], edits)
            if got is None:
                return None
        return (got[0], low + got[1]) if got else None

    def hits(self, text: str) -> list[tuple]:
        """(item_id, distance, start, chars) of each item that the text holds, at its best place."""
        text = normal(text)
        places = {text: 0} if text in self.whole else {}
        if len(self.words):
            for end, item in self.words.iter(f" {text} "):
                places.setdefault(item, end - 1 - len(item))
        found = [(self.items[k][0], 0, at, len(item)) for item, at in places.items() for k in self.whole[item]]
        best: dict[int, tuple[int, int]] = {}
        seen: set[tuple[int, int]] = set()
        if len(self.automaton):
            for end, (length, owners) in self.automaton.iter(text):
                for k, a, above in owners:
                    start = end + 1 - length - a  # where the item would begin
                    if (k, start) not in seen and best.get(k, (1,))[0]:
                        got = self.near(text, k, start, above)
                        if got:
                            seen.add((k, start))
                            best[k] = min(got, best.get(k, got))
        for k, (distance, at) in best.items():
            item_id, item, _ = self.items[k]
            first = max(0, at - len(item))
            found.append((item_id, distance, first, at - first))
        return found


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple]]:
    block, size = [], 0
    rows = benchmark.where(F.length(F.trim("text")) > 0).select("item_id", "text").distinct()
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        text = normal(r["text"])
        if text:
            block.append((r["item_id"], text))
            size += len(text)
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row of HITS for each document and benchmark item it holds; no shuffle."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select("doc_id", "text")

    def matches(items: list[tuple]):
        shared = spark.sparkContext.broadcast((items, error_rate, min_chars))
        built: list[Matcher] = []

        def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if not built:
                built.append(Matcher(*shared.value))
            for b in batches:
                rows = []
                for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    rows += [(doc_id, *h) for h in built[0].hits(text or "")]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["doc_id", "item_id", "distance", "start", "n_chars"]
                )

        return match

    parts = [texts.mapInArrow(matches(items), HITS) for items in _blocks(benchmark)]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], HITS)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns stay."""
    spark = docs.sparkSession
    small_batches(spark)
    for items in _blocks(benchmark):
        shared = spark.sparkContext.broadcast((items, how.get("error_rate", ERROR_RATE), how.get("min_chars", MIN_CHARS)))
        docs = docs.where(~_holds(shared)(F.coalesce("text", F.lit(""))))
    return docs


def _holds(shared):
    built: list[Matcher] = []

    @F.pandas_udf("boolean")
    def holds(texts):
        if not built:
            built.append(Matcher(*shared.value))
        return texts.map(lambda t: bool(built[0].hits(t))).astype("bool")

    return holds
