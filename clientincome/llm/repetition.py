"""Quality rules on repetition, by suffix arrays over words.

For the documents of an Arrow batch together, the suffixes of their words are
sorted by prefix doubling (suffixes of different documents never share a
rank), and the longest common prefix of neighbours follows from the ranks of
each doubling step.  The deepest LCP interval that holds the suffix at word i
has the length ``max(lcp before, lcp after)``: the longest string at i that
the document repeats.  The union of these spans, from ``min_repeat`` words on,
is that of all maximal repeated substrings; a document fails if it covers more
than the share ``max_covered`` of the words, or if the longest repeat holds more
than the share ``max_repeat`` of them and more than ``REPEAT_WORDS`` words.  Both
shares are well below the half that the base rule allows to words in repeated
3-word windows, so they reject texts that pass it.

Nulls and empty texts have no words and fail the base rule.  Rows with equal
or null doc_ids are judged one by one.  An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clientincome.llm.common import small_batches

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"  # fixed values of the rule
MIN_REPEAT = 5  # words of the shortest repeated substring that counts
MAX_COVERED = 0.2  # largest share of the words in repeated substrings
MAX_REPEAT = 0.05  # largest share of the words in one repeated substring; it covers twice that, so below half of MAX_COVERED
REPEAT_WORDS = 10  # a repeat up to this length never fails a text by itself
CHUNK_WORDS = 200_000  # words sorted together (a longer document goes alone)

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, covered_words long, longest_repeat long"
)


def longest_repeats(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each position, the length of the longest string there that its document repeats.

    ``words``: word numbers of the documents one after the other; ``doc``: the
    document number of each, ascending.
    """
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64)
    ends = np.searchsorted(doc, doc, "right")  # where each position's document ends

    def ranked(keys: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order of the keys, the rank of each group of equals, and which have company."""
        order = np.argsort(keys, kind="stable")
        k, b = keys[order], base[order]
        new = np.r_[True, k[1:] != k[:-1]]
        old = np.r_[True, b[1:] != b[:-1]]
        at = np.arange(len(k))
        rank = b + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(old, at, 0))
        alone = new & np.r_[new[1:], True]
        return order, rank, ~alone

    rank = np.zeros(n, np.int64)
    order, r, shared = ranked(doc.astype(np.int64) * (int(words.max()) + 1) + words, rank)
    rank[order] = r
    active, steps, h = order[shared], [rank.astype(np.int32)], 1
    while len(active):
        after = active + h
        inside = after < ends[active]
        second = np.where(inside, rank[np.minimum(after, n - 1)] + 1, 0)
        order, r, shared = ranked(rank[active] * (n + 1) + second, rank[active])
        rank = rank.copy()
        rank[active[order]] = r
        active = active[order][shared]
        steps.append(rank.astype(np.int32))
        h *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    # neighbours in the suffix array: add up the steps on which they still agree
    a, b = suffixes[:-1], suffixes[1:]
    lcp = np.zeros(n - 1, np.int64)
    for k in range(len(steps) - 1, -1, -1):
        x, y = a + lcp, b + lcp
        ok = (x < n) & (y < n)
        ok[ok] = steps[k][x[ok]] == steps[k][y[ok]]
        lcp[ok] += 1 << k
    longest = np.zeros(n, np.int64)
    longest[suffixes] = np.maximum(np.r_[0, lcp], np.r_[lcp, 0])
    return longest


def covered(longest: np.ndarray, least: int, length: int | None = None) -> np.ndarray:
    """Which positions lie in a repeated string of ``least`` words or more (cut to ``length``)."""
    n = len(longest)
    at = np.flatnonzero(longest >= least)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + (length or longest[at]), -1)
    return np.cumsum(edge[:n]) > 0


def judged(ids: list, texts: list[str], min_repeat: int, max_covered: float, max_repeat: float) -> list[tuple]:
    """Rows of SCHEMA for some whole documents."""
    split = [WORD.findall(t) for t in texts]
    sizes = np.array([len(w) for w in split])
    numbers: dict[str, int] = {}
    for w in split:
        for x in dict.fromkeys(w):
            numbers.setdefault(x, len(numbers))
    words = np.fromiter((numbers[x] for w in split for x in w), np.int64, int(sizes.sum()))
    doc = np.repeat(np.arange(len(split)), sizes)
    longest = longest_repeats(words, doc)
    per_doc = lambda mask: np.bincount(doc[mask], minlength=len(split))
    windows, spans = per_doc(covered(longest, 3, 3)), per_doc(covered(longest, min_repeat))
    most = np.zeros(len(split), np.int64)
    np.maximum.at(most, doc, longest)
    rows = []
    for i, (text, w) in enumerate(zip(texts, split, strict=True)):
        n = len(w)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        failed = n < 50 or 100 * int(windows[i]) > 50 * n
        fine = spans[i] <= max_covered * n and most[i] <= max(REPEAT_WORDS, max_repeat * n)
        rows.append(
            (ids[i], n, sum(map(len, w)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), int(windows[i]),
             failed, bool(not failed and fine), int(spans[i]), int(most[i]))
        )
    return rows


def quality(
    docs: DataFrame, min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED, max_repeat: float = MAX_REPEAT
) -> DataFrame:
    """One row of SCHEMA for each row of ``docs`` (doc_id, text); no shuffle."""
    small_batches(docs.sparkSession)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("doc_id", pa.int64())] + [(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
            + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("covered_words", pa.int64()), ("longest_repeat", pa.int64())]
        )
        for batch in batches:
            ids, texts, size = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(doc_id)
                texts.append(text or "")
                size += len(texts[-1]) // 4
                if size >= CHUNK_WORDS:
                    yield _batch(judged(ids, texts, min_repeat, max_covered, max_repeat), schema)
                    ids, texts, size = [], [], 0
            if ids:
                yield _batch(judged(ids, texts, min_repeat, max_covered, max_repeat), schema)

    return docs.select("doc_id", "text").mapInArrow(judge, SCHEMA)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
