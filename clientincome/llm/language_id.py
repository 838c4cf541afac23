"""Language identification by segmentation-marginalised unigrams.

A word is a run of a-z and of characters beyond ASCII, lower-cased, with a space
before it, as UTF-8 bytes.  Its pieces come from a fixed public vocabulary of
byte strings that holds every single byte, so each word has segmentations.  A
language has a probability for each piece; the probability of a word is the sum
over all its segmentations of the product of their pieces (forward algorithm),
that of a text the product over its words.

Learning (``fit``).  Distinct words are counted by language over all learning
rows; expectation maximisation then gives each piece its expected count in each
language (forward and backward sums over all segmentations, not one best).
Counts of words and pieces come from all learning rows and grow with them.
Probabilities are smoothed towards those of all languages together, so an
unseen piece costs the same everywhere.

Scoring (``identify``).  Whole texts; a word is scored once by a worker and
then remembered.  The score is the probability of the predicted language given
the text, with the languages' shares of the learning rows as a prior.  Words of one
length are summed together: their spans are hashed (64 bits) side by side and
looked up in the vocabulary's table of hashes.

Sizes.  The model has a float for each piece and language: it is the only thing
that passes through the driver, and is bounded by the vocabulary times the
number of languages, not by the corpus.  Words longer than LONG bytes are
summed position by position, with a few rows of state.

Nulls: a text that is null or has no letter gives ``und`` and 0; rows of null
text or lang teach nothing; a null doc_id is scored like any other.  Repeated
rows count again.  Equal probabilities go to the smallest language name.
Without learning rows every text is ``und``.  An empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientincome.llm.common import discard, open_read, small_batches, written

UNKNOWN = "und"
ROUNDS = 2  # of expectation maximisation
TOWARDS_ALL = 200.0  # pieces' worth of all languages together in each language
ADDED = 0.1  # added to the count of every piece in all languages together
LONGEST = 24  # bytes of a piece that is used
LONG = 64  # bytes of a word that is summed together with others of its length
HELD_WORDS = 400_000  # distinct words that a task counts before it hands them on
CACHED_WORDS = 1_000_000  # words whose sums a worker remembers (about 150 bytes each)
TOGETHER = 2_000  # words of equal length summed at a time

_FACTOR, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_CELLS = 1 << 19  # of the table of hashes; a sixth of them hold a piece at most
# a-z and what is beyond ASCII stay, A-Z become a-z, the rest of ASCII parts words
_FOLD = bytes(c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


class Vocabulary:
    """The byte strings of a rank file, numbered from 0; ``none`` stands for no piece."""

    def __init__(self, path: str):
        with open_read(path) as f:
            pieces = sorted(base64.b64decode(line.split()[0]) for line in f.read().splitlines() if line)
        pieces = [p for p in pieces if len(p) <= LONGEST]
        self.number = {p: i for i, p in enumerate(pieces)}
        missing = [b for b in range(256) if bytes([b]) not in self.number]
        if missing:
            raise ValueError(f"{path}: no pieces for the bytes {missing[:5]}")
        if 6 * len(pieces) > _CELLS:
            raise ValueError(f"{path}: more than {_CELLS // 6} pieces")
        self.none = len(pieces)
        self.longest = max(map(len, pieces))
        # open addressing: a piece lies in its cell or in one of the next ``probes``
        self.hashes, self.at = np.zeros(_CELLS + 64, np.uint64), np.full(_CELLS + 64, self.none, np.int32)
        self.probes = 1
        for p, i in self.number.items():
            h = 0
            for c in p:
                h = ((h + c + 1) * int(_FACTOR)) % 2**64
            cell = first = self._cell(np.array([h], np.uint64))[0]
            while self.at[cell] != self.none:
                cell += 1
            self.hashes[cell], self.at[cell] = h, i
            self.probes = max(self.probes, int(cell - first) + 1)

    @staticmethod
    def _cell(h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(31))) * _MIX >> np.uint64(45)).astype(np.intp)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``h`` that are the hash of a piece, ascending, and the pieces."""
        cell = self._cell(h)
        found, where = np.full(len(h), self.none, np.int32), np.arange(len(h))
        for _ in range(self.probes):
            taken = self.at[cell] != self.none  # behind an empty cell lies nothing
            where, cell = where[taken], cell[taken]
            if not len(where):
                break
            hit = self.hashes[cell] == h[where]
            found[where[hit]] = self.at[cell[hit]]
            where, cell = where[~hit], cell[~hit] + 1
        where = np.flatnonzero(found != self.none)
        return where, found[where]


_VOCABULARIES: dict[str, Vocabulary] = {}


def _vocabulary(path: str) -> Vocabulary:
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as the model sees them, without the space; none if the text has no letter."""
    words = (text or "").lower().encode("utf-8", "replace").translate(_FOLD).split()
    if words and not any(w.isascii() for w in words) and not any(map(str.isalpha, text)):
        return []  # signs beyond ASCII alone
    return words


# ---------------------------------------------------------------- segmentations
class Segmentations:
    """Sums over all segmentations of words under piece probabilities (pieces + 1, languages).

    The last row of ``p`` is zero: a string that is no piece.
    """

    def __init__(self, vocabulary: Vocabulary, p: np.ndarray):
        self.v, self.p = vocabulary, p

    def _pieces(self, words: list[bytes]) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
        """Of words of one length: (start, end) -> which words have a piece there, and the pieces; in the order of ends."""
        n = len(words[0])
        chars = np.frombuffer(b"".join(words), np.uint8).reshape(-1, n).astype(np.uint64).T + np.uint64(1)
        found = {}
        for start in range(n):
            h = np.zeros(len(words), np.uint64)
            for end in range(start + 1, min(n, start + self.v.longest) + 1):
                h = (h + chars[end - 1]) * _FACTOR
                where, ids = self.v.find(h)
                if len(where):
                    found[start, end] = where, ids
        return dict(sorted(found.items(), key=lambda x: x[0][::-1]))

    def _alike(self, words: list[bytes]) -> Iterator[list[int]]:
        """Places of words of one length, TOGETHER at most."""
        by: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by.setdefault(len(w), []).append(i)
        for some in by.values():
            for k in range(0, len(some), TOGETHER):
                yield some[k : k + TOGETHER]

    def log_sums(self, words: list[bytes]) -> np.ndarray:
        """The log of the sum over all segmentations, (words, languages)."""
        out = np.empty((len(words), self.p.shape[1]))
        for some in self._alike(words):
            n = len(words[some[0]])
            if n > LONG:
                for i in some:
                    out[i] = self._long(words[i])
                continue
            spans = self._pieces([words[i] for i in some])
            out[some] = np.log(self._forward(spans, n, len(some))[n])
        return out

    def _forward(self, spans, n: int, count: int) -> np.ndarray:
        a = np.zeros((n + 1, count, self.p.shape[1]))
        a[0] = 1.0
        for (start, end), (where, ids) in spans.items():  # in the order of their ends
            a[end, where] += a[start, where] * self.p[ids]
        return a

    def _long(self, word: bytes) -> np.ndarray:
        """Position by position; the last ``longest`` sums, rescaled as they go."""
        get, longest = self.v.number.get, self.v.longest
        recent, scale = [np.ones(self.p.shape[1])], np.zeros(self.p.shape[1])
        for end in range(1, len(word) + 1):
            total = np.zeros(self.p.shape[1])
            for back in range(1, min(longest, end) + 1):
                if (i := get(word[end - back : end])) is not None:
                    total += recent[-back] * self.p[i]
            recent.append(total)
            if len(recent) > longest:
                recent.pop(0)
            if end % 16 == 0:
                recent = [r / total for r in recent]
                scale += np.log(total)
        return scale + np.log(recent[-1])

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """The expected counts of the pieces, (pieces + 1, languages), of words that occur ``counts`` (words, languages) times."""
        out = np.zeros_like(self.p)
        for some in self._alike(words):
            n = len(words[some[0]])
            # long words in parts: a part is a word of its own here
            pieces = [[words[i][k : k + LONG] for k in range(0, n, LONG)] for i in some]
            for part in zip(*pieces, strict=True):
                spans = self._pieces(list(part))
                a = self._forward(spans, len(part[0]), len(part))
                b = np.zeros_like(a)
                b[-1] = 1.0
                for (start, end), (where, ids) in reversed(spans.items()):
                    b[start, where] += b[end, where] * self.p[ids]
                weight = counts[some] / a[-1]
                shares = [weight[where] * a[start, where] * self.p[ids] * b[end, where] for (start, end), (where, ids) in spans.items()]
                pieces_at, shares = np.concatenate([ids for _, ids in spans.values()]), np.concatenate(shares)
                for lang in range(out.shape[1]):
                    out[:, lang] += np.bincount(pieces_at, shares[:, lang], len(out))
        return out


# --------------------------------------------------------------------- learning
class Model(NamedTuple):
    """``languages`` ascending; ``log_prior`` of each; ``p``: (pieces + 1, languages), shared with the workers."""

    vocabulary: str
    languages: list[str]
    log_prior: np.ndarray
    p: Broadcast | None


def word_counts(docs: DataFrame, learn: Column) -> DataFrame:
    """(lang, word, n) over the rows of ``docs`` (doc_id, text, lang) for which ``learn`` holds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for lang, words in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(words), pa.string()), pa.array(list(words), pa.binary()), pa.array(list(words.values()), pa.int64())],
                    ["lang", "word", "n"],
                )
            held.clear()

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, held.values())) > HELD_WORDS:
                yield from counted()
        yield from counted()

    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    return rows.mapInArrow(count, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, learn: Column, vocabulary: str) -> Model:
    """A model of the languages of those rows of ``docs`` (doc_id, text, lang) for which ``learn`` holds."""
    spark = docs.sparkSession
    small_batches(spark)
    shares = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).groupBy("lang").count()
    shares = {r["lang"]: r["count"] for r in shares.collect()}  # a row for each language
    languages = sorted(shares)
    if not languages:
        return Model(vocabulary, [], np.zeros(0), None)
    by_word = word_counts(docs, learn).groupBy("word").agg(F.collect_list(F.struct("lang", "n")).alias("ns"))  # a language once
    words = written(by_word, "lang-words")
    pieces = _vocabulary(vocabulary).none
    place = {lang: i for i, lang in enumerate(languages)}
    p = np.full((pieces + 1, len(languages)), 1.0 / pieces)
    p[-1] = 0.0
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(p)

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            sums, total = Segmentations(_vocabulary(vocabulary), shared.value), np.zeros_like(shared.value)
            words: list[bytes] = []
            counts: list[tuple[int, int, int]] = []  # word, language, how often

            def add() -> None:
                if words:
                    n = np.zeros((len(words), len(languages)))
                    word, lang, each = np.array(counts).T
                    n[word, lang] = each
                    np.add(total, sums.expected(words, n), out=total)
                    words.clear()
                    counts.clear()

            for b in batches:
                for word, ns in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    counts += [(len(words), place[x["lang"]], x["n"]) for x in ns]
                    words.append(b" " + word)
                if len(words) > 20 * TOGETHER:
                    add()
            add()
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(total[piece, lang])], ["piece", "lang", "n"]
            )

        # a task gives as many rows as the model has at most
        summed = words.mapInArrow(expect, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toArrow()
        counts = np.zeros_like(p)
        counts[summed["piece"].to_numpy(), summed["lang"].to_numpy()] = summed["n"].to_numpy()
        p = _smoothed(counts)
        shared.unpersist()
    discard(words)
    n = np.array([shares[x] for x in languages], float)
    return Model(vocabulary, languages, np.log(n / n.sum()), spark.sparkContext.broadcast(p))


def _smoothed(counts: np.ndarray) -> np.ndarray:
    """Probabilities of the pieces in each language from their counts; the last row stays zero."""
    every = counts[:-1].sum(1) + ADDED
    every /= every.sum()
    p = np.zeros_like(counts)
    p[:-1] = (counts[:-1] + TOWARDS_ALL * every[:, None]) / (counts[:-1].sum(0) + TOWARDS_ALL)
    return p


# ---------------------------------------------------------------------- scoring
class Scorer:
    """Log probabilities of texts; a word is summed the first time a worker meets it."""

    def __init__(self, model: Model):
        self.sums = Segmentations(_vocabulary(model.vocabulary), model.p.value)
        self.prior = model.log_prior
        self.row: dict[bytes, int] = {}  # word -> its row in logs
        self.logs = np.empty((0, len(model.languages)), np.float32)

    def _learn(self, new: list[bytes]) -> None:
        n = len(self.row)
        if n + len(new) > len(self.logs):
            larger = np.empty((2 * n + len(new), self.logs.shape[1]), np.float32)
            larger[:n] = self.logs[:n]
            self.logs = larger
        self.logs[n : n + len(new)] = self.sums.log_sums([b" " + w for w in new])
        self.row.update(zip(new, range(n, n + len(new)), strict=True))

    def of(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """The log probability of each text and language; None without a word."""
        split = [words_of(t) for t in texts]
        new = sorted(set().union(*split).difference(self.row))
        self._learn(new)
        out: list[np.ndarray | None] = []
        for words in split:
            at = np.fromiter(map(self.row.__getitem__, words), np.intp, len(words))
            out.append(self.prior + self.logs[at].sum(0, dtype=np.float64) if words else None)
        if len(self.row) > CACHED_WORDS:
            for w in new:
                del self.row[w]
        return out


_SCORERS: dict[int, Scorer] = {}


def _scorer(model: Model) -> Scorer:
    """The worker's scorer for a model, kept between tasks; an earlier model's goes."""
    key = id(model.p.value)
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(model)
    return _SCORERS[key]


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs`` (doc_id, text)."""
    small_batches(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model) if model.languages else None
        for b in batches:
            texts, found, scores = b.column(1).to_pylist(), [], []
            for x in scorer.of(texts) if scorer else [None] * len(texts):
                best = None if x is None else int(x.argmax())
                found.append(UNKNOWN if best is None else model.languages[best])
                scores.append(0.0 if best is None else float(1.0 / np.exp(x - x[best]).sum()))
            columns = [b.column(0).cast(pa.int64()), pa.array(found, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, lang_pred string, score double")
