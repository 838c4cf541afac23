"""Toxic passages by maximum-scoring segments over token log-odds.

Fit.  For the labelled documents the documents holding each token are counted
by class, and so are all tokens.  A token counts as evidence if its log-odds
under an informative Dirichlet prior (its corpus rate times ``prior``) exceed
their standard error by ``min_z``; only tokens of ``min_docs`` toxic documents
can.  Evidence tokens score the log of their rate in toxic over that in clean
documents, every other token the same log of the remaining rates, which is
below zero.

Scan.  All maximal-scoring segments of a document are found in one linear
pass (Ruzzo and Tompa) over its evidence tokens, the tokens between them
adding their common score.

Calibration.  Such scores follow an extreme-value law: lambda solves
sum p(s) exp(lambda s) = 1 over clean tokens, and K makes the mean of
K n exp(-lambda S) over clean documents 1.  A segment is significant if its
expected number E = K n exp(-lambda S) is below ``max_e``.  A document has two
features, ln(1 + 1/E) of its best segment and the sum of those of its
significant ones; a logistic regression on them gives the score.  Its training
features are scored with weights fitted without the document's fold.

At most ``max_labelled`` labelled documents (smallest hash of doc_id) are used
to fit; the fitted evidence has at most ``max_tokens`` tokens, which bounds the
broadcast.  Labels of one class only give that class's share as every score.

Nulls: a null text is empty, it holds no segment and scores the intercept;
null labels and null doc_ids teach nothing; a document labelled twice is toxic
if one label says so.  Empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientincome.llm.common import small_batches

TOKEN = re.compile(r"[^\W\d_]+")
FOLDS = 4


@dataclass(frozen=True)
class Params:
    prior: float = 500.0
    min_z: float = 3.0
    min_docs: int = 3
    max_e: float = 0.1
    max_labelled: int = 20_000
    max_tokens: int = 100_000


@dataclass
class Segments:
    """Scores of tokens and the law of their best segments."""

    weights: dict[str, float] = field(default_factory=dict)
    other: float = -1.0  # of a token without evidence
    lam: float = 1.0
    k: float = 1.0

    def find(self, text: str, max_e: float) -> tuple[int, list[tuple[int, int, float, float]]]:
        """Number of tokens, and (first, end, score, E) of each maximal segment with E < max_e."""
        tokens = TOKEN.findall(text.lower())
        n = len(tokens)
        get, found = self.weights, []
        hits = [(i, get[t]) for i, t in enumerate(tokens) if t in get]
        for first, end, score in maximal_segments(hits, self.other):
            e = self.k * n * math.exp(-self.lam * score)
            if e < max_e:
                found.append((first, end, score, e))
        return n, found

    def features(self, text: str, max_e: float) -> tuple[float, float, int]:
        n, found = self.find(text, math.inf)
        strength = [math.log1p(1 / max(e, 1e-300)) for _, _, _, e in found]
        sure = [s for s, (_, _, _, e) in zip(strength, found, strict=True) if e < max_e]
        return max(strength, default=0.0), sum(sure), len(sure)


def maximal_segments(hits: list[tuple[int, float]], other: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, end, score) of a row of tokens.

    ``hits``: (place, score) of the tokens with a score of their own, ascending;
    all others score ``other`` < 0.  Each candidate keeps the sum before it and
    at its end and the last candidate with a smaller sum before (its parent).
    """
    out: list[list] = []  # first, end, sum before, sum at end, parent
    total, at = 0.0, 0
    for i, s in hits:
        total += other * (i - at)
        at = i + 1
        before, total = total, total + s
        if s <= 0:
            continue
        new = [i, i + 1, before, total, -1]
        j = len(out) - 1
        while True:
            while j >= 0 and out[j][2] >= new[2]:
                j = out[j][4]
            if j < 0 or out[j][3] >= new[3]:
                new[4] = j
                out.append(new)
                break
            # it ends higher than candidate j: both and all between become one
            new[0], new[2], j2 = out[j][0], out[j][2], out[j][4]
            del out[j:]
            j = j2
    return [(c[0], c[1], c[3] - c[2]) for c in out]


def fitted(rows: list[tuple], docs: dict, tokens: dict, p: Params) -> Segments:
    """Weights from (token, clean docs, toxic docs, clean uses, toxic uses) and totals by class."""
    seg = Segments()
    if not docs[0] or not docs[1]:
        return seg
    both = docs[0] + docs[1]
    scored = []
    for token, c, t, uses_c, uses_t in rows:
        if t < p.min_docs:
            continue
        a = p.prior * (c + t) / both
        odds = [math.log((x + a) / (n + p.prior - x - a)) for x, n in ((t, docs[1]), (c, docs[0]))]
        z = (odds[0] - odds[1]) / math.sqrt(1 / (t + a) + 1 / (c + a))
        if z >= p.min_z:
            rate = (uses_c + uses_t) / (tokens[0] + tokens[1])
            smooth = [(u + 10 * rate) / (n + 10) for u, n in ((uses_c, tokens[0]), (uses_t, tokens[1]))]
            if smooth[1] > smooth[0]:
                scored.append((z, token, smooth[0], smooth[1]))
    scored = sorted(scored, reverse=True)[: p.max_tokens]
    if not scored:
        return seg
    clean, toxic = sum(x[2] for x in scored), sum(x[3] for x in scored)
    seg.weights = {token: math.log(t / c) for _, token, c, t in scored}
    seg.other = math.log((1 - toxic) / (1 - clean))
    # lambda: one positive root, by halving
    law = [(math.log(t / c), c) for _, _, c, t in scored] + [(seg.other, 1 - clean)]
    moment = lambda x: sum(q * math.exp(x * s) for s, q in law) - 1
    low, high = 1e-3, 50.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if moment(mid) < 0 else (low, mid)
    seg.lam = (low + high) / 2
    return seg


@dataclass
class Model:
    segments: Segments
    coefficients: tuple[float, float, float]
    params: Params

    def probability(self, best: float, total: float) -> float:
        b, c, a = self.coefficients
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, a + b * best + c * total))))


def _labelled(labels: DataFrame, train: Column | None, p: Params) -> DataFrame:
    """(doc_id, toxic, fold) of the labelled documents to fit on, at most ``max_labelled``."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    if train is not None:
        rows = rows.where(train)
    by_doc = rows.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    hashed = by_doc.withColumn("_h", F.xxhash64("doc_id"))
    kept = hashed.orderBy("_h", "doc_id").limit(p.max_labelled)
    return kept.select("doc_id", "toxic", F.pmod("_h", F.lit(FOLDS)).cast("int").alias("fold"))


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, params: Params = Params()) -> Model:
    """Fit on the labelled rows that ``train`` (a condition on doc_id) admits."""
    spark = docs.sparkSession
    small_batches(spark)
    chosen = _labelled(labels, train, params).toPandas()  # bounded by max_labelled
    few = F.broadcast(spark.createDataFrame(chosen.astype("int64"), "doc_id long, toxic long, fold long"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(few, "doc_id").cache()
    try:
        return _fit(rows, params)
    finally:
        rows.unpersist()


def _fit(rows: DataFrame, params: Params) -> Model:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["token", "toxic", "fold", "docs", "uses"]
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        for b in batches:
            seen: dict[tuple, list[int]] = {}
            for _, text, toxic, fold in zip(*(c.to_pylist() for c in b.columns), strict=True):
                tokens = TOKEN.findall(text.lower())
                uses: dict[str, int] = {"": len(tokens)}  # "" stands for the document
                for t in tokens:
                    uses[t] = uses.get(t, 0) + 1
                for t, n in uses.items():
                    x = seen.setdefault((t, toxic, fold), [0, 0])
                    x[0] += 1
                    x[1] += n
            out = [(*k, *v) for k, v in seen.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    schema = "token string, toxic int, fold int, docs long, uses long"
    counts = rows.select("doc_id", "text", "toxic", "fold").mapInArrow(count, schema)
    columns = [
        F.sum(F.when((F.col("toxic") == y) & (F.col("fold") == f), F.col(v)).otherwise(0)).alias(f"{v}_{y}_{f}")
        for v in ("docs", "uses") for y in (0, 1) for f in range(FOLDS)
    ]
    toxic_docs = sum(F.col(f"docs_1_{f}") for f in range(FOLDS))
    clean_docs = sum(F.col(f"docs_0_{f}") for f in range(FOLDS))
    table = counts.groupBy("token").agg(*columns)
    totals = table.where("token = ''").collect()
    if not totals:
        return Model(Segments(), (0.0, 0.0, -30.0), params)
    all_docs = {y: sum(totals[0][f"docs_{y}_{f}"] for f in range(FOLDS)) for y in (0, 1)}
    if not all_docs[0] or not all_docs[1]:
        return Model(Segments(), (0.0, 0.0, 30.0 if all_docs[1] else -30.0), params)
    # only tokens relatively as frequent in toxic documents can be evidence
    likely = toxic_docs * all_docs[0] > clean_docs * all_docs[1]
    evidence = table.where((F.col("token") != "") & (toxic_docs >= params.min_docs) & likely)
    evidence = evidence.orderBy(toxic_docs.desc(), "token").limit(4 * params.max_tokens).collect()

    def model(without: int | None) -> Segments:
        folds = [f for f in range(FOLDS) if f != without]
        part = lambda r, v, y: sum(r[f"{v}_{y}_{f}"] for f in folds)
        both = [{y: part(totals[0], v, y) for y in (0, 1)} for v in ("docs", "uses")]
        each = [(r["token"], *(part(r, v, y) for v in ("docs", "uses") for y in (0, 1))) for r in evidence]
        return fitted(each, both[0], both[1], params)

    final, held = model(None), [model(f) for f in range(FOLDS)]

    def lengths_and_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for _, text, toxic, fold in zip(*(c.to_pylist() for c in b.columns), strict=True):
                n, found = held[fold].find(text, math.inf)
                score = [s for _, _, s, _ in found]
                out.append((toxic, fold, n, score))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], k) for i, k in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64())))],
                ["toxic", "fold", "n", "scores"],
            )

    # a row for each labelled document used: bounded by max_labelled
    trained = rows.select("doc_id", "text", "toxic", "fold").mapInArrow(
        lengths_and_scores, "toxic int, fold int, n long, scores array<double>"
    ).collect()
    for f, seg in enumerate(held):
        seg.k = _k([(r["n"], max(r["scores"], default=0.0)) for r in trained if r["toxic"] == 0 and r["fold"] == f], seg.lam)
    final.k = float(np.median([s.k for s in held]))
    x, y = [], []
    for r in trained:
        seg = held[r["fold"]]
        strength = [math.log1p(math.exp(min(700.0, seg.lam * s)) / (seg.k * max(1, r["n"]))) for s in r["scores"]]
        floor = math.log1p(1 / params.max_e)
        x.append((max(strength, default=0.0), sum(s for s in strength if s > floor), 1.0))
        y.append(r["toxic"])
    return Model(final, _logistic(np.array(x), np.array(y, float)), params)


def _k(clean: list[tuple[int, float]], lam: float) -> float:
    """K n exp(-lambda S) has the mean 1 over clean documents with tokens."""
    values = [n * math.exp(-min(700.0, lam * s)) for n, s in clean if n]
    return 1 / max(1e-9, float(np.mean(values))) if values else 1.0


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float, float]:
    """Newton's method; the features are damped to sqrt-free units by a ridge."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.diag([1.0, 1.0, 0.0]) + 1e-9 * np.eye(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - penalty @ w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, w))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Rows (doc_id, score, n_passages, strength) for each row of ``docs``; no shuffle."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # at most max_tokens tokens

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            rows = []
            for text in b.column(1).to_pylist():
                best, total, n = m.segments.features(text or "", m.params.max_e)
                rows.append((m.probability(best, total), n, best))
            cols = [pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.float64(), pa.int32(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), *cols], ["doc_id", "score", "n_passages", "strength"])

    return docs.select("doc_id", "text").mapInArrow(scan, "doc_id long, score double, n_passages int, strength double")


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """Every significant toxic passage: (doc_id, first, end, score, e_value, text); first and end count tokens."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                _, found = m.segments.find(text or "", m.params.max_e)
                if found:
                    tokens = TOKEN.findall(text.lower())
                    rows += [(doc_id, f, t, s, e, " ".join(tokens[f:t])) for f, t, s, e in found]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["doc_id", "first", "end", "score", "e_value", "text"]
            )

    return docs.select("doc_id", "text").mapInArrow(scan, "doc_id long, first long, end long, score double, e_value double, text string")


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows that score 0.5 or more; all columns stay."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def toxic(texts):
        m = shared.value
        return texts.map(lambda t: m.probability(*m.segments.features(t or "", m.params.max_e)[:2])).astype("float64")

    return docs.where(toxic(F.coalesce("text", F.lit(""))) < 0.5)
