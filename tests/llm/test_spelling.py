"""Spelling variants against counts and pairs by brute force."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest

from clientincome.llm import queries, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(docs) -> dict[str, int]:
    out = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(n: dict[str, int]) -> set[tuple]:
    form, n_near = {}, {}
    for w in n:
        close = [v for v in n if near(w, v)]
        n_near[w] = len(close)
        best = min(close, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], n_near[w], n.get(form[w])))
    return out


def query(spark, docs, folder, schema="doc_id long, text string"):
    spark.createDataFrame(docs, schema).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return queries.op13_spelling_variants(spark, str(folder))


def made(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcdeéÿ×", k=rng.randint(5, 9))) for _ in range(40)]
    docs = []
    for d in range(80):
        words = []
        for _ in range(60):
            w = rng.choice(base)
            if rng.random() < 0.3:
                i = rng.randrange(len(w))
                w = w[:i] + rng.choice(["", rng.choice("abcÿ"), w[i] + rng.choice("abé")]) + w[i + 1 :]
            words.append(w.upper() if rng.random() < 0.1 else w)
        docs.append((d, rng.choice([" ", ", ", "\n", "1"]).join(words)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_equal_brute_force(spark, tmp_path, seed):
    docs = [*made(seed), (None, "nullo nullo nullo nulla nulla nulla"), (81, None), (82, ""), (83, " 12 ."), (82, "again again again again")]
    docs.append((84, "kette " * 4 + "ketten " * 9 + "kettenz " * 20 + "xkettenz " * 45))
    want = expected(counts(docs))
    assert len(want) > 100 and any(r[1] for r in want) and any(r[1] and r[2] != r[1] for r in want)
    assert {tuple(r) for r in query(spark, docs, tmp_path).collect()} == want


def test_spoilt_words(spark):
    docs = [(d, "Ortografía común") for d in range(400)]
    got = Counter(r["word"] for r in spelling.occurrences(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert sum(got.values()) == 800 and len(got) > 2
    assert {w: n for w, n in got.items() if len(w) >= 5 and n >= 3} == counts(docs)


def test_all_signatures_of_near_words_meet(spark):
    """Each kind of edit in every pair of parts of the alphabet is found once."""
    letters = spelling._ALPHABET[:60]
    n = {"stamm" + a + "ung": i + 1 for i, a in enumerate(letters)}
    n |= {"stammung": 500, "stammungen": 3}
    rows = spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long")).collect()
    want = {r[0]: (r[1], r[2], r[4]) for r in expected(n)}
    assert {r["word"]: (r["form"], r["root"], r["n_near"]) for r in rows} == want and len(rows) == len(n)


def test_long_words_and_one_letter(spark):
    n = {"a" * 4000: 9, "a" * 3999: 3, "a" * 4001: 50, "a" * 2000 + "b" + "a" * 1999: 4, "ab" * 1500: 1, "ba" * 1500: 7}
    rows = spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long")).collect()
    want = {r[0]: (r[1], r[2], r[4]) for r in expected(n)}
    assert {r["word"]: (r["form"], r["root"], r["n_near"]) for r in rows} == want


def test_empty_tables_and_extra_columns(spark, tmp_path):
    assert query(spark, [], tmp_path).collect() == []
    wide = "doc_id long, text string, word string, n long, letters string, id string, run string"
    rows = query(spark, [(1, "wordy wordy wordy", "x", 1, "y", "z", "r")], tmp_path, wide).collect()
    assert [tuple(r) for r in rows] == [("wordy", None, "wordy", 3, 0, None)]


def test_query_equals_its_sql(spark, tmp_path):
    import duckdb

    got = query(spark, [*made(3), (None, "nullo nullo nullo nulla nulla nulla"), (7, None)], tmp_path)
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(queries.OP13_SQL)
    assert got.columns == want.columns and sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))
