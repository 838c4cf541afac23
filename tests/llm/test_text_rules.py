import random

import numpy as np
import pytest

from clientincome.llm import decontaminate, line_dedup, passage_dedup, repetition, unigram
from tests.llm import brute


# ------------------------------------------------------------------ line dedup
def lines_result(docs, min_sites):
    return {r["doc_id"]: r["text"] or "" for r in line_dedup.dedup_lines(docs, min_sites=min_sites).collect()}


@pytest.mark.parametrize("min_sites", [2, 10])
def test_lines_small_table(small, make_docs, min_sites):
    assert lines_result(make_docs(small), min_sites) == brute.spread_lines(small, min_sites)


def test_lines_threshold(make_docs):
    """Spreads around the threshold are exact; a text of spread lines alone stays."""
    rows = [(100 * n + s, f"spread {n}\nown words of document {n} {s} that nobody else has at all", f"s{s}") for n in (8, 9, 10, 11, 12) for s in range(n)]
    rows += [(5000 + s, "spread 12", f"s{s}") for s in range(3)]
    rows += [(6000, "spread 12\n \t\nspread 11\nmy own", "s1"), (6001, "spread 12\n\nspread 11", "s1")]
    got = lines_result(make_docs(rows), 10)
    assert got == brute.spread_lines(rows, 10)
    assert got[5000] == "spread 12" and got[900].startswith("spread") and got[1000].startswith("own")
    assert got[6000] == " \t\nmy own" and got[6001] == "spread 12\n\nspread 11"


def test_lines_odd_rows(odd_docs, make_docs, spark):
    out = line_dedup.dedup_lines(odd_docs)
    assert out.columns[:-2] == odd_docs.columns and out.count() == odd_docs.count()
    assert line_dedup.drop_lines(make_docs([])).count() == 0
    clash = odd_docs.withColumnRenamed("lang", "line").withColumnRenamed("n_chars", "pos")
    assert line_dedup.drop_lines(clash).columns == clash.columns


# ------------------------------------------------------------------ repetition
def test_repetition_small_table(small, make_docs):
    got = {r["doc_id"]: tuple(r)[1:7] for r in repetition.quality(make_docs(small)).collect()}
    assert got == {d: brute.base_counts(t) for d, t, _ in small}


def test_longest_repeats():
    rng = random.Random(3)
    texts = [[rng.choice("abc") for _ in range(rng.randrange(0, 60))] for _ in range(40)] + [["a"] * 50, [], ["a", "b"] * 20]
    words = np.array([ord(w) for t in texts for w in t])
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    assert repetition.longest_repeats(words, doc).tolist() == [x for t in texts for x in brute.longest_repeats(t)]


def verdict(text):
    """(covered words, longest repeat, kept) by comparing all suffixes."""
    words = brute.WORD.findall(text)
    longest, n = brute.longest_repeats(words), len(words)
    inside = {j for i, k in enumerate(longest) if k >= 5 for j in range(i, i + k)}
    most = max(longest, default=0)
    fine = len(inside) <= 0.2 * n and most <= max(10, 0.05 * n)
    return len(inside), most, fine and not brute.base_counts(text)[5]


def test_repetition_verdict(make_docs, odd_docs):
    rng = random.Random(12)
    word = lambda k: f"{'uvw'[k % 3]}{rng.randrange(10**5)}"
    rows = []
    for i in range(120):
        words = [word(i) for _ in range(rng.randrange(40, 160))]
        for _ in range(rng.randrange(0, 6)):
            at, size, to = rng.randrange(len(words)), rng.randrange(3, 16), rng.randrange(len(words))
            words[to:to] = words[at : at + size]
        rows.append((i, " ".join(words)))
    got = {r["doc_id"]: r for r in repetition.quality(make_docs(rows)).collect()}
    assert {d: (r["covered_words"], r["longest_repeat"], r["kept"]) for d, r in got.items()} == {d: verdict(t) for d, t in rows}
    passed = [r for r in got.values() if not r["base_failed"]]
    by_share = [r["covered_words"] > 0.2 * r["n_words"] for r in passed]
    by_length = [r["longest_repeat"] > max(10, 0.05 * r["n_words"]) for r in passed]
    alone = set(zip(by_share, by_length, strict=True))
    assert {(False, False), (True, False), (False, True)} <= alone  # each limit rejects by itself
    assert repetition.quality(odd_docs).count() == odd_docs.count() and repetition.quality(make_docs([])).count() == 0


# ------------------------------------------------------------------ passages
def passages(docs, **how):
    return {r["doc_id"]: (bytes(r["kept"]), [tuple(s) for s in r["spans"]]) for r in passage_dedup.remove_repeats(docs, **how).collect()}


def expected(rows, span):
    out = {}
    for d, (data, flags) in brute.repeated_bytes(rows, span).items():
        edges = [i for i in range(len(flags) + 1) if (flags[i - 1] if i else False) != (flags[i] if i < len(flags) else False)]
        out[d] = (bytes(b for b, f in zip(data, flags, strict=True) if not f), list(zip(edges[::2], edges[1::2], strict=True)))
    return out


def test_passages_small_table(small, make_docs):
    rows = [(d, t) for d, t, _ in small]
    assert passages(make_docs(rows)) == expected(rows, 100)


def test_passages_random(make_docs):
    """Periodic texts, overlaps, repeats within a document, lengths about the span."""
    rng = random.Random(9)
    piece = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(60, 400))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(piece)[rng.randrange(30) :] for _ in range(rng.randrange(1, 6)))) for i in range(80)]
    rows += [(100, "ab" * 400), (101, "ba" * 300), (102, "x" * 99), (103, "x" * 100), (104, "x" * 350), (105, ""), (106, None)]
    rng.shuffle(rows)
    assert passages(make_docs(rows)) == expected(rows, 100)


def test_passages_hot_copies(make_docs):
    rng = random.Random(2)
    text = " ".join(f"w{rng.randrange(10**5)}" for _ in range(80))
    rows = [(i, text if i % 3 else text + f" and number {i} has an end of its own " + "y" * i) for i in range(200)]
    assert passages(make_docs(rows)) == expected(rows, 100)


def test_passages_odd_rows(odd_docs, make_docs, monkeypatch):
    out = passage_dedup.remove_repeats(odd_docs).collect()
    assert len(out) == odd_docs.count() and passage_dedup.remove_repeats(make_docs([])).count() == 0
    monkeypatch.setattr(passage_dedup, "SLICE", 500)
    rng = random.Random(4)
    base = "".join(rng.choice("abcdefgh") for _ in range(3000))
    data = [base[:1700] + base[200:900], base]
    runs = [run for *_, run in passage_dedup.anchors([x.encode() for x in data])]
    assert sum(int(passage_dedup.unpacked(r)[2].sum()) for r in runs) == sum(len(x) - 99 for x in data)
    # long texts pass through every step slice by slice
    texts = [x.encode() for x in [*data, base[500:2000] + "z" + base[2000:]]]
    for expand in (passage_dedup._blocks(100), passage_dedup._single(100)):
        for text in texts:
            whole = np.frombuffer(text, np.uint8)
            run = np.sort(np.concatenate([r for _, _, i, r in passage_dedup.anchors([text])]))
            *_, at = expand(whole, *passage_dedup.unpacked(run))
            assert len(at)


def test_multikey_order():
    rng = np.random.default_rng(0)
    columns = [rng.integers(0, 4, 500) for _ in range(4)]
    order = passage_dedup.multikey_order(columns)
    rows = list(zip(*(c.tolist() for c in columns), strict=True))
    assert [rows[i] for i in order] == sorted(rows)


# ------------------------------------------------------------------ token counts
def test_unigram(small, make_docs, odd_docs):
    P = pytest.importorskip("public_tokenizers")
    import regex

    path = str(P.path("byte_bpe_50k.tiktoken"))
    vocabulary = unigram.Vocabulary(path)
    pattern, known = regex.compile(P.PATTERN), {}
    docs = make_docs(small[:60]).unionByName(odd_docs.where("doc_id in (1, 2, 5, 6, 7)"))
    for r in docs.collect():
        cut = [t.encode() for t in pattern.findall(r["text"] or "")]
        for t in cut:
            if t not in known:
                known[t] = brute.unigram_tokens(t, vocabulary.score)[1]
    want = sorted((r["doc_id"], len(c), sum(known[t] for t in c)) for r in docs.collect() for c in [[t.encode() for t in pattern.findall(r["text"] or "")]])
    got = sorted(tuple(r) for r in unigram.token_counts(docs, path, P.PATTERN).collect())
    assert got == want
    assert unigram.token_counts(odd_docs, path, P.PATTERN).count() == odd_docs.count()
    assert unigram.token_counts(make_docs([]), path, P.PATTERN).count() == 0


def test_unigram_counter_looks_up_endings_alone(monkeypatch):
    """Counts as of every way to cut, over white space, NUL, long and forgotten pre-tokens; no look-up beyond the longest ending."""
    P = pytest.importorskip("public_tokenizers")
    import regex

    path, rng = str(P.path("byte_bpe_50k.tiktoken")), random.Random(8)
    counter = unigram.Counter(path, P.PATTERN)
    vocabulary, looked_up = counter.trie.vocabulary, []

    class Endings(dict):
        def get(self, key):
            looked_up.append(key)
            return dict.get(self, key)

    vocabulary.ending = Endings(vocabulary.ending)
    words = ["".join(rng.choice("aeinotrhé") for _ in range(rng.randrange(1, 14))) for _ in range(60)]
    words += ["x" * n for n in (unigram.LONG - 2, unigram.LONG - 1, unigram.LONG, unigram.LONG + 40)] + ["Inter", "internationale,", "\0", "a\0b", "7", "", "\t"]
    texts = [rng.choice(["", " ", "\n"]) + "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", ". "]) for _ in range(40)).strip(" ") for _ in range(40)]
    texts += [" ".join(rng.choices(words[:64], k=50)) for _ in range(40)] + ["", "\0"]
    known, find = {}, regex.compile(P.PATTERN).findall
    for t in {t for text in texts for t in find(text)}:
        known[t] = brute.unigram_tokens(t.encode(), vocabulary.score)[1]
    want = [(len(find(t)), sum(known[x] for x in find(t))) for t in texts]
    assert counter.totals(texts) == want and counter.totals(texts[::-1]) == want[::-1]
    assert looked_up and all(k in vocabulary.ending or k[1:] in vocabulary.ending or len(k) == 1 for k in looked_up)
    for name in ("MAX_PRETOKENS", "MAX_PIECES"):
        monkeypatch.setattr(unigram, name, 3)
    assert [x for t in texts for x in counter.totals([t])] == want


# ------------------------------------------------------------------ decontamination
def test_myers():
    rng = random.Random(6)
    for _ in range(200):
        p = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 90)))
        t = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 120)))
        got = decontaminate.myers(p, t, len(p))
        assert (got[0] if got else len(p)) == brute.edit_distance_within(p, t)


def test_short_items(make_docs, spark):
    """Short items of four words or more are found as whole words, others as whole documents."""
    items = [(1, "What is 7 times 8?"), (2, "so be it"), (3, "what is 7"), (4, "is 7 times 8"), (4, "IS 7 TIMES 8"), (5, "it is 7 or 8")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    texts = ["Say: what is 7 -- times 8, or what is 7 times 8", "what is 7 times 88", "So be it!", "and so be it", "this 7 times 8",
             "was it is 7 or 8? it is 7 or 8", "x is 7 times 8 it is 7 or 8", "What is 7 times 8", "", None]
    want = []
    for d, text in enumerate(texts):
        t = decontaminate.normal(text or "")
        for k, item in {(k, decontaminate.normal(i)) for k, i in items[:4] + items[5:]}:
            at = f" {t} ".find(f" {item} ")
            if at >= 0 and (item == t or len(item.split()) >= decontaminate.MIN_WORDS):
                want += [(d, k, 0, at, len(item))] * (2 if k == 4 else 1)  # items of one id each count
    got = [tuple(r) for r in decontaminate.contaminated(make_docs(list(enumerate(texts))), benchmark).collect()]
    assert sorted(got) == sorted(want) and {(0, 1), (2, 2), (5, 5), (6, 4), (7, 1)} <= {w[:2] for w in want}
    left = decontaminate.drop_contaminated(make_docs(list(enumerate(texts))), benchmark)
    assert {r["doc_id"] for r in left.collect()} == set(range(len(texts))) - {w[0] for w in want} == {1, 3, 4, 8, 9}


def test_decontamination(make_docs, spark, odd_docs):
    rng = random.Random(8)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    items = [(i, prose(30)) for i in range(15)] + [(20, "ok"), (21, None), (22, ""), (3, prose(25))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = []
    for i in range(90):
        k, text = rng.choice([x for x in items if x[1] and len(x[1]) > 30])
        chars = list(text)
        for _ in range(rng.randrange(0, 30)):
            at = rng.randrange(len(chars))
            chars[at : at + rng.randrange(2)] = rng.choice(["", "q", "zz"])
        rows.append((i, prose(20) + " " + "".join(chars).upper() + ".\n" + prose(20)))
    rows += [(200, "OK!"), (201, "that is ok"), (202, prose(60))]
    want = set()
    for d, t in rows:
        t = decontaminate.normal(t)
        for k, text in items:
            p = decontaminate.normal(text or "")
            if len(p) >= decontaminate.MIN_CHARS:
                n = brute.edit_distance_within(p, t)
                if n <= int(decontaminate.ERROR_RATE * len(p)):
                    want.add((d, k, n))
            elif p and p == t:
                want.add((d, k, 0))
    got = decontaminate.contaminated(make_docs(rows), benchmark).collect()
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in got} == want and len(got) == len(want) and 20 < len(want) < 90
    left = decontaminate.drop_contaminated(make_docs(rows), benchmark)
    assert {r["doc_id"] for r in left.collect()} == {d for d, _ in rows} - {d for d, _, _ in want} and left.columns == make_docs([]).columns
    assert decontaminate.contaminated(odd_docs, benchmark).count() == 0
    assert decontaminate.contaminated(make_docs([]), benchmark).count() == 0
    assert decontaminate.contaminated(odd_docs, benchmark.limit(0)).count() == 0
