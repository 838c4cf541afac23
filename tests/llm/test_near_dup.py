import random

from clientincome.llm import near_dup
from clientincome.llm.components import components
from tests.llm import brute


def result(docs):
    rows = near_dup.near_duplicates(docs).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows if r["doc_id"] is not None)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}


def test_small_table(spark, small, make_docs):
    assert result(make_docs([(d, t) for d, t, _ in small])) == brute.near_duplicates([(d, t) for d, t, _ in small])


def test_clusters(make_docs):
    """A star of copies that are near its centre but hardly each other, a clique, a chain and near misses."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(10**6)}"
    docs, base = [], [word() for _ in range(300)]

    def edited(words, n):
        words = list(words)
        for i in rng.sample(range(len(words)), n):
            words[i] = word()
        return words

    docs += [base] + [edited(base, 8) for _ in range(150)]  # each about 0.77 from the centre
    other = [word() for _ in range(200)]
    docs += [edited(other, 2) for _ in range(60)]
    chain = [word() for _ in range(120)]
    for _ in range(12):
        chain = edited(chain, 3)
        docs.append(chain)
    far = [word() for _ in range(100)]
    docs += [far, far[:60] + [word() for _ in range(40)], far[:90] + [word() for _ in range(10)]]
    rows = [(i, " ".join(w)) for i, w in enumerate(docs)]
    rng.shuffle(rows)
    assert result(make_docs(rows)) == brute.near_duplicates(rows)


def test_copies(make_docs):
    rows = [(i, "The same Words, again and again in all of them") for i in range(400)] + [(1000, "the same words, again AND again in all of them")]
    assert result(make_docs(rows)) == {d: (6, 0) for d, _ in rows}


def test_odd_rows(make_docs, odd_docs):
    rows = near_dup.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert [(r["n_shingles"], r["component_id"], r["kept"]) for r in by[1] + by[2] + by[5]] == [(0, 1, True), (0, 2, True), (0, 5, True)]
    assert sorted(r["n_shingles"] for r in by[4]) == [1, 1, 2]
    assert all(r["component_id"] is None and r["kept"] for r in by[None])
    assert near_dup.near_duplicates(make_docs([])).count() == 0
    assert near_dup.drop_near_duplicates(odd_docs).columns == odd_docs.columns


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, 200 + i) for i in range(50)] + [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(70)]
    links = [(a, b) for a, b in links if a != b]
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == brute.components(links)


def test_candidates_whatever_the_partitions(spark, make_docs, monkeypatch):
    """A region cut by ranges and blocks has one hub, and the windows reach over the cuts."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    docs = [list(base) for _ in range(301)]
    for words in docs[1:]:
        for i in rng.sample(range(300), 8):
            words[i] = f"w{rng.randrange(10**6)}"
    docs += [[f"x{rng.randrange(10**6)}" for _ in range(80)] for _ in range(100)]
    docs += [[*words[:-1], "end"] for words in docs[-100:]]
    nodes = near_dup.sketches(make_docs([(i, " ".join(w)) for i, w in enumerate(docs)])).cache()
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n, block in (("8", 20_000), ("64", 20_000), ("3", 40)):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            monkeypatch.setattr(near_dup, "BLOCK", block)
            found.append({(r["a"], r["b"]) for r in near_dup.candidates(nodes).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2]
    assert {(0, i) for i in range(1, 301)} | {(i, i + 100) for i in range(301, 401)} <= found[0]


def test_recall_of_a_crowd(make_docs):
    """Documents that share a passage and are just below the threshold, with closer pairs among them."""
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(170)]
    crowd = [passage + [f"a{i}x{k}" for k in range(30)] for i in range(600)]  # about 0.73 to each other
    pairs = [passage + words[170:176] + [f"b{i}x{k}" for k in range(24)] for i, words in enumerate(crowd[:100])]  # about 0.78
    rows = [(i, " ".join(w)) for i, w in enumerate(crowd + pairs)]
    rng.shuffle(rows)
    want, got = brute.near_duplicates(rows), result(make_docs(rows))
    linked = [d for d in range(600, 700) if want[d][1] != d]
    assert len(linked) == 100
    found = sum(got[d][1] == want[d][1] for d in linked)
    assert found >= 90 and all(got[d][1] == d for d in range(600))
