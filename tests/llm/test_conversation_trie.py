"""The prefix trie against a plain trie in memory, and its SQL."""

import random
from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import Row

from clientincome.llm import conversation_trie as ct
from clientincome.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_trie(conversations: dict[int, list[tuple[str, str]]]) -> set[tuple]:
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out = set()
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = sorted(c for c in m if len(conversations[c]) == len(p))
        out.add((
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), sum(not children[q] for q in below),
            sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q), sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return out


def ordered(rows) -> dict[int, list[tuple[str, str]]]:
    out = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)):
        if c is not None:
            out[c].append((r or "", x or ""))
    return out


def rebuilt(own: dict[int, list]) -> dict[int, list]:
    out = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 9
        base = c - c % 5
        out[c] = own[base][:h] + turns[h:] if base in own else turns[h:]
    return out


def found(spark, rows, rebuild=False, tmp=None):
    turns = ct.numbered(spark.createDataFrame(rows, SCHEMA))
    if rebuild:
        turns = ct.rebuilt(turns, 5, 9)
    nodes, ends = ct.prefix_trie(turns)
    got = nodes.join(ct.member_digests(ends), "name", "left").drop("name").collect()
    empty = sha256(b"").hexdigest()
    return sorted((*r[:-1], r[-1] or empty) for r in got)


def made(seed: int, convs: int, longest: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        length = rng.choice([0, 1, 2, 3, 5, 8, rng.randrange(longest + 1)])
        for t in range(length):
            rows.append((c * rng.choice([1, 1, 3]) if t == 0 else c, t, rng.choice(["user", "bot", None]), rng.choice(["a", "é", "", None])))
    rows += [(None, 0, "user", "lost"), (7, None, "user", "first"), (9_000_000_000, 0, None, None)]
    rng.shuffle(rows)
    return list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())


@pytest.mark.parametrize("seed,convs,longest", [(1, 40, 9), (2, 12, 70)])
@pytest.mark.parametrize("rebuild", [False, True])
def test_trie_equals_plain_trie(spark, seed, convs, longest, rebuild):
    rows = made(seed, convs, longest)
    want = ordered(rows)
    assert found(spark, rows, rebuild) == sorted(plain_trie(rebuilt(want) if rebuild else want))


def test_repeated_conversation_and_turns(spark):
    copies = [(c, t, "user", x) for c in range(300) for t, x in enumerate("abc")]
    rows = [*copies, *copies[:3], (500, 0, "user", "a")]  # conversation 0 has each turn twice
    want = ordered(rows)
    assert found(spark, rows) == sorted(plain_trie(want))


def test_long_conversation_over_stretches_and_partitions(spark):
    long = [(1, t, "user", str(t % 7)) for t in range(2500)]
    rows = [*long, *[(2, *r[1:]) for r in long[:2100]], (2, 2100, "user", "else"), (3, 0, "user", "0")]
    got = found(spark, rows)
    assert len(got) == 1 + 2500 + 1
    by = {(r[0], r[1]): r for r in got}
    assert by[1, 2100][3:6] == (2, 2, 2) and by[2, 2101][2] == 1 and by[0 + 1, 0][5] == 2 + 0
    # node (1, 1) belongs to three conversations, the next 2099 to two
    assert by[1, 1][6] == 2 * 1 + 2099 and by[1, 2101][6] == 0
    assert by[1, 1][7] == sha256(b"3").hexdigest()


def test_empty_and_extra_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    nodes, ends = ct.prefix_trie(ct.rebuilt(ct.numbered(none), 5, 9))
    assert nodes.collect() == [] and ct.member_digests(ends).collect() == []
    rows = spark.createDataFrame([Row(conv_id=4, turn=0, role="user", text="x", name="n", depth=3, pos=1, key="k")])
    nodes, _ = ct.prefix_trie(ct.numbered(rows))
    assert sorted((r.conv_id, r.depth, r.n_convs) for r in nodes.collect()) == [(4, 0, 1), (4, 1, 1)]
    shown = {r.depth: (r.role, r.text) for r in ct.last_turns(nodes, rows).collect()}
    assert shown == {0: (None, None), 1: ("user", "x")}


def test_query_equals_its_sql(spark, tmp_path):
    import duckdb

    rows = made(3, 60, 14)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op11_conversation_trie(spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.sql(queries.OP11_SQL)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
    assert sorted(map(tuple, got.collect())) == sorted(plain_trie(rebuilt(ordered(rows))))
