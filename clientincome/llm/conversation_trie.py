"""Conversation prefix trie by van Emde Boas recursion.

The nodes of the trie are the distinct beginnings of conversations.  A tree of
height 2**k is cut at half its depth: an upper tree of height 2**(k-1), and a
forest of lower trees, one below each cut prefix.  Both halves are cut again,
all trees of a level in the same Spark job, down to height 1.

* Names go down.  Blocks of 2**k turns get a digest from their halves, bottom
  up; then the name of a cut prefix is the digest of the name of its tree's
  root and of the upper block, top down.  At height 1 every prefix has a name,
  after as many rounds as the longest conversation's length has bits, and with
  rows that add up to a few times the number of turns.
* Totals go up.  A node's total first covers its tree of height 1, itself.  In
  round k the tops of all lower forests are grafted: their totals are added to
  the nodes above them in the upper tree, which lie on the path of any one
  conversation through the top.  So a top costs at most the turns that one
  conversation has there, and no level costs more rows than there are turns.

A turn is known by the MD5 digest of its role and text, so texts are read once
and not shuffled.  No conversation, node or list of members is gathered into
one task: positions come from a range-partitioned sort, joins are keyed by
blocks of a conversation, children of one parent are dealt over SALTS keys.
Lists of members become text chunks of bounded size where they are sorted; a
SHA-256 digest is sequential by definition, so the chunks of one node (not its
members) go through one task, a chunk at a time.

Nulls: a null role or text is empty, a null turn is first, rows of a null
conv_id belong to no conversation.  Turns of equal number follow each other by
digest; repeated rows are turns of their own.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientincome.llm.common import discard, partitions, text_or_empty, written

SALTS = 64  # keys over which the children of one parent are dealt
STRETCH = 10  # joins on a conversation are keyed by stretches of 2**STRETCH turns
CHUNK_IDS = 50_000  # member ids of a chunk of text
ROOT = bytes(16)  # the name of the textless root


class Turns(NamedTuple):
    """``rows``: (conv_id, pos from 0, key, bytes); ``convs``: (conv_id, length), turnless ones too."""

    rows: DataFrame
    convs: DataFrame


class Trie(NamedTuple):
    """``nodes``: (name, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_bytes),
    with the root; ``ends``: (name, conv_id) of every conversation, the node where it ends."""

    nodes: DataFrame
    ends: DataFrame


def _digest(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def _root() -> Column:
    return F.lit(bytearray(ROOT))


# ------------------------------------------------------------------- turns
def numbered(conversations: DataFrame) -> Turns:
    """The turns of each conversation of (conv_id, turn, role, text), in order."""
    role, text = text_or_empty("role"), text_or_empty()
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"),
        _digest(F.octet_length(role).cast("string"), F.lit(":"), role, text).alias("key"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    order = ("conv_id", "turn", "key")  # nulls first
    ordered = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            conv = b.column(0).to_numpy()
            starts = np.r_[0, np.flatnonzero(np.diff(conv)) + 1]
            sizes = np.diff(np.r_[starts, n])
            pos = np.arange(n) - np.repeat(starts, sizes)
            if conv[0] == last:
                pos[: sizes[0]] += seen
            last, seen = conv[-1], int(pos[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(pos, pa.int64()), b.column(2), b.column(3), pa.array(np.full(n, part, np.int32))],
                ["conv_id", "pos", "key", "bytes", "part"],
            )

    local = written(ordered.mapInArrow(number, "conv_id long, pos long, key binary, bytes long, part int"), "trie-turns")
    # a conversation may start in an earlier partition: one row of ends for each partition
    edges = local.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "pos")).alias("last")).orderBy("part").collect()
    shifts, running, before = [], None, 0
    for e in edges:
        if e["first"] == running:
            shifts.append((e["part"], running, before))
        before = e["last"]["pos"] + 1 + (before if e["first"] == e["last"]["conv_id"] == running else 0)
        running = e["last"]["conv_id"]
    rows = local
    if shifts:
        shift = F.broadcast(local.sparkSession.createDataFrame(shifts, "part int, conv_id long, shift long"))
        rows = local.join(shift, ["part", "conv_id"], "left").withColumn("pos", F.col("pos") + F.coalesce("shift", F.lit(0)))
    rows = rows.select("conv_id", "pos", "key", "bytes")
    return Turns(rows, rows.groupBy("conv_id").agg((F.max("pos") + 1).alias("length")))


def _stretches(convs: DataFrame, last: Column) -> DataFrame:
    """A row for each stretch of 2**STRETCH positions of a conversation, 0 to ``last``."""
    return convs.withColumn("stretch", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(last, STRETCH))))


def _stretch(pos: str) -> Column:
    return F.shiftright(pos, STRETCH)


def rebuilt(turns: Turns, group: int, heads: int) -> Turns:
    """Conversations that begin like the first of their group.

    Conversation c begins with the first h turns of conversation c - c % group
    (all if it has fewer, none if it is absent) and goes on with its own turns
    after its first h; h is the CRC-32 of its decimal id, modulo ``heads``.
    """
    convs = turns.convs.select(
        "conv_id", F.col("length").alias("own"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"),
    )
    convs = written(convs, "trie-convs")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("base_length"))
    convs = convs.join(bases, "base", "left").withColumn("head", F.least("h", F.coalesce("base_length", F.lit(0).cast("long"))))
    convs = written(convs.withColumn("length", F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "trie-heads")
    first = turns.rows.where(F.col("pos") < heads).withColumnRenamed("conv_id", "base")
    borrowed = (
        convs.where("head > 0").select("conv_id", "base", F.explode(F.sequence(F.lit(0).cast("long"), F.col("head") - 1)).alias("pos"))
        .join(first, ["base", "pos"]).select("conv_id", "pos", "key", "bytes")
    )
    kept = _stretches(convs.where("own > h").select("conv_id", "own", "h", "head"), F.col("own") - 1)
    own = (
        turns.rows.withColumn("stretch", _stretch("pos")).join(kept, ["conv_id", "stretch"]).where("pos >= h")
        .select("conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "key", "bytes")
    )
    return Turns(written(borrowed.unionByName(own), "trie-rebuilt"), convs.select("conv_id", "length"))


# ------------------------------------------------------------------- names
def prefix_names(turns: Turns, height: int) -> DataFrame:
    """(conv_id, pos, name) of the first ``pos`` turns, 0 <= pos <= length; 2**height is more than any length."""
    level = turns.rows.select("conv_id", F.col("pos").alias("j"), F.col("key").alias("block"))
    upper, used = [], []
    for k in range(height):
        # only even blocks are the upper half of a tree
        upper.append(level.where("j % 2 = 0").select("conv_id", F.shiftright("j", 1).alias("j"), "block"))
        if k + 1 < height:
            half = lambda odd: F.max(F.when(F.col("j") % 2 == odd, F.col("block")))
            pairs = level.groupBy("conv_id", F.shiftright("j", 1).alias("j")).agg(half(0).alias("a"), half(1).alias("b"))
            level = written(pairs.where("a is not null and b is not null").select("conv_id", "j", _digest(F.col("a"), F.col("b")).alias("block")), "trie-blocks")
            used.append(level)
    bits = F.length(F.bin("length"))  # a conversation enters at the least height that holds it
    enters = turns.convs.select("conv_id", F.when(F.col("length") > 0, bits).otherwise(0).alias("k"))
    enters = written(enters, "trie-enters")
    trees = None
    for k in range(height, -1, -1):
        new = enters.where(F.col("k") == k).select("conv_id", F.lit(0).cast("long").alias("j"), _root().alias("name"))
        trees = new if trees is None else trees.unionByName(new)
        if k:
            halves = F.array(
                F.struct((2 * F.col("j")).alias("j"), F.col("name").alias("name")),
                F.when(F.col("block").isNotNull(), F.struct((2 * F.col("j") + 1).alias("j"), _digest(F.col("name"), F.col("block")).alias("name"))),
            )
            trees = trees.join(upper[k - 1], ["conv_id", "j"], "left").select("conv_id", F.explode(halves).alias("t")).where("t is not null")
            trees = trees.select("conv_id", "t.j", "t.name")
    names = written(trees.withColumnRenamed("j", "pos"), "trie-names")
    discard(*used, enters)
    return names


# ------------------------------------------------------------------- nodes
def _salt(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SALTS)).cast("int")


def _relatives(nodes: DataFrame, names: DataFrame, convs: DataFrame) -> DataFrame:
    """``nodes`` with parent_conv_id and n_children.

    A node belongs to its smallest member.  A conversation's nodes are a run of
    depths down to its end; only the uppermost hangs on another's node.
    """
    runs = nodes.groupBy("conv_id").agg(F.min("depth").alias("top")).join(convs, "conv_id")
    runs = written(runs, "trie-runs")
    hung = runs.where("top > 1").select("conv_id", (F.col("top") - 1).alias("pos")).join(names, ["conv_id", "pos"])
    hung = written(hung.select("conv_id", "name", _salt("conv_id").alias("salt")), "trie-hung")
    # of one parent at most SALTS rows meet its node
    owners = written(
        hung.groupBy("name", "salt").agg(F.count("*").alias("n")).join(nodes.select("name", F.col("conv_id").alias("parent")), "name"),
        "trie-owners",
    )
    parents = hung.join(owners.drop("n"), ["name", "salt"]).select("conv_id", "parent")
    runs = runs.join(parents, "conv_id", "left")
    stretches = _stretches(runs, F.col("length"))
    more = owners.groupBy("name").agg(F.sum("n").alias("hung"))
    out = nodes.withColumn("stretch", _stretch("depth")).join(stretches, ["conv_id", "stretch"]).join(more, "name", "left")
    return out.select(
        "name", "conv_id", "depth", "n_convs",
        F.when(F.col("depth") > F.col("top"), F.col("conv_id")).otherwise(F.col("parent")).alias("parent_conv_id"),
        (F.coalesce("hung", F.lit(0)) + (F.col("depth") < F.col("length")).cast("long")).alias("n_children"),
    )


def grafted(values: DataFrame, names: DataFrame, height: int) -> DataFrame:
    """(name, leaves, saved) summed over the subtree of every node.

    ``values``: (name, conv_id, depth, leaves, saved) of the nodes alone;
    ``names``: (conv_id, pos, name).  2**height is at least the largest depth.
    """
    state = values
    paths = names.where("pos > 0")
    for k in range(1, height + 1):
        half = 1 << (k - 1)
        tops = state.where(((F.col("depth") - 1) % (2 * half)) == half).select(
            "conv_id", (F.shiftright(F.col("depth") - 1, k - 1) - 1).alias("block"), "leaves", "saved"
        )
        above = paths.select("conv_id", F.shiftright(F.col("pos") - 1, k - 1).alias("block"), "name").where("block % 2 = 0")
        grafts = above.join(tops, ["conv_id", "block"]).groupBy("name").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        nothing = F.lit(None).cast("long")
        both = state.unionByName(grafts.select("name", nothing.alias("conv_id"), nothing.alias("depth"), "leaves", "saved"))
        summed = both.groupBy("name").agg(
            F.max("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
        )
        later = written(summed, "trie-totals")
        if state is not values:
            discard(state)
        state = later
    return state.select("name", "leaves", "saved")


def prefix_trie(turns: Turns) -> Trie:
    """The trie of the conversations ``turns``."""
    longest = turns.convs.agg(F.max("length")).first()[0]
    spark = turns.rows.sparkSession
    schema = "name binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_bytes long"
    if longest is None:
        return Trie(spark.createDataFrame([], schema), spark.createDataFrame([], "name binary, conv_id long"))
    height = int(longest).bit_length()
    names = prefix_names(turns, height)
    ends = turns.convs.select("conv_id", F.col("length").alias("pos")).join(names, ["conv_id", "pos"]).select("name", "conv_id")

    found = names.where("pos > 0").groupBy("name").agg(
        F.min("conv_id").alias("conv_id"), F.max("pos").alias("depth"), F.count("*").alias("n_convs")
    )
    found = written(found, "trie-found")
    nodes = _relatives(found, names, turns.convs)
    # a node of one conversation saves nothing: only the others need the size of their last text
    last = turns.rows.select("conv_id", (F.col("pos") + 1).alias("depth"), "bytes")
    sizes = found.where("n_convs > 1").join(last, ["conv_id", "depth"]).select("name", "bytes")
    saved = (F.col("n_convs") - 1) * F.coalesce("bytes", F.lit(0).cast("long"))
    nodes = nodes.join(sizes, "name", "left").withColumn("saved", saved).withColumn("leaves", (F.col("n_children") == 0).cast("long"))
    nodes = written(nodes.drop("bytes"), "trie-nodes")
    totals = grafted(nodes.select("name", "conv_id", "depth", "leaves", "saved"), names, height)
    top = turns.convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    below = (
        nodes.where("depth = 1").select("name").join(totals, "name")
        .agg(F.count("*").alias("n_children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    )
    zero = F.lit(0).cast("long")
    # two one-row aggregates
    root = top.crossJoin(F.broadcast(below)).select(
        _root().alias("name"), "conv_id", zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
        F.coalesce("leaves", F.lit(1).cast("long")).alias("n_leaves"), F.coalesce("saved", zero).alias("saved_bytes"),
    )
    smallest = top.select(F.col("conv_id").alias("root_conv"))
    rest = nodes.drop("leaves", "saved").join(totals, "name").crossJoin(F.broadcast(smallest)).select(
        "name", "conv_id", "depth", F.when(F.col("depth") == 1, F.col("root_conv")).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_bytes"),
    )
    return Trie(rest.unionByName(root), ends)


def last_turns(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """``nodes`` of the trie of the conversations as they are, with role and text of their last turn."""
    role, text = text_or_empty("role"), text_or_empty()
    key = _digest(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = numbered(conversations).rows.select("conv_id", (F.col("pos") + 1).alias("depth"), "key")
    shown = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), key.alias("key"), role.alias("role"), text.alias("text"))
    shown = shown.dropDuplicates(["conv_id", "key"])
    return nodes.join(turns, ["conv_id", "depth"], "left").join(shown, ["conv_id", "key"], "left").drop("key")


def member_digests(ends: DataFrame) -> DataFrame:
    """(name, sha256) of the decimal conv_ids that end at a node, ascending, joined by commas."""
    n = partitions(ends.sparkSession)
    ordered = ends.repartitionByRange(n, "name", "conv_id").sortWithinPartitions("name", "conv_id")

    def runs(b: pa.RecordBatch) -> Iterator[tuple[bytes, int, int]]:
        names = b.column(0).to_pylist()
        first = 0
        for i in range(1, len(names) + 1):
            if i == len(names) or names[i] != names[first]:
                yield names[first], first, i
                first = i

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (name, smallest id, ids as text); a row holds what a batch has of a node, CHUNK_IDS at most."""
        for b in batches:
            ids, out = b.column(1).to_pylist(), []
            for name, x, y in runs(b):
                for k in range(x, y, CHUNK_IDS):
                    some = ids[k : min(k + CHUNK_IDS, y)]
                    out.append((name, some[0], ",".join(map(str, some))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.string()))], ["name", "first", "ids"]
            )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        name, running = None, None
        for b in batches:
            done = []
            for at, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if at == name:
                    running.update(b"," + ids.encode())
                else:
                    if running is not None:
                        done.append((name, running.hexdigest()))
                    name, running = at, sha256(ids.encode())
            yield _named(done)
        if running is not None:
            yield _named([(name, running.hexdigest())])

    pieces = written(ordered.mapInArrow(chunks, "name binary, first long, ids string"), "trie-ends")
    gathered = pieces.repartition(n, "name").sortWithinPartitions("name", "first").select("name", "ids")
    return gathered.mapInArrow(digest, "name binary, sha256 string")


def _named(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], ["name", "sha256"])
