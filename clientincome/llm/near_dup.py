"""Near-duplicates by an LSH forest over MinHash signatures.

Sets.  A document's set holds its distinct 5-word shingles.  Documents with
equal sets (128-bit hash) form a class; its smallest doc_id stands for it, so
thousands of copies are one node.

Forest.  A signature has TREES * DEPTH minima; tree t sorts the nodes by its
own DEPTH minima, over range partitions.  The cuts between partitions, and
between the blocks of one, leave no trace in the candidates of a node:

* its neighbours in sorted order, WINDOW to either side, over the ends of blocks
  and partitions too, and
* in every region of a tree (a run of nodes that share a prefix) larger than
  that, the region's hub: the node whose signature agrees most with the
  majority of the region.  Dense regions are split further, prefix by prefix,
  down to regions that the window covers, so the depth adapts; a region of n
  nodes gives n candidates and not all pairs.  A region that reaches an end of a
  block is put together from counts of its marks: its hub is found and compared
  in the range partitions that hold its rows.

Crowds.  Where a node's region goes on beyond its window in many trees, a partner
may be none of its candidates: documents that share a long passage and are just
below 0.75 to each other fill the regions.  What lifts a pair of them over the
threshold lies outside the passage, so crowded nodes are joined on their rare
shingles, those of at most RARE crowded nodes, and all pairs of such a shingle
become candidates.

Links.  Candidates whose whole signatures agree in fewer than MIN_AGREE places
are dropped (a pair of similarity 0.75 agrees in so few with a chance of about
1e-6).  Each node first confirms its two most promising candidates on the full
sets; then all candidates between different components are confirmed, so no
candidate that could join two components goes unchecked.

A pair of similarity s shares a prefix of length 1 in some tree with a chance
of 1 - (1 - s)**TREES, above 0.9999999 from 0.75 on; that is no chance of being
compared.  What is missed: pairs that meet in crowded regions alone, are never
neighbours or hub there, share no shingle of at most RARE crowded nodes, and that
nothing else links.

Nulls and empty texts have an empty set, linked with nothing.  A null doc_id
is linked with nothing and kept, its component is null.  Rows of one doc_id are
one node, each with its own set.  An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientincome.llm.common import partitions, small_batches, written
from clientincome.llm.components import components

SHINGLE = 5
TREES, DEPTH = 12, 6
WINDOW = 2
MIN_AGREE = 36  # of TREES * DEPTH
SIMILAR = (75, 100)  # 100 * intersection >= 75 * union
BLOCK = 20_000  # rows of a tree looked at together
CROWDED = 8  # minima, over all trees, that a node shares with the nodes just beyond its windows
RARE = 16  # crowded nodes that hold a shingle whose pairs are all candidates
PAIR, REGION, EDGE, COUNT, CROWD = range(5)  # what a look at a block gives
CACHED_WORDS = 300_000

_N = TREES * DEPTH
_RANDOM = np.random.default_rng(20240229)
_FACTORS = _RANDOM.integers(0, 2**64, _N, np.uint64) | np.uint64(1)
_OFFSETS = _RANDOM.integers(0, 2**64, _N, np.uint64)
_PLACES = _RANDOM.integers(0, 2**64, SHINGLE, np.uint64) | np.uint64(1)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHED_WORDS:
            self[word] = h
        return h


_WORDS = _Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: bytes | None) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending."""
    words = (text or b"").lower().split()  # A-Z; splits at \x20 and \x09-\x0D
    n = len(words)
    w = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, n)
    if n == 0:
        return w
    size = min(n, SHINGLE)
    total = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        total += w[k : n - size + 1 + k] * _PLACES[k]
    return np.unique(_mixed(total))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of _N minima for each set; none may be empty."""
    flat = np.concatenate(sets)
    starts = np.r_[0, np.cumsum([len(s) for s in sets])[:-1]]
    out = np.empty((len(sets), _N), np.uint32)
    for k in range(_N):
        out[:, k] = np.minimum.reduceat((flat * _FACTORS[k] + _OFFSETS[k]) >> np.uint64(32), starts)
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_1, set_2, signature) of every row; signature null for an empty set."""
    schema = "doc_id long, n_shingles long, set_1 long, set_2 long, signature binary"

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            sets = [shingles(t) for t in texts]
            full = [i for i, s in enumerate(sets) if len(s)]
            minima: list[bytes | None] = [None] * len(sets)
            for first in range(0, len(full), 100):
                some = full[first : first + 100]
                for i, row in zip(some, signatures([sets[i] for i in some]).astype(">u4"), strict=True):
                    minima[i] = row.tobytes()
            sums = [
                [int(_mixed(s * np.uint64(m)).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
                for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
            ]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(sums[0], pa.int64()),
                 pa.array(sums[1], pa.int64()), pa.array(minima, pa.binary())],
                ["doc_id", "n_shingles", "set_1", "set_2", "signature"],
            )

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(sketch, schema)


def _best_of(region: np.ndarray, ids: np.ndarray) -> int:
    """The row that agrees in most places with the majority of its region, of equals the smallest id."""
    places = np.arange(region.shape[1])
    counts = np.bincount((region.astype(np.int64) + 256 * places).ravel(), minlength=256 * region.shape[1])
    agree = (region == counts.reshape(-1, 256).argmax(1)).sum(1)
    return int(np.lexsort((ids, -agree))[0])


class Block(NamedTuple):
    """Sorted rows of the forest: ``keys`` are DEPTH minima of each row in its
    tree, ``marks`` a byte of every minimum of the whole signature."""

    tree: np.ndarray
    keys: np.ndarray
    marks: np.ndarray
    ids: np.ndarray
    sizes: np.ndarray

    def rows(self, at) -> Block:
        return Block(*(x[at] for x in self))

    def name(self, row: int, depth: int) -> bytes:
        """The region of a row's first ``depth`` minima."""
        return bytes([self.tree[row]]) + self.keys[row, :depth].astype(">u4").tobytes()

    def after(self, other: Block) -> Block:
        return Block(*(np.concatenate(x) for x in zip(other, self, strict=True)))

    def crowding(self) -> np.ndarray:
        """The longest prefix that each row shares with a row just beyond its window, on either side.

        Beyond the block, where the row at its end stands for that row, it may be given too long.
        """
        at, longest = np.arange(len(self.ids)), np.zeros(len(self.ids), np.int64)
        for beyond in (np.minimum(at + WINDOW + 1, len(at) - 1), np.maximum(at - WINDOW - 1, 0)):
            same = (self.keys[beyond] == self.keys) & (self.tree[beyond] == self.tree)[:, None]
            longest = np.maximum(longest, np.cumprod(same, axis=1).sum(1))
        return longest

    def shared(self, w: int) -> np.ndarray:
        """The length of the prefix that each row shares with the one ``w`` rows on."""
        same = (self.keys[w:] == self.keys[:-w]) & (self.tree[w:] == self.tree[:-w])[:, None]
        return np.cumprod(same, axis=1).sum(1)


def _close(rows: Block, a: np.ndarray, b: np.ndarray) -> set[tuple[int, int, int]]:
    """(a, b, agreement) of those pairs of rows whose sizes and signatures allow a link."""
    out = set()
    for k in range(0, len(a), 100_000):
        x, y = a[k : k + 100_000], b[k : k + 100_000]
        low, high = np.minimum(rows.sizes[x], rows.sizes[y]), np.maximum(rows.sizes[x], rows.sizes[y])
        fits = (SIMILAR[1] * low >= SIMILAR[0] * high) & (rows.ids[x] != rows.ids[y])
        x, y = x[fits], y[fits]
        agree = (rows.marks[x] == rows.marks[y]).sum(1)
        close = agree >= MIN_AGREE
        x, y, agree = rows.ids[x[close]], rows.ids[y[close]], agree[close]
        out.update(zip(np.minimum(x, y).tolist(), np.maximum(x, y).tolist(), agree.tolist(), strict=True))
    return out


def window_candidates(rows: Block, piece: np.ndarray | None = None) -> set[tuple[int, int, int]]:
    """Pairs of rows up to WINDOW apart that share a prefix; with ``piece``, those of different pieces alone."""
    out = set()
    for w in range(1, min(WINDOW, len(rows.ids) - 1) + 1):
        meet = rows.shared(w) > 0
        if piece is not None:
            meet &= piece[w:] != piece[:-w]
        at = np.flatnonzero(meet)
        out |= _close(rows, at, at + w)
    return out


def region_candidates(rows: Block) -> tuple[set[tuple[int, int, int]], list[tuple[bytes, int, int]]]:
    """Candidates of the regions that end within the block, and the others.

    A region that holds the first or the last row may go on in another block:
    it is returned as (its name, first row, last row).
    """
    n = len(rows.ids)
    if n == 0:
        return set(), []
    prefix = rows.shared(1)
    hubs, others, going_on = [], [], []
    for depth in range(1, DEPTH + 1):
        bounds = np.flatnonzero(np.r_[True, prefix < depth, True])
        inner = bounds[1:-1] if len(bounds) > 2 else bounds[:0]
        for first, last in {(0, int(bounds[1]) - 1), (int(bounds[-2]), n - 1)}:
            going_on.append((rows.name(first, depth), first, last))
        for k in np.flatnonzero(np.diff(inner) > 2 * WINDOW + 1):
            first, last = inner[k], inner[k + 1] - 1  # rows first..last share the prefix
            hub = first + _best_of(rows.marks[first : last + 1], rows.ids[first : last + 1])
            rest = np.r_[first:hub, hub + 1 : last + 1]
            hubs.append(np.full(len(rest), hub))
            others.append(rest)
    if not hubs:
        return set(), going_on
    return _close(rows, np.concatenate(hubs), np.concatenate(others)), going_on


def _counts(marks: np.ndarray) -> np.ndarray:
    """How often each mark stands at each place."""
    return np.bincount((marks.astype(np.int64) + 256 * np.arange(_N)).ravel(), minlength=256 * _N)


def _matrix(marks: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(marks.to_pylist()), np.uint8).reshape(-1, _N)


_COUNTS = "region binary, n long, counts binary"


def _added(parts: pa.Table) -> pa.Table:
    """One row of _COUNTS for the parts of a region."""
    total = np.zeros(256 * _N, np.int64)
    for x in parts["counts"]:
        total += np.frombuffer(zlib.decompress(x.as_py()), np.int64)
    n = sum(parts["n"].to_pylist())
    return pa.table([parts["region"].slice(0, 1), pa.array([n], pa.int64()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], ["region", "n", "counts"])


def _most(parts: pa.Table) -> pa.Table:
    """The majority of a region, of equally frequent marks the smallest."""
    total = _added(parts)
    counts = np.frombuffer(zlib.decompress(total["counts"][0].as_py()), np.int64).reshape(-1, 256)
    return pa.table([total["region"], total["n"], pa.array([counts.argmax(1).astype(np.uint8).tobytes()], pa.binary())], ["region", "n", "marks"])


def _beside(heads: DataFrame, nodes: DataFrame) -> DataFrame:
    """``heads`` (piece, region, id, size, marks) and ``nodes`` of the same pieces together, of each piece
    the heads first.  A piece is a range partition, so none is larger than the others."""
    both = heads.select(F.lit(0).alias("kind"), "piece", "region", "id", "size", "marks").unionByName(
        nodes.select(F.lit(1).alias("kind"), "piece", "region", "id", "size", "marks")
    )
    return both.repartition(partitions(nodes.sparkSession), "piece").sortWithinPartitions("piece", "kind", "region")


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, dict, dict[bytes, np.ndarray], pa.RecordBatch]]:
    """Of rows from ``_beside``: (whether a piece begins, its heads by region, rows of the nodes by region, batch).

    A node stands under its deepest region; it is given for each prefix of that name that has a head.
    """
    piece, heads = None, {}
    for b in batches:
        kinds, pieces, regions = b.column("kind").to_numpy(), b.column("piece").to_numpy(), b.column("region").to_pylist()
        for at in np.split(np.arange(b.num_rows), np.flatnonzero(np.diff(pieces)) + 1):
            if not len(at):
                continue
            begins = pieces[at[0]] != piece
            if begins:
                piece, heads = pieces[at[0]], {}
            some: dict[bytes, list[int]] = {}
            for i in at.tolist():
                if kinds[i] == 0:
                    heads[regions[i]] = (b.column("id")[i].as_py(), b.column("size")[i].as_py(), np.frombuffer(b.column("marks")[i].as_py(), np.uint8))
                else:
                    some.setdefault(regions[i], []).append(i)
            under: dict[bytes, list[int]] = {}
            for name, rows in some.items():
                for end in range(5, len(name) + 1, 4):  # a byte for the tree, four for each minimum
                    if name[:end] in heads:
                        under.setdefault(name[:end], []).extend(rows)
            yield begins, heads, {k: np.array(v) for k, v in under.items()}, b


def hub_candidates(going_on: DataFrame, counts: DataFrame) -> DataFrame:
    """(a, b, agree) of the regions that lie in several blocks, by the same hub as in one.

    ``going_on``: (piece, region, id, size, marks), a row for each tree and node, under the deepest of its
    regions that reach an end of its block; ``counts``: (piece, region, n, counts) of all those regions.
    No row is repeated for the regions it lies in: the majority and then the hub of a region go to the
    pieces that hold its rows.
    """
    some = counts.withColumn("part", F.floor(F.col("piece") / 32)).groupBy("part", "region").applyInArrow(
        lambda parts: _added(parts), _COUNTS
    )
    most = some.groupBy("region").applyInArrow(lambda parts: _most(parts), "region binary, n long, marks binary")
    where = written(
        counts.select("piece", "region").distinct().join(most.where(F.col("n") > 2 * WINDOW + 1).drop("n"), "region"), "nd-majorities"
    )
    heads = where.select("piece", "region", F.lit(0).cast("long").alias("id"), F.lit(0).cast("long").alias("size"), "marks")
    schema = "region binary, agree int, id long, size long, marks binary"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[bytes, tuple[int, int, int, bytes]] = {}

        def scored() -> pa.RecordBatch:
            columns = zip(*best.values(), strict=True) if best else ([], [], [], [])
            agree, ids, sizes, marks = (list(c) for c in columns)
            out = [pa.array(list(best), pa.binary()), pa.array(agree, pa.int32()), pa.array([-i for i in ids], pa.int64()),
                   pa.array(sizes, pa.int64()), pa.array(marks, pa.binary())]
            best.clear()
            return pa.RecordBatch.from_arrays(out, ["region", "agree", "id", "size", "marks"])

        for begins, heads, under, b in _met(batches):
            if begins:
                yield scored()
            if not under:
                continue
            ids, sizes, every = b.column("id").to_numpy(), b.column("size").to_numpy(), b.column("marks")
            for name, at in under.items():
                agree = (_matrix(every.take(pa.array(at))) == heads[name][2]).sum(1)
                k = int(np.lexsort((ids[at], -agree))[0])
                found = (int(agree[k]), -int(ids[at[k]]), int(sizes[at[k]]), every[int(at[k])].as_py())
                best[name] = max(best[name], found) if name in best else found
        yield scored()

    # every region's best row of each piece; ``id`` is that of the node again
    each = _beside(heads, going_on).mapInArrow(score, schema)
    top = F.max(F.struct("agree", (-F.col("id")).alias("less"), "size", "marks")).alias("hub")
    hubs = each.groupBy("region").agg(top).select("region", (-F.col("hub.less")).alias("id"), "hub.size", "hub.marks")
    heads = written(where.select("piece", "region").join(hubs, "region"), "nd-hubs")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, heads, under, b in _met(batches):
            if not under:
                continue
            ids, sizes, every = b.column("id").to_numpy(), b.column("size").to_numpy(), b.column("marks")
            found = set()  # a node has one pair with each of its hubs
            for name, at in under.items():
                hub, size, marks = heads[name]
                low, high = np.minimum(sizes[at], size), np.maximum(sizes[at], size)
                at = at[(SIMILAR[1] * low >= SIMILAR[0] * high) & (ids[at] != hub)]
                agree = (_matrix(every.take(pa.array(at))) == marks).sum(1)
                close = agree >= MIN_AGREE
                at, agree = ids[at[close]], agree[close]
                found.update(zip(np.minimum(at, hub).tolist(), np.maximum(at, hub).tolist(), agree.tolist(), strict=True))
            rows = sorted(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32()))], ["a", "b", "agree"]
            )

    return _beside(heads, going_on).mapInArrow(compare, "a long, b long, agree int")


def _marks(signatures: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The minima of signatures, and a byte of each."""
    minima = np.frombuffer(b"".join(signatures.to_pylist()), ">u4").reshape(-1, _N)
    return minima, (minima.astype(np.uint32) * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8)


def looks(nodes: DataFrame) -> DataFrame:
    """What the sorted orders of ``nodes`` (doc_id, n_shingles, signature) show, block by block, written."""

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            minima, marks = _marks(b.column(2))
            sketch = pa.array([m.tobytes() for m in marks], pa.binary())
            for t in range(TREES):
                keys = [m.tobytes() for m in minima[:, t * DEPTH : (t + 1) * DEPTH]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, t, np.int32)), pa.array(keys, pa.binary()), sketch, b.column(0), b.column(1)],
                    ["tree", "key", "marks", "id", "size"],
                )

    forest = nodes.select("doc_id", "n_shingles", "signature").mapInArrow(
        plant, "tree int, key binary, marks binary, id long, size long"
    )
    ordered = forest.repartitionByRange(2 * partitions(nodes.sparkSession), "tree", "key", "id").sortWithinPartitions("tree", "key", "id")

    names = ["kind", "a", "b", "agree", "region", "marks", "piece"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32()]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = TaskContext.get().partitionId()

        def out(kind: int, *columns) -> pa.RecordBatch:
            """Some of the columns a to marks, the others null."""
            n = len(columns[0])
            full = [[kind] * n, *(c if c is not None else [None] * n for c in columns), [piece] * n]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(full, types, strict=True)], names)

        def pairs(found: set[tuple[int, int, int]]) -> pa.RecordBatch:
            rows = sorted(found)
            return out(PAIR, *([r[i] for r in rows] for i in range(3)), None, None)

        def edge(rows: Block) -> pa.RecordBatch:
            keys, marks = [k.astype(">u4").tobytes() for k in rows.keys], [m.tobytes() for m in rows.marks]
            return out(EDGE, rows.ids, rows.sizes, rows.tree, keys, marks)

        def block(held: list[pa.RecordBatch]) -> Block:
            t = pa.Table.from_batches(held)
            n = t.num_rows
            return Block(
                t["tree"].to_numpy(), np.frombuffer(b"".join(t["key"].to_pylist()), ">u4").reshape(n, DEPTH),
                np.frombuffer(b"".join(t["marks"].to_pylist()), np.uint8).reshape(n, _N), t["id"].to_numpy(), t["size"].to_numpy(),
            )

        def blocks() -> Iterator[Block]:
            held: list[pa.RecordBatch] = []
            for b in batches:
                if b.num_rows:
                    held.append(b)
                if sum(x.num_rows for x in held) >= BLOCK:
                    yield block(held)
                    held = []
            if held:
                yield block(held)

        open_counts: dict[bytes, tuple[int, np.ndarray]] = {}  # of regions that may go on in the next block

        def counted(regions: list[bytes]) -> pa.RecordBatch:
            held = [open_counts.pop(r) for r in regions]
            return out(COUNT, [n for n, _ in held], None, None, regions, [zlib.compress(c.tobytes(), 1) for _, c in held])

        first: Block | None = None
        last: Block | None = None
        for rows in blocks():
            found, going_on = region_candidates(rows)
            # windows reach back to the last rows of the block before
            joined = rows if last is None else rows.after(last)
            yield pairs(found | window_candidates(joined))
            crowding = rows.crowding()
            at = np.flatnonzero(crowding)
            yield out(CROWD, rows.ids[at], crowding[at], None, None, None)
            deepest = np.zeros(len(rows.ids), np.int64)
            for name, x, y in going_on:
                deepest[x : y + 1] = np.maximum(deepest[x : y + 1], (len(name) - 1) // 4)
                n, counts = open_counts.get(name, (0, 0))
                open_counts[name] = n + y + 1 - x, counts + _counts(rows.marks[x : y + 1])
            ended = open_counts.keys() - {name for name, _, y in going_on if y == len(rows.ids) - 1}
            yield counted(sorted(ended))
            at = np.flatnonzero(deepest)
            for some in np.split(at, range(1000, len(at), 1000)):
                names_of = [rows.name(i, deepest[i]) for i in some]
                yield out(REGION, rows.ids[some], rows.sizes[some], None, names_of, [m.tobytes() for m in rows.marks[some]])
            if first is None or len(first.ids) < WINDOW:
                first = joined.rows(slice(0, WINDOW))
            last = joined.rows(slice(-WINDOW, None))
        yield counted(sorted(open_counts))
        if first is not None:
            known = set(zip(first.tree.tolist(), first.ids.tolist(), strict=True))
            yield edge(first)
            yield edge(last.rows([i for i, x in enumerate(zip(last.tree.tolist(), last.ids.tolist(), strict=True)) if x not in known]))

    schema = "kind int, a long, b long, agree int, region binary, marks binary, piece int"
    return written(ordered.mapInArrow(look, schema), "nd-looks")


def crowded(seen: DataFrame) -> DataFrame:
    """The ids of the nodes in crowds, from what ``looks`` gave.

    A pair of similarity 0.75 that no tree compares shares some 30 minima on average, fewer than CROWDED
    about once in two thousand, and the nodes just beyond the windows share no fewer.
    """
    each = seen.where(F.col("kind") == CROWD).groupBy(F.col("a").alias("id")).agg(F.sum("b").alias("n"))
    return each.where(F.col("n") >= CROWDED).select("id")


def candidates(nodes: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Distinct candidate pairs (a, b, agree) of ``nodes`` (doc_id, n_shingles, signature); ``seen``: their ``looks``."""
    seen = looks(nodes) if seen is None else seen

    def seams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The windows over the ends of the range partitions, from 2 * WINDOW rows of each at most."""
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        n = t.num_rows
        rows = Block(
            t["agree"].to_numpy(), np.frombuffer(b"".join(t["region"].to_pylist()), ">u4").reshape(n, DEPTH),
            np.frombuffer(b"".join(t["marks"].to_pylist()), np.uint8).reshape(n, _N), t["a"].to_numpy(), t["b"].to_numpy(),
        )
        found = sorted(window_candidates(rows, t["piece"].to_numpy()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in found], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.int32()))], ["a", "b", "agree"]
        )

    edges = seen.where(F.col("kind") == EDGE).drop("kind").repartition(1).sortWithinPartitions("agree", "region", "a")
    over = edges.mapInArrow(seams, "a long, b long, agree int")
    going_on = seen.where(F.col("kind") == REGION).select("piece", "region", F.col("a").alias("id"), F.col("b").alias("size"), "marks")
    counts = seen.where(F.col("kind") == COUNT).select("piece", "region", F.col("a").alias("n"), F.col("marks").alias("counts"))
    pairs = seen.where(F.col("kind") == PAIR).select("a", "b", "agree")
    return pairs.unionByName(over).unionByName(hub_candidates(going_on, counts)).distinct()


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar; ``texts``: (id, text as bytes) of one row per node."""
    # texts are never broadcast: the plan is the same at every size
    mine = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")).hint("merge")
    other = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")).hint("merge")
    joined = pairs.select("a", "b").join(mine, "a").join(other, "b").select("a", "b", "text_a", "text_b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, kept = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            last: tuple = (None, None)
            for i in range(batch.num_rows):
                if b[i] != last[0]:  # rows of one b follow each other
                    last = (b[i], shingles(batch.column(3)[i].as_py()))
                x, y = shingles(batch.column(2)[i].as_py()), last[1]
                both = len(np.intersect1d(x, y, assume_unique=True))
                if SIMILAR[1] * both >= SIMILAR[0] * (len(x) + len(y) - both):
                    kept.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[i] for i in kept], pa.int64()), pa.array([b[i] for i in kept], pa.int64())], ["a", "b"]
            )

    return joined.mapInArrow(check, "a long, b long")


def _perhaps(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not among ``ids``, before any shuffle.

    The ids' hashes are bits of a map of 2**26, 2,048 rows of 4 KB at most whatever the data, broadcast.
    Every row of the ids stays; where the map is full, all rows do.
    """
    place = F.shiftrightunsigned(F.xxhash64(key), 38)
    bits = ids.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits"))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0
    met = rows.withColumn("_bucket", F.bitmap_bucket_number(place)).join(F.broadcast(bits), "_bucket").where(marked)
    return met.select(*rows.columns)


def rare_pairs(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """Distinct candidate pairs (a, b, agree) of the crowded nodes ``texts`` (id, text as bytes) that share a shingle
    of at most RARE of them; ``nodes``: (doc_id, n_shingles, signature).

    Shingles are counted first, map-side; only the ids of rare ones are then brought together, RARE at most.
    """

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                found = shingles(text.as_py()).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.full(len(found), i, np.int64))], ["shingle", "id"])

    spelt = texts.select("id", "text").mapInArrow(spell, "shingle long, id long")
    rare = written(spelt.groupBy("shingle").count().where(F.col("count").between(2, RARE)).select("shingle"), "nd-rare")
    groups = _perhaps(spelt, rare, "shingle").join(rare, "shingle").groupBy("shingle").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    later = F.expr("flatten(transform(ids, (x, i) -> transform(slice(ids, i + 2, size(ids)), y -> struct(x AS a, y AS b))))")
    pairs = groups.select("ids").distinct().select(F.explode(later).alias("p")).select("p.a", "p.b").distinct()
    for c in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("doc_id").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("signature").alias(f"of_{c}")), c)
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    fits = pairs.where(SIMILAR[1] * small >= SIMILAR[0] * large).select("a", "b", "of_a", "of_b")

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                same = (_marks(b.column(2))[1] == _marks(b.column(3))[1]).sum(1).astype(np.int32)
                close = pa.array(same >= MIN_AGREE)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(same)], ["a", "b", "agree"]).filter(close)

    return fits.mapInArrow(agree, "a long, b long, agree int")


def _promising(pairs: DataFrame) -> DataFrame:
    """Of each node the candidate that agrees most, and the one with the smallest id."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "agree"))
    chosen = both.groupBy("a").agg(
        F.max(F.struct("agree", F.xxhash64("a", "b"), F.col("b").alias("b"))).alias("closest"), F.min("b").alias("smallest")
    )
    each = chosen.select("a", F.explode(F.array("closest.b", "smallest")).alias("b"))
    return each.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text)."""
    small_batches(docs.sparkSession)
    rows = written(sketches(docs), "nd-sketches")
    usable = rows.where("n_shingles > 0 and doc_id is not null")
    classes = written(usable.groupBy("set_1", "set_2").agg(F.min("doc_id").alias("node")), "nd-classes")
    first = usable.join(classes, ["set_1", "set_2"]).where("doc_id = node")
    nodes = first.select("doc_id", "n_shingles", "signature")
    seen = looks(nodes)
    pairs = written(candidates(nodes, seen), "nd-candidates")
    alone = F.lit(False).alias("crowded")
    every = pairs.select("a", alone).unionByName(pairs.select(F.col("b").alias("a"), alone))
    every = every.unionByName(crowded(seen).select(F.col("id").alias("a"), F.lit(True).alias("crowded")))
    named = written(every.groupBy("a").agg(F.max("crowded").alias("crowded")), "nd-named")
    plain = docs.select(F.col("doc_id").alias("a"), F.col("text").cast("binary").alias("text")).where("text is not null")
    texts = written(
        _perhaps(plain, named, "a").join(named, "a").groupBy(F.col("a").alias("id"), "crowded").agg(F.max("text").alias("text")), "nd-texts"
    )
    close = written(rare_pairs(texts.where("crowded"), nodes), "nd-rare-pairs")
    pairs = pairs.unionByName(close).distinct()
    chosen = written(_promising(pairs), "nd-chosen")
    links = written(confirmed(chosen, texts), "nd-links")
    part = components(links)

    # what is left between components
    rest = pairs.join(chosen, ["a", "b"], "left_anti")
    for c in ("a", "b"):
        rest = rest.join(part.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}")), c, "left")
    rest = rest.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")
    more = written(confirmed(rest, texts), "nd-more-links")
    # contracted: the first components and what joins them; classes hang on their nodes
    shared = links.unionByName(more)
    part = components(shared)

    belongs = classes.join(part, "node", "left").select("set_1", "set_2", F.coalesce("component", "node").alias("found"))
    out = rows.join(belongs, ["set_1", "set_2"], "left")
    component = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("found")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group: the rows of its smallest doc_id."""
    gone = near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
