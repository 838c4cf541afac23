"""Token-id files: one zstandard frame for each document and a seek table.

A shard file holds, in ascending doc_id order,

* one independent zstandard frame per document, with a content checksum: its
  ids as little-endian unsigned integers of ``width`` bytes;
* a skippable frame with the document index (doc_ids, null flags);
* a skippable frame with the seek table of the public seekable format: for
  each frame its compressed and plain size and the low 32 bits of the XXH64
  of its plain bytes, then the number of frames and the closing magic number.

A reader seeks to the end, reads the table and the index, and decompresses the
frames of the documents asked for.  Each task attempt writes a file of its own
name; only files in the manifest count, so a lost or repeated attempt leaves
no wrong shard.

Nulls: a null text is empty (its frame holds the end id alone), a null doc_id
sorts first and stays null.  Repeated doc_ids each keep their own frame, in the
order of a hash of their texts.  An id too large for ``width`` is an error.
An empty table gives no shard and no rows.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientincome.llm.common import (
    make_folder, open_read, open_write, partitions, small_batches, text_or_empty, written,
)
from clientincome.llm.tokens import encoder

# The magic numbers of the public seekable zstandard format.
SEEK_MAGIC, FOOTER_MAGIC, INDEX_MAGIC = 0x184D2A5E, 0x8F92EAB1, 0x184D2A50
CHECKSUMS = 0x80

MANIFEST = "shard int, path string, docs long, ids long"


class ShardWriter:
    """Writes one shard: a frame per document, then index and seek table."""

    def __init__(self, path: str, width: int = 2, level: int = 3):
        import zstandard

        self.out = open_write(path)
        self.width = width
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.table, self.doc_ids = [], []
        self.ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """``ids``: little-endian unsigned 32-bit integers."""
        import numpy as np
        import xxhash

        if self.width == 2:
            wide = np.frombuffer(ids, "<u4")
            if len(wide) and wide.max() > 0xFFFF:
                raise ValueError(f"id {wide.max()} does not fit into two bytes: write with width 4")
            ids = wide.astype("<u2").tobytes()
        frame = self.zstd.compress(ids)
        self.out.write(frame)
        self.table.append((len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self.doc_ids.append(doc_id)
        self.ids += len(ids) // self.width

    def close(self) -> None:
        index = struct.pack("<BI", self.width, len(self.doc_ids)) + b"".join(
            struct.pack("<?q", d is None, d or 0) for d in self.doc_ids
        )
        seek = b"".join(struct.pack("<III", *row) for row in self.table)
        seek += struct.pack("<IBI", len(self.table), CHECKSUMS, FOOTER_MAGIC)
        for magic, body in ((INDEX_MAGIC, index), (SEEK_MAGIC, seek)):
            self.out.write(struct.pack("<II", magic, len(body)) + body)
        self.out.close()


class ShardReader:
    """Opens a shard by its seek table; ``ids(i)`` reads the frame of document i alone."""

    def __init__(self, path: str):
        import zstandard

        self.file = f = open_read(path)
        self.unzip = zstandard.ZstdDecompressor()
        f.seek(0, 2)
        size = f.tell()
        f.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", f.read(9))
        if magic != FOOTER_MAGIC or flags != CHECKSUMS:
            raise ValueError(f"{path}: no seek table at its end")
        f.seek(size - 9 - 12 * n - 8)
        if struct.unpack("<II", f.read(8)) != (SEEK_MAGIC, 12 * n + 9):
            raise ValueError(f"{path}: broken seek table")
        body = f.read(12 * n)
        self.table = [struct.unpack_from("<III", body, 12 * i) for i in range(n)]
        self.starts = [0]
        for packed, _, _ in self.table:
            self.starts.append(self.starts[-1] + packed)
        f.seek(self.starts[-1])
        magic, length = struct.unpack("<II", f.read(8))
        if magic != INDEX_MAGIC:
            raise ValueError(f"{path}: no document index")
        body = f.read(length)
        self.width, docs = struct.unpack_from("<BI", body)
        rows = [struct.unpack_from("<?q", body, 5 + 9 * i) for i in range(docs)]
        self.doc_ids = [None if null else d for null, d in rows]
        self.path = path

    def lengths(self) -> list[int]:
        return [plain // self.width for _, plain, _ in self.table]

    def ids(self, i: int) -> bytes:
        """The ids of document ``i`` as little-endian unsigned 32-bit integers."""
        import numpy as np
        import xxhash

        packed, plain, checksum = self.table[i]
        self.file.seek(self.starts[i])
        out = self.unzip.decompress(self.file.read(packed), max_output_size=plain)
        if len(out) != plain or xxhash.xxh64_intdigest(out) & 0xFFFFFFFF != checksum:
            raise ValueError(f"{self.path}: frame {i} fails its checksum")
        return out if self.width == 4 else np.frombuffer(out, "<u2").astype("<u4").tobytes()

    def close(self) -> None:
        self.file.close()


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, shards: int | None = None, width: int = 2
) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into shard files; returns the manifest.

    Documents are range-partitioned by doc_id, so shards and the documents in
    them ascend.  ``width``: bytes of an id, 2 while the vocabulary fits.
    """
    spark = docs.sparkSession
    small_batches(spark)
    make_folder(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, end = encoder(tokenizer).many, struct.pack("<I", end_id)
        shard = TaskContext.get().partitionId()
        path = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.zst"
        out = None
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist()), strict=True):
                out = out or ShardWriter(path, width)
                out.add(doc_id, ids + end)
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int32()), "path": [path], "docs": [len(out.table)], "ids": [out.ids]}
            )

    # rows of one doc_id are ordered, and parted if they are many, by the hash of their text
    order = ("doc_id", "hash")
    rows = docs.select("doc_id", text_or_empty().alias("text"), F.xxhash64(text_or_empty()).alias("hash"))
    ordered = rows.repartitionByRange(shards or partitions(spark), *order).sortWithinPartitions(*order)
    return written(ordered.select("doc_id", "text").mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(spark: SparkSession, manifest: DataFrame, doc_ids: list[int] | None = None) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids) of the files; ``doc_ids``: these documents' frames only.

    ``start`` counts the ids of all documents before it, over all shards.  The
    manifest has one row per shard, so its running sum is taken on the driver.
    """
    small_batches(spark)
    wanted = None if doc_ids is None else frozenset(doc_ids)
    shards, at = [], 0
    for row in sorted(manifest.collect(), key=lambda r: r["shard"]):
        shards.append((row["path"], at))
        at += row["ids"]
    schema = "doc_id long, start long, n_tokens long, ids binary"
    if not shards:
        return spark.createDataFrame([], schema)
    listed = spark.createDataFrame(shards, "path string, first long").repartition(len(shards))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = ShardReader(path)
                rows = []
                for i, (doc_id, n) in enumerate(zip(shard.doc_ids, shard.lengths(), strict=True)):
                    if wanted is None or doc_id in wanted:
                        rows.append((doc_id, at, n, shard.ids(i)))
                    at += n
                    if len(rows) == 500:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)
                shard.close()

    return listed.mapInArrow(read, schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])


def ids_crc32():
    """Unsigned CRC-32 of the ids column."""
    return F.crc32("ids")
