"""WARC files: written from pages, read back, transactions assembled.

Writing: each page gives a request, a response (or a revisit) and a metadata
record; request and metadata name the response's record id in
WARC-Concurrent-To.  Of pages with equal payloads the one with the smallest
page_id is the response, the others are revisits (identical-payload-digest)
that keep the HTTP headers and refer to it.  Files are compressed record by
record with gzip, as the standard asks; a task attempt writes a file of its
own name and only files in the manifest count.

Reading: the files are streamed record by record into rows; ``captures`` joins
request, response and metadata rows through the concurrent-to ids into one
nested row per capture.

Nulls: a null html is an empty payload, a null url an empty target, a page
with a null page_id is a capture of its own like any other (it sorts after
the others).  Rows with the same page_id and payload: one is the response.  An
empty table gives no file and no captures.
"""

from __future__ import annotations

import gzip
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientincome.llm.common import discard, make_folder, open_read, open_write, small_batches, written

MANIFEST = "path string, records long"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRAWLED = "2024-01-01T00:00:00Z"
LEVEL = 6  # of gzip
RECORD = (
    "warc_type string, record_id string, concurrent_to string, target_uri string, payload_digest string, "
    "refers_to string, payload_bytes long, fields map<string,string>, payload binary"
)


def _record(kind: str, record_id: str, block: bytes, **headers: str) -> bytes:
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": CRAWLED}
    head |= {k.replace("_", "-"): v for k, v in headers.items() if v is not None}
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return gzip.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n", LEVEL, mtime=0)


def _header_value(text: str) -> str:
    """A header holds no line ends."""
    return (text or "").replace("\r", "%0D").replace("\n", "%0A")


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Payloads compressed, for the table and the shuffle they pass on the way to their file."""
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=5).compress
    for b in batches:
        packed = pa.array([squeeze(x) for x in b.column(3).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(1), b.column(2), packed], ["page_id", "url", "sha1", "packed"])


def write_warc(pages: DataFrame, folder: str, files: int | None = None) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to WARC files in ``folder``; returns the manifest."""
    spark = pages.sparkSession
    small_batches(spark)
    make_folder(folder)
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    # a record id must not depend on the attempt: it is that of the page and its place among repeats
    # digests and ids move as bytes, half as long as their text
    rows = pages.select("page_id", "url", F.unhex(F.sha1(html)).alias("sha1"), html.alias("payload"))
    rows = rows.mapInArrow(_squeezed, "page_id long, url string, sha1 binary, packed binary")
    keyed = written(rows.withColumn("row_id", F.expr("unhex(replace(uuid(), '-', ''))")), "warc-pages")
    # nulls last, so a page with an id is the response before one without
    firsts = keyed.groupBy("sha1").agg(F.min_by("row_id", F.struct(F.col("page_id").isNull(), "page_id", "row_id")).alias("first_row"))
    # the payloads move once, by row_id; roles are found on the digests alone
    roles = keyed.select("row_id", "sha1").join(firsts, "sha1").select("row_id", "first_row")
    planned = keyed.join(roles, "row_id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from base64 import b32encode

        import zstandard

        unzip = zstandard.ZstdDecompressor()
        path = f"{folder}/pages-{uuid.uuid4().hex}.warc.gz"
        out, n = None, 0
        for batch in batches:
            for page_id, url, packed, sha1, row_id, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out = out or open_write(path)
                payload = unzip.decompress(packed)
                digest = "sha1:" + b32encode(sha1).decode()
                own = uuid.UUID(bytes=row_id)
                uri, ident = _header_value(url), own.urn
                revisit = row_id != first
                http = HTTP.format(len(payload)).encode()
                out.write(
                    _record(
                        "revisit" if revisit else "response", ident, http + (b"" if revisit else payload),
                        WARC_Target_URI=uri, WARC_Payload_Digest=digest, Content_Type="application/http; msgtype=response",
                        WARC_Profile=PROFILE if revisit else None,
                        WARC_Refers_To=f"<{uuid.UUID(bytes=first).urn}>" if revisit else None,
                    )
                )
                for kind, block, type_ in (
                    ("request", f"GET {uri} HTTP/1.1\r\n\r\n".encode(), "application/http; msgtype=request"),
                    ("metadata", f"page_id: {'' if page_id is None else page_id}\r\n".encode(), "application/warc-fields"),
                ):
                    other = uuid.uuid5(own, kind).urn
                    out.write(_record(kind, other, block, WARC_Target_URI=uri, WARC_Concurrent_To=f"<{ident}>", Content_Type=type_))
                n += 3
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [n]})

    dealt = planned.select("page_id", "url", "packed", "sha1", "row_id", "first_row")
    if files:
        dealt = dealt.repartition(files, "row_id")
    manifest = written(dealt.mapInArrow(write, MANIFEST), "warc-manifest")
    discard(keyed)
    return manifest


def _records(path: str, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of a file; each is one gzip member, read in bounded chunks."""
    with open_read(path) as f:
        member, parts, data = zlib.decompressobj(31), [], b""
        while data or (data := f.read(chunk)):
            parts.append(member.decompress(data))
            data = member.unused_data
            if member.eof:
                yield b"".join(parts)
                member, parts = zlib.decompressobj(31), []
        if any(parts):
            raise ValueError(f"{path}: the last record is cut off")


def _parsed(record: bytes) -> tuple[str, dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {}
    for line in lines:
        k, _, v = line.partition(":")
        fields[k.strip().lower()] = v.strip()
    return fields["warc-type"], fields, rest[: int(fields["content-length"])]


def read_records(spark: SparkSession, manifest: DataFrame, payload: bool = True) -> DataFrame:
    """One row per WARC record; ``payload``: carry the blocks too.

    ``payload_bytes`` is the full payload's length, for a revisit that of the
    HTTP header it keeps; digests of responses are checked against their blocks.
    ``fields`` are the name: value lines of a metadata block.
    """
    small_batches(spark)
    paths = manifest.select("path")
    count = paths.count()
    listed = paths.repartition(max(1, count))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from base64 import b32encode
        from hashlib import sha1

        names = ["warc_type", "record_id", "concurrent_to", "target_uri", "payload_digest", "refers_to", "payload_bytes", "fields", "payload"]
        kinds = [pa.string()] * 6 + [pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary()]
        bare = lambda v: v[1:-1] if v else None  # noqa: E731  <id>

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

        for b in batches:
            for path in b.column(0).to_pylist():
                rows = []
                for record in _records(path):
                    kind, h, block = _parsed(record)
                    digest, length, fields = h.get("warc-payload-digest", "")[5:] or None, None, None
                    if kind in ("response", "revisit"):
                        http, _, body = block.partition(b"\r\n\r\n")
                        length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                        if kind == "response" and (len(body) != length or b32encode(sha1(body).digest()).decode() != digest):
                            raise ValueError(f"{path}: {h['warc-record-id']} fails its digest")
                        block = body
                    elif kind == "metadata":
                        fields = [tuple(x.split(": ", 1)) for x in block.decode().split("\r\n") if ": " in x]
                    rows.append(
                        (kind, bare(h["warc-record-id"]), bare(h.get("warc-concurrent-to")), h.get("warc-target-uri"), digest,
                         bare(h.get("warc-refers-to")), length, fields, block if payload else None)
                    )
                    if len(rows) == 300:
                        yield batch(rows)
                        rows = []
                if rows:
                    yield batch(rows)

    return listed.mapInArrow(read, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: (record_id, target_uri, response, request, metadata).

    Request and metadata records join the response or revisit they are
    concurrent to.  A response without them keeps nulls there; should one be
    written twice, the smallest record id counts.
    """
    response = records.where(F.col("warc_type").isin("response", "revisit")).select(
        "record_id", "target_uri",
        F.struct("warc_type", "payload_digest", "payload_bytes", "refers_to", "payload").alias("response"),
    )

    def one(kind: str, *columns: str) -> DataFrame:
        return (
            records.where((F.col("warc_type") == kind) & F.col("concurrent_to").isNotNull())
            .groupBy(F.col("concurrent_to").alias("record_id"))
            .agg(F.min_by(F.struct(F.col("record_id").alias("id"), *columns), "record_id").alias(kind))
        )

    return response.join(one("request", "payload"), "record_id", "left").join(one("metadata", "fields", "payload"), "record_id", "left")


def page_rows(assembled: DataFrame) -> DataFrame:
    """Digest rows of captures: which page is the response and which refer to it."""
    page_id = F.col("metadata.fields")["page_id"].try_cast("long")
    flat = assembled.select("record_id", page_id.alias("page_id"), "response.*")
    target = flat.where("warc_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("response_page"))
    # responses refer to nothing: they stay out of the join, where their nulls would meet in one task
    alone = flat.where("refers_to is null").withColumn("response_page", F.lit(None).cast("long"))
    found = flat.where("refers_to is not null").join(target, "refers_to", "left")
    return alone.unionByName(found).select(
        "page_id", "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), F.col("response_page").alias("refers_to")
    )
