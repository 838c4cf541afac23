import base64
import hashlib
import random
import struct
import uuid
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clientincome.llm import packing, token_files, tokens, warc
from clientincome.llm.common import table
from clientincome.session import scratch_path

P = pytest.importorskip("public_tokenizers")
WORD, BYTE = str(P.path("word_bpe_49k.json")), str(P.path("byte_bpe_50k.json"))
ODD = ["", " ", " a", "a ", "a  b", "a\n\nb", "a.\nB c", "don't stop, it's 5'9\" x", "ée ́x", "x\ty z", "<|endoftext|> a", "a <|endoftext|> b", "a<|startoftext|>b <|STARTOFTEXT|>", "<| a |>", "..., ,,", "a \nb", "1.5, 2!? ok..", "a's. b've, c", " x   y", "İΣ Σ.", "ÀÉ Öß\nÿ", "ªº µ", "a\u00a0b c", "Straße,Œuvre ŒUVRE", "\u212b e\u0301"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    loaded = {}

    def ids(path, text):
        if path not in loaded:
            loaded[path] = Tokenizer.from_file(path)
        return loaded[path].encode(text or "", add_special_tokens=False).ids

    return ids


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_ids_are_the_librarys(path, small, library, monkeypatch):
    encode = tokens.encoder(path).ids
    for text in ODD + [t for _, t, _ in small]:
        assert list(struct.unpack(f"<{len(encode(text)) // 4}I", encode(text))) == library(path, text)
    # a full memory changes nothing
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 300)
    monkeypatch.setattr(tokens, "TOGETHER", 5000)
    texts = ODD + [t for _, t, _ in small]
    assert list(tokens.encoder(path).many(texts)) == [struct.pack(f"<{len(x)}I", *x) for x in (library(path, t) for t in texts)]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_marks_after_any_latin_letter(path, library):
    """A word is merged once, whatever marks follow it; the ids stay the library's."""
    pieces = type(tokens.encoder(path))(path)
    stems = [f"Qu{chr(c)}z{chr(c)}" for c in (*range(65, 91), *range(97, 123), *range(0xC0, 0x100)) if c not in (0xD7, 0xF7)]
    marks = [*",.;:!?#%&*)", "###", "%%%", ".&&&", "?!)", "...", "*)."]
    texts = ["a " + " ".join(s + m for s in stems) for m in marks] + ["\n".join(f"{s}{m} {s}{m}{s}" for s in stems[::9]) for m in marks]
    for text in texts:
        assert list(struct.unpack(f"<{len(pieces.ids(text)) // 4}I", pieces.ids(text))) == library(path, text)
    assert all(s in pieces for s in stems)


def test_token_files(spark, small, make_docs, library):
    rows = [(d, t) for d, t, _ in small] + [(1000 + i, t) for i, t in enumerate(ODD)] + [(5000, None)]
    manifest = token_files.write_token_files(make_docs(rows), scratch_path(spark, "tf"), WORD, 2, shards=5)
    assert manifest.count() > 1
    got = sorted(tuple(r) for r in token_files.read_token_files(spark, manifest).collect())
    at, want = 0, []
    for d, t in sorted(rows):
        ids = library(WORD, t) + [2]
        want.append((d, at, len(ids), bytearray(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    assert got == want
    few = token_files.read_token_files(spark, manifest, [rows[3][0], 5000]).collect()
    assert sorted(tuple(r) for r in few) == [w for w in want if w[0] in (rows[3][0], 5000)]


def test_token_file_format(tmp_path):
    """A standard decoder reads the whole file; a damaged frame is found out; width 4 holds large ids."""
    import zstandard

    path = str(tmp_path / "x.zst")
    ids = [struct.pack("<3I", 1, 2, 70_000), struct.pack("<I", 2), b""]
    w = token_files.ShardWriter(path, width=4)
    for i, x in enumerate(ids):
        w.add(None if i == 1 else i, x)
    w.close()
    r = token_files.ShardReader(path)
    assert [r.ids(i) for i in (2, 0, 1)] == [ids[2], ids[0], ids[1]] and r.doc_ids == [0, None, 2]
    with open(path, "rb") as f:
        raw = f.read()
    assert zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read() == b"".join(ids)
    with open(path, "wb") as f:
        f.write(raw[:12] + bytes([raw[12] ^ 255]) + raw[13:])
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_files.ShardReader(path).ids(0)


def test_token_files_odd_rows(spark, odd_docs, make_docs):
    manifest = token_files.write_token_files(odd_docs, scratch_path(spark, "tf"), WORD, 2)
    assert token_files.read_token_files(spark, manifest).count() == odd_docs.count()
    none = token_files.write_token_files(make_docs([]), scratch_path(spark, "tf"), WORD, 2)
    assert token_files.read_token_files(spark, none).count() == 0


# ------------------------------------------------------------------ packing
def check_bins(bins, histogram, capacity):
    placed = Counter()
    for lengths, n in bins:
        assert n > 0 and sum(lengths) <= capacity
        for s in lengths:
            placed[s] += n
    assert placed == Counter(histogram)
    return sum(n for _, n in bins)


def optimum(sizes, capacity):
    """Fewest bins by trying all places."""
    best = [len(sizes)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for k in sorted({b: j for j, b in enumerate(bins)}.values()):
            if bins[k] + sizes[i] <= capacity:
                bins[k] += sizes[i]
                place(i + 1, bins)
                bins[k] -= sizes[i]
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best[0]


def test_plan_against_the_optimum():
    rng = random.Random(11)
    over = 0
    for _ in range(150):
        capacity = rng.choice([10, 17, 30])
        sizes = sorted((rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 11))), reverse=True)
        bins, fixed = packing.plan(Counter(sizes), capacity)
        used, best = check_bins(bins, Counter(sizes), capacity), optimum(sizes, capacity)
        over += used - best
        assert fixed <= best
    assert over <= 5


def test_reduction_is_safe():
    """Bins fixed by dominance never cost the optimum anything."""
    rng = random.Random(12)
    for _ in range(100):
        sizes = sorted((rng.randrange(1, 21) for _ in range(9)), reverse=True)
        left, fixed = packing.Sizes(Counter(sizes)), 0
        for s in sorted(set(sizes), reverse=True):
            while left.count.get(s) and (chosen := packing.dominant(left, s, 20)):
                for x in chosen:
                    left.take(x, 1)
                fixed += 1
        rest = sorted(Counter(left.count).elements(), reverse=True)
        assert fixed + (optimum(rest, 20) if rest else 0) == optimum(sizes, 20)


def check_pack(out, texts, library, capacity):
    """Every id once, in order; pieces cut as told; sequences without gaps or overlaps."""
    docs = {}
    for r in out:
        docs.setdefault(r["doc_id"], []).append(r)
    for d, t in texts.items():
        ids = library(BYTE, t) + [0]
        pieces = sorted(docs.pop(d), key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces))) and all(r["length"] == capacity for r in pieces[1:])
        assert len(pieces) == -(-len(ids) // capacity)
        at = 0
        for r in pieces:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(struct.pack(f"<{r['length']}I", *ids[at : at + r["length"]]))
            at += r["length"]
        assert at == len(ids)
    assert not docs
    sequences = {}
    for r in out:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r["length"] for r in out)
    return len(sequences), -(-total // capacity)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_pack(small, make_docs, library, capacity):
    texts = {d: t for d, t, _ in small} | {10_000 + i: t for i, t in enumerate(ODD)} | {20_000: None}
    out = packing.pack(make_docs(list(texts.items())), BYTE, 0, capacity).collect()
    used, least = check_pack(out, texts, library, capacity)
    assert used <= least * 1.01 + 1


def test_pack_odd_rows(odd_docs, make_docs):
    out = packing.pack(odd_docs, BYTE, 0, 2048).collect()
    assert sum(r["piece"] == 0 for r in out) == odd_docs.count()
    assert packing.pack(make_docs([]), BYTE, 0, 2048).count() == 0


# ------------------------------------------------------------------ WARC
def expected_pages(pages):
    first, out = {}, []
    for p, h in pages:
        body = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        first[digest] = min(first.get(digest, p), p)
        out.append((p, len(body), digest))
    return sorted((p, n, d, "response" if first[d] == p else "revisit", None if first[d] == p else first[d]) for p, n, d in out)


def test_warc(spark):
    pages = table(spark, "/root/testdata/sf0.001", "pages").select("page_id", "url", "html")
    extra = [(5000 + i, f"http://x/{i}", "same é") for i in range(30)] + [(1, None, None)][:0] + [(6000, None, None), (6001, "u\r\nv", ""), (6002, "", "WARC/1.1\r\n\r\n")]
    pages = pages.unionByName(spark.createDataFrame(extra, pages.schema))
    manifest = warc.write_warc(pages, scratch_path(spark, "warc"), files=7)
    assert sum(r["records"] for r in manifest.collect()) == 3 * pages.count()
    records = warc.read_records(spark, manifest)
    nested = warc.captures(records)
    got = sorted(tuple(r) for r in warc.page_rows(nested).collect())
    assert got == expected_pages([(r["page_id"], r["html"]) for r in pages.collect()])
    row = nested.where(F.col("metadata.fields")["page_id"] == "6002").collect()[0]
    assert bytes(row["response"]["payload"]) == b"WARC/1.1\r\n\r\n" and bytes(row["request"]["payload"]).startswith(b"GET ")
    alone = warc.captures(records.where("warc_type in ('response', 'revisit')"))
    assert alone.count() == pages.count() and alone.where("request is not null or metadata is not null").count() == 0


def test_warc_moves_ids_and_digests_as_bytes(spark, monkeypatch):
    """What is written and shuffled beside the payloads is as short as it can be; the files still hold the ids as text."""
    seen, write = {}, warc.written
    monkeypatch.setattr(warc, "written", lambda df, name: seen.setdefault(name, write(df, name)))
    pages = spark.range(40).selectExpr("id as page_id", "concat('http://x/', id) as url", "concat('<p>', id % 25, '</p>') as html")
    manifest = warc.write_warc(pages, scratch_path(spark, "warc"))
    types = dict(seen["warc-pages"].dtypes)
    assert (types["sha1"], types["row_id"], types["packed"]) == ("binary", "binary", "binary")
    records = warc.read_records(spark, manifest).collect()
    assert len({r["record_id"] for r in records}) == 120
    assert all(str(uuid.UUID(r["record_id"].removeprefix("urn:uuid:"))) == r["record_id"].removeprefix("urn:uuid:") for r in records)
    responses = {r["record_id"] for r in records if r["warc_type"] == "response"}
    assert len(responses) == 25 and {r["refers_to"] for r in records if r["warc_type"] == "revisit"} <= responses


def test_warc_odd_rows(spark):
    schema = "page_id long, url string, html string, sha1 string, row_id string"
    rows = [(None, "u", "x", "c", "d"), (1, "u", "x", None, None), (1, "u", "x", None, None), (2, None, "long " * 200_000, None, None)]
    got = warc.page_rows(warc.captures(warc.read_records(spark, warc.write_warc(spark.createDataFrame(rows, schema), scratch_path(spark, "w"))))).collect()
    assert sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in got) == [
        ("1", "response", None), ("1", "revisit", 1), ("2", "response", None), ("None", "revisit", 1)
    ]
    none = warc.write_warc(spark.createDataFrame([], schema), scratch_path(spark, "w"))
    assert warc.page_rows(warc.captures(warc.read_records(spark, none))).count() == 0
