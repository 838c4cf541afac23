"""The queries of the corpus operators, over whole tables of a test folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientincome.llm import conversation_trie, decontaminate, language_id, line_dedup, near_dup, packing, passage_dedup, repetition, spelling, token_files, toxicity, unigram, warc
from clientincome.llm.common import table, written
from clientincome.session import scratch_path

WORD_VOCABULARY, BYTE_VOCABULARY, RANKS = "word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
MULTI_RANKS = "byte_bpe_multi_50k.tiktoken"
END_ID, PACK_END, CAPACITY = 2, 0, 2048
LANG_FOLDS, LANG_HELD_OUT = 4, 2  # held out: CRC-32 of the id leaves this remainder
TRIE_GROUP, TRIE_HEADS = 5, 9  # see op11_conversation_trie
MIN_LETTERS, MIN_COUNT = 5, 3  # of a word that op13 looks at
HELD_OUT = 5  # a document is held out if the CRC-32 of its id is divisible by this


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def op1_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Boilerplate lines cut from every document, by distinct sources."""
    out = line_dedup.dedup_lines(table(spark, sf, "documents"))
    return out.select(
        "doc_id", F.col("_ld_lines").cast("long").alias("n_lines"), F.col("_ld_removed").cast("long").alias("n_removed"),
        F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"),
    )


def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """A toxicity score of every document, learnt from labels outside the held-out fifth."""
    docs = table(spark, sf, "documents")
    model = toxicity.fit(docs, table(spark, sf, "labels"), ~held_out())
    return toxicity.score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_passages", "strength"
    )


def op3_minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_dup.near_duplicates(table(spark, sf, "documents"))


def op4_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Base counts and the verdict on repetition of every document."""
    return repetition.quality(table(spark, sf, "documents"))


def op5_suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Repeated passages cut from every document."""
    out = passage_dedup.remove_repeats(table(spark, sf, "documents"))
    return out.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Unigram token counts of every document."""
    import public_tokenizers

    return unigram.token_counts(table(spark, sf, "documents"), vocabulary(RANKS), public_tokenizers.PATTERN)


def op7_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark items held by documents, exactly or within the error budget."""
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op8_token_files(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as token-id files and read back."""
    manifest = token_files.write_token_files(
        table(spark, sf, "documents"), scratch_path(spark, "token-files"), vocabulary(WORD_VOCABULARY), END_ID
    )
    return token_files.read_token_files(spark, manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Pages written as WARC files, read back and assembled into captures."""
    manifest = warc.write_warc(table(spark, sf, "pages"), scratch_path(spark, "warc"))
    # parsed once: the assembly reads the records by type, and once more for what revisits refer to
    records = written(warc.read_records(spark, manifest, payload=False), "warc-records")
    return warc.page_rows(warc.captures(records))


def op10_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    return packing.pack(table(spark, sf, "documents"), vocabulary(BYTE_VOCABULARY), PACK_END, CAPACITY)


def op11_conversation_trie(spark: SparkSession, sf: str) -> DataFrame:
    """Every node of the prefix trie of conversations rebuilt on the first of their group."""
    turns = conversation_trie.rebuilt(conversation_trie.numbered(table(spark, sf, "conversations")), TRIE_GROUP, TRIE_HEADS)
    nodes, ends = conversation_trie.prefix_trie(turns)
    digests = conversation_trie.member_digests(ends)
    return nodes.join(digests, "name", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved_bytes").alias("saved_tokens"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def op12_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """The language of every document, learnt outside the held-out quarter."""
    docs = table(spark, sf, "documents")
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % LANG_FOLDS
    apart = F.coalesce(rest == LANG_HELD_OUT, F.lit(False))
    model = language_id.fit(docs, ~apart, vocabulary(MULTI_RANKS))
    return language_id.identify(docs, model).select("doc_id", apart.alias("held_out"), "lang_pred", "score")


def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Words of all documents, their spelling variants and the word each stands for."""
    words = spelling.counted(spelling.occurrences(table(spark, sf, "documents")), MIN_LETTERS, MIN_COUNT)
    return spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_toxicity, op3_minhash_near_dedup, op4_quality_rules, op5_suffix_array_dedup, op6_token_counts,
    op7_benchmark_decontamination, op8_token_files, op9_warc, op10_best_fit_packing,
    op11_conversation_trie, op12_language_id, op13_spelling_variants,
)}

OP1_SQL = f"""
with line as (
  select d.doc_id, d.source, md5(concat(coalesce(d.doc_id::varchar, 'null'), '/', coalesce(d.text, ''))) as r, u.pos,
         trim(string_split(coalesce(d.text, ''), chr(10))[u.pos], ' ' || chr(9) || chr(13)) as bare
  from documents d, unnest(generate_series(1, len(string_split(coalesce(d.text, ''), chr(10))))) as u(pos)
), common as (
  select bare from line where bare <> '' group by bare having count(distinct source) >= {line_dedup.MIN_SITES}
), cuts as (
  select r, list(pos) as pos from (select distinct r, pos from line where bare in (select bare from common)) group by r
), worded as (
  select r, count(distinct pos) as n from line where bare <> '' group by r
), joined as (
  select d.doc_id, string_split(coalesce(d.text, ''), chr(10)) as ls,
         case when len(c.pos) < w.n then c.pos else [] end as pos
  from documents d left join cuts c on c.r = md5(concat(coalesce(d.doc_id::varchar, 'null'), '/', coalesce(d.text, '')))
  left join worded w on w.r = c.r
)
select doc_id, len(ls)::bigint as n_lines, coalesce(len(pos), 0)::bigint as n_removed,
       md5(array_to_string(list_transform(
         list_filter(generate_series(1, len(ls)), lambda i: not list_contains(coalesce(pos, []), i)), lambda i: ls[i]), chr(10))) as kept_md5
from joined
"""

OP9_SQL = """
with p as (
  select page_id, encode(coalesce(html, '')) as body from pages
), d as (
  select page_id, octet_length(body) as n, sha1(body) as hex from p
), f as (
  select hex, min(page_id) as first_page from d group by hex
), bits as (
  -- 40 hex digits are 160 bits, 32 base32 digits of five bits
  select d.page_id, d.n, d.hex, f.first_page,
         list_aggregate(list_transform(generate_series(0, 31), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
           (('0x' || substr(d.hex || '000', 1 + (5 * i) // 4, 3))::bigint >> (7 - (5 * i) % 4)) & 31)::bigint, 1)), 'string_agg', '') as b32
  from d join f using (hex)
)
select page_id, n::bigint as payload_bytes, b32 as payload_digest,
       case when page_id = first_page then 'response' else 'revisit' end as record_type,
       case when page_id = first_page then null else first_page end as refers_to
from bits
"""

OP11_SQL = f"""
with convs as (
  select distinct conv_id, conv_id - conv_id % {TRIE_GROUP} as base,
    (4294967295 - list_reduce(
      flatten(list_transform(string_split(conv_id::varchar, ''), lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
      -- a byte is xored in, then shifted out bit by bit
      lambda c, b: case when b >= 0 then xor(c, b) else xor(c >> 1, 3988292384 * (c & 1)) end, 4294967295::bigint)) % {TRIE_HEADS} as h
  from conversations where conv_id is not null
), turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as i
  from conversations where conv_id is not null
), rebuilt as (
  select c.conv_id, t.i, t.role, t.text from convs c join turns t on t.conv_id = c.base and t.i <= c.h
  union all
  select c.conv_id, t.i + 1000000000, t.role, t.text from convs c join turns t on t.conv_id = c.conv_id and t.i > c.h
), paths as (
  select conv_id, row_number() over (partition by conv_id order by i) as depth, octet_length(encode(text)) as bytes,
    list(sha256(octet_length(encode(role)) || ':' || role || text)) over (partition by conv_id order by i) as name
  from rebuilt
), all_paths as (
  select conv_id, depth, bytes, sha256(array_to_string(name, '')) as name from paths
  union all
  select conv_id, 0, 0, '' from convs
), nodes as (
  select name, min(conv_id) as conv_id, any_value(depth) as depth, count(*) as n_convs, any_value(bytes) as bytes from all_paths group by name
), up as (
  select n.name, p.name as parent, p.conv_id as parent_conv_id
  from nodes n join all_paths a on a.conv_id = n.conv_id and a.depth = n.depth - 1 join nodes p on p.name = a.name
), children as (
  select parent as name, count(*) as n_children from up group by parent
), above as (
  select a.name, sum((c.name is null)::int) as n_leaves, sum((n.n_convs - 1) * n.bytes) as saved_tokens
  from nodes n left join children c using (name) join all_paths a on a.conv_id = n.conv_id and a.depth <= n.depth
  group by a.name
), ends as (
  select name, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as ends_sha256
  from (select conv_id, arg_max(name, depth) as name from all_paths group by conv_id) group by name
)
select n.conv_id, n.depth::bigint as depth, up.parent_conv_id, n.n_convs::bigint as n_convs, coalesce(c.n_children, 0)::bigint as n_children,
  a.n_leaves::bigint as n_leaves, a.saved_tokens::bigint as saved_tokens, coalesce(e.ends_sha256, sha256('')) as ends_sha256
from nodes n left join up using (name) left join children c using (name) join above a using (name) left join ends e using (name)
"""

OP13_SQL = f"""
with runs as (
  select coalesce(doc_id::varchar, '') || ':' || run as id, run, count(*) as n from (
    select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) as run
    from documents) group by doc_id, run
), hashed as (
  -- CRC-32: a byte of the UTF-8 text is xored in, then shifted out bit by bit
  select run, n, 4294967295 - list_reduce(flatten(list_transform(
      string_split(id, ''), lambda c: case when ascii(c) < 128 then [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]
        else [192 + (ascii(c) >> 6)::bigint, -1, -1, -1, -1, -1, -1, -1, -1, 128 + (ascii(c) & 63)::bigint, -1, -1, -1, -1, -1, -1, -1, -1] end)),
    lambda c, b: case when b >= 0 then xor(c, b) else xor(c >> 1, 3988292384 * (c & 1)) end, 4294967295::bigint) as h
  from runs
), words as (
  select word, sum(n)::bigint as n from (
    select case when h % {spelling.SPOILT} = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, n
    from hashed) where length(word) >= {MIN_LETTERS} group by word having sum(n) >= {MIN_COUNT}
), cuts as (
  select word, n, i, substr(word, 1, i - 1) as head, substr(word, i + 1) as tail
  from (select word, n, unnest(generate_series(1, length(word))) as i from words)
), pairs as (
  select a.word, a.n, b.word as near, b.n as near_n from cuts a join cuts b on a.i = b.i and a.head = b.head and a.tail = b.tail and a.word <> b.word
  union
  select w.word, w.n, c.word, c.n from words w join cuts c on c.head || c.tail = w.word
  union
  select c.word, c.n, w.word, w.n from words w join cuts c on c.head || c.tail = w.word
), best as (
  select word, count(*) as n_near, min({{'m': -near_n, 'w': near}}) as b, any_value(n) as n from pairs group by word
), forms as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when -b.b.m >= 2 * w.n then b.b.w end as form, case when -b.b.m >= 2 * w.n then -b.b.m end as form_n
  from words w left join best b using (word)
), chains as (
  with recursive step(word, here, next) as (
    select word, word, form from forms
    union all
    select s.word, s.next, f.form from step s join forms f on f.word = s.next
  ) select word, here as root from step where next is null
)
select word, form, root, n, n_near::bigint as n_near, form_n::bigint as form_n from forms join chains using (word)
"""

SQL = {"op1_line_dedup": OP1_SQL, "op9_warc": OP9_SQL, "op11_conversation_trie": OP11_SQL, "op13_spelling_variants": OP13_SQL}
