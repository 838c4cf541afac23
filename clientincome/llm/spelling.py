"""Spelling variants by PartEnum signatures of letter multisets.

Two words are near if one inserted, deleted or replaced letter makes one of the
other.  A word's letters, without their order, form a binary vector: one bit
for the first, second, ... occurrence of each letter.  Near words have vectors
at a Hamming distance of one (a letter more) or two (a letter for another).

* Words of equal vectors form a class; a class is looked at once.
* Partition: a letter belongs to part (code point mod PARTS).  Enumerate: a
  replacement touches two parts at most, an insertion one, so a class has a
  signature for every pair of parts left out, and for every single part left
  out, each with the number of letters.  Classes within the distance agree in a
  signature, always: the search is exact.
* Signatures are equi-joined; the classes that meet are verified bit by bit.
  What shares a signature differs in the letters of two parts alone, with equal
  numbers of them, so the size of such a group is bounded by the alphabet and
  the length of a word, whatever the corpus holds.
* Words of two close classes are verified through the letters that differ: with
  that letter blanked out (or taken out) near words are equal, so they meet in
  one more equi-join, and hardly a pair that is not near meets.

All of it is DataFrame functions.  Counts run over all texts with map-side
combining, so a frequent word costs a row for each task.

Nulls: a null text has no words, a null doc_id is read as an empty string where
the id matters (``occurrences``).  Repeated rows count again.  An empty table,
and texts without words, give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientincome.llm.common import discard, written

LETTERS = "[A-Za-zÀ-ÿ]+"
PARTS = 8  # parts of the alphabet
SPOILT = 97  # one in so many words of a text loses a letter
BLANK = "\u0001"  # stands for the replaced letter; no word holds it

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALPHABET = _LOWER + "".join(map(chr, range(0xC0, 0x100)))


def occurrences(docs: DataFrame) -> DataFrame:
    """(word) for each run of letters in the texts of ``docs``, lower-cased (A-Z alone).

    Where SPOILT divides h, the CRC-32 of "doc_id:run", the letter at h modulo
    the length is taken out.
    """
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(LETTERS), F.lit(0))).alias("run"),
    )
    h, n = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")), F.length("run")
    cut = (h % n).cast("int")
    spoilt = F.concat(F.substring("run", F.lit(1), cut), F.substring(F.col("run"), cut + 2, n))
    return runs.select(F.when(h % SPOILT == 0, spoilt).otherwise(F.col("run")).alias("word"))


def counted(words: DataFrame, min_letters: int, min_count: int) -> DataFrame:
    """(word, n) of the words of so many letters and occurrences at least."""
    long = words.where(F.length("word") >= min_letters)
    return long.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


# ----------------------------------------------------------------- classes
def _vector(letters: str) -> Column:
    """The bits of sorted letters: each letter with the number of equal ones before it."""
    return F.expr(f"transform(split({letters}, ''), (c, i) -> concat(c, i + 1 - instr({letters}, c)))")


def _part(p: int) -> Column:
    """The hash of the class's letters of part ``p``."""
    others = "".join(c for c in _ALPHABET if ord(c) % PARTS != p)
    return F.xxhash64(F.lit(p), F.translate("letters", others, ""))


def _part_of(letter: str) -> Column:
    return F.ascii(letter) % PARTS


def _without(*parts: int) -> Column:
    """The parts of the class but these, as one number."""
    out = F.lit(0).cast("long")
    for p in range(PARTS):
        if p not in parts:
            out = out.bitwiseXOR(F.col(f"part_{p}"))
    return out


def close_classes(classes: DataFrame) -> DataFrame:
    """(a, b, gone, new): classes (letters) with b = a - gone + new; ``gone`` is empty where b has a letter more."""
    hashed = classes.select("letters", F.length("letters").alias("size"), *[_part(p).alias(f"part_{p}") for p in range(PARTS)])

    def signatures(size: Column, left_out: list[tuple[int, ...]]) -> DataFrame:
        each = F.array(*[
            F.struct(F.lit(o[0]).alias("p"), F.lit(o[-1]).alias("q"), F.xxhash64(size, F.lit(o[0]), F.lit(o[-1]), _without(*o)).alias("signature"))
            for o in left_out
        ])
        return hashed.select("letters", F.explode(each).alias("s")).select("s.signature", "s.p", "s.q", "letters")

    def meet(left: DataFrame, right: DataFrame) -> DataFrame:
        met = left.withColumnRenamed("letters", "a").join(right.select("signature", F.col("letters").alias("b")), "signature")
        return met.select(
            "a", "b", "p", "q", F.array_except(_vector("a"), _vector("b")).alias("less"), F.array_except(_vector("b"), _vector("a")).alias("more")
        )

    first = lambda c: F.substring(F.get(F.col(c), F.lit(0)), 1, 1)
    pairs = signatures(F.col("size"), [(p, q) for p in range(PARTS) for q in range(p + 1, PARTS)])
    replaced = meet(pairs, pairs).where("a < b and size(less) = 1 and size(more) = 1")
    replaced = replaced.select("a", "b", "p", "q", first("less").alias("gone"), first("more").alias("new"))
    # of the signatures that find a pair the one that counts: the parts of its two letters, or theirs and the next
    x, y = F.least(_part_of("gone"), _part_of("new")), F.greatest(_part_of("gone"), _part_of("new"))
    second = F.when(x != y, y).when(x + 1 < PARTS, x + 1).otherwise(F.lit(0))
    replaced = replaced.where((F.col("p") == F.least(x, second)) & (F.col("q") == F.greatest(x, second)))
    single = [(p,) for p in range(PARTS)]
    inserted = meet(signatures(F.col("size") + 1, single), signatures(F.col("size"), single)).where("size(less) = 0 and size(more) = 1")
    return replaced.select("a", "b", "gone", "new").unionByName(inserted.select("a", "b", F.lit("").alias("gone"), first("more").alias("new")))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n) of every near pair of ``words`` (word, n), in both directions."""
    spelt = written(words.withColumn("letters", F.array_join(F.array_sort(F.split("word", "")), "")), "spell-words")
    close = written(close_classes(spelt.select("letters").distinct()), "spell-classes")

    def blanked(column: str, blank: Column) -> Column:
        """Hashes of the word with each occurrence of the letter in ``column`` put aside in turn."""
        at = F.expr(f"filter(transform(split(word, ''), (c, i) -> if(c = {column}, i + 1, 0)), i -> i > 0)")
        rest = lambda i: F.concat(F.substring("word", F.lit(1), i - 1), blank, F.substring("word", i + 1, F.length("word")))
        return F.array_distinct(F.transform(at, lambda i: F.xxhash64(rest(i))))

    def side(letters: str, masks: Column) -> DataFrame:
        met = close.join(spelt, close[letters] == spelt["letters"])
        return met.select("gone", "new", F.explode(masks).alias("mask"), "word", "n")

    more = F.col("gone") == ""
    left = side("a", F.when(more, F.array(F.xxhash64("word"))).otherwise(blanked("gone", F.lit(BLANK))))
    right = side("b", blanked("new", F.when(more, F.lit("")).otherwise(F.lit(BLANK))))
    met = left.join(right.select("gone", "new", "mask", F.col("word").alias("near"), F.col("n").alias("near_n")), ["gone", "new", "mask"])
    met = met.where(F.levenshtein("word", "near", 1) == 1)  # no mere agreement of hashes
    pairs = written(met.select("word", "n", "near", "near_n"), "spell-pairs")
    discard(spelt, close)
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


# ------------------------------------------------------------------- forms
def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms from each word of ``forms`` (word, form).

    Chains are undone from their ends: a round resolves the words whose form
    was resolved in the round before.  A form has at least twice the count of
    its word, so there are at most as many rounds as a count has bits, and a
    key has no more rows than a word has near words.
    """
    level = written(forms.where("form is null").select("word", F.col("word").alias("root")), "spell-level")
    levels, rest = [level], forms.where("form is not null")
    while True:
        ends = level.select(F.col("word").alias("form"), "root")
        level = written(rest.join(ends, "form").select("word", "root"), "spell-level")
        if level.isEmpty():
            break
        levels.append(level)
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out


def variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of ``words`` (word, n).

    A word's form is its near word with the largest n (of equals the smallest),
    if that is at least ``ratio`` times its own.
    """
    kept = written(words.select("word", "n"), "spell-counts")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    summed = near_words(kept).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.n") >= ratio * F.col("n")
    shown = kept.join(summed, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.n")).alias("form_n"),
    )
    shown = written(shown, "spell-forms")
    return shown.join(roots(shown.select("word", "form")), "word")
