"""Token counts of a unigram vocabulary, by dynamic programming along a trie.

The new pre-tokens of a batch are sorted, which walks the trie of their bytes
depth first.  A node has the forward score of its prefix, the best sum of
token log-probabilities over all ways to cut it, and the number of tokens on
that way; both follow from nodes above it, so a prefix is computed once for
all the pre-tokens of the walk that share it, and the node where a pre-token
ends has its count.  Ties go to fewer tokens.  Texts then only add up terminal
counts, which a worker remembers.

The vocabulary is a public file of byte tokens with ranks (tiktoken format);
a token of rank r has the probability 1 / ((r + 1) H), Zipf's law over the
ranks.  Single bytes are in it, so every text can be cut.

Beyond ``MAX_PRETOKENS`` and ``MAX_PIECES`` a worker forgets the counts and
starts anew; that bounds its memory and changes no result.  Null and empty texts have no tokens.  Null and
repeated doc_ids are counted row by row.  An empty table gives no rows.
"""

from __future__ import annotations

import base64
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from clientincome.llm.common import small_batches

MAX_PRETOKENS = 600_000  # pre-tokens whose counts a worker remembers
MAX_PIECES = 500_000  # pieces of text whose sums a worker remembers
LONG = 256  # bytes; longer pre-tokens are cut by the same rule, but not stored

_RUN = re.compile(r"\s\s")

SCHEMA = "doc_id long, n_pretokens long, n_tokens long"


class Vocabulary:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        norm = math.log(sum(1 / (r + 1) for r in ranks.values()))
        self.score = {t: -math.log(r + 1) - norm for t, r in ranks.items()}
        # tokens with their scores, and minus infinity for what only ends tokens: a longer start cannot
        # be a token either once the bytes before an end are the end of none
        self.ending = dict.fromkeys((t[k:] for t in ranks for k in range(1, len(t))), -math.inf) | self.score

    def extend(self, text: bytes, end: int, best: list[float], count: list[int]) -> tuple[float, int]:
        """Forward score and tokens of text[:end] from those of its shorter prefixes."""
        top, tokens = -math.inf, 0
        get, start = self.ending.get, end
        while start:
            start -= 1
            s = get(text[start:end])
            if s is None:
                break
            s += best[start]
            if s > top or s == top and count[start] + 1 < tokens:
                top, tokens = s, count[start] + 1
        return top, tokens


class Trie:
    """Pre-tokens and their tokens; the nodes above them are walked, not kept."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.terminal: dict[bytes, int] = {}  # pre-token -> its tokens

    def insert(self, tokens: list[bytes]) -> None:
        """Sorted pre-tokens of at most LONG bytes, walked depth first: the scores on the way to a
        prefix are kept until the last pre-token below it."""
        get, terminal, lowest = self.vocabulary.ending.get, self.terminal, -math.inf
        previous, best, count = b"", [0.0], [0]
        for token in tokens:
            shared = 0
            for x, y in zip(previous, token):
                if x != y:
                    break
                shared += 1
            previous = token
            del best[shared + 1 :], count[shared + 1 :]
            for end in range(shared + 1, len(token) + 1):
                # as in Vocabulary.extend, of which a call for each byte takes as long again
                top, n, start = lowest, 0, end
                while start:
                    start -= 1
                    s = get(token[start:end])
                    if s is None:
                        break
                    s += best[start]
                    if s > top or s == top and count[start] + 1 < n:
                        top, n = s, count[start] + 1
                best.append(top)
                count.append(n)
            terminal[token] = count[-1]

    def long(self, token: bytes) -> int:
        """Tokens of a pre-token of any length, nothing kept."""
        best, count = [0.0], [0]
        for end in range(1, len(token) + 1):
            s, n = self.vocabulary.extend(token, end, best, count)
            best.append(s)
            count.append(n)
        return count[-1]


class Counter:
    """Sums over texts: a piece between spaces has the same pre-tokens anywhere."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.trie = Trie(Vocabulary(path))
        self.pretokens = regex.compile(pattern)
        self.sums: dict[str, int] = {}  # key of a piece -> tokens + 2**32 * pre-tokens

    def keys_of(self, text: str) -> list[str]:
        """Keys: "word" after a space, "\\nword" after a line end, NUL and the piece for any other."""
        if not text:
            return []
        if "\0" in text or text[0].isspace() or text[-1].isspace() or _RUN.search(text):
            return ["\0" + p for p in self.pretokens.findall(text)]
        return ("\0" + text.replace("\n", " \n")).split(" ")

    def totals(self, texts: list[str]) -> list[tuple[int, int]]:
        """(pre-tokens, tokens) of each text."""
        split = [self.keys_of(t) for t in texts]
        if len(self.sums) > MAX_PIECES:
            self.sums = {}
        if len(self.trie.terminal) > MAX_PRETOKENS:
            self.trie.terminal.clear()
        sums, terminal, find = self.sums, self.trie.terminal, self.pretokens.findall
        cut = {}
        for key in set().union(*split):
            if key not in sums:
                piece = key[1:] if key[:1] == "\0" else key if key[:1] == "\n" else " " + key
                cut[key] = [t.encode("utf-8", "surrogatepass") for t in find(piece)]
        new = sorted({t for ts in cut.values() for t in ts if t not in terminal})
        self.trie.insert([t for t in new if len(t) <= LONG])
        long = {t: self.trie.long(t) for t in new if len(t) > LONG}
        for key, tokens in cut.items():
            n = 0
            for t in tokens:
                n += terminal[t] if t in terminal else long[t]
            sums[key] = n + (len(tokens) << 32)
        return [divmod(sum(map(sums.__getitem__, keys)), 1 << 32) for keys in split]


_COUNTERS: dict[str, Counter] = {}


def token_counts(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Rows (doc_id, n_pretokens, n_tokens) for each row of ``docs`` (doc_id, text); no shuffle.

    ``vocabulary``: path of a rank file; ``pattern``: its pre-token pattern.
    """
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _COUNTERS:
            _COUNTERS[vocabulary] = Counter(vocabulary, pattern)
        counter = _COUNTERS[vocabulary]
        for batch in batches:
            totals = counter.totals([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array([a for a, _ in totals], pa.int64()), pa.array([b for _, b in totals], pa.int64())],
                ["doc_id", "n_pretokens", "n_tokens"],
            )

    return docs.select("doc_id", "text").mapInArrow(count, SCHEMA)
