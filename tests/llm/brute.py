"""Plain versions of the corpus operators, for small inputs."""

import math
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = [w.decode() for w in (text or "").encode().lower().split()]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def near_duplicates(docs):
    """doc_id -> (set size, component) by comparing all pairs."""
    sets = {d: shingle_set(t) for d, t in docs}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


def repeated_bytes(docs, span):
    """doc_id -> removed flags, by looking every string up."""
    seen, gone = set(), {}
    for d, t in sorted(docs):
        data = (t or "").encode()
        flags = [False] * len(data)
        for i in range(len(data) - span + 1):
            s = data[i : i + span]
            if s in seen:
                flags[i : i + span] = [True] * span
            seen.add(s)
        gone[d] = (data, flags)
    return gone


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    windows = Counter(tuple(words[i : i + 3]) for i in range(n - 2))
    repeated = {j for i in range(n - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated),
            n < 50 or 100 * len(repeated) > 50 * n)


def longest_repeats(words):
    out = []
    for i in range(len(words)):
        best = 0
        for j in range(len(words)):
            k = 0
            while i != j and i + k < len(words) and j + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            best = max(best, k)
        out.append(best)
    return out


def edit_distance_within(pattern, text):
    """Least edit distance of pattern to any substring of text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern):
        new = [i + 1]
        for j, c in enumerate(text):
            new.append(min(row[j] + (p != c), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def unigram_tokens(pretoken, scores):
    """(score, tokens) of the best cut of a byte string, without a trie."""
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(pretoken)
    for end in range(1, len(pretoken) + 1):
        for start in range(end):
            s = scores.get(pretoken[start:end])
            if s is not None:
                c = (best[start][0] + s, best[start][1] + 1)
                if c[0] > best[end][0] or c[0] == best[end][0] and c[1] < best[end][1]:
                    best[end] = c
    return best[-1]


def maximal_segments(scores):
    """All maximal-scoring segments by their recursive definition."""

    def within(low, high):
        best = None
        for i in range(low, high):
            total = 0.0
            for j in range(i, high):
                total += scores[j]
                if total > 1e-12 and (best is None or total > best[0] + 1e-12):
                    best = (total, i, j + 1)
        if best is None:
            return []
        _, i, j = best
        return within(low, i) + [(i, j)] + within(j, high)

    return within(0, len(scores))


def components(links):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in list(parent)}


def spread_lines(docs, min_sites):
    """doc_id -> text without boilerplate; docs are (doc_id, text, source)."""
    sites = {}
    for _, t, s in docs:
        for line in (t or "").split("\n"):
            if s is not None:
                sites.setdefault(line.strip(" \t\r"), set()).add(s)
    out = {}
    for d, t, _ in docs:
        lines = (t or "").split("\n")
        drop = [bool(x.strip(" \t\r")) and len(sites.get(x.strip(" \t\r"), ())) >= min_sites for x in lines]
        if sum(drop) < sum(bool(x.strip(" \t\r")) for x in lines):
            lines = [x for x, y in zip(lines, drop, strict=True) if not y]
        out[d] = "\n".join(lines)
    return out
