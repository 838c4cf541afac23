"""Token ids by the tokenizers library, each distinct piece of text encoded once.

Both public vocabularies cut a text at white space before they merge anything,
so the ids of a text are those of its pieces between single spaces and line
ends, one after the other; a piece is encoded by the library the first time a
worker meets it.  A piece of Latin letters alone is one pre-token: it goes to
the library's merging model at once, spelt as the library's byte table spells
it.  Texts with runs of white space, white space at an end, or what may be an
added token go to the library whole.
"""

from __future__ import annotations

import gc
import os
import re
from array import array
from collections.abc import Iterator

CACHE_ENTRIES = 800_000  # pieces a worker remembers (about 200 bytes each)

TOGETHER = 2_000_000  # characters whose pieces are held at a time

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_LATIN = re.compile(f" ?[{_LETTERS}]+")
_MARKS = ".,!?;:#%&*)"
_STEM = re.compile(rf"(.*[{_LETTERS}])([{_MARKS}]+)\Z", re.DOTALL)


class Pieces(dict):
    """Key of a piece -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.openings = tuple({t[:2] for t in added})
        table = ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes_of = {c: table.pre_tokenize_str(chr(c))[0][0] for c in [32, *range(65, 256)] if chr(c).isalpha() or c == 32}

    def library(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def may_hold_added(self, text: str) -> bool:
        return any(x in text for x in self.openings)

    def keys_of(self, text: str) -> list[str] | None:
        """The keys of a text's pieces; None for a text that goes to the library whole."""
        raise NotImplementedError

    def spelled(self, key: str) -> str:
        """The text of a piece; marks after letters have the key NUL and the marks."""
        return key[1:] if key[:1] == "\0" else key

    def folded(self, latin: str) -> str:
        """Latin letters as the vocabulary's normalizer leaves them."""
        return latin

    def learn(self, new: list[str]) -> list[str]:
        """Encode the pieces that are new; returns the keys added."""
        parts, needed = {}, set()
        for key in new:
            m = key[-1:] in _MARKS and _STEM.match(key)  # letters and the marks after them are never in one pre-token
            if m and key[:1] != "\0":
                parts[key] = (m[1], "\0" + m[2])
                needed.update(parts[key])
            else:
                needed.add(key)
        single = [k for k in needed if k not in self]
        tokenize, spelt, others = self.tokenizer.model.tokenize, self.bytes_of, []
        before = self.spelled("").translate(spelt)
        for k in single:
            if k.isascii() and k.isalpha():  # the byte table leaves these letters as they are
                self[k] = array("I", [t.id for t in tokenize(before + self.folded(k))]).tobytes()
                continue
            text = self.spelled(k)
            if _LATIN.fullmatch(text):
                self[k] = array("I", [t.id for t in tokenize(self.folded(text).translate(spelt))]).tobytes()
            else:
                others.append((k, text))
        encoded = self.tokenizer.encode_batch_fast([text for _, text in others], add_special_tokens=False)
        for (k, _), e in zip(others, encoded, strict=True):
            self[k] = array("I", e.ids).tobytes()
        for key, (stem, marks) in parts.items():
            self[key] = self[stem] + self[marks]
        return [*single, *parts]

    def together(self, texts: list[str]) -> list[bytes]:
        split = [self.keys_of(t) for t in texts]
        added = self.learn([k for k in set().union(*filter(None, split)) if k not in self])
        ids_of = self.__getitem__
        out = [self.library(t) if keys is None else b"".join(map(ids_of, keys)) for t, keys in zip(texts, split, strict=True)]
        if len(self) > CACHE_ENTRIES:
            for key in added:
                del self[key]
        return out

    def many(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= TOGETHER:
                yield from self._without_gc(held)
                held, size = [], 0
        yield from self._without_gc(held)

    def _without_gc(self, texts: list[str]) -> list[bytes]:
        """``together``; its many small objects have no cycles to look for."""
        on = gc.isenabled()
        gc.disable()
        try:
            return self.together(texts)
        finally:
            if on:
                gc.enable()

    def ids(self, text: str) -> bytes:
        return self.together([text])[0]


class WordPieces(Pieces):
    """A vocabulary in lower case that drops white space: a piece has the same ids anywhere."""

    def folded(self, latin: str) -> str:
        return latin.lower()

    def keys_of(self, text: str) -> list[str] | None:
        return None if "\0" in text or self.may_hold_added(text) else text.replace("\n", " ").split(" ")


class BytePieces(Pieces):
    """A byte vocabulary whose pre-tokens carry the space before them.

    Keys: "word" after a space, "\\nword" after a line end, NUL and the word at
    the start of a text.
    """

    def keys_of(self, text: str) -> list[str] | None:
        words = text.split()
        runs = len(text) - len("".join(words)) != max(len(words) - 1, 0)  # of white space, or some at an end
        return None if runs or "\0" in text or self.may_hold_added(text) else ("\0" + text.replace("\n", " \n")).split(" ")

    def spelled(self, key: str) -> str:
        return key[1:] if key[:1] == "\0" else key if key[:1] == "\n" else " " + key


_LOADED: dict[str, Pieces] = {}


def encoder(path: str) -> Pieces:
    """The worker's encoder for the vocabulary file ``path`` (kept between tasks)."""
    if path not in _LOADED:
        import json

        with open(path, encoding="utf-8") as f:
            kind = json.load(f).get("pre_tokenizer", {}).get("type")
        _LOADED[path] = (BytePieces if kind == "ByteLevel" else WordPieces)(path)
    return _LOADED[path]
