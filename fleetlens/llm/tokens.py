"""Encoding whole texts with a given tokenizer, fast enough for a corpus.

The ids are those of the tokenizers library. Most of a corpus is the same
words again, so the text is cut where the tokenizer's own splitting certainly
cuts (at single ASCII spaces; a word tokenizer also at other ASCII white
space), and the ids of each part are kept in a bounded cache. Parts with
characters outside Latin-1, runs of spaces and special-token strings go to the
library whole.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import regex

from fleetlens.llm.caches import worker_cache

#: Entries of the caches of a worker process: parts (words with their
#: punctuation) and pieces. The byte-level kind tells upper from lower case and
#: words behind a space from others, so it meets more of both.
CACHE = {"byte": (900_000, 600_000), "word": (400_000, 300_000)}
_SPLIT_BYTE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_SPLIT_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
_PLAIN = re.compile("[\n\x20-\x7e¡-ÿ]*")
_SPACES = re.compile(r"\s ")
_WORD_SPACE = re.compile("[ \t\n\r\x0b\x0c]+")
#: What ``str.split`` takes for white space besides those.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_MARKS = frozenset(".,;:!?")


def _byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte:
    printable bytes stand for themselves, the others follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, extra = [], 256
    for b in range(256):
        letters.append(chr(b if b in plain else extra))
        extra += b not in plain
    return letters


_LETTERS = dict(enumerate(_byte_letters()))


class _Cache(dict):
    """Ids by text: a text that is not held is encoded, and kept while there is room. Hits
    never leave the dictionary's own lookup."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, text: str) -> bytes:
        got = self.encode(text)
        if len(self) < self.most:
            self[text] = got
        return got


class CorpusEncoder:
    """``encode(text)`` gives the ids as little-endian uint32 bytes.

    ``kind`` is "byte" (byte-level BPE that keeps white space) or "word"
    (lower-casing BPE that drops white space).
    """

    def __init__(self, path: str, kind: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.kind = kind
        max_parts, max_pieces = CACHE[kind]
        self.parts = _Cache(self._spaced if kind == "byte" else self._word, max_parts)
        self.pieces = _Cache(self._piece, max_pieces)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        # a letter for each byte
        letters = piece.translate(_LETTERS) if piece.isascii() else piece.encode().decode("latin-1").translate(_LETTERS)
        return array("I", [t.id for t in self.tok.model.tokenize(letters)]).tobytes()

    def _part(self, part: str) -> bytes:
        if not _PLAIN.fullmatch(part):
            return self._whole(part)
        if self.kind == "byte":
            return b"".join(map(self.pieces.__getitem__, _SPLIT_BYTE.findall(part)))
        return b"".join(map(self.pieces.__getitem__, _SPLIT_WORD.findall(part.lower())))

    def _spaced(self, part: str) -> bytes:
        return self._part(" " + part)

    def _word(self, part: str) -> bytes:
        if part.isascii() or _PLAIN.fullmatch(part):  # letters alone, or with one mark behind, need no splitting
            if part.isalpha():
                return self.pieces[part.lower()]
            if part[-1:] in _MARKS and part[:-1].isalpha():
                return self.pieces[part[:-1].lower()] + self.pieces[part[-1]]
        return self._part(part) if part else b""

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if "<|" in text and any(s in text for s in self.special):
            return self._whole(text)
        if self.kind == "word":
            parts = _WORD_SPACE.split(text) if _OTHER_SPACE.search(text) else text.split()
            return b"".join(map(self.parts.__getitem__, parts))
        if _SPACES.search(text):
            return self._whole(text)
        head, *rest = text.split(" ")
        first = self._part(head) if head else b""
        return first + b"".join(map(self.parts.__getitem__, rest))


def encoder(path: str, kind: str) -> CorpusEncoder:
    """The process's encoder for a vocabulary file; its cache serves all tasks
    that run in the worker."""
    return worker_cache(("encoder", path, kind), lambda: CorpusEncoder(path, kind))
