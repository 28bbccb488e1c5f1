"""Token ids of whole texts, as the tokenizers library gives them, through a cache of words.

A text is cut before each run of white space that follows other characters. Byte-level and word-level
pre-tokenizers never join characters over such a cut, so the ids of a text are those of its chunks in
order. A chunk seen before costs one look-up; a new one is cut by the library's own pre-tokenizer
and each new word is merged by the library's own model. Chunks that hold a special string are encoded
by the library as they stand, and so are whole texts in which the cut could be wrong.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np
import regex

_BLANKS = " \t\n\x0b\x0c\r"
# Below this the library and `regex` agree on letters and digits, and texts are in normal form.
_LATIN_END = "\u0250"
_LATIN_SPACE = re.compile("[\x85\xa0]")
_CHUNK = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
_WORD_ONLY = re.compile(r"[^ \t-\r]+")
# Letters below `_LATIN_END`, but for the one whose lower case is two characters.
_LATIN_WORD = re.compile(" ?[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u024f]+").fullmatch
# Most bytes of a worker's cache. It has two halves: when the newer one is full, the older one goes; what
# is met again moves to the newer one, so that frequent words stay.
CACHED_BYTES = 160 << 20
# What Python needs for an entry beside its letters and ids: two objects and a place in the table.
_ENTRY_BYTES = 152
# Longer chunks are not kept.
KEPT_LENGTH = 40

# The byte-level alphabet, printable bytes as themselves, the others from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [b for b in range(256) if b not in set(_PRINTABLE)]
ALPHABET = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + k) for k, b in enumerate(_OTHERS)}

# The pre-tokenizer pattern of byte-level BPE, and that of the lower-case word BPE.
BYTE_LEVEL = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Encoder:
    """Ids of texts for one tokenizer file. `dtype` is the width its vocabulary needs."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        self.special = [t["content"] for t in config["added_tokens"]]
        self.dtype = np.dtype(np.uint16 if self.library.get_vocab_size() <= 1 << 16 else np.uint32)
        kind = json.dumps([config["normalizer"], config["pre_tokenizer"]])
        lower = '"Lowercase"' in kind
        byte_level = config["normalizer"] is None and '"use_regex": true' in kind
        # The cut is proven for these two forms only; any other tokenizer gets whole texts.
        self.cut = byte_level or (lower and '\\\\s+' in kind)
        self.cut = self.cut and all("<" in s for s in self.special)
        self.lower = lower
        self.chunks = (_WORD_ONLY if lower else _CHUNK).findall
        self.words = regex.compile(WORD_LEVEL if lower else BYTE_LEVEL).findall
        # Ids of chunks and of words; a word alone is a chunk.
        self.cache: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._held = 0
        self.marks = {mark: self._merged(mark) for mark in ".,"} if self.cut else {}

    def _packed(self, ids: list[int]) -> bytes:
        return array(self.dtype.char, ids).tobytes()

    def whole(self, text: str) -> bytes:
        return self._packed(self.library.encode(text, add_special_tokens=False).ids)

    def _keep(self, piece: str, ids: bytes) -> bytes:
        if len(piece) <= KEPT_LENGTH:
            self._held += len(piece) + len(ids) + _ENTRY_BYTES
            if self._held > CACHED_BYTES // 2:
                self._older, self.cache = self.cache, {}
                self._held = 0
            self.cache[piece] = ids
        return ids

    def _known(self, piece: str) -> bytes | None:
        ids = self.cache.get(piece)
        if ids is None and self._older and (ids := self._older.pop(piece, None)) is not None:
            self._keep(piece, ids)
        return ids

    def _merged(self, letters: str) -> bytes:
        """Ids of one word in the byte-level alphabet, by the library's model."""
        return self._packed([t.id for t in self.model.tokenize(letters)])

    def _chunk(self, chunk: str) -> bytes | None:
        """Ids of a chunk; None if the text around it has to be encoded whole.

        New words are kept. A chunk of several words is kept when all of them were known before, so
        that rare words don't fill the cache with their punctuation.
        """
        if (ids := self._known(chunk)) is not None:
            return ids
        # Most new chunks are one word, maybe with a comma or stop, which is a word of its own.
        last = chunk[-1]
        core = chunk[:-1] if last in self.marks else chunk
        plain = core.isascii()
        if (core.isalpha() or (core[:1] == " " and core[1:].isalpha())) if plain else _LATIN_WORD(core):
            core = core.lower() if self.lower else core
            # One that stands alone in lower case was looked for already.
            ids = self._known(core) if core != chunk else None
            known = ids is not None
            if not known:
                # Letters of ASCII stand for themselves.
                letters = core if core.isalpha() else "\u0120" + core[1:]
                if not plain:
                    letters = core.encode().decode("latin-1").translate(ALPHABET)
                ids = self._keep(core, self._merged(letters))
            if last not in self.marks:
                return self._keep(chunk, ids) if core != chunk else ids
            ids += self.marks[last]
            return self._keep(chunk, ids) if known else ids
        plain = chunk.isascii()
        latin = plain or (max(chunk) < _LATIN_END and not _LATIN_SPACE.search(chunk))
        if "<" in chunk and any(s in chunk for s in self.special):
            return self.whole(chunk)
        if not self.lower and last not in _BLANKS and last.isspace():
            return None
        if not latin:
            normal = chunk
            if self.library.normalizer is not None:
                normal = self.library.normalizer.normalize_str(chunk)
            cut = self.library.pre_tokenizer.pre_tokenize_str(normal)
            return self._keep(chunk, b"".join([self._merged(w) for w, _ in cut]))
        words = self.words(chunk.lower() if self.lower else chunk)
        parts, known = [], True
        for word in words:
            ids = self._known(word)
            if ids is None:
                known = False
                letters = word if plain else word.encode().decode("latin-1")
                ids = self._keep(word, self._merged(letters.translate(ALPHABET)))
            parts.append(ids)
        ids = b"".join(parts)
        return self._keep(chunk, ids) if known else ids

    def encode(self, text: str) -> bytes:
        """Ids of a text, packed little-endian in `dtype`."""
        if not self.cut:
            return self.whole(text)
        chunks = self.chunks(text)
        known = self.cache
        parts = list(map(known.get, chunks))
        k = -1
        for _ in range(parts.count(None)):
            k = parts.index(None, k + 1)
            part = known.get(chunks[k]) or self._chunk(chunks[k])
            if part is None:
                return self.whole(text)
            parts[k] = part
        return b"".join(parts)

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode(text), self.dtype)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One per worker process and file, so that the cache lives through all its tasks."""
    return Encoder(path)
