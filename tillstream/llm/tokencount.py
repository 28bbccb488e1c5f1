"""Token counts of whole texts by heap-and-linked-list byte-pair merging.

A word starts as a linked list of its bytes' symbols. All adjacent pairs that have a merge rank lie
in a heap; the lowest rank (leftmost of equals) is popped again and again, its two symbols become
one, and the pairs with the new neighbours are pushed. A popped pair whose symbols have changed
meanwhile is skipped. The count of a word is its symbols less its merges: no identifier is looked up.

Defined results: a null or empty text counts 0 bytes and 0 tokens; a repeated row is counted again;
an empty table gives an empty result; other columns are carried through, and columns of the names
this operator adds are replaced. Texts of any length: a word of n bytes takes n log n steps.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import pieces
from tillstream.llm.tokens import ALPHABET, BYTE_LEVEL, KEPT_LENGTH

CACHED = 1_000_000


class Merges:
    """Merge ranks of a byte-level tokenizer file, on symbol numbers."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        pre = json.dumps(config["pre_tokenizer"])
        if config["normalizer"] is not None or '"use_regex": true' not in pre:
            raise ValueError(f"{path} is not a byte-level BPE file with the standard word pattern")
        symbols = {char: byte for byte, char in ALPHABET.items()}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(config["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            made = symbols.setdefault(left + right, len(symbols))
            self.pairs.setdefault((symbols[left], symbols[right]), (rank, made))
        special = [re.escape(t["content"]) for t in config["added_tokens"]]
        self.special = re.compile("|".join(special)) if special else None
        self.chunks = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+").findall
        self.words = regex.compile(BYTE_LEVEL).findall
        self.by_chunk: dict[str, int | None] = {}

    def word(self, data: bytes) -> int:
        """Tokens of one word."""
        symbols, pairs = list(data), self.pairs
        n = len(symbols)
        heap = []
        for at, pair in enumerate(zip(symbols, symbols[1:])):
            found = pairs.get(pair)
            if found is not None:
                heap.append((found[0], at, pair[1], found[1]))
        if not heap:
            return n
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = 0
        while heap:
            _, at, right, made = heapq.heappop(heap)
            nxt = after[at]
            # Stale: one of the two has been merged since. `made` names the pair uniquely only
            # together with the left symbol, so the pair is looked up again.
            if nxt >= n or symbols[at] < 0 or symbols[nxt] != right:
                continue
            found = pairs.get((symbols[at], right))
            if found is None or found[1] != made:
                continue
            symbols[at], symbols[nxt] = made, -1
            merges += 1
            after[at] = end = after[nxt]
            if end < n:
                before[end] = at
                found = pairs.get((made, symbols[end]))
                if found is not None:
                    heapq.heappush(heap, (found[0], at, symbols[end], found[1]))
            start = before[at]
            if start >= 0:
                found = pairs.get((symbols[start], made))
                if found is not None:
                    heapq.heappush(heap, (found[0], start, made, found[1]))
        return n - merges

    def plain(self, text: str) -> int:
        """Tokens of a stretch without special strings, each word merged anew."""
        return sum(self.word(w.encode()) for w in self.words(text))

    def _stretch(self, text: str) -> int:
        """As `plain`, with the counts of chunks met before.

        A cut before white space that follows another character never falls inside a word; where
        that character may be white space of another kind, the stretch is counted as a whole.
        """
        chunks = self.chunks(text)
        counts = list(map(self.by_chunk.get, chunks))
        if None in counts:
            for k, count in enumerate(counts):
                if count is None:
                    chunk = chunks[k]
                    count = self.by_chunk.get(chunk)
                    if count is None:
                        if chunk[-1].isspace() and chunk[-1] not in " \t\n\x0b\x0c\r":
                            return self.plain(text)
                        count = self.plain(chunk)
                        if len(self.by_chunk) >= CACHED:
                            self.by_chunk.clear()
                        if len(chunk) <= KEPT_LENGTH:
                            self.by_chunk[chunk] = count
                    counts[k] = count
        return sum(counts)

    def count(self, text: str) -> int:
        if self.special is None or "<" not in text:
            return self._stretch(text)
        total, start = 0, 0
        for found in self.special.finditer(text):
            total += self._stretch(text[start : found.start()]) + 1
            start = found.end()
        return total + self._stretch(text[start:])


@lru_cache(maxsize=4)
def merges(path: str) -> Merges:
    return Merges(path)


def count_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`docs` without its text, with `n_bytes` and `n_tokens` (both long)."""
    kept = [c for c in docs.columns if c not in (text, "n_bytes", "n_tokens")]
    source = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = source.drop("_text").withColumns(
        {"n_bytes": F.lit(0).cast("long"), "n_tokens": F.lit(0).cast("long")}
    ).schema

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = merges(path)
        for batch in pieces(batches, "_text"):
            texts = batch.column("_text")
            sizes = pc.binary_length(texts).cast(pa.int64())
            tokens = pa.array([counter.count(t) for t in texts.to_pylist()], pa.int64())
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, sizes, tokens], [*kept, "n_bytes", "n_tokens"])

    return source.mapInArrow(counted, schema)
