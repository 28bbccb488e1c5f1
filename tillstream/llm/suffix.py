"""Removal of repeated byte strings by bucket-pointer refinement of sampled suffixes.

A suffix lies in a bucket with all suffixes that start with the same bytes. The bucket of a suffix for
2q bytes follows from two buckets for q bytes, its own and that of the suffix q bytes later, so refined
identifiers are built from those of later offsets, level by level, each reused by the next. Here
identifiers are content hashes (64 bits), so a text's own are worked out where the text is, and only
the question who else is in a bucket needs a shuffle.

A string of `LENGTH` bytes holds `WINDOWS` suffixes with `Q` bytes of their own in it; the one with the
least q-gram identifier (the first of equals) is its anchor, whoever looks at it. So equal strings have
equal anchors at equal places, and it is enough to refine the buckets of anchors, about one per 140
bytes:

1. q-gram buckets of anchors. An anchor alone in its bucket belongs to no repeated string.
2. All starts that share an anchor are refined together over the whole text that they span. Two equal
   spans: every start in them is repeated. This settles the inside of copies.
3. For buckets with spans left over, the text of one anchor per different span is fetched. Its starts
   are refined by blocks of `BLOCK`: the common core of a block's strings and their union. A core alone
   in its bucket: none is repeated; a union in company: all are.
4. The blocks left over, mostly one on each side of a copy's edge, are refined start by start.

Every step is an aggregate and a join on bucket identifiers, with counts added up before the shuffle;
no bucket is gathered. Texts are seen as UTF-8 bytes, matches never cross texts, overlapping ones count.

Defined results: null texts are empty; repeated rows repeat each other; a table without rows gives none;
other columns are left out. Longer texts than `TILE` are worked on in overlapping tiles.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import pieces, settled

LENGTH = 400
Q = 128
BLOCK = 16
TILE = 1 << 20
# Bytes looked at together: a worker holds about a hundred times as many.
PIECE = 1 << 19
_U = np.uint64
_GOLDEN = _U(0x9E3779B97F4A7C15)


def _scramble(x: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit mixing generator; gives the identifiers of single bytes."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTES = _scramble((np.arange(256, dtype=_U) + _U(1)) * _GOLDEN)


def _refine(first: np.ndarray, later: np.ndarray, level: int) -> np.ndarray:
    """Bucket identifiers of twice the length, from those at both offsets."""
    out = first * _U(((2 * level + 3) * int(_GOLDEN) | 1) & (1 << 64) - 1)
    out += later
    out ^= out >> _U(29)
    return out


def buckets(data: np.ndarray, most: int, least: int = 2) -> dict[int, np.ndarray]:
    """Identifiers of all suffixes for `least`, twice as many, ... `most` bytes."""
    out, have, size, level = {}, _BYTES[data], 1, 0
    while size < most and len(data) >= 2 * size:
        count = len(data) - 2 * size + 1
        have = _refine(have[:count], have[size : size + count], level)
        size, level = 2 * size, level + 1
        if size >= least:
            out[size] = have
    return out


def spanned(ids: dict[int, np.ndarray], start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Identifiers of data[start : start + size], 256 <= size <= 1024: two overlapping halves."""
    half = np.where(size > 512, 512, 256)
    at = np.where(size > 512, start, 0)
    end = np.where(size > 512, start + size - 512, 0)
    large = _refine(ids[512][at], ids[512][end], 20)
    small = _refine(
        ids[256][start], ids[256][np.maximum(np.where(size > 512, 0, start + size - 256), 0)], 21
    )
    return _refine(_scramble(np.where(half == 512, large, small)), size.astype(_U), 22)


def anchors(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, q: int = Q):
    """Of texts one after the other: anchor, first and last start that have it, q-gram and span
    identifiers. `data` must be followed by 1024 bytes that belong to no text."""
    windows = length - q + 1
    begins = np.r_[0, ends[:-1]]
    starts = [np.arange(a, e - length + 1) for a, e in zip(begins, ends) if e - a >= length]
    if not starts:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, _U),) * 2
    start = np.concatenate(starts)
    ids = buckets(data, 512, min(q, 256))
    gram = ids[q]
    low = _U((1 << 24) - 1)
    # The place is in the low bits, so that the first of equal identifiers is the least.
    key = (gram & ~low) | np.arange(len(gram), dtype=_U)
    padded = np.full(-(-len(key) // windows) * windows, ~_U(0))
    padded[: len(key)] = key
    padded = padded.reshape(-1, windows)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[start], ahead[start + windows - 1])
    anchor = (least & low).astype(np.int64)
    fresh = np.flatnonzero(
        np.r_[True, (start[1:] != start[:-1] + 1) | (anchor[1:] != anchor[:-1])]
    )
    lo, hi = start[fresh], start[np.r_[fresh[1:], len(start)] - 1]
    at = anchor[fresh]
    whole = spanned(ids, lo, hi - lo + length)
    shape = ((at - lo) * 4096 + (hi - lo)).astype(_U)
    return at, lo, hi, gram[at], _refine(_scramble(whole), shape, 23)


def _tiled(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts side by side: data, ends, text number and offset of each part."""
    parts, numbers, offsets, held = [], [], [], 0
    for number, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - LENGTH + 1), TILE):
            part = text[offset : offset + TILE + LENGTH - 1]
            if held and held + len(part) > TILE:
                yield _beside(parts, numbers, offsets)
                parts, numbers, offsets, held = [], [], [], 0
            parts.append(part)
            numbers.append(number)
            offsets.append(offset)
            held += len(part)
    if parts:
        yield _beside(parts, numbers, offsets)


def _beside(parts: list[bytes], numbers: list[int], offsets: list[int]):
    data = np.frombuffer(b"".join([*parts, bytes(1024)]), np.uint8)
    return data, np.cumsum([len(p) for p in parts]), np.array(numbers), np.array(offsets)


_KEYS = ["doc_id", "text_id"]


def _source(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(
        "doc_id",
        F.xxhash64("doc_id", text).alias("text_id"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"),
    )


def _anchor_rows(docs: DataFrame, text: str) -> DataFrame:
    """One row per anchor: keys, first and last start, place of the anchor, `gram`, `span`."""

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text", PIECE):
            texts = batch.column(2).to_pylist()
            for data, ends, numbers, offsets in _tiled(texts):
                at, lo, hi, gram, span = anchors(data, ends)
                part = np.searchsorted(ends, lo, side="right")
                rows = pa.array(numbers[part])
                shift = offsets[part] - np.r_[0, ends[:-1]][part]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(lo + shift, pa.int64()),
                        pa.array(hi + shift, pa.int64()),
                        pa.array(at + shift, pa.int64()),
                        pa.array(gram.view(np.int64), pa.int64()),
                        pa.array(span.view(np.int64), pa.int64()),
                    ],
                    [*_KEYS, "lo", "hi", "at", "gram", "span"],
                )

    schema = "doc_id long, text_id long, lo long, hi long, at long, gram long, span long"
    made_rows = _source(docs, text).mapInArrow(made, schema)
    return made_rows.withColumn("anchor", F.monotonically_increasing_id())


def _same_text(a: str, b: str) -> Column:
    return F.expr(f"{a}.doc_id <=> {b}.doc_id and {a}.text_id = {b}.text_id")


def _contexts(docs: DataFrame, text: str, left: DataFrame) -> DataFrame:
    """(anchor, place of the anchor in the context, its start in the text, context) for `left`."""
    asked = left.groupBy(*_KEYS).agg(
        F.collect_list(F.struct("anchor", "lo", "hi", "at")).alias("asked")
    )
    rows = _source(docs, text).alias("d").join(asked.alias("a"), _same_text("d", "a"))
    each = rows.select("_text", F.explode("asked").alias("q"))
    # Byte positions: the text is binary here.
    size = (F.col("q.hi") - F.col("q.lo") + LENGTH).cast("int")
    return each.select(
        F.col("q.anchor").alias("anchor"),
        (F.col("q.at") - F.col("q.lo")).alias("place"),
        F.col("q.lo").alias("lo"),
        F.substring(F.col("_text"), (F.col("q.lo") + 1).cast("int"), size).alias("context"),
    )


def _beside_contexts(batch: pa.RecordBatch) -> tuple:
    contexts = batch.column(batch.schema.get_field_index("context")).to_pylist()
    data, ends, _, _ = _beside(contexts, [], [])
    return buckets(data, 512, 256), np.r_[0, ends[:-1]].astype(np.int64), ends


def _block_rows(contexts: DataFrame) -> DataFrame:
    """(anchor, lo, block, first, last, core, union): blocks of each context's starts.

    Blocks are counted by the distance from the start to the anchor, so that they mean the same in
    every context; `first` and `last` are starts in the text.
    """

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "context", PIECE):
            ids, begins, ends = _beside_contexts(batch)
            place = batch.column(1).to_numpy()
            count = ends - begins - LENGTH + 1
            nearest = place - (count - 1)  # distance of the last start
            first_block, last_block = nearest // BLOCK, place // BLOCK
            per = last_block - first_block + 1
            row = np.repeat(np.arange(len(per)), per)
            block = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per) + first_block[row]
            far = np.minimum(block * BLOCK + BLOCK - 1, place[row])
            near = np.maximum(block * BLOCK, nearest[row])
            anchor_at = begins[row] + place[row]
            a, b = anchor_at - far, anchor_at - near
            union = spanned(ids, a, b - a + LENGTH)
            union = _refine(_scramble(union), (far * 4096 + near).astype(_U), 24)
            core_from = anchor_at - block * BLOCK
            core = spanned(ids, core_from, np.full(len(row), LENGTH - BLOCK + 1))
            core = _refine(_scramble(core), block.astype(_U), 25)
            shift = batch.column(2).to_numpy()[row] - begins[row]
            arrays = [
                batch.column(0).to_numpy()[row], block, a + shift, b + shift,
                core.view(np.int64), union.view(np.int64),
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in arrays],
                ["anchor", "block", "first", "last", "core", "union"],
            )

    schema = "anchor long, block long, first long, last long, core long, union long"
    return contexts.mapInArrow(made, schema)


def _single_rows(contexts: DataFrame, blocks: DataFrame) -> DataFrame:
    """(anchor, first, string): each start of the given blocks with the identifier of its string."""
    asked = blocks.groupBy("anchor").agg(F.collect_list(F.struct("first", "last")).alias("asked"))

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "context", PIECE):
            ids, begins, _ = _beside_contexts(batch)
            anchor, lo = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            lists = batch.column(4)
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            flat = lists.flatten()
            a, b = (flat.field(k).to_numpy() for k in (0, 1))
            per = b - a + 1
            start = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per) + np.repeat(a, per)
            row = np.repeat(row, per)
            at = start - lo[row] + begins[row]
            string = spanned(ids, at, np.full(len(at), LENGTH))
            arrays = [anchor[row], start, string.view(np.int64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in arrays], ["anchor", "first", "string"]
            )

    return contexts.join(asked, "anchor").select(
        "anchor", "place", "lo", "context", "asked"
    ).mapInArrow(made, "anchor long, first long, string long")


def _in_company(rows: DataFrame, by: str) -> DataFrame:
    """Buckets that hold two rows or more."""
    return rows.groupBy(by).count().filter("count > 1").select(by)


def _marked(rows: DataFrame, loose: str, tight: str, name: list[str]) -> DataFrame:
    """Rows whose `loose` bucket has company, with `n`, the rows of their `tight` bucket, `least`, the
    smallest such number in the loose one, and whether they stand for their tight bucket.

    Where `least` is 1 some row is not settled; it may still match rows that are, so one row of each
    tight bucket goes on to the next refinement.
    """
    label = F.xxhash64(*name) if len(name) > 1 else F.col(name[0])
    classes = rows.groupBy(loose, tight).agg(
        F.count(F.lit(1)).alias("n"), F.min(label).alias("_head")
    )
    both = classes.groupBy(loose).agg(F.sum("n").alias("_total"), F.min("n").alias("least"))
    told = settled(classes.join(both.filter("_total > 1"), loose).drop("_total"), "classes")
    return (
        rows.join(told, [loose, tight])
        .withColumn("is_head", label == F.col("_head"))
        .drop("_head")
    )


def repeated_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, text_id, first, last): runs of starts of repeated strings, in bytes."""
    rows = settled(_anchor_rows(docs, text), "anchors")
    marked = settled(
        _marked(rows, "gram", "span", ["anchor"]).drop("gram", "span"), "marked"
    )
    inside = marked.filter("n > 1").select(
        *_KEYS, F.col("lo").alias("first"), F.col("hi").alias("last")
    )
    left = marked.filter("least = 1 and is_head")
    contexts = settled(_contexts(docs, text, left), "contexts")
    blocks = settled(_block_rows(contexts), "blocks")
    parted = settled(_marked(blocks, "core", "union", ["anchor", "block"]), "parted")
    whole = parted.filter("n > 1")
    split = parted.filter("least = 1 and is_head")
    singles = settled(_single_rows(contexts, split), "singles")
    single = singles.join(_in_company(singles, "string"), "string")
    found = whole.select("anchor", "first", "last").unionByName(
        single.select("anchor", "first", F.col("first").alias("last"))
    )
    edges = found.join(left.filter("n = 1").select("anchor", *_KEYS), "anchor").select(
        *_KEYS, "first", "last"
    )
    return inside.unionByName(edges)


def without_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """`doc_id`, `n_bytes`, `n_removed`, `n_spans` and `kept` (bytes) of each document."""
    spans = repeated_spans(docs, text).groupBy(*_KEYS).agg(
        F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts")
    )
    joined = (
        _source(docs, text)
        .alias("d")
        .join(spans.alias("s"), _same_text("d", "s"), "left")
        .select("d.doc_id", "_text", "firsts", "lasts")
    )

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text", 2 << 20):
            rows = []
            for data, firsts, lasts in zip(*[batch.column(k).to_pylist() for k in (1, 2, 3)]):
                if not firsts:
                    rows.append((len(data), 0, 0, data))
                    continue
                first = np.array(firsts)
                order = np.argsort(first, kind="stable")
                first = first[order]
                end = np.maximum.accumulate(np.array(lasts)[order] + LENGTH)
                # A run ends where the next one starts beyond all ends so far.
                gap = np.flatnonzero(first[1:] > end[:-1])
                begins, ends = first[np.r_[0, gap + 1]], end[np.r_[gap, len(end) - 1]]
                kept = b"".join(
                    data[a:b] for a, b in zip(np.r_[0, ends], np.r_[begins, len(data)])
                )
                rows.append((len(data), len(data) - len(kept), len(begins), kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *arrays], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
            )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return joined.mapInArrow(made, schema)
