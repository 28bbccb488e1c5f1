"""Token-id files in Simple-8b words.

A 64-bit word holds a selector in its top 4 bits and as many ids as fit into the other 60: from 60
ids of 1 bit to one of 60 bits, and two selectors for runs of zeros. A wider value is an escape: the
selector for one 60-bit value with all bits set, followed by the value in a word of its own. Ids lie
in blocks of `BLOCK`, each starting a new word; the offset of each block's first word is kept, so that
blocks are packed and unpacked side by side in numpy, or one by one.

A file is the rows one task writes, ascending; a row is a run of whole documents: their ids, lengths
and place in the file, the number of ids, the words and the block offsets. Rows are kept in Parquet,
so any store that Spark writes to will do and a lost task writes its file again.

Defined results: a null or empty text has the end id only. Documents are ordered by doc_id (nulls
first), then text; a repeated row is written again, next to the first. An empty table gives no rows.
Other columns are left out. A document of any length is one row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.common import ARROW, partitions, pieces
from tillstream.llm.tokens import encoder
from tillstream.session import conf_override

BLOCK = 256
# Ids after which a row of documents is closed.
ROW_IDS = 1 << 17

# Fixed values of the format: ids in a word and bits of each, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
_ESCAPE = np.uint64((1 << 60) - 1)
_PAYLOAD = np.uint64(60)

SCHEMA = (
    "file int, row int, file_start long, doc_ids array<long>, lengths array<int>, n_ids long, "
    "words binary, offsets array<int>"
)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of `values` (unsigned), and the word at which each block of `BLOCK` starts."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    if n == 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    blocks = -(-n // BLOCK)
    # A row for each block, with zeros behind it: a word at its end looks past it.
    width = BLOCK + 64
    held = np.zeros((blocks, width), np.uint64)
    whole = n // BLOCK
    held[:whole, :BLOCK] = values[: whole * BLOCK].reshape(whole, BLOCK)
    if n % BLOCK:
        held[whole, : n % BLOCK] = values[whole * BLOCK :]
    widest = int(values.max())
    # By value, the selectors whose ids are too narrow for it; then the most of them from here on.
    narrow = np.zeros((blocks, width), np.int8)
    for bits in BITS[1:-1]:
        if widest >= 1 << int(bits):
            narrow += held >= np.uint64(1 << int(bits))
    ahead, seen = narrow.copy(), 1
    # The largest selector whose ids from here on all fit; values past the block count as zero.
    step = np.full((blocks, BLOCK), len(COUNTS) - 1, np.int8)
    for selector in range(len(COUNTS) - 2, -1, -1):
        count, bits = int(COUNTS[selector]), int(BITS[selector])
        if widest < 1 << bits:
            step[:] = selector
            continue
        for k in range(seen, count):
            reach = max(0, width - k)
            np.maximum(ahead[:, :reach], narrow[:, k:], out=ahead[:, :reach])
        seen = count
        fits = ahead[:, :BLOCK] < max(1, selector)
        if not fits.any():
            break  # no shorter code can fit where this wider one does not
        np.copyto(step, np.int8(selector), where=fits)
    # All blocks walk from word to word together.
    at = np.zeros(blocks, np.int64)
    live = np.arange(blocks)
    ends = np.minimum(BLOCK, n - np.arange(blocks) * BLOCK)
    counts = COUNTS[step]
    starts = []
    while len(live):
        place = at[live]
        starts.append(live * BLOCK + place)
        at[live] = place = place + counts[live, place]
        live = live[place < ends[live]]
    start = np.sort(np.concatenate(starts))
    selector = step.reshape(-1)[start]
    flat = held.reshape(-1)
    source = start + (start // BLOCK) * (width - BLOCK)
    wide = (selector == len(COUNTS) - 1) & (flat[source] >= _ESCAPE)
    place = np.arange(len(start))
    if wide.any():
        place += np.cumsum(wide) - wide
    words = np.zeros(len(start) + int(wide.sum()), np.uint64)
    for s in np.unique(selector):
        rows = np.flatnonzero(selector == s)
        word = np.full(len(rows), np.uint64(s) << _PAYLOAD, np.uint64)
        if s == len(COUNTS) - 1:
            word |= np.where(wide[rows], _ESCAPE, flat[source[rows]])
        elif BITS[s]:
            origin = source[rows]
            for k in range(COUNTS[s]):
                word |= flat[origin + k] << np.uint64(k * BITS[s])
        words[place[rows]] = word
    words[place[wide] + 1] = flat[source[wide]]
    first = np.searchsorted(start, np.arange(blocks) * BLOCK)
    return words, place[first]


def unpack(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The `n` values packed in `words`."""
    words, offsets = np.asarray(words, np.uint64), np.asarray(offsets, np.int64)
    selector = (words >> _PAYLOAD).astype(np.int64)
    payload = words & _ESCAPE
    last = len(COUNTS) - 1
    # Raw words follow an escape and are no words of their own. Raw words may look like escapes, so
    # of a run of words that look so, every second one from the first is one.
    mark = (selector == last) & (payload == _ESCAPE)
    escape = np.zeros(len(words), bool)
    if mark.any():
        at = 0
        for at in np.flatnonzero(mark):
            if at == 0 or not escape[at - 1]:
                escape[at] = True
    raw = np.zeros(len(words), bool)
    raw[1:] = escape[:-1]
    code = np.flatnonzero(~raw)
    counts = COUNTS[selector[code]]
    # Places within the block: every block starts a word, the last word of a block is cut short.
    block = np.searchsorted(offsets, code, side="right") - 1
    before = np.cumsum(counts) - counts
    base = before[np.searchsorted(code, offsets)]
    start = before - base[block] + block * BLOCK
    stop = np.minimum((block + 1) * BLOCK, n)
    out = np.zeros(n, np.uint64)
    for s in np.unique(selector[code]):
        if not BITS[s]:
            continue
        rows = np.flatnonzero(selector[code] == s)
        value, begin, end = payload[code[rows]], start[rows], stop[rows]
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for k in range(COUNTS[s]):
            good = begin + k < end
            out[begin[good] + k] = (value[good] >> np.uint64(k * BITS[s])) & mask
    wide = np.flatnonzero(escape[code])
    out[start[wide]] = words[code[wide] + 1]
    return out


def encode_rows(docs: DataFrame, path: str, end_id: int, text: str = "text") -> DataFrame:
    """File rows of `docs` (see the module): ids of each text and `end_id`, ascending by doc_id."""
    spark = docs.sparkSession
    source = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("_text"))
    ordered = source.repartitionByRange(partitions(spark), "doc_id", "_text").sortWithinPartitions(
        "doc_id", "_text"
    )

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path)
        file = TaskContext.get().partitionId()
        end = np.array([end_id], tokens.dtype).tobytes()
        number, start = 0, 0
        doc_ids, lengths, parts, held = [], [], [], 0

        def row() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), tokens.dtype)
            words, offsets = pack(ids)
            columns = [[file], [number], [start], [doc_ids], [lengths], [len(ids)]]
            columns += [[words.astype("<u8").tobytes()], [offsets.tolist()]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
            kinds += [pa.int64(), pa.binary(), pa.list_(pa.int32())]
            names = "file row file_start doc_ids lengths n_ids words offsets".split()
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in pieces(batches, "_text", 2 << 20):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = tokens.encode(text) + end
                doc_ids.append(doc_id)
                lengths.append(len(ids) // tokens.dtype.itemsize)
                parts.append(ids)
                held += lengths[-1]
                if held >= ROW_IDS:
                    yield row()
                    number, start = number + 1, start + held
                    doc_ids, lengths, parts, held = [], [], [], 0
        if doc_ids:
            yield row()

    return ordered.mapInArrow(rows, SCHEMA)


def write(docs: DataFrame, path: str, end_id: int, folder: str, text: str = "text") -> None:
    """Write the token files of `docs` to `folder`. The words are packed; no further compression."""
    with conf_override(docs.sparkSession, ARROW):
        encode_rows(docs, path, end_id, text).write.option("compression", "none").parquet(folder)


def _documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of file rows: doc_id, file, place within it, number of ids, ids."""
    # A worker that encoded before still holds words that reading has no use for.
    encoder.cache_clear()
    for batch in batches:
        held = {name: batch.column(name) for name in batch.schema.names}
        for k in range(batch.num_rows):
            words = np.frombuffer(held["words"][k].as_buffer(), "<u8")
            offsets = held["offsets"][k].values.to_numpy(False)
            ids = unpack(words, offsets, held["n_ids"][k].as_py())
            lengths = held["lengths"][k].values.to_numpy(False).astype(np.int64)
            ends = np.cumsum(lengths)
            starts = ends - lengths
            # One buffer for all: `pa.array` never lets go of the memoryviews that it is given.
            places = pa.array(4 * np.r_[0, ends], pa.int32())
            buffers = [None, places.buffers()[1], pa.py_buffer(ids.astype("<u4"))]
            yield pa.RecordBatch.from_arrays(
                [
                    held["doc_ids"][k].values,
                    pa.array(np.full(len(starts), held["file"][k].as_py(), np.int32)),
                    pa.array(starts + held["file_start"][k].as_py()),
                    pa.array(lengths),
                    pa.Array.from_buffers(pa.binary(), len(starts), buffers),
                ],
                ["doc_id", "file", "within", "n_tokens", "ids"],
            )


def read(spark, folder: str) -> DataFrame:
    """Documents of token files: doc_id, `start` (ids of all documents before), `n_tokens`, `ids`.

    `ids` are packed as little-endian unsigned 32-bit integers. Only one number per file is summed
    up over all files.
    """
    rows = spark.read.schema(SCHEMA).parquet(folder)
    totals = rows.groupBy("file").agg(F.sum("n_ids").alias("_ids"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("file", F.coalesce(F.sum("_ids").over(earlier), F.lit(0)).alias("base"))

    schema = "doc_id long, file int, within long, n_tokens long, ids binary"
    decoded = rows.mapInArrow(_documents, schema)
    # One number per file, and as many files as the writing shuffle had partitions.
    return decoded.join(F.broadcast(base), "file").select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids"
    )
