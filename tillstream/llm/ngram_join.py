"""N-gram Jaccard join by a blocked sparse matrix product.

Rows of the incidence matrix are distinct sets of word n-grams (documents with equal sets share a
row), columns are n-grams. The product of the matrix with its transpose holds the overlaps of all
pairs of rows. It is worked out in blocks of columns, one or more per task, and only as far as needed:

* Columns go from rare to frequent. A pair that links has a common n-gram among the first
  n - ceil(3n/4) + 1 of either row (at the ratio 3/4), so only these entries enter the blocks.
* Each block adds up overlap counts of pairs, and the counts of all blocks are summed up. A pair whose
  count, together with all entries outside the blocks, can't reach the overlap that its sizes ask for is
  discarded.
* Within a column not all pairs are multiplied. First every row is paired with the column's pivot
  of like size, and each row's best pair is verified over its whole sets. Rows so linked are one
  component, and a column whose rows are all of one is done. In the columns left open rows are paired with
  their neighbours, by size and in an order by hash, and linked rows are contracted.
* What is then open is multiplied block by block in the tasks: each pair of rows of different components
  whose sizes and places of the common entry still allow a link. Rows of overlap a link needs, alpha, are
  3/7 of both sizes, so a common entry is looked for among the first n - alpha + 1 of either row. A column
  of more than `TILE` rows is cut into tiles, so no task holds a hot column. First each row's nearest row of
  another component is verified and linked rows are contracted, then all pairs that are left. No link
  between components is lost, and a column of a thousand near copies costs thousands of pairs, not a million.
* A row has a parity sketch: one or two bits for each member, each the parity of how many members hash to
  it. Every member that only one of two rows has changes one bit at most, so rows whose sketches differ in
  more bits than a link leaves members apart can't link, and their sets are never sent.

How frequent an n-gram is only decides the order of columns, so an estimate does: all entries are counted
in `COUNTERS` counters by hash. A task counts what it reads and passes its counters on in chunks.

N-grams are 64-bit hashes, and so is the identity of a row. Defined results: texts that are null or
without a word have the empty set and no links; with fewer words than n the whole sequence is the only
member; documents with a null id are in no component (null) and link no others; repeated rows are copies;
different texts under one id are compared each on its own; an empty table gives no rows; other columns are
left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.common import few, partitions, pieces, settled
from tillstream.llm.components import components

WORDS = 5
# The ratio to reach, as a fraction: overlap / union >= TOP / BOTTOM.
TOP, BOTTOM = 3, 4
# Counters of n-grams; their sums go to all tasks (8 MB).
COUNTERS = 1 << 21
_CHUNK = 1 << 13
# Rows compared with one pivot by one task.
GROUP = 2000
# Rows of an open column that one task pairs with each other, or with as many others.
TILE = 8192
# Pairs of rows looked at together within a tile.
STEP = 1 << 18
# Whole sets, and entries with their sketch, that are enough for a task.
SETS_PER_TASK, ENTRIES_PER_TASK = 4_000, 20_000
# Bits of a sketch: the next power of two to the number of members, within these.
SKETCH_LEAST, SKETCH_MOST = 64, 1 << 15
# Bits of the filter over documents whose sets are asked for. More documents than it can tell apart
# let more rows pass; they are dropped by the join that follows.
FILTER_BITS = 1 << 25

_ODD = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _ODD[1]
    x = (x ^ (x >> np.uint64(27))) * _ODD[2]
    return x ^ (x >> np.uint64(31))


def ngram_sets(texts: list[str | None], n: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct hashes of the word n-grams of each text."""
    lists = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    lengths = [len(words) for words in lists]
    words = chain.from_iterable(lists)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, sum(lengths))
    grams = _hashed(hashes, n)
    sets, start = [], 0
    for length in lengths:
        if length >= n:
            found = np.sort(grams[start : start + length - n + 1])
        else:
            found = _hashed(hashes[start : start + length], length)
        fresh = found[1:] != found[:-1]
        sets.append(found if fresh.all() else found[np.r_[True, fresh]])
        start += length
    return sets


def _hashed(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words."""
    out = np.full(max(0, len(hashes) - n + 1) if n else 0, n, np.uint64)
    for k in range(n):
        out = mixed(out * _ODD[0] + hashes[k : k + len(out)])
    return out


def ngram_set(text: str | None, n: int = WORDS) -> np.ndarray:
    return ngram_sets([text], n)[0]


def sketch(members: np.ndarray) -> bytes:
    """Parities of how many members hash to each bit. The sketch of half the bits is its halves' xor."""
    bits = min(max(SKETCH_LEAST, 1 << (len(members) - 1).bit_length()), SKETCH_MOST)
    held = np.bincount((members & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(held & 1, bitorder="little").tobytes()


def differing(sketches: list[bytes], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bits in which the sketches x and y (places in `sketches`) differ, at the shorter one's length; at
    most so many members do the sets have apart. Neither is longer than twice the other."""
    words = np.array([len(s) // 8 for s in sketches])
    short = np.minimum(words[x], words[y])
    out = np.empty(len(x), np.int64)
    for w in np.unique(short):
        own, twice = np.flatnonzero(words == w), np.flatnonzero(words == 2 * w)
        place = np.zeros(len(words), np.int64)
        place[own], place[twice] = np.arange(len(own)), len(own) + np.arange(len(twice))
        same = np.frombuffer(b"".join(sketches[k] for k in own), np.uint64).reshape(-1, w)
        halves = np.frombuffer(b"".join(sketches[k] for k in twice), np.uint64).reshape(-1, 2, w)
        table = np.concatenate([same, halves[:, 0] ^ halves[:, 1]])
        pairs, step = np.flatnonzero(short == w), max(1, (1 << 20) // int(w))
        for start in range(0, len(pairs), step):
            part = pairs[start : start + step]
            other = table[place[x[part]]] ^ table[place[y[part]]]
            out[part] = np.bitwise_count(other).sum(axis=1, dtype=np.int64)
    return out


def _apart(sizes: np.ndarray) -> np.ndarray:
    """Members that two rows of so many together may have apart in a link."""
    return sizes - 2 * -(-TOP * sizes // (TOP + BOTTOM))


def _identity(members: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(members.tobytes())).view(np.int64)))


def prefix_length(n: int) -> int:
    """Entries of a row of n that enter the product."""
    return n - -(-TOP * n // BOTTOM) + 1


def _counter(grams: np.ndarray) -> np.ndarray:
    return (mixed(grams) >> np.uint64(64 - (COUNTERS - 1).bit_length())).astype(np.int64)


def rows_of(docs: DataFrame, text: str, n: int) -> DataFrame:
    """doc_id, `digest` of its text, `row` (identity of its set), `size`, `sketch`; and each task's
    counters, by `chunk`."""
    names = ["doc_id", "digest", "row", "size", "sketch", "chunk", "counts"]

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.uint32)
        for batch in pieces(batches, "_text", 2 << 20):
            sets = ngram_sets(batch.column(1).to_pylist(), n)
            np.add.at(counts, _counter(np.concatenate(sets)), np.uint32(1))
            nothing = [pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())]
            rows = [pa.array([_identity(s) for s in sets], pa.int64())]
            rows.append(pa.array([len(s) for s in sets], pa.int64()))
            rows.append(pa.array([sketch(s) if len(s) else None for s in sets], pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *rows, *nothing], names)
        chunks = counts.reshape(-1, _CHUNK)
        filled = np.flatnonzero(chunks.any(axis=1))
        data = [zlib.compress(chunks[k].tobytes(), 1) for k in filled]
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
        nothing = [pa.nulls(len(filled), t) for t in kinds]
        yield pa.RecordBatch.from_arrays(
            [*nothing, pa.array(filled, pa.int32()), pa.array(data, pa.binary())], names
        )

    schema = "doc_id long, digest string, row long, size long, sketch binary, chunk int, counts binary"
    return _source(docs, text).withColumn("digest", F.md5("_text")).mapInArrow(made, schema)


def counters(rows: DataFrame) -> np.ndarray:
    """The sums of all tasks' counters."""

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(zlib.decompress(data), np.uint32)
                sums[chunk] = sums.get(chunk, 0) + part.astype(np.uint64)
        most = np.uint64(2**32 - 1)
        data = [np.minimum(v, most).astype(np.uint32).tobytes() for v in sums.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array(data, pa.binary())], ["chunk", "counts"]
        )

    parts = rows.filter("chunk is not null").select("chunk", "counts")
    dealt = parts.repartition(partitions(rows.sparkSession), "chunk")
    found = dealt.mapInArrow(summed, "chunk int, counts binary").toArrow()
    out = np.zeros((COUNTERS // _CHUNK, _CHUNK), np.uint32)
    for chunk, data in zip(found.column("chunk").to_pylist(), found.column("counts").to_pylist()):
        out[chunk] = np.frombuffer(data, np.uint32)
    return out.reshape(-1)


def _source(docs: DataFrame, text: str) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("_text"))


def _prefix(members: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The rarest members by their counters, equals in the order of their hash."""
    key = counts.astype(np.uint64) << np.uint64(32) | np.arange(len(members), dtype=np.uint64)
    key.sort()
    return members[key[: prefix_length(len(members))] & np.uint64(2**32 - 1)]


def _blocks(docs: DataFrame, text: str, n: int, counts: np.ndarray) -> DataFrame:
    """Entries of the matrix by block of columns: (block, entries), entries being packed arrays."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(counts)  # COUNTERS of them
    count = 4 * partitions(spark)

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        seen: set[int] = set()
        for batch in pieces(batches, "_text", 2 << 20):
            grams, rows, sizes, spots = [], [], [], []
            sets = ngram_sets(batch.column(1).to_pylist(), n)
            held = counts[_counter(np.concatenate(sets))]
            for members, end in zip(sets, np.cumsum([len(m) for m in sets])):
                row = _identity(members)
                if not len(members) or row in seen:
                    continue  # copies met in this task
                if len(seen) >= 1_000_000:
                    seen.clear()
                seen.add(row)
                part = _prefix(members, held[end - len(members) : end])
                grams.append(part)
                rows.append(np.full(len(part), row, np.int64))
                sizes.append(np.full(len(part), len(members), np.int32))
                spots.append(np.arange(len(part), dtype=np.int32))
            if not grams:
                continue
            gram = np.concatenate(grams)
            block = (mixed(gram) % np.uint64(count)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            gram, block = gram[order], block[order]
            row, size, spot = (np.concatenate(x)[order] for x in (rows, sizes, spots))
            starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            ends = np.r_[starts[1:], len(block)]
            data = [
                b"".join(x[a:b].tobytes() for x in (gram, row, size, spot))
                for a, b in zip(starts, ends)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[starts], pa.int64()), pa.array(data, pa.binary())],
                ["block", "entries"],
            )

    # Documents without an id are in no component, so nothing is compared with them.
    named = _source(docs, text).filter("doc_id is not null")
    return named.mapInArrow(made, "block long, entries binary")


def _columns(blocks: DataFrame) -> DataFrame:
    """Columns with two rows or more: (col, weight, rows, sizes, spots); equal columns of a task are one
    with their number as weight and the first of their places in each row. Rows are ordered by size."""
    spark = blocks.sparkSession

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, rows, sizes, spots = [], [], [], []
        for batch in batches:
            for data in batch.column(1):
                view = data.as_buffer()
                k = view.size // 24
                grams.append(np.frombuffer(view, np.uint64, k))
                rows.append(np.frombuffer(view, np.int64, k, 8 * k))
                sizes.append(np.frombuffer(view, np.int32, k, 16 * k))
                spots.append(np.frombuffer(view, np.int32, k, 20 * k))
        if not grams:
            return
        gram, row, size, spot = map(np.concatenate, (grams, rows, sizes, spots))
        order = np.argsort(gram, kind="stable")
        # Columns of one row say nothing; dropped before the rest is put in order.
        gram = gram[order]
        twin = np.zeros(len(gram), bool)
        twin[1:] = gram[1:] == gram[:-1]
        twin[:-1] |= twin[1:]
        gram, row, size, spot = gram[twin], *(x[order][twin] for x in (row, size, spot))
        order = np.lexsort((row, size, gram))
        gram, row, size, spot = (x[order] for x in (gram, row, size, spot))
        fresh = np.r_[True, (gram[1:] != gram[:-1]) | (row[1:] != row[:-1])][: len(gram)]
        gram, row, size, spot = (x[fresh] for x in (gram, row, size, spot))
        starts = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])[: len(gram)]
        ends = np.r_[starts[1:], len(gram)]
        keep = ends - starts > 1
        starts, ends = starts[keep], ends[keep]
        if not len(starts):
            return
        sums = np.add.reduceat(mixed(row.view(np.uint64)), np.c_[starts, ends].ravel()[:-1])[::2]
        key = mixed(sums + (ends - starts).astype(np.uint64))
        _, first, same, weight = np.unique(
            key, return_index=True, return_inverse=True, return_counts=True
        )
        by_key = np.split(np.argsort(same, kind="stable"), np.cumsum(weight)[:-1])

        def least(k: int) -> np.ndarray:
            return np.minimum.reduce([spot[starts[c] : ends[c]] for c in by_key[k]])

        for a in range(0, len(first), 20_000):
            part = first[a : a + 20_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key[part].view(np.int64), pa.int64()),
                    pa.array(weight[a : a + 20_000], pa.int64()),
                    pa.array([row[starts[k] : ends[k]] for k in part], pa.list_(pa.int64())),
                    pa.array([size[starts[k] : ends[k]] for k in part], pa.list_(pa.int32())),
                    pa.array([least(k) for k in range(a, a + len(part))], pa.list_(pa.int32())),
                ],
                ["col", "weight", "rows", "sizes", "spots"],
            )

    dealt = blocks.repartition(4 * partitions(spark), "block")
    return dealt.mapInArrow(
        made, "col long, weight long, rows array<long>, sizes array<int>, spots array<int>"
    )


def _possible(count: str, a: str, b: str):
    """Whether sizes a and b can still link, given the overlap counted within the blocks."""

    def outside(size: str):
        n = F.col(size)
        return n - (n - F.ceil(n * TOP / BOTTOM) + 1)

    most = F.col(count) + F.greatest(outside(a), outside(b))
    return (TOP + BOTTOM) * most >= TOP * (F.col(a) + F.col(b))


def _pivot_pairs(columns: DataFrame) -> DataFrame:
    """(a, b, a_size, b_size, count): pairs of each row with the pivots of its columns."""

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            if not len(lists):
                continue
            row = lists.flatten().to_numpy()
            size = batch.column(3).flatten().to_numpy().astype(np.int64)
            lengths = np.diff(lists.offsets.to_numpy())
            weight = np.repeat(batch.column(1).to_numpy(), lengths)
            pivot = np.repeat(np.cumsum(lengths) - lengths, lengths)
            place = np.arange(len(row))
            while True:
                # Too large for the pivot: the first such row of each run is the next pivot.
                far = TOP * size > BOTTOM * size[pivot]
                if not far.any():
                    break
                change = far & np.r_[True, ~far[:-1] | (pivot[1:] != pivot[:-1])]
                start = np.maximum.accumulate(np.where(change, place, 0))
                pivot = np.where(far, start, pivot)
            pair = pivot != place
            a, b = row[pivot[pair]], row[pair]
            if not len(a):
                continue
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            fresh = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            total = np.add.reduceat(weight[pair][order], fresh)
            arrays = [a[fresh], b[fresh], size[pivot[pair]][order][fresh], size[pair][order][fresh]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in [*arrays, total]],
                ["a", "b", "a_size", "b_size", "count"],
            )

    parts = columns.mapInArrow(made, "a long, b long, a_size long, b_size long, count long")
    return (
        parts.groupBy("a", "b", "a_size", "b_size")
        .agg(F.sum("count").alias("count"))
        .filter(_possible("count", "a_size", "b_size"))
    )


def _entries(columns: DataFrame) -> DataFrame:
    """(col, row, weight, size, spot). A column may come from several tasks under one name."""
    single = columns.select("col", "weight", F.explode(F.arrays_zip("rows", "sizes", "spots")).alias("e"))
    return single.groupBy("col", F.col("e.rows").alias("row")).agg(
        F.sum("weight").alias("weight"),
        F.first("e.sizes").alias("size"),
        F.min("e.spots").alias("spot"),
    )


def _open(entries: DataFrame, found: DataFrame, count: int) -> DataFrame:
    """Of `count` entries those of the columns that hold rows of two components, with `component` and
    the column's number of `parts`."""
    told = (
        entries.drop("component", "parts")
        .join(found.withColumnRenamed("node", "row"), "row", "left")
        .withColumn("component", F.coalesce("component", "row"))
    )
    told = few(told, count)
    columns = (
        told.groupBy("col")
        .agg(
            F.min("component").alias("least"),
            F.max("component").alias("most"),
            F.ceil(F.count(F.lit(1)) / TILE).alias("parts"),
        )
        .filter("least <> most")
        .select("col", "parts")
    )
    return settled(few(told.join(few(columns, count), "col"), count), "open")


def _part():
    return F.pmod(F.xxhash64("row"), F.col("parts"))


def _neighbours(open_: DataFrame, by_size: bool) -> DataFrame:
    """(a, b): for each row of an open column the neighbour of another component it most often has."""
    place = F.col("size").cast("long") if by_size else F.xxhash64("row", F.lit(1))
    spark = open_.sparkSession
    values = ["col", "part", "row", "component", "weight", "size"]
    dealt = (
        open_.withColumn("part", _part())
        .withColumn("place", place)
        .select(*[F.col(v).cast("long").alias(v) for v in values], "place", "sketch")
        .repartition(partitions(spark), "col", "part")
        .sortWithinPartitions("col", "part", "place", "row")
    )

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, before = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(v).to_numpy() for v in values])
            sketches = batch.column("sketch").to_pylist()
            if last is not None:
                rows, sketches = np.concatenate([last, rows], axis=1), before + sketches
            last, before = rows[:, -1:], sketches[-1:]
            x, y = rows[:, :-1], rows[:, 1:]
            side = (x[0] == y[0]) & (x[1] == y[1]) & (x[3] != y[3])
            side &= TOP * np.maximum(x[5], y[5]) <= BOTTOM * np.minimum(x[5], y[5])
            first = np.flatnonzero(side)
            near = differing(sketches, first, first + 1) <= _apart(x[5] + y[5])[first]
            first = first[near]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v[first], pa.int64()) for v in (x[2], y[2], x[4])], ["a", "b", "count"]
            )

    pairs = dealt.mapInArrow(made, "a long, b long, count long")
    both = pairs.union(pairs.select("b", "a", "count"))
    best = Window.partitionBy("b").orderBy(F.desc("count"), "a")
    chosen = both.groupBy("a", "b").agg(F.sum("count").alias("count"))
    return _ordered(chosen.withColumn("nth", F.row_number().over(best)).filter("nth = 1"))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _multiplied(rows: np.ndarray, sketches: list[bytes]) -> Iterator[np.ndarray]:
    """Pairs (a, b) of one tile whose sizes, places and sketches allow a link, with the bits in which the
    sketches differ. `rows`: row, size, spot, component, part, ordered by size; rows of one part only pair
    with each other where the tile has but one."""
    row, size, spot, component, part = rows
    ends = np.searchsorted(size, BOTTOM * size // TOP, "right")
    count = ends - np.arange(len(row)) - 1
    total = np.cumsum(count)
    mixed_parts = part[0] != part.min() or part.min() != part.max()
    start = 0
    while start < len(row):
        stop = max(start + 1, np.searchsorted(total, (total[start - 1] if start else 0) + STEP, "right"))
        x = np.repeat(np.arange(start, stop), count[start:stop])
        before = np.repeat(np.cumsum(count[start:stop]) - count[start:stop], count[start:stop])
        y = x + 1 + np.arange(len(x)) - before
        both = size[x] + size[y]
        need = -(-TOP * both // (TOP + BOTTOM))
        keep = (component[x] != component[y]) & (spot[x] <= size[x] - need) & (spot[y] <= size[y] - need)
        if mixed_parts:
            keep &= part[x] != part[y]
        x, y = x[keep], y[keep]
        if len(x):
            low, high = x.min(), y.max() + 1
            bits = differing(sketches[low:high], x - low, y - low)
            near = bits <= _apart(both[keep])
            yield np.stack([row[x[near]], row[y[near]], bits[near]])
        start = stop


def _nearest(pairs: np.ndarray) -> np.ndarray:
    """Of pairs (a, b, bits) the nearest `a` of each row, as `b`."""
    both = np.concatenate([pairs, pairs[[1, 0, 2]]], axis=1)
    both = both[:, np.lexsort((both[0], both[2], both[1]))]
    return both[:, np.r_[True, both[1, 1:] != both[1, :-1]][: both.shape[1]]]


def _cross_pairs(open_: DataFrame, nearest: bool) -> DataFrame:
    """(a, b): pairs of rows in different components that may link; the product of open columns. With
    `nearest`, of each row only the one with the row whose sketch differs least."""
    spark = open_.sparkSession
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    tiles = (
        open_.withColumn("part", _part())
        .withColumn("other", other)
        .select(
            "col", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
            "row", F.col("size").cast("long").alias("size"), F.col("spot").cast("long").alias("spot"),
            "component", "part", "sketch",
        )
        .repartition(4 * partitions(spark), "col", "low", "high")
        .sortWithinPartitions("col", "low", "high", "size", "row")
    )

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        sketches: list[bytes] = []
        pairs: list[np.ndarray] = []
        waiting = 0

        def sent() -> pa.RecordBatch:
            found = np.concatenate(pairs, axis=1)
            out = _nearest(found) if nearest else np.unique(found, axis=1)
            return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out], ["a", "b", "bits"])

        def finished(stop: bool) -> Iterator[pa.RecordBatch]:
            nonlocal waiting
            if held:
                for found in _multiplied(np.concatenate(held, axis=1), sketches):
                    pairs.append(found)
                    waiting += found.shape[1]
                    if waiting > STEP:
                        yield sent()
                        pairs.clear()
                        waiting = 0
                held.clear()
                sketches.clear()
            if stop and waiting:
                yield sent()

        key = None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("col", "low", "high")])
            values = ("row", "size", "spot", "component", "part")
            rows = np.stack([batch.column(c).to_numpy() for c in values])
            own = batch.column("sketch").to_pylist()
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for begin, end in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows]):
                if begin == end:
                    continue
                now = tuple(keys[:, begin])
                if now != key:
                    yield from finished(False)
                    key = now
                held.append(rows[:, begin:end])
                sketches.extend(own[begin:end])
        yield from finished(True)

    found = tiles.mapInArrow(made, "a long, b long, bits long")
    if nearest:
        best = Window.partitionBy("b").orderBy("bits", "a")
        found = found.withColumn("nth", F.row_number().over(best)).filter("nth = 1")
    return _ordered(found)


def _sets(docs: DataFrame, text: str, n: int, wanted: DataFrame) -> DataFrame:
    """(doc_id, row, members) of the documents in `wanted` (and a few more): whole sets, packed, with
    their identity, as one id may stand on several texts."""
    spark = docs.sparkSession
    bits = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).cast("int")
    # The filter has a fixed size: at most FILTER_BITS / 32 words come to the driver, as one array.
    words = (
        wanted.select(bits.alias("bit"))
        .groupBy(F.expr("bit div 32").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, bit % 32)")).alias("flags"))
        .toArrow()
    )
    table = np.zeros(FILTER_BITS // 32, np.uint32)
    table[words.column("word").to_numpy()] = words.column("flags").to_numpy().astype(np.uint32)
    shared = spark.sparkContext.broadcast(table)
    source = _source(docs, text).filter("doc_id is not null").withColumn("_bit", bits)

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            bit = batch.column(2).to_numpy()
            batch = batch.filter(pa.array((table[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1 == 1))
            for part in pieces([batch], "_text", 2 << 20):
                sets = ngram_sets(part.column(1).to_pylist(), n)
                rows = pa.array([_identity(s) for s in sets], pa.int64())
                data = pa.array([s.tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), rows, data], ["doc_id", "row", "members"]
                )

    return source.mapInArrow(made, "doc_id long, row long, members binary")


def _verified(docs: DataFrame, text: str, n: int, pairs: DataFrame, owners: DataFrame) -> DataFrame:
    """Links (u, v) among `pairs` (a, b) of rows: whole sets, each sent once per pivot `a`.

    `owners` names a document of each row. Pairs of a pivot are dealt to groups of about `GROUP`.
    """
    spark = docs.sparkSession
    pairs = settled(pairs, "pairs")
    most = 2 * pairs.count()  # pivots are no more than pairs, nor are groups
    pairs = few(pairs, most)
    groups = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    groups = groups.withColumn("groups", F.ceil(F.col("n") / GROUP)).drop("n")
    groups = few(groups, most)
    dealt = pairs.join(groups, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("groups")).alias("part")
    )
    heads = groups.select("a", F.col("a").alias("b"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("part"))
    # A pivot comes first in each of its groups.
    asked = dealt.withColumn("order", F.lit(1)).unionByName(heads.withColumn("order", F.lit(0)))
    asked = few(asked.withColumnRenamed("b", "row"), most).join(owners, "row")
    asked = settled(few(asked, most), "asked")
    sets = _sets(docs, text, n, asked.select("doc_id"))
    sent = asked.join(sets, ["doc_id", "row"]).withColumnRenamed("row", "b")
    ordered = few(sent, most, SETS_PER_TASK).repartition(partitions(spark), "a", "part").sortWithinPartitions(
        "a", "part", "order"
    )

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, head = None, None
        for batch in batches:
            links = []
            columns = [batch.column(c).to_pylist() for c in ("a", "b", "order", "members")]
            for a, b, order, data in zip(*columns):
                members = np.frombuffer(data, np.uint64)
                if order == 0:
                    pivot, head = a, members
                    continue
                if a != pivot:
                    raise ValueError("a pivot's set is missing")
                spot = np.minimum(np.searchsorted(head, members), len(head) - 1)
                common = int((head[spot] == members).sum())
                if BOTTOM * common >= TOP * (len(head) + len(members) - common):
                    links.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["u", "v"]
            )

    return few(ordered, most, SETS_PER_TASK).mapInArrow(made, "u long, v long")


def jaccard_components(docs: DataFrame, text: str = "text", n: int = WORDS) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id` of every document of `docs`."""
    return jaccard_groups(docs, text, n).select("doc_id", "n_shingles", "component_id")


def jaccard_groups(docs: DataFrame, text: str = "text", n: int = WORDS) -> DataFrame:
    """As `jaccard_components`, with `digest`, the MD5 of the text, and `group`, the component's own
    number: two components have the same `component_id` if one id stands on a text of each. `group` is
    null for a null id and for a text without words."""
    read = settled(rows_of(docs, text, n), "rows")
    columns = settled(_columns(_blocks(docs, text, n, counters(read))), "columns")
    rows = read.filter("chunk is null").select("doc_id", "digest", "row", "size")
    named = read.filter("size > 0 and doc_id is not null")
    sketched = settled(
        named.groupBy("row").agg(F.min("doc_id").alias("doc_id"), F.min("sketch").alias("sketch")), "owners"
    )
    owners = sketched.select("row", "doc_id")
    best = Window.partitionBy("b").orderBy(F.desc("count"), "a")
    first = _pivot_pairs(columns).withColumn("nth", F.row_number().over(best)).filter("nth = 1")
    links = settled(_verified(docs, text, n, first.select("a", "b"), owners), "links")
    # Entries of the columns, one at least for each that `_entries` gives.
    count = columns.agg(F.sum(F.size("rows").cast("long"))).first()[0] or 0
    open_ = _open(_entries(columns), components(links), count)
    sketches = sketched.select("row", "sketch")
    rounds = (
        lambda left: _neighbours(left, True).union(_neighbours(left, False)).distinct(),
        lambda left: _cross_pairs(left, nearest=True),
    )
    for paired in rounds:
        count = open_.count()
        pairs = paired(few(open_.join(sketches, "row"), count, ENTRIES_PER_TASK))
        links = links.union(settled(_verified(docs, text, n, pairs, owners), "links"))
        open_ = _open(open_, components(links), count)
    count = open_.count()
    left = _cross_pairs(few(open_.join(sketches, "row"), count, ENTRIES_PER_TASK), nearest=False)
    links = links.union(settled(_verified(docs, text, n, left, owners), "links"))
    final = settled(components(links), "found")
    named = (
        final.join(owners.withColumnRenamed("row", "node"), "node")
        .groupBy("component")
        .agg(F.min("doc_id").alias("component_id"))
        .join(final, "component")
        .select(F.col("node").alias("row"), "component_id", F.col("component").alias("group"))
    )
    # Rows without a link, too, stand for the smallest id among their copies.
    classes = owners.join(named, "row", "left").select(
        "row",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("group", "row").alias("group"),
    )
    return rows.join(classes, "row", "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.when(F.col("doc_id").isNull(), None)
        .when(F.col("size") == 0, F.col("doc_id"))
        .otherwise(F.col("component_id"))
        .alias("component_id"),
        "digest",
        F.when(F.col("doc_id").isNotNull() & (F.col("size") > 0), F.col("group")).alias("group"),
    )
