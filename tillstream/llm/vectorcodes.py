"""Vector code compression: product codes kept up to date by adaptive distance bounds.

Vectors become integers and are cut into parts; each part position has a codebook that Lloyd rounds move.
Between rounds a written table keeps, for every part of every vector, the b closest entries in order: an
upper bound of the distance to the first, which is the part's code, a lower bound of the distance to each
other, and one outer bound for all entries not listed. When entries move, the bounds move by as much. A
part whose upper bound stays below all others keeps its code unseen; of the rest, first the distance to
the code is taken anew, then those to the listed entries that could be nearer, and only where the outer
bound fails are all entries looked at. Whatever the bounds leave open is decided on exact integer squares,
ties by index, so the codes are those of the plain method. After each round b shrinks to the longest list
that was of use.

What passes through the driver is the codebooks: entries x length numbers, whatever the table holds.

Defined results: rows whose vector is null, empty, or holds null or non-finite components are left out, as
are those of another length than the vector of the smallest id (null ids come last). A length that the
parts don't divide is cut as evenly as it goes. Rows are told apart by nothing but themselves: repeated
rows and rows with null ids each have their own result. Fewer vectors than entries make smaller codebooks.
An empty table gives no rows. Other columns are left out. Components too large for exact products in
double precision are computed with whole numbers of any size, without bounds; an error beyond 64 bits is
null then.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import settled

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# Longest list a part starts with, and the shortest it shrinks to.
FIRST_LIST, LEAST_LIST = 32, 4
# Squares below this leave room for the entry's index in a double's 53 bits.
EXACT = 2**44
_FAR = 2**30


def _square_roots(squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers just below and just above the roots."""
    low = np.floor(np.sqrt(squares)).astype(np.int64)
    low -= low * low > squares
    return low, low + (low * low < squares)


def _squares(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows and entries, all whole numbers in double precision."""
    return (x * x).sum(1)[:, None] - 2 * (x @ book.T) + (book * book).sum(1)


class Part:
    """Lists and bounds of one part position for a batch of rows."""

    def __init__(self, ids: np.ndarray, bounds: np.ndarray):
        self.ids, self.bounds = ids, bounds  # n x b; n x (b + 1): upper, lower ..., outer

    @classmethod
    def fresh(cls, x: np.ndarray, book: np.ndarray, width: int) -> Part:
        """From distances to all entries."""
        width = min(width, len(book))
        keys = _squares(x, book) * ENTRIES + np.arange(len(book))
        if width < len(book):
            keys = np.partition(keys, width, axis=1)[:, : width + 1]
        keys = np.sort(keys, axis=1).astype(np.int64)
        low, high = _square_roots(keys // ENTRIES)
        bounds = np.full((len(x), width + 1), _FAR)
        bounds[:, : keys.shape[1]] = low
        bounds[:, 0] = high[:, 0]
        return cls(keys[:, :width] % ENTRIES, bounds)

    def follow(self, x: np.ndarray, book: np.ndarray, moves: np.ndarray, width: int) -> dict:
        """Bounds and codes after the entries moved by at most `moves`; what had to be looked at."""
        ids, bounds = self.ids, self.bounds
        if width < ids.shape[1]:
            outer = bounds[:, width:].min(1)
            ids, bounds = ids[:, :width], np.column_stack([bounds[:, :width], outer])
        steps = moves[ids]
        bounds = bounds.copy()
        bounds[:, 0] += steps[:, 0]
        bounds[:, 1:-1] -= steps[:, 1:]
        bounds[:, -1] -= moves.max()
        self.ids, self.bounds = ids.copy(), np.maximum(bounds, 0)
        open_ = np.flatnonzero(self.bounds[:, 0] >= self.bounds[:, 1:].min(1))
        own = ((x[open_] - book[self.ids[open_, 0]]) ** 2).sum(1)
        self.bounds[open_, 0] = _square_roots(own)[1]
        still = self.bounds[open_, 0] >= self.bounds[open_, 1:].min(1)
        rows, own = open_[still], own[still]
        far = self.bounds[rows, 0] >= self.bounds[rows, -1]
        depth = self._verify(x, book, rows[~far], own[~far])
        if far.any():
            anew = Part.fresh(x[rows[far]], book, self.ids.shape[1])
            self.ids[rows[far]], self.bounds[rows[far]] = anew.ids, anew.bounds
        return {"open": len(open_), "listed": int((~far).sum()), "full": int(far.sum()), "depth": depth}

    def _verify(self, x: np.ndarray, book: np.ndarray, rows: np.ndarray, own: np.ndarray) -> int:
        """Exact distances to the listed entries that may be nearer; the lists are put in order again."""
        if not len(rows):
            return 1
        ids, bounds = self.ids[rows], self.bounds[rows]
        width = ids.shape[1]
        keys = np.full((len(rows), width), np.iinfo(np.int64).max)
        keys[:, 0] = own.astype(np.int64) * ENTRIES + ids[:, 0]
        at, place = np.nonzero(bounds[:, 1:width] <= bounds[:, :1])
        place += 1
        squares = ((x[rows[at]] - book[ids[at, place]]) ** 2).sum(1).astype(np.int64)
        keys[at, place] = squares * ENTRIES + ids[at, place]
        lower = bounds[:, :width].copy()
        lower[at, place] = _square_roots(squares)[0]
        lower[:, 0] = _square_roots(own.astype(np.int64))[0]
        best = keys.argmin(1)
        upper = _square_roots(keys[np.arange(len(rows)), best] // ENTRIES)[1]
        lower[np.arange(len(rows)), best] = -1
        order = np.argsort(lower, axis=1, kind="stable")
        self.ids[rows] = np.take_along_axis(ids, order, 1)
        self.bounds[rows, 1:width] = np.take_along_axis(lower, order, 1)[:, 1:]
        self.bounds[rows, 0] = upper
        return int(place.max(initial=0)) + 1


def _cuts(length: int) -> list[int]:
    return [k * length // PARTS for k in range(PARTS + 1)]


def _matrix(cells: pa.Array, wide: bool) -> np.ndarray:
    flat = cells.flatten().to_numpy(False)
    if wide:
        whole = [math.floor(v * SCALE) if abs(v) < 2**53 else int(v) * SCALE for v in flat.tolist()]
        flat = np.array(whole, dtype=object)
    else:
        flat = flat.astype(np.float64)
    return flat.reshape(len(cells), -1) if len(cells) else flat.reshape(0, 0)


def _bytes(column: pa.Array, dtype: type, rows: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(rows, PARTS, -1)


def _wide_codes(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes, squares = [], []
    for row in x:
        found = ((book - row) ** 2).sum(1)
        codes.append(int(found.argmin()))
        squares.append(found[codes[-1]])
    return np.array(codes, dtype=np.int64), np.array(squares, dtype=object)


def _parts(batch: pa.RecordBatch, books: list, moves: list | None, width: int, wide: bool):
    """Codes' lists and bounds of a batch, by part, and what was looked at."""
    x = _matrix(batch.column("cells"), wide)
    cuts, out, seen = _cuts(x.shape[1]), [], []
    if moves is not None and not wide:
        near = _bytes(batch.column("near"), np.uint8, len(x)).astype(np.int64)
        bounds = _bytes(batch.column("bounds"), np.int32, len(x)).astype(np.int64)
    for k, book in enumerate(books):
        piece = x[:, cuts[k] : cuts[k + 1]]
        if wide:
            part = Part(_wide_codes(piece, book)[0][:, None], np.zeros((len(x), 2), np.int64))
            seen.append({"full": len(x)})
        elif moves is None:
            part = Part.fresh(piece, book, width)
            seen.append({"full": len(x)})
        else:
            part = Part(near[:, k], bounds[:, k])
            seen.append(part.follow(piece, book, moves[k], width))
        out.append(part)
    return x, cuts, out, seen


def _step(books: list, moves: list | None, width: int, wide: bool):
    """Map function: the state table of the next round."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            _, _, parts, seen = _parts(batch, books, moves, width, wide)
            near = np.stack([p.ids for p in parts], 1).astype(np.uint8)
            bounds = np.stack([p.bounds for p in parts], 1).astype("<i4")
            sums = {name: sum(s.get(name, 0) for s in seen) for name in ("open", "listed", "full")}
            counts = np.zeros((3, n), np.int64)
            counts[:, 0] = list(sums.values())  # on the first row of a batch: only totals are read
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("id", "label", "cells")),
                    pa.array([row.tobytes() for row in near], pa.binary()),
                    pa.array([row.tobytes() for row in bounds], pa.binary()),
                    *(pa.array(c) for c in counts),
                    pa.array([max(s.get("depth", 1) for s in seen)] * n, pa.int64()),
                ],
                ["id", "label", "cells", "near", "bounds", "n_open", "n_listed", "n_full", "depth"],
            )

    return run


def _final(books: list, moves: list | None, width: int, wide: bool):
    """Map function: codes and errors."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, cuts, parts, _ = _parts(batch, books, moves, width, wide)
            error = 0
            for k, part in enumerate(parts):
                error = error + ((x[:, cuts[k] : cuts[k + 1]] - books[k][part.ids[:, 0]]) ** 2).sum(1)
            codes = np.stack([p.ids[:, 0] for p in parts], 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("label"),
                    pa.array([row.tobytes().hex() for row in codes], pa.string()),
                    pa.array([int(e) if e < 2**63 else None for e in error], pa.int64()),
                ],
                ["id", "label", "code", "error"],
            )

    return run


def _sums(books: list, wide: bool):
    """Map function: per task, part and entry, how many rows and the sums of their components."""
    sizes = [book.shape for book in books]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(size, object if wide else np.int64) for size in sizes]
        counts = [np.zeros(size[0], np.int64) for size in sizes]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("cells"), wide)
            codes = _bytes(batch.column("near"), np.uint8, len(x))[:, :, 0]
            cuts = _cuts(x.shape[1])
            for k in range(PARTS):
                piece = x[:, cuts[k] : cuts[k + 1]]
                counts[k] += np.bincount(codes[:, k], minlength=sizes[k][0])
                if wide:
                    np.add.at(totals[k], codes[:, k], piece)
                else:
                    chosen = (codes[:, k, None] == np.arange(sizes[k][0])).astype(np.float64)
                    totals[k] += (chosen.T @ piece).astype(np.int64)
        keys = [(k, e) for k in range(PARTS) for e in np.flatnonzero(counts[k])]
        if keys:
            rows = [totals[k][e].tolist() for k, e in keys]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k for k, _ in keys], pa.int32()),
                    pa.array([int(e) for _, e in keys], pa.int32()),
                    pa.array([int(counts[k][e]) for k, e in keys], pa.int64()),
                    pa.array([[str(v) for v in r] for r in rows], pa.list_(pa.string()))
                    if wide
                    else pa.array(rows, pa.list_(pa.int64())),
                ],
                ["part", "entry", "n", "sums"],
            )

    return run


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    """One row per part and entry, from one per task: whole numbers of any size as text."""
    lists = [[int(v) for v in r] for r in rows["sums"]]
    sums = [str(sum(column)) for column in zip(*lists)]
    return pd.DataFrame(
        {"part": rows["part"][:1], "entry": rows["entry"][:1], "n": [rows["n"].sum()], "sums": [sums]}
    )


def _moved(state: DataFrame, books: list, wide: bool) -> list:
    """Codebooks after a round: each entry the floored mean of its parts, unused ones as they were."""
    kind = "string" if wide else "long"
    schema = f"part int, entry int, n long, sums array<{kind}>"
    rows = state.select("cells", "near").mapInArrow(_sums(books, wide), schema)
    if wide:
        added = rows.groupBy("part", "entry").applyInPandas(_added, schema)
    else:
        longest = max(book.shape[1] for book in books)
        each = [F.sum(F.get("sums", F.lit(i))).alias(str(i)) for i in range(longest)]
        sums = rows.groupBy("part", "entry").agg(F.sum("n").alias("n"), *each)
        added = sums.select("part", "entry", "n", F.array(*map(str, range(longest))).alias("sums"))
    after = [book.copy() for book in books]
    for row in added.collect():  # at most parts x entries rows
        length = after[row.part].shape[1]
        after[row.part][row.entry] = [int(v) // row.n for v in row.sums[:length]]
    return after


def _steps(before: list, after: list) -> list:
    """How far each entry moved, rounded up."""
    return [_square_roots(((b - a) ** 2).sum(1))[1] for b, a in zip(before, after)]


def finite(vector: Column) -> Column:
    """Vectors that can be coded."""
    good = F.forall(
        vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(float("inf")))
    )
    return F.coalesce(good & (F.size(vector) > 0), F.lit(False))


def compress(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    *,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    trace: list | None = None,
) -> DataFrame:
    """`key`, `label`, `code` (two hex digits a part), `error`, `label_error` and the codebooks' hash.

    `trace` is given one row per round: list width, and how many parts were open, verified against
    their list, and against all entries.
    """
    columns = [F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector")]
    kept = vectors.select(*columns).filter(finite(F.col("vector")))
    order = [F.col("id").asc_nulls_last(), F.col("vector")]
    head = kept.orderBy(*order).limit(1).collect()
    schema = f"id {_type(vectors, key)}, label {_type(vectors, label)}"
    if not head:
        empty = vectors.sparkSession.createDataFrame([], f"{schema}, code string, error long")
        return _named(empty, key, label, "")
    length = len(head[0].vector)
    kept = kept.filter(F.size("vector") == length)
    reach = F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector"))).cast("double")
    largest = kept.agg(F.max(reach)).first()[0]
    wide = not -(-length // PARTS) * (2 * (largest * SCALE + 1)) ** 2 < EXACT
    whole = F.transform("vector", lambda v: F.floor(v.cast("double") * SCALE).cast("int"))
    cells = F.col("vector").cast("array<double>") if wide else whole
    state = settled(kept.select("id", "label", cells.alias("cells")), "cells")
    first = state.orderBy(F.col("id").asc_nulls_last(), "cells").limit(entries).select("cells").collect()
    start = _matrix(pa.array([r.cells for r in first], pa.list_(pa.float64() if wide else pa.int32())), wide)
    cuts = _cuts(length)
    books = [start[:, a:b] for a, b in zip(cuts, cuts[1:])]
    width, moves = 1 if wide else min(FIRST_LIST, len(start)), None
    kind = _type(state, "cells")
    counts = "n_open long, n_listed long, n_full long, depth long"
    for _ in range(rounds):
        schema_state = f"{schema}, cells {kind}, near binary, bounds binary, {counts}"
        state = settled(state.mapInArrow(_step(books, moves, width, wide), schema_state), "codes")
        after = _moved(state, books, wide)
        seen = state.agg(F.max("depth"), F.sum("n_open"), F.sum("n_listed"), F.sum("n_full")).first()
        if trace is not None:
            trace.append((width, *seen[1:]))
        if moves is not None and not wide:
            width = max(min(LEAST_LIST, width), min(width, seen[0]))
        moves, books = (None if wide else _steps(books, after)), after
    coded = state.mapInArrow(_final(books, moves, width, wide), f"{schema}, code string, error long")
    digits = ",".join(str(int(v)) for book in books for entry in book for v in entry)
    return _named(settled(coded, "coded"), key, label, hashlib.sha256(digits.encode()).hexdigest())


def _type(frame: DataFrame, column: str) -> str:
    return frame.schema[column].dataType.simpleString()


def _named(coded: DataFrame, key: str, label: str, digest: str) -> DataFrame:
    """With the error of each label, summed before the join, so that a hot label is one row there."""
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error")
    labels = coded.groupBy(F.col("label").alias("_label")).agg(total)
    joined = coded.join(labels, F.col("label").eqNullSafe(F.col("_label")), "left")
    return joined.select(
        F.col("id").alias(key),
        F.col("label").alias(label),
        "code",
        "error",
        "label_error",
        F.lit(digest).alias("codebooks_sha256"),
    )
