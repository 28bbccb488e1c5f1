"""Sequence packing: shortest-pack-first over the histogram of piece lengths.

1. Texts become token ids; a document longer than a sequence is cut into full pieces and a rest.
2. Only the histogram of piece lengths (at most `max_len` rows) goes to the driver. There lengths are
   placed longest first, each into the patterns with the most room left, many pieces at a time: the
   state is a count per packing pattern, never a list of pieces.
3. Each piece gets its rank among the pieces of its length. Every slot of a pattern owns a range of
   ranks, so a join on the length and that range gives the piece its sequence and offset.

Ranks are counted per (length, salt) and completed by the salts' totals, so that a length which many
pieces have is not numbered in one task.

Defined results: a null or empty text is one piece of the end id; documents repeated in all columns
are packed again; an empty table gives no rows. Other columns are not carried.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.common import partitions, pieces, settled
from tillstream.llm.tokens import encoder

MAX_LEN = 2048
# Slots of all patterns; their table is sent to every task only below this size.
BROADCAST_SLOTS = 200_000

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def token_pieces(
    docs: DataFrame, path: str, end_id: int, max_len: int = MAX_LEN, text: str = "text"
) -> DataFrame:
    """Pieces of at most `max_len` ids: doc_id, start, length, doc_tokens, ids (packed uint32)."""
    source = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("_text"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path)
        for batch in pieces(batches, "_text", 2 << 20):
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(tokens.ids(text), end_id).astype("<u4")
                for start in range(0, len(ids), max_len):
                    piece = ids[start : start + max_len]
                    rows.append((doc_id, start, len(piece), len(ids), piece.tobytes()))
            kinds = [pa.int64()] * 4 + [pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(
                arrays, ["doc_id", "start", "length", "doc_tokens", "ids"]
            )

    return source.mapInArrow(cut, PIECES)


def shortest_pack_first(histogram: Mapping[int, int], max_len: int) -> list[tuple[int, list[int]]]:
    """Patterns as (count, lengths in order) that hold every piece of the histogram.

    Lengths go longest first. Of the open patterns the one with the most room is the shortest pack;
    if a length does not fit there it fits nowhere, and new patterns are opened for the pieces left.
    """
    room: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)
    done: list[tuple[int, list[int]]] = []
    most = 0  # no pattern has more room than this

    def put(count: int, pattern: list[int], left: int) -> None:
        nonlocal most
        if left:
            room[left].append((count, pattern))
            most = max(most, left)
        else:
            done.append((count, pattern))

    for length in sorted(histogram, reverse=True):
        waiting = histogram[length]
        while waiting:
            while most and not room.get(most):
                room.pop(most, None)
                most -= 1
            if most < length:
                # One at a time, each new pattern would be filled before the next is opened.
                each = max_len // length
                for times, size in ((waiting // each, each), (1, waiting % each)):
                    if times and size:
                        put(times, [length] * size, max_len - size * length)
                break
            count, pattern = room[most].pop()
            used = min(count, waiting)
            if count > used:
                room[most].append((count - used, pattern))
            waiting -= used
            put(used, [*pattern, length], most - length)
    return done + [item for open_ in room.values() for item in open_]


def slots(patterns: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset) of each slot of each pattern."""
    taken: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            first = taken[length]
            taken[length] = first + count
            rows.append((length, first, first + count, sequence, offset))
            offset += length
        sequence += count
    return rows


def ranked(frame: DataFrame, group: str, order: list[str], rank: str = "rank") -> DataFrame:
    """Rank from 0 within `group`, counted by salts of the rows and the salts' totals."""
    salts = 4 * partitions(frame.sparkSession)
    salted = frame.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    totals = salted.groupBy(group, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(
        group, "_salt", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base")
    )
    within = Window.partitionBy(group, "_salt").orderBy(*order)
    local = salted.withColumn("_local", F.row_number().over(within) - 1)
    return (
        local.join(base, [group, "_salt"])
        .withColumn(rank, F.col("_base") + F.col("_local"))
        .drop("_salt", "_base", "_local")
    )


def pack(parts: DataFrame, order: list[str], max_len: int = MAX_LEN) -> DataFrame:
    """Give each row of `parts` (with its `length`) a `sequence_id` and an `offset`.

    `parts` is read twice, so it should be a written table. `order` names columns that tell its rows
    apart; rows equal in all of them are interchangeable.
    """
    spark = parts.sparkSession
    counts = parts.groupBy("length").count().collect()  # at most max_len rows
    histogram = {int(r["length"]): int(r["count"]) for r in counts}
    rows = slots(shortest_pack_first(histogram, max_len))
    schema = "length long, first long, end long, sequence long, offset long"
    table = spark.createDataFrame(rows, schema)
    if len(rows) <= BROADCAST_SLOTS:
        table = F.broadcast(table)
    numbered = ranked(parts.drop("sequence_id", "offset"), "length", order)
    inside = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end"))
    return (
        numbered.alias("p")
        .join(table.alias("s"), (F.col("p.length") == F.col("s.length")) & inside)
        .select(
            "p.*", (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset"
        )
        .drop("rank")
    )


def pack_documents(
    docs: DataFrame, path: str, end_id: int, max_len: int = MAX_LEN, keep_ids: bool = True
) -> DataFrame:
    """Pieces of all documents with their place: doc_id, start, length, doc_tokens, ids_crc32,
    sequence_id, offset, and the ids themselves unless `keep_ids` is false."""
    parts = token_pieces(docs, path, end_id, max_len).withColumn("ids_crc32", F.crc32("ids"))
    parts = settled(parts if keep_ids else parts.drop("ids"), "pieces")
    return pack(parts, ["doc_id", "start", "ids_crc32"], max_len)
