"""Product codes against the plain method on whole numbers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from __spark_entry__ import queries
from tillstream.llm import vectorcodes

KIND = "vec_id LONG, embedding ARRAY<DOUBLE>, label INT, code STRING, near INT, id INT"


def plain(rows, entries=256, rounds=4):
    """Lloyd rounds as stated, in Python's whole numbers. `rows`: (id, vector, label)."""
    good = [r for r in rows if r[1] and all(v is not None and math.isfinite(v) for v in r[1])]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not good:
        return []
    length = len(good[0][1])
    good = [r for r in good if len(r[1]) == length]
    cut = [k * length // 4 for k in range(5)]
    whole = [[int(math.floor(v * 1024)) for v in r[1]] for r in good]
    parts = [[w[cut[k] : cut[k + 1]] for w in whole] for k in range(4)]
    books = [p[:entries] for p in parts]

    # int64 where no square can reach its end, else Python's own whole numbers.
    kind = np.int64 if all(abs(v) < 2**24 for w in whole for v in w) else object

    def nearest(part, book):
        rows, entries_ = np.array(part, dtype=kind), np.array(book, dtype=kind)
        squares = np.array([((entries_ - row) ** 2).sum(1) for row in rows], dtype=kind)
        return [(int(line[j]), int(j)) for line, j in zip(squares, squares.argmin(1))]

    for _ in range(rounds):
        for k in range(4):
            found = nearest(parts[k], books[k])
            after = []
            for j, entry in enumerate(books[k]):
                mine = [x for x, (_, c) in zip(parts[k], found) if c == j]
                after.append([sum(c) // len(mine) for c in zip(*mine)] if mine else entry)
            books[k] = after
    found = [nearest(parts[k], books[k]) for k in range(4)]
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    errors = [sum(found[k][i][0] for k in range(4)) for i in range(len(good))]
    codes = ["".join(f"{found[k][i][1]:02x}" for k in range(4)) for i in range(len(good))]
    totals: dict = {}
    for r, e in zip(good, errors):
        totals[r[2]] = totals.get(r[2], 0) + e
    return [(r[0], c, e, totals[r[2]], digest) for r, c, e in zip(good, codes, errors)]


def coded(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], KIND)
    names = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return [tuple(r) for r in vectorcodes.compress(frame, **options).select(*names).collect()]


def same(left, right):
    assert sorted(left, key=repr) == sorted(right, key=repr)


@pytest.mark.parametrize("length", [8, 10, 64])
def test_codes_equal_the_plain_method(spark, length):
    rng = random.Random(length)
    centres = [[rng.gauss(0, 0.3) for _ in range(length)] for _ in range(40)]
    rows = [
        (i, [c + rng.gauss(0, 0.05) for c in rng.choice(centres)], rng.choice([None, 1, 1, 1, 2]))
        for i in range(900)
    ]
    rows += [(5000 + i, rows[3][1], 1) for i in range(300)]  # a third of all: copies
    trace: list = []
    same(coded(spark, rows, trace=trace), plain(rows))
    # Bounds spare work: after the first round not every part is compared with every entry.
    assert trace[0][3] == 4 * len(rows) and trace[-1][3] < 4 * len(rows) / 2


def test_small_codebooks_ties_and_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (7, [0.0, 1.0, 0.0, 1.0], 1), (3, [0.0, 0.0, 0.0, 0.0], None), (3, [0.0, 0.0, 0.0, 0.0], None),
        (None, [0.5, 0.5, 0.5, 0.5], 2), (1, [-0.0005, 0.0004, 1.0, -1.0], 2), (9, None, 1), (10, [], 1),
        (11, [1.0, None, 1.0, 1.0], 1), (12, [nan, 0.0, 0.0, 0.0], 1), (13, [inf, 0.0, 0.0, 0.0], 1),
        (14, [1.0, 1.0], 1), (8, [0.0, 2.0, 0.0, 2.0], 1),
    ]
    same(coded(spark, rows), plain(rows))
    assert len(coded(spark, rows)) == 6
    same(coded(spark, rows, entries=2), plain(rows, entries=2))


def test_empty_table(spark):
    assert coded(spark, []) == []
    assert coded(spark, [(1, None, 1)]) == []


def test_components_beyond_exact_doubles(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([1e30, -3e12, 1.5, 0.25]) * rng.random() for _ in range(8)], i % 3) for i in range(60)]
    got = {r[0]: r[1:] for r in coded(spark, rows, entries=16)}
    for key, code, error, _, digest in plain(rows, entries=16):
        assert got[key][0] == code and got[key][3] == digest
        assert got[key][1] == (error if error < 2**63 else None)


def test_query_equals_the_plain_method(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label")
    names = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    got = [tuple(r) for r in queries()["op11_vector_codes"](spark, folder).select(*names).collect()]
    same(got, plain([tuple(r) for r in table.collect()]))
