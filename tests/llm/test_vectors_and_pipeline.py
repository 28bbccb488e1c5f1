"""Vectors against all pairs, the registered queries and the pipeline."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tests.compare import difference, duck, duck_rows, spark_rows
from tillstream.llm import hnsw, mixing

from .conftest import shingles, texts_of
from .test_text_operators import brute_spans

VECTORS = "vec_id LONG, embedding ARRAY<FLOAT>, label INT"


def brute_links(rows: list[tuple]) -> dict:
    good = {i: np.array(v, float) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    out, parent = {i: 0 for i, _ in rows}, {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(good)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            u, v = good[a], good[b]
            if len(u) == len(v) and u @ v / np.sqrt((u @ u) * (v @ v)) >= 0.95:
                out[a] += 1
                out[b] += 1
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (out[i], find(i), find(i) == i) for i in out}


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 16))
    rows = []
    for k in range(400):
        centre = centres[0 if k % 3 == 0 else k % 12]
        noise = rng.choice([0.02, 0.12, 0.6])
        rows.append((k, (centre + rng.normal(size=16) * noise).astype(np.float32).tolist()))
    rows += [(400, rows[0][1]), (401, rows[0][1]), (402, [2 * x for x in rows[1][1]])]
    rows += [(500, None), (501, []), (502, [0.0] * 16), (503, [float("nan")] * 16), (504, [None] * 16)]
    rows += [(505, [float("inf")] + [1.0] * 15), (506, [1.0, 2.0]), (507, [2.0, 4.0])]
    docs = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in hnsw.near_duplicates(docs).collect()}
    expected = brute_links(rows)
    links = sum(e[0] for e in expected.values())
    assert set(got) == set(expected)
    assert sum(min(g[0], expected[i][0]) for i, g in got.items()) >= 0.99 * links
    assert all(g[0] <= expected[i][0] for i, g in got.items())
    assert np.mean([got[i] == e for i, e in expected.items()]) > 0.98
    for i in range(500, 506):
        assert got[i] == (0, i, True)


def test_no_vectors_and_repeated_rows(spark):
    assert hnsw.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [1.0, 0.0], None), (None, None, None)]
    got = hnsw.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
    assert sorted((r.vec_id or 0, r.n_links) for r in got) == [(0, 0), (0, 2), (1, 2), (1, 2)]


def test_shards_follow_cores_and_of_two_shards_one_asks_the_other(spark):
    assert [hnsw.shard_count(n, 8) for n in (0, 5000, 8 * hnsw.SHARD, 8 * hnsw.SHARD + 1)] == [8, 8, 8, 9]
    for shards in (1, 2, 5, 6):
        asked = spark.range(shards).select("id", F.explode(hnsw.asked_shards(F.col("id"), shards)).alias("other"))
        pairs = sorted(tuple(sorted(r)) for r in asked.collect())
        assert pairs == [(a, b) for a in range(shards) for b in range(a + 1, shards)]


def test_what_another_shard_asks_counts_for_both():
    shard = hnsw._Shard(np.array([1, 2]), np.array([1, 3]), np.array([[1.0, 0.0], [0.0, 1.0]]), 0.95)
    ids, counts, edges = shard.answer(np.array([7, 8]), np.array([[5.0, 0.1], [1.0, 1.0]]), 0.95, np.array([2, 4]))
    assert sorted(zip(ids.tolist(), counts.tolist())) == [(1, 2), (7, 1)]
    assert edges == [(7, 1)]


def test_recall_of_a_graph():
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(3000, 32)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    graph = hnsw.Graph(vectors)
    assert hnsw.FIRST_BEAM <= graph.audited_beam(0.95) <= 64
    queries_ = vectors[rng.integers(0, 3000, 100)]
    exact = hnsw._top(queries_ @ vectors.T, 10)
    ids, _ = graph.search(queries_, 96)
    assert np.mean([np.isin(a, b).mean() for a, b in zip(exact, ids)]) >= 0.9


def test_audited_beam_finds_nearest_and_outside_links():
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(3000, 32)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    graph = hnsw.Graph(vectors)
    beam = graph.audited_beam(0.95)
    queries_ = vectors[rng.integers(0, 3000, 100)]
    exact = hnsw._top(queries_ @ vectors.T, 10)
    ids, _ = graph.search(queries_, beam)
    assert np.mean([np.isin(a, b).mean() for a, b in zip(exact, ids)]) >= 0.9
    outside = vectors[1::10] + rng.normal(size=(300, 32)).astype(np.float32) * 0.05
    outside /= np.linalg.norm(outside, axis=1)[:, None]
    wanted = outside @ vectors.T >= 0.95
    found = np.zeros_like(wanted)
    for rows, nodes in graph.within(outside, 0.95 - 1e-5, beam):
        found[rows, nodes] = True
    assert wanted.sum() > 100 and (found & wanted).sum() >= 0.99 * wanted.sum()


def test_audit_does_not_count_a_node_as_its_own_link(monkeypatch):
    """A search that finds nothing but the queried node below a beam of 96: all links are missed."""
    rng = np.random.default_rng(10)
    vectors = rng.normal(size=(2000, 32)).astype(np.float32)
    vectors[1000] = vectors[0] + 0.05 * rng.normal(size=32)
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    graph = hnsw.Graph(vectors)
    whole = graph.within

    def only_itself(queries_, least, beam):
        for rows, nodes in whole(queries_, least, beam):
            same = np.einsum("nd,nd->n", queries_[rows], vectors[nodes]) > 0.9999
            keep = same if beam < 96 else np.ones(len(rows), bool)
            yield rows[keep], nodes[keep]

    monkeypatch.setattr(graph, "within", only_itself)
    assert graph.audited_beam(0.95) >= 96


@pytest.mark.parametrize("name", [n for n in oracle_sql() if n.startswith("op")])
def test_queries_equal_their_sql(spark, folder, name):
    rows = spark_rows(queries()[name](spark, folder))
    assert not difference(rows, duck_rows(duck(folder), oracle_sql()[name]))


def test_stages(spark, folder, odd_docs, no_docs):
    """Each stage on its own input: columns kept, decisions visible, nothing else lost."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(150)
    for given in (docs, odd_docs):
        given = given.select(*corpus_pipeline.COLUMNS)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, given, folder)
            assert sorted(out.columns) == sorted(corpus_pipeline.COLUMNS), name
    named = corpus_pipeline.language_id(spark, docs, folder)
    assert named.count() == docs.filter("text rlike '\\\\p{L}'").count()
    alone = texts_of(corpus_pipeline.near_copies(spark, docs, folder))
    before = texts_of(docs)
    kept = [shingles(t) for _, t in alone]
    for k, a in enumerate(kept):
        assert all(100 * len(a & b) < 75 * len(a | b) for b in kept[k + 1 :] if a and b)
    for _, text in before:
        s = shingles(text)
        assert not s or any(100 * len(s & k) >= 50 * len(s | k) for k in kept)
    masked = corpus_pipeline.secret_scan(spark, docs, folder)
    clean = {i: t for i, t in before if not brute_spans(t)}
    after = dict(texts_of(masked))
    assert all(after[i] == t for i, t in clean.items()) and len(after) == len(before)
    assert all("[SECRET]" in after[i] for i, t in before if brute_spans(t))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs.select(*corpus_pipeline.COLUMNS), folder).count() == 0


def test_pipeline(spark, folder):
    packed = corpus_pipeline.run(spark, folder).collect()
    assert packed and max(r.offset + r.length for r in packed) <= 2048


def test_near_copies_go_by_row_not_by_id(spark):
    """One id on two texts: each text is judged on its own, and one text of each group stays."""
    def words(first, last):
        return " ".join(f"w{k}" for k in range(first, last))

    rows = [
        (1, words(0, 60), "x", "s", 1),
        (2, words(0, 61), "x", "s", 1),  # near copy of 1
        (2, words(900, 960), "x", "s", 1),  # alone, under the same id
        (3, words(500, 560), "x", "s", 1),
        (3, words(500, 561), "x", "s", 1),  # both texts of 3 are copies of each other
        (4, words(700, 760), "x", "s", 1),
        (4, words(700, 760), "x", "t", 1),  # same id and text, other source
        (5, "", "x", "s", 0),
        (None, words(0, 60), "x", "s", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")
    got = corpus_pipeline.near_copies(spark, docs, "").collect()
    left = sorted((r.doc_id or 0, r.text) for r in got if r.doc_id != 3)
    assert left == sorted(
        [(0, words(0, 60)), (1, words(0, 60)), (2, words(900, 960)), (4, words(700, 760)), (5, "")]
    )
    assert [r.doc_id for r in got].count(3) == 1
    assert {r.source for r in got if r.doc_id == 4} == {"s"}


def test_rows_without_an_id_are_drawn_each_on_its_own(spark):
    rows = [(None, f"text {k} of some words", "x", "s", 1) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")
    drawn = mixing.mix(mixing.labelled(docs), fraction=0.5).count()
    assert 120 < drawn < 280
