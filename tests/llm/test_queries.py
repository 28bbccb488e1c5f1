"""Registered queries without SQL, all their columns against brute force on one small folder of tables."""

from __future__ import annotations

import hashlib
import zlib
from functools import cache

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from __spark_entry__ import queries
from tillstream.llm.queries import BYTE_BPE, WORD_BPE

from .conftest import DOCS, crc, multiset, texts_of
from .test_text_operators import brute_components, brute_repeats, near_copies


@pytest.fixture(scope="module")
def tables(spark, odd_docs, tmp_path_factory):
    """The odd documents, near copies, and texts that share a passage of more than 400 bytes."""
    passage = " ".join(f"shared{k}" for k in range(80))
    texts = [(100 + i, t) for i, t in near_copies(4)]
    texts += [(900, "before " + passage), (901, passage + " after"), (902, "é" * 300)]
    rows = [(i, t, ("en", "fr", None)[i % 3], f"s{i % 2}", len(t), "x") for i, t in texts]
    more = spark.createDataFrame(rows, DOCS)
    path = tmp_path_factory.mktemp("tables")
    docs = odd_docs.select(*more.columns).unionByName(more)
    docs.coalesce(3).write.parquet(f"{path}/documents.parquet")
    return str(path)


def _texts(spark, tables):
    return texts_of(spark.read.parquet(f"{tables}/documents.parquet"))


def _run(spark, tables, name):
    return queries()[name](spark, tables).collect()


@cache
def _library(file):
    return Tokenizer.from_file(public_tokenizers.path(file))


def _ids(file, text, end):
    return [*_library(file).encode(text, add_special_tokens=False).ids, *end]


def _ascending(texts):
    return sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode()))


def test_op1(spark, tables):
    texts = _texts(spark, tables)
    expected = [(i, _ids(WORD_BPE, t, [1])) for i, t in texts]
    rows = _run(spark, tables, "op1_packing")
    assert sum(r.length for r in rows) == sum(len(ids) for _, ids in expected)
    pieces, places = {}, {}
    for r in rows:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    copies = multiset((i, len(ids)) for i, ids in expected)
    for i, ids in expected:
        parts = pieces[(i, len(ids))]
        assert all(crc(ids[r.start : r.start + r.length]) == r.ids_crc32 for r in parts)
        covered = sorted(k for r in parts for k in range(r.start, r.start + r.length))
        assert covered == sorted(list(range(len(ids))) * copies[(i, len(ids))])
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_op5(spark, tables):
    start, expected = 0, []
    for i, text in _ascending(_texts(spark, tables)):
        ids = _ids(BYTE_BPE, text, [0])
        expected.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    rows = _run(spark, tables, "op5_token_files")
    assert multiset((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == multiset(expected)


def test_op10(spark, tables):
    expected = []
    for i, text in _texts(spark, tables):
        n = len(_ids(BYTE_BPE, text, []))
        expected.append((i, len(text.encode()), n, n > 1024))
    rows = _run(spark, tables, "op10_token_counts")
    assert multiset((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == multiset(expected)
    assert any(r.over_limit for r in rows)


def test_op9(spark, tables):
    rows = _run(spark, tables, "op9_repeated_bytes")
    got = multiset((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)
    assert got == multiset(brute_repeats(_texts(spark, tables)))
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[900].kept_text, by_id[901].kept_text) == ("before ", " after")
    for r in rows:
        if "�" not in r.kept_text:
            assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256


def test_op4(spark, tables):
    texts = _texts(spark, tables)
    expected = brute_components(texts)
    rows = _run(spark, tables, "op4_ngram_join")
    assert len(rows) == len(texts)
    for r in rows:
        assert r.doc_id is None or (r.n_shingles, r.component_id) == expected[r.doc_id]


def test_op6(spark, tables):
    texts = _texts(spark, tables)
    order = _ascending(texts)
    rows = _run(spark, tables, "op6_imatch")
    expected = []
    for k, (i, text) in enumerate(order):
        half = len(text) // 2
        edited = text[: len(text) - half] + order[(k + 1) % len(order)][1][:half]
        expected.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert multiset((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == multiset(expected)
    prints = {}
    known = {(i, len(t)): t for i, t in texts}
    for r in rows:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        text = known[(r.doc_id, r.n_chars)]
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        if hashlib.sha256(text.encode()).hexdigest() == r.edited_sha256:
            assert r.edited_fingerprint == r.fingerprint and r.near_edited == 1


def test_op3(spark, tables):
    texts = _texts(spark, tables)
    rows = _run(spark, tables, "op3_language_id")
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 3 == 1 for i, _ in texts}
    assert multiset((r.doc_id, r.held_out) for r in rows) == multiset((i, held[i]) for i, _ in texts)
    letters = {i for i, t in texts if any(c.isalpha() for c in t)}
    for r in rows:
        assert r.lang_pred in ("en", "fr") if r.doc_id in letters else r.lang_pred == "und"
        assert 0 <= r.score <= 1
