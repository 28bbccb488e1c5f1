"""Tokenizing operators against the tokenizers library."""

from __future__ import annotations

import gc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tillstream.llm import packing, tokencount, tokenfile, tokens

from .conftest import crc, multiset, texts_of

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("path", [BYTE, WORD])
@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.sampled_from(list(" \t\n\x1c\x85\xa0 aAbé'sİΣ1½.,!<|>日́")) | st.characters(codec="utf-8"), max_size=40))
def test_chunked_ids_are_the_librarys(path, text):
    encoder = tokens.encoder(path)
    expected = encoder.library.encode(text, add_special_tokens=False).ids
    assert encoder.ids(text).tolist() == expected
    if path == BYTE:
        assert tokencount.merges(path).count(text) == len(expected)


def test_long_words_take_little_time():
    text = "ab" * 50_000
    assert tokencount.merges(BYTE).count(text) == len(tokens.encoder(BYTE).library.encode(text).ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 60_000) | st.just(0), max_size=700))
def test_words_round_trip(values):
    values = np.array(values, np.uint64)
    words, offsets = tokenfile.pack(values)
    assert np.array_equal(tokenfile.unpack(words, offsets, len(values)), values)


def test_files_give_back_every_document(spark, odd_docs, no_docs, tmp_path):
    library = Tokenizer.from_file(BYTE)
    tokenfile.write(odd_docs, BYTE, 0, str(tmp_path / "a"))
    got = sorted(tokenfile.read(spark, str(tmp_path / "a")).collect(), key=lambda r: r.start)
    order = sorted(texts_of(odd_docs), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode()))
    start = 0
    for row, (doc_id, text) in zip(got, order, strict=True):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        read = np.frombuffer(bytes(row.ids), "<u4").tolist()
        assert (row.doc_id, row.start, row.n_tokens, read) == (doc_id, start, len(ids), ids)
        start += len(ids)
    tokenfile.write(no_docs, BYTE, 0, str(tmp_path / "b"))
    assert tokenfile.read(spark, str(tmp_path / "b")).count() == 0


def test_reading_lets_go_of_what_it_read(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"word {k} " * 20) for k in range(3000)], "doc_id LONG, text STRING")
    tokenfile.write(docs, BYTE, 0, str(tmp_path / "a"))

    def views(batches):
        list(batches)
        held = sum(o.nbytes for o in gc.get_objects() if isinstance(o, memoryview))
        yield pa.RecordBatch.from_arrays([pa.array([held])], ["held"])

    def held():
        """Bytes that the workers keep alive by views."""
        counted = spark.range(64, numPartitions=8).mapInArrow(views, "held LONG")
        return max(r.held for r in counted.collect())

    before = held()
    read = tokenfile.read(spark, str(tmp_path / "a"))
    ids = sum(r.n for r in read.selectExpr("length(ids) AS n").collect())
    assert ids > 500_000 and held() <= before + 10_000


def test_counts(odd_docs, no_docs):
    library = Tokenizer.from_file(BYTE)
    got = tokencount.count_tokens(odd_docs, BYTE)
    assert "extra" in got.columns and got.columns.count("n_bytes") == 1
    expected = [
        (i, len(t.encode()), len(library.encode(t, add_special_tokens=False).ids))
        for i, t in texts_of(odd_docs)
    ]
    assert multiset(got.select("doc_id", "n_bytes", "n_tokens").collect()) == multiset(expected)
    assert tokencount.count_tokens(no_docs, BYTE).count() == 0


def _check_packing(rows, expected_ids, max_len):
    pieces, places = {}, {}
    for r in rows:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= max_len
    for doc_id, ids in expected_ids:
        parts = pieces[(doc_id, len(ids))]
        for start, length, check in parts:
            assert crc(ids[start : start + length]) == check
        assert sum(p[1] for p in parts) % len(ids) == 0
    return places


def test_packing(odd_docs, no_docs):
    library = Tokenizer.from_file(WORD)
    expected = [(i, [*library.encode(t, add_special_tokens=False).ids, 1]) for i, t in texts_of(odd_docs)]
    rows = packing.pack_documents(odd_docs, WORD, 1, max_len=256).collect()
    assert sum(r.length for r in rows) == sum(len(ids) for _, ids in expected)
    _check_packing(rows, expected, 256)
    assert packing.pack_documents(no_docs, WORD, 1).count() == 0


def test_packing_of_many_is_tight(spark):
    rng = np.random.default_rng(3)
    lengths = np.r_[np.minimum(rng.geometric(1 / 300, 3000), 2048), np.full(1500, 700)]
    parts = spark.createDataFrame([(k, int(n)) for k, n in enumerate(lengths)], "doc_id LONG, length LONG")
    rows = packing.pack(parts, ["doc_id"]).collect()
    assert len(rows) == len(lengths)
    filled: dict = {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for inside in filled.values():
        assert sorted(inside)[0][0] == 0 and sum(n for _, n in inside) <= 2048
    assert lengths.sum() > 0.93 * 2048 * len(filled)


def test_frequent_words_outlive_a_full_cache(monkeypatch):
    """A small cache: ids stay those of the library, and what each text repeats is never dropped."""
    monkeypatch.setattr(tokens, "CACHED_BYTES", 20_000)
    encoder = tokens.Encoder(BYTE)
    for k in range(200):
        text = "the sea" + "".join(f" w{chr(97 + k % 26)}{chr(97 + j)}q{'x' * (k // 26)}" for j in range(20))
        expected = encoder.library.encode(text, add_special_tokens=False).ids
        assert encoder.ids(text).tolist() == expected
        assert encoder._known(" sea") is not None
        held = [*encoder.cache.items(), *encoder._older.items()]
        assert sum(len(p) + len(i) + 152 for p, i in held) <= 20_000


def test_words_are_held_once():
    encoder = tokens.Encoder(WORD)
    text = "the sea, The Sea thé Seaside. sea, thé! o'er"
    assert encoder.ids(text).tolist() == encoder.library.encode(text, add_special_tokens=False).ids
    held = sum(len(p) + len(i) + tokens._ENTRY_BYTES for p, i in encoder.cache.items())
    assert encoder._held == held


def test_a_worker_keeps_room_for_others():
    """Two or three workers of an executor share what Spark's heap leaves: about 900 MB of 3000."""
    assert tokens.CACHED_BYTES <= 160 << 20
