"""The source audit against plain Python, cube cells against whole matrices."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from tillstream.llm import divergence

from .conftest import multiset


def brute(rows, least_docs=30, top=50):
    """`rows`: (text, lang, source)."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in ((t or "", g or "", s or "") for t, g, s in rows):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups[lang].add(source)
        counts[lang, source].update(words)
        counts[lang, None].update(words)
        docs[lang].update(set(words))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        p = {}
        for s in (*sources, None):
            total = sum(counts[lang, s][t] for t in kept)
            p[s] = {t: 1 + 10**9 * (counts[lang, s][t] + 5) // (total + 5 * len(kept)) for t in kept}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            over = [(p[s][t] - p[None][t], t) for t in kept if counts[lang, s][t] and p[s][t] > p[None][t]]
            for part, items, most in (("pair", pairs, None), ("term", over, top)):
                items.sort(key=lambda i: (-i[0], i[1].encode()))
                out += [(lang, s, part, i, v, r) for r, (v, i) in enumerate(items[:most], 1)]
    return out


COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def audited(docs, **options):
    return [tuple(r) for r in divergence.audit(docs, **options).select(*COLUMNS).collect()]


def test_odd_documents(odd_docs, no_docs):
    rows = [(r.text, r.lang, r.source) for r in odd_docs.select("text", "lang", "source").collect()]
    for least in (1, 2, 30):
        assert multiset(audited(odd_docs, least_docs=least)) == multiset(brute(rows, least))
    assert audited(no_docs) == []


@pytest.mark.parametrize("blocks", [(2, 7), (3, 1000), (32, 8192)])
def test_many_sources_in_blocks(spark, monkeypatch, blocks):
    """A third of all rows from one source, many sources, a flush of the counters after every few texts."""
    monkeypatch.setattr(divergence, "SOURCE_BLOCK", blocks[0])
    monkeypatch.setattr(divergence, "TERM_BLOCK", blocks[1])
    rng = random.Random(7)
    words = ["über", "the", "Ünder", "a", "日本", "ZEBRA", "zebra", "x\x00y", "é"] + [f"w{chr(97 + k)}" for k in range(20)]
    rows = []
    for k in range(300):
        source = "hot" if k % 3 == 0 else f"s{k % 11}"
        text = rng.choice([" ", "-", "1"]).join(rng.choice(words[: 5 + k % 24]) for _ in range(rng.randint(0, 30)))
        rows.append((text or None, rng.choice(["en", "en", "de", None]), rng.choice([source, source, None])))
    rows += [(None, "xx", "only")] + [("", "yy", s) for s in "ab"]
    docs = spark.createDataFrame(rows, "text STRING, lang STRING, source STRING").repartition(3)
    assert multiset(audited(docs, least_docs=3, top=4)) == multiset(brute(rows, 3, 4))


def test_counters_are_handed_on(spark, monkeypatch):
    whole = [("a b c d e f g h", "en", str(k % 3)) for k in range(40)]
    frame = spark.createDataFrame(whole, "text STRING, lang STRING, source STRING").coalesce(1)
    batch = pa.RecordBatch.from_pylist([{"lang": g, "source": s, "text": t} for t, g, s in whole])
    monkeypatch.setattr(divergence, "HELD", 10)
    parts = list(divergence._counted([batch]))
    assert len(parts) > 3 and sum(sum(p.column("n").to_pylist()) for p in parts) == 40 * 8
    assert multiset(audited(frame, least_docs=1)) == multiset(brute(whole, 1))
