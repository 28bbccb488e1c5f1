"""Source divergence audit: how far the term rates of a language's sources lie apart.

Terms are counted per language and source, first inside the tasks. A language keeps the terms that enough
of its documents hold. Each group - a source of a language, or the whole language - gives each kept term a
smoothed rate in whole billionths; the divergence of two groups is the sum of the absolute differences.

Pairs of sources come from a three-dimensional cube: sources are cut into blocks, and so are terms. A cell
(source block, source block, term block) is a task's work: it holds the slices of both source blocks for
that term block - a slice is replicated once per source block it is compared with - as two small dense
matrices, and gives each pair's partial divergence. The partials are summed along the term axis. Terms
that neither source block holds all have the same difference; they are added at the end by their number.
A cell's size is bounded by the block sizes in expectation, as blocks are dealt by hash, however many
sources, terms or rows there are, and no pair is met in two cells of a term block.

Defined results: null texts, languages and sources count as ''. A group without terms still has a row for
each other source; a language of one source has no pairs. Repeated rows count each time; ties in a ranking
go by the item's UTF-8 bytes. An empty table gives no rows. Other columns are left out. All arithmetic is
on whole numbers (Python's or DECIMAL(38) where 64 bits could not do).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.common import ARROW, pieces, settled
from tillstream.session import conf_override

LEAST_DOCS = 30
TOP_TERMS = 50
SMOOTHING = 5
BILLION = 1_000_000_000
# Sources and terms of a block, about.
SOURCE_BLOCK, TERM_BLOCK = 32, 8192
# Distinct (group, term) counts that a task holds before it hands them on.
HELD = 200_000

# Lower case for A-Z, blanks for every other byte below 128: what is left between blanks is a term.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """Runs of A-Z, a-z and anything beyond ASCII, A-Z lowered."""
    return text.translate(_FOLD).split()


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of a task; a null term marks a group that was seen."""
    found: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in found.items():
            size = len(n)
            named = [w.decode() for w in n]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * (size + 1), pa.string()),
                    pa.array([source] * (size + 1), pa.string()),
                    pa.array([*named, None], pa.string()),
                    pa.array([*n.values(), 0], pa.int64()),
                    pa.array([*(docs[w] for w in n), 0], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )

    for batch in pieces(batches, "text"):
        groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for group, text in zip(groups, texts):
            n, docs = found.setdefault(group, (Counter(), Counter()))
            words = terms(text)
            held -= len(n)
            n.update(words)
            docs.update(set(words))
            held += len(n)
            if held > HELD:
                yield from rows()
                found.clear()
                held = 0
    yield from rows()


def term_counts(docs: DataFrame) -> DataFrame:
    """`n` occurrences and `docs` documents of each (lang, source, term); null terms mark the groups."""
    named = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    schema = "lang string, source string, term string, n long, docs long"
    counted = named.mapInArrow(_counted, schema).groupBy("lang", "source", "term")
    return settled(counted.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "terms")


def _rate(n: Column, total: Column, kept: Column) -> Column:
    """Smoothed rate in billionths, plus one; DECIMAL holds the product."""
    wide = (n + SMOOTHING).cast("decimal(19,0)") * F.lit(BILLION).cast("decimal(10,0)")
    rate = F.call_function("div", wide, (total + SMOOTHING * kept).cast("decimal(19,0)"))
    return F.when(kept > 0, rate + 1).cast("long")


def _block(column: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(column), blocks).cast("int")


def _cell(left: pd.DataFrame) -> pd.DataFrame:
    """Partial divergences of all source pairs of a cell.

    Rows without a term give a source and its rate for terms it lacks; the others give its rates.
    """
    heads = left[left["term"].isna()]
    names = heads.drop_duplicates(["side", "source"]).reset_index(drop=True)
    place = {key: k for k, key in enumerate(zip(names["side"], names["source"]))}
    base = names["rate"].to_numpy(np.int64)
    held = left[left["term"].notna()]
    columns, uniques = pd.factorize(held["term"])
    rates = np.repeat(base[:, None], len(uniques), 1)
    at = [place[key] for key in zip(held["side"], held["source"])]
    rates[at, columns] = held["rate"].to_numpy(np.int64)
    first, second = (np.flatnonzero(names["side"] == side) for side in (0, 1))
    diagonal = left["a"].iloc[0] == left["b"].iloc[0]
    second = first if diagonal else second
    sources = names["source"].to_numpy()
    out = []
    for k, row in enumerate(first):
        others = second[k + 1 :] if diagonal else second
        for other, part in zip(others, np.abs(rates[others] - rates[row]).sum(1)):
            gap = int(abs(base[other] - base[row]))
            out.append((names["lang"].iloc[0], sources[row], sources[other], int(part), len(uniques), gap))
    return pd.DataFrame(out, columns=["lang", "source", "item", "part", "seen", "gap"])


_PARTIAL = "lang string, source string, item string, part long, seen long, gap long"


def pair_divergences(heads: DataFrame, rates: DataFrame) -> DataFrame:
    """`lang, source, item, value` for both directions of every two sources of a language.

    `heads` has `lang, source, rate` (of a term that the source lacks), `kept` (terms of the language)
    and `sources` (of the language); `rates` the rates of what the sources hold.
    """
    blocks = F.ceil(F.col("sources") / SOURCE_BLOCK)
    slices = F.greatest(F.ceil(F.col("kept") / TERM_BLOCK), F.lit(1))
    sized = heads.withColumns({"blocks": blocks, "slices": slices})
    placed = sized.withColumn("block", _block("source", F.col("blocks")))
    shape = placed.select("lang", "source", "block", "blocks", "slices")
    # A source is in one block; its slice goes to the cells of that block with every block: as the
    # first side with blocks from its own on, as the second with blocks before.
    mine = F.col("block")
    cells = F.transform(
        F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")),
        lambda other: F.struct(
            F.least(mine, other).alias("a"),
            F.greatest(mine, other).alias("b"),
            F.when(mine <= other, 0).otherwise(1).alias("side"),
        ),
    )
    term_slice = F.explode(F.sequence(F.lit(0), (F.col("slices") - 1).cast("int"))).alias("k")
    marks = placed.select("*", term_slice).withColumn("term", F.lit(None).cast("string"))
    held = rates.join(shape, ["lang", "source"]).withColumn("k", _block("term", F.col("slices")))
    columns = ["lang", "source", "k", "term", "rate", F.inline(cells)]
    rows = marks.select(*columns).unionByName(held.select(*columns))
    with conf_override(heads.sparkSession, ARROW):
        partial = rows.groupBy("lang", "a", "b", "k").applyInPandas(_cell, _PARTIAL)
        summed = settled(
            partial.groupBy("lang", "source", "item").agg(
                F.sum("part").alias("part"), F.sum("seen").alias("seen"), F.max("gap").alias("gap")
            ),
            "pairs",
        )
    kept = heads.select("lang", "kept").distinct()
    rest = (F.col("kept") - F.col("seen")) * F.col("gap")
    value = F.when(F.col("kept") > 0, F.col("part") + rest).otherwise(F.lit(0)).cast("long")
    one_way = summed.join(kept, "lang").select("lang", "source", "item", value.alias("value"))
    other_way = one_way.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    return one_way.unionByName(other_way)


def audit(docs: DataFrame, *, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """`lang, source, part, item, value, rank`: all other sources, and the terms used most in excess."""
    counts = term_counts(docs)
    terms_only = counts.filter(F.col("term").isNotNull())
    kept_terms = settled(
        terms_only.groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
        .filter(F.col("docs") >= least_docs)
        .select("lang", "term", "lang_n"),
        "kept-terms",
    )
    langs = kept_terms.groupBy("lang").agg(
        F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total")
    )
    used = settled(terms_only.join(kept_terms, ["lang", "term"]).drop("docs"), "used-terms")
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    seen = counts.select("lang", "source").distinct()
    number = seen.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    none = F.lit(0).cast("long")
    groups = settled(
        seen.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").join(number, "lang")
        .select(
            "lang", "source", "sources",
            *(F.coalesce(c, none).alias(c) for c in ("total", "kept", "lang_total")),
        ),
        "groups",
    )
    rated = used.join(groups, ["lang", "source"]).select(
        "lang", "source", "term",
        _rate(F.col("n"), F.col("total"), F.col("kept")).alias("rate"),
        _rate(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("lang_rate"),
    )
    lacking = F.coalesce(_rate(none, F.col("total"), F.col("kept")), none)
    heads = groups.select("lang", "source", "kept", "sources", lacking.alias("rate"))
    pairs = pair_divergences(heads, rated.select("lang", "source", "term", "rate"))
    excess = rated.filter(F.col("rate") > F.col("lang_rate")).select(
        "lang", "source", F.col("term").alias("item"), (F.col("rate") - F.col("lang_rate")).alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    ranked = excess.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumns({"rank": F.row_number().over(order), "part": F.lit("pair")}).select(*columns)
        .unionByName(ranked.withColumn("part", F.lit("term")).select(*columns))
    )


# The SQL names the same bounds as the contract of the audit.
SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
word AS (SELECT row, lang, source,
    unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM word GROUP BY lang, term HAVING count(DISTINCT row) >= {LEAST_DOCS}),
lang AS (SELECT lang, count(*) AS v, CAST(sum(n) AS HUGEINT) AS total FROM kept GROUP BY lang),
used AS (SELECT lang, source, term, count(*) AS n FROM word JOIN kept USING (lang, term) GROUP BY lang, source, term),
grp AS (SELECT d.lang, d.source, coalesce(max(u.total), 0) AS total
    FROM (SELECT DISTINCT lang, source FROM docs) d
    LEFT JOIN (SELECT lang, source, CAST(sum(n) AS HUGEINT) AS total FROM used GROUP BY lang, source) u
      ON u.lang = d.lang AND u.source = d.source GROUP BY d.lang, d.source),
rate AS (SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n,
    1 + {BILLION}::HUGEINT * (coalesce(u.n, 0) + {SMOOTHING}) // (g.total + {SMOOTHING} * l.v) AS p,
    1 + {BILLION}::HUGEINT * (k.n + {SMOOTHING}) // (l.total + {SMOOTHING} * l.v) AS q
  FROM grp g JOIN kept k ON k.lang = g.lang JOIN lang l ON l.lang = g.lang
    LEFT JOIN used u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(max(f.value), 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
      FROM rate x JOIN rate y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
      GROUP BY x.lang, x.source, y.source) f
    ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  GROUP BY a.lang, a.source, b.source),
both_parts AS (
  SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value FROM pair
  UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM rate WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (
    PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM both_parts)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
