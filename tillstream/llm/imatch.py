"""I-Match document fingerprints with randomised lexicons.

The lexicon holds the terms whose share of documents lies in a band, that is, whose inverse document
frequency does. A document's distinct lexicon terms are sorted; each randomised subset of the lexicon
gives one signature, the hash of the terms that the document has in it. Subsets are drawn by a hash
of the term at five rates, so that short and long texts both have subsets in which they hold a few
terms. The likeness of two fingerprints is the share of equal signatures among those that are not
empty in both.

The lower end of the band bounds the lexicon, whatever the corpus: a document has as many distinct
terms as it has, and each lexicon term takes up `low` of all documents, so there are at most (mean
distinct terms) / low of them. They are kept as a table of `SLOTS` flags by term hash; a term that
shares a lexicon term's slot counts as one, the same in every document.

All of it is DataFrame functions. Defined results: null texts count as empty; texts without a lexicon
term are told by the hash of all their terms, and are alike only to equals; repeated rows follow each
other; an empty table gives no rows. Other columns are dropped.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.common import partitions, settled

# The band, as shares of documents: idf from ln(1 / 0.05) to ln(1 / 0.0005).
LOW, HIGH = 0.0005, 0.05
SLOTS = 1 << 20
# One term in so many is in a subset; as many subsets of each rate.
RATES, SEEDS = (4, 16, 64, 256, 1024), 12
# Signatures, not empty in both, that a rate needs to tell the likeness.
ENOUGH = 4


def terms(text: Column) -> Column:
    """Distinct lower-case words of letters and digits."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def _slot(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(SLOTS)).cast("int")


def lexicon(docs: DataFrame, text: str, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Terms in the band with their document counts, over all documents."""
    n = docs.count()
    frequency = docs.select(F.explode(terms(F.col(text))).alias("term")).groupBy("term").count()
    least = max(2, math.ceil(low * n))
    return frequency.filter((F.col("count") >= least) & (F.col("count") <= high * n))


def lexicon_flags(words: DataFrame) -> DataFrame:
    """One row with an array of `SLOTS` bits, 64 to a number."""
    slots = words.select(_slot(F.col("term")).alias("slot"))
    bit = F.expr("shiftleft(1L, pmod(slot, 64))")
    used = slots.groupBy(F.expr("slot div 64").cast("int").alias("word")).agg(
        F.bit_or(bit).alias("bits")
    )
    every = words.sparkSession.range(SLOTS // 64).select(F.col("id").cast("int").alias("word"))
    flags = every.join(used, "word", "left").select(
        F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")).alias("flag")
    )
    return flags.agg(F.sort_array(F.collect_list("flag"))["bits"].alias("flags"))


def fingerprint(text: Column, flags: Column) -> Column:
    """Struct of `signatures` (one per subset, null if empty) and `rest` (hash of all terms, for
    texts that have no lexicon term)."""

    def told(found: Column) -> Column:
        def listed(slot: Column) -> Column:
            word = F.get(flags, F.floor(slot / 64).cast("int"))
            return F.getbit(word, F.pmod(slot, F.lit(64)).cast("int")) == 1

        kept = F.filter(found, lambda w: listed(_slot(w)))
        hashes = F.transform(F.sort_array(kept), lambda w: F.xxhash64(w))

        def seeded(hashes: Column, seed: int) -> Column:
            """Signatures of one seed, densest first: each subset is drawn from the one before."""
            def drawn(hashes: Column, rate: int) -> Column:
                return F.filter(
                    hashes, lambda h: F.pmod(F.xxhash64(h, F.lit(seed)), F.lit(rate)) == 0
                )

            def signed(chosen: Column, level: int) -> Column:
                sign = F.when(F.size(chosen) > 0, F.xxhash64(chosen, F.lit(seed)))
                if level + 1 == len(RATES):
                    return F.array(sign)
                rest = F.array(drawn(chosen, RATES[level + 1]))
                return F.concat(F.array(sign), F.transform(rest, lambda r: signed(r, level + 1))[0])

            first = F.array(drawn(hashes, RATES[0]))
            return F.transform(first, lambda c: signed(c, 0))[0]

        def both(hashes: Column) -> Column:
            made = F.flatten(F.array(*[seeded(hashes, seed) for seed in range(SEEDS)]))
            rest = F.when(F.size(hashes) == 0, F.xxhash64(F.sort_array(found)))
            return F.struct(made.alias("signatures"), rest.alias("rest"))

        return F.transform(F.array(hashes), both)[0]

    return F.transform(F.array(terms(text)), told)[0]


def shown(print_: Column) -> Column:
    """A fingerprint as text: signatures in hex, `-` for an empty one, then the rest if any."""
    parts = F.transform(print_.signatures, lambda s: F.coalesce(F.lower(F.hex(s)), F.lit("-")))
    rest = F.coalesce(F.concat(F.lit("/"), F.lower(F.hex(print_.rest))), F.lit(""))
    return F.concat(F.array_join(parts, "."), rest)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal signatures among those that at least one has, 0 to 1, at the sparsest rate
    with `ENOUGH` of these, or else at the densest."""
    pairs = F.zip_with(
        a.signatures,
        b.signatures,
        lambda x, y: F.when(x.isNotNull() | y.isNotNull(), F.coalesce(x == y, F.lit(False))),
    )
    same = F.coalesce(a.rest == b.rest, F.lit(False)).cast("double")

    def told(pairs: Column) -> Column:
        out = same
        for level in range(len(RATES)):
            places = F.lit([seed * len(RATES) + level for seed in range(SEEDS)])
            used = F.filter(
                F.transform(places, lambda k: F.get(pairs, k)), lambda p: p.isNotNull()
            )
            least = ENOUGH if level else 1
            share = F.size(F.filter(used, lambda p: p)) / F.size(used)
            out = F.when(F.size(used) >= least, share).otherwise(out)
        return out

    return F.transform(F.array(pairs), told)[0]


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted `bounds` are at most `key`, found in two steps of their square root."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    coarse = F.lit(bounds[step - 1 :: step])
    whole = F.size(F.filter(coarse, lambda b: b <= key))
    fine = F.slice(F.lit(bounds), whole * step + 1, F.lit(step))
    return whole * step + F.size(F.filter(fine, lambda b: b <= key))


def with_next(
    docs: DataFrame, key: str, columns: list[str], derive: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """`docs` with what `derive` adds to it and `next_<c>` of the row that follows in the order of
    `key` and the columns of `docs`, the first row following the last.

    Rows are dealt to ranges of the key by quantiles, as many as the session's shuffle has
    partitions; each range also gets the first row of the next one. So rows move once, and nothing
    but the bounds passes through the driver.
    """
    spark = docs.sparkSession
    keyed = docs.withColumn("_key", F.coalesce(F.col(key), F.lit(-(1 << 63))))
    count = partitions(spark)
    shares = [k / count for k in range(1, count)]
    bounds = []
    if shares:
        found = keyed.agg(F.percentile_approx("_key", shares, 10_000)).first()[0]
        bounds = sorted(set(found or []))
    dealt = keyed.withColumn("_bucket", _bucket(F.col("_key"), bounds))
    firsts = dealt.groupBy("_bucket").agg(F.min("_key").alias("_key")).orderBy("_bucket").collect()
    # The first row of each range, as the last of the range before; one row per range.
    before = [
        (firsts[k - 1]["_bucket"], row["_key"], len(firsts) if k == 0 else 0)
        for k, row in enumerate(firsts)
    ]
    order = ["_key", *[c for c in docs.columns if c != key]]
    heads = spark.createDataFrame(before, "_before int, _key long, _wrap int")
    extra = dealt.join(F.broadcast(heads), "_key").withColumn(
        "_nth", F.row_number().over(Window.partitionBy("_key").orderBy(*order))
    )
    extra = extra.filter("_nth = 1").withColumn("_bucket", F.col("_before"))
    rows = dealt.withColumn("_extra", F.lit(False)).unionByName(
        extra.drop("_before", "_wrap", "_nth").withColumn("_extra", F.lit(True))
    )
    # An added row comes last in its range.
    within = Window.partitionBy("_bucket").orderBy("_extra", *order)
    ahead = {f"next_{c}": F.lead(c).over(within) for c in columns}
    return derive(rows).withColumns(ahead).filter(~F.col("_extra")).drop("_key", "_bucket", "_extra")


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """`doc_id`, text and fingerprint of each document, those of its edited text (see
    `op6_imatch`), and how like they and the next document's are."""
    source = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))
    table = settled(lexicon_flags(lexicon(source, "text")), "lexicon").scalar()
    flags = F.col("_flags")

    def printed(rows: DataFrame, text: str, name: str) -> DataFrame:
        # Higher-order functions take columns only, so a row carries the table (128 KB) while it is
        # fingerprinted, and drops it before any shuffle.
        carried = rows.withColumn("_flags", table)
        return carried.withColumn(name, fingerprint(F.col(text), flags)).drop("_flags")

    pairs = with_next(
        source, "doc_id", ["text", "print"], lambda rows: printed(rows, "text", "print")
    )
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - half),
        F.substring(F.col("next_text"), F.lit(1), half),
    )
    told = pairs.withColumn("n_chars", n.cast("long")).withColumn("edited", edited)
    return printed(told, "edited", "edited_print")
