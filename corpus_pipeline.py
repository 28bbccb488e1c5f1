"""From raw documents to packed sequences, in five stages.

1. language ID: documents without a recognisable language go, missing labels are filled in.
2. n-gram Jaccard join: of each group of near copies the document with the smallest id stays, under
   one id the text with the smaller digest.
3. secret scan: secrets are masked in the text.
4. mixing: documents are drawn so that sources, languages and topics come near their target shares.
5. packing: the rest is cut into sequences of 2048 tokens.

Each stage takes (spark, docs, sf_dir); `run` writes what it returns and reads it again for the next.
All but the last return the columns of `documents`. Documents with a null id are kept by the second
stage, as they belong to no group, and so are texts without words; of rows equal in id and text one
stays there, the least by its other columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import langid, mixing, ngram_join, packing, secrets
from tillstream.llm.common import settled, table
from tillstream.llm.queries import WORD_BPE, held_out

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Share of all tokens that the mixing stage draws.
KEPT_TOKENS = 0.7


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is undetermined; nothing is dropped if there are no labels."""
    net = langid.fit(docs.filter(~held_out()))
    if net is None:
        return docs.select(*COLUMNS)
    found = langid.predict(docs.select(*COLUMNS), net).filter(F.col("lang_pred") != langid.UNKNOWN)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    found = ngram_join.jaccard_groups(docs).filter("doc_id is not null")
    first = F.min(F.struct("doc_id", "digest")).alias("first")
    leaders = found.filter("group is not null").groupBy("group").agg(first).select("first.*")
    wordless = found.filter("group is null").select("doc_id", "digest")
    stay = leaders.union(wordless).distinct()
    keyed = docs.select(*COLUMNS, F.md5(F.coalesce("text", F.lit(""))).alias("digest"))
    kept = keyed.join(stay, ["doc_id", "digest"], "left_semi")
    others = [c for c in COLUMNS if c not in ("doc_id", "text")]
    once = kept.groupBy("doc_id", "text").agg(F.min(F.struct(*others)).alias("other"))
    unnamed = docs.select(*COLUMNS).filter(F.col("doc_id").isNull())
    return once.select("doc_id", "text", "other.*").select(*COLUMNS).unionByName(unnamed)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets."""
    found = secrets.find_secrets(docs.select(*COLUMNS))
    masked = found.withColumn("text", secrets.redacted(F.col("text"), F.col("secrets")))
    chars = F.when(F.size("secrets") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", chars.cast("long")).select(*COLUMNS)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw documents at target shares."""
    drawn = mixing.mix(mixing.labelled(docs.select(*COLUMNS)), fraction=KEPT_TOKENS)
    return drawn.select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of the remaining documents in its sequence."""
    path = public_tokenizers.path(WORD_BPE)
    return packing.pack_documents(docs, path, end_id=1, keep_ids=False)


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_copies),
    ("secret scan", secret_scan),
    ("mixing to target weights", mixing_weights),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", *COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), f"stage-{name.split()[0].lower()}")
    return STAGES[-1][1](spark, docs, sf_dir)


# A trained network and a hash draw have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None
