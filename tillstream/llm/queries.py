"""Registered queries of the operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import (
    divergence,
    hnsw,
    htmltext,
    imatch,
    langid,
    mixing,
    ngram_join,
    packing,
    secrets,
    suffix,
    tokencount,
    tokenfile,
    vectorcodes,
)
from tillstream.llm.common import settled, table
from tillstream.session import workspace

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 2048 tokens."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    packed = packing.pack_documents(
        docs, public_tokenizers.path(WORD_BPE), end_id=1, keep_ids=False
    )
    return packed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, counted by kind, with their spans."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents", "doc_id", "text"))
    spans = F.col("secrets")

    def counted(kind: str):
        return F.size(F.filter(spans, lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    counts = [counted(rule.kind) for rule in secrets.BASE_RULES]
    listed = found.select("doc_id", *counts, secrets.span_list(spans).alias("spans"))
    return listed.withColumn("base_sha256", F.sha2("spans", 256))


def held_out() -> Column:
    """Rows that no model learns from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by a network trained on those not held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    net = langid.fit(docs.filter(~held_out()))
    found = langid.predict(docs.select("doc_id", "text"), net)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose five-word shingles reach a Jaccard similarity of 3/4."""
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id files of all documents, read back: place, length and checksum of each."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    folder = workspace(spark, "tokens")
    tokenfile.write(docs, public_tokenizers.path(BYTE_BPE), 0, folder)
    read = tokenfile.read(spark, folder)
    told = read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    # Read under the limits of `settled`: ids stay in the tasks, four numbers a document are kept.
    return settled(told, "token_places")


def op6_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text.

    The edited text has the last half of the characters replaced by the start of the next document.
    """
    found = imatch.fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))
    own = F.col("print")
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        imatch.shown(own).alias("fingerprint"),
        imatch.shown(F.col("edited_print")).alias("edited_fingerprint"),
        imatch.likeness(own, F.col("edited_print")).alias("near_edited"),
        imatch.likeness(own, F.col("next_print")).alias("near_next"),
    )


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of vectors with a cosine of 0.95 or more."""
    return hnsw.near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn at target shares of sources, languages and topics."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    drawn = mixing.mix(mixing.labelled(docs).drop("text"))
    return drawn.select("doc_id", "source", "lang", "topic", "tokens", "probability")


def op9_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes of strings of 400 that also start elsewhere."""
    kept = suffix.without_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
        # A cut inside a character leaves bytes that are no text; each is shown as U+FFFD.
        F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"),
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    counted = tokencount.count_tokens(docs, public_tokenizers.path(BYTE_BPE))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all vectors with whole-number components, and their errors."""
    coded = vectorcodes.compress(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language lie apart, and the terms each uses in excess."""
    return divergence.audit(table(spark, sf_dir, "documents", "text", "lang", "source"))


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = htmltext.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_secret_scan,
        op3_language_id,
        op4_ngram_join,
        op5_token_files,
        op6_imatch,
        op7_near_vectors,
        op8_mixing,
        op9_repeated_bytes,
        op10_token_counts,
        op11_vector_codes,
        op12_source_divergence,
        op13_html_text,
    )
}


def _secret_sql() -> str:
    """Positions from lengths: each match is taken together with the text before it."""
    kinds = []
    for number, rule in enumerate(secrets.BASE_RULES):
        pattern = f"(?s:(.*?))({rule.pattern})".replace("'", "''")
        lengths = [
            f"list_transform(regexp_extract_all(coalesce(text, ''), '{pattern}', {group}), lambda m: length(m))"
            for group in (0, 1, 2 + rule.group)
        ]
        kinds.append(
            f"SELECT row, {number} AS rule, '{rule.kind}' AS kind, {rule.least} AS least, "
            f"{lengths[0]} AS w, {lengths[1]} AS g, {lengths[2]} AS m FROM docs"
        )
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
read AS ({" UNION ALL ".join(kinds)}),
spans AS (
  SELECT row, rule, kind, least, m[k] AS measured,
    CAST(coalesce(list_sum(w[1:k - 1]), 0) AS BIGINT) + g[k] AS start,
    CAST(list_sum(w[1:k]) AS BIGINT) AS stop
  FROM (SELECT *, unnest(range(1, len(w) + 1)) AS k FROM read)),
kept AS (
  SELECT row,
    count(*) FILTER (kind = 'assign') AS n_assign,
    count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rule) AS spans
  FROM spans WHERE measured >= least GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM docs LEFT JOIN kept USING (row)
"""


SQL: dict[str, str] = {"op2_secret_scan": _secret_sql(), "op12_source_divergence": divergence.SQL}
