"""Inverted index: for each term the documents that hold it, and where.

Built batch by batch from columns of a table with a key. Postings lie in folders by a hash of field and
term, sorted, so a query reads a few row groups of a few folders and never the texts. A document that
comes again in a later batch replaces its former text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import query_terms, run_terms, runs
from ..session import folder_names

_RUN_STEP = 1 << 32


def postings(docs: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """`field, term, key, at`, one row per occurrence: `at` is the run and the place in it as one number.

    Nothing is grouped, so a frequent term is no group anywhere; sorted, the repeats cost the files little.
    """
    texts = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields)))
    rows = docs.select(F.col(key).alias("key"), texts.alias("t")).select("key", "t.field", runs(F.col("t.text")).alias("runs"))
    placed = rows.select("key", "field", F.posexplode("runs").alias("run", "text")).select(
        "key", "field", "run", F.posexplode(run_terms(F.col("text"))).alias("offset", "term")
    )
    at = F.col("run").cast("bigint") * F.lit(_RUN_STEP) + F.col("offset")
    return placed.select("field", "term", "key", at.alias("at"))


@dataclass(frozen=True)
class PostingIndex:
    """An index below `path`; `batch` folders hold postings by bucket and the keys they are of."""

    spark: SparkSession
    path: str
    buckets: int = 16
    key_type: str = "BIGINT"

    def _postings(self) -> DataFrame:
        schema = f"field STRING, term STRING, key {self.key_type}, at BIGINT, batch INT, bucket INT"
        return self.spark.read.schema(schema).parquet(f"{self.path}/postings")

    def _keys(self) -> DataFrame:
        return self.spark.read.schema(f"key {self.key_type}, batch INT").parquet(f"{self.path}/keys")

    def add(self, docs: DataFrame, key: str, fields: Sequence[str], batch: int) -> None:
        """Index a batch; given again, it replaces itself. Keys are unique within a batch."""
        rows = postings(docs, key, fields).withColumn("bucket", self._bucket(F.col("field"), F.col("term")))
        (
            rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "field", "term", "key")
            .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/postings/batch={batch}")
        )
        keys = docs.select(F.col(key).alias("key"))
        keys.write.mode("overwrite").parquet(f"{self.path}/keys/batch={batch}")

    def _bucket(self, field: Column, term: Column) -> Column:
        return F.pmod(F.xxhash64(field, term), F.lit(self.buckets)).cast("int")

    def _read(self, field: str, terms: Sequence[str]) -> DataFrame:
        """Postings of some terms, from their buckets, of the newest text of each document."""
        rows = self._postings().filter(F.col("field") == field)
        values = self.spark.range(1).select(
            F.array(*(self._bucket(F.lit(field), F.lit(t)) for t in terms))
        ).first()[0]
        rows = rows.filter(F.col("bucket").isin(sorted(set(values))) & F.col("term").isin(list(terms)))
        return self._newest(rows)

    def _newest(self, rows: DataFrame) -> DataFrame:
        if len(folder_names(self.spark, f"{self.path}/keys")) <= 1:
            return rows
        newest = self._keys().groupBy("key").agg(F.max("batch").alias("batch"))
        return rows.join(newest, ["key", "batch"], "left_semi")

    def _word(self, field: str, terms: list[list[str]]) -> DataFrame:
        """Keys of the documents with one word, which has one or more runs of terms."""
        flat = [t for run in terms for t in run]
        if len(flat) == 1:
            if len(terms[0][0]) == 1 and not terms[0][0].isascii():
                # A single character may begin a pair of a script without blanks.
                rows = self._postings().filter(
                    (F.col("field") == field) & F.col("term").startswith(flat[0]) & (F.length("term") <= 2)
                )
                return self._newest(rows).select("key").distinct()
            return self._read(field, flat).select("key")
        # Every term must stand where the word has it, seen from the same start.
        starts = [
            self._read(field, [term]).select(
                "key", F.lit(number).alias("n"), self._start(F.col("at"), run, offset, len(terms) > 1).alias("start")
            )
            for number, (run, offset, term) in enumerate(
                (r, o, t) for r, run_ in enumerate(terms) for o, t in enumerate(run_)
            )
        ]
        met = reduce(DataFrame.unionByName, starts).groupBy("key", "start").agg(
            F.count_distinct("n").alias("met")
        )
        return met.filter(F.col("met") == len(flat)).select("key").distinct()

    @staticmethod
    def _start(at: Column, run: int, offset: int, several: bool) -> Column:
        """Where the word would start; of several runs only their order is held against each other."""
        return F.floor(at / _RUN_STEP).cast("bigint") - run if several else at - offset

    def any_word(self, field: str, words: str) -> DataFrame:
        """Keys of the documents with any of the blank-separated words in a field."""
        found = [query_terms(self.spark, word) for word in words.split()]
        single = [t[0][0] for t in found if len(t) == 1 and len(t[0]) == 1 and (len(t[0][0]) > 1 or t[0][0].isascii())]
        parts = [self._read(field, single).select("key")] if single else []
        parts += [self._word(field, t) for t in found if t and not (len(t) == 1 and len(t[0]) == 1 and t[0][0] in single)]
        if not parts:
            return self._keys().select("key").limit(0)
        return reduce(DataFrame.unionByName, parts).distinct()
