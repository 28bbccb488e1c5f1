"""Tables stored by day, changed by merging rows into the days they touch.

A store lies in one folder per day, or per month where days are too small to fill a file (`grain_for`).
A change is read, merged and written for the touched folders only, in files of about the target size, and
beside the store first: a folder replaces its predecessor by a rename once all of the change is written,
and a change that stopped half-way is put in place when it is given again. Other folders keep their files.
One writer per store.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.keyed import latest_per_key
from ..session import conf_override, folder_exists, folder_names, replace_folder

GRAINS = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}
# Rows of a day from which it fills a file, and the size files are written in.
ROWS_PER_FILE = 100_000
FILE_BYTES = 128 << 20
_NO_DAY = "none"


def grain_for(rows: int, days: int) -> str:
    """Months where an average day would be a small file."""
    return "day" if rows >= ROWS_PER_FILE * max(days, 1) else "month"


@dataclass(frozen=True)
class DayStore:
    """A table with a DATE column `dt`, one row per day and key, the newest version by `version`."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    version: str | None = None
    grain: str = "day"
    file_bytes: int = FILE_BYTES
    _folder: str = field(default="part", repr=False)

    def _part(self, day: Column) -> Column:
        return F.coalesce(F.date_format(day, GRAINS[self.grain]), F.lit(_NO_DAY))

    def _stored(self) -> DataFrame:
        with_part = T.StructType([*self.schema.fields, T.StructField(self._folder, T.StringType())])
        return self.spark.read.schema(with_part).parquet(self.path)

    def read(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """All rows, or those of the days `first`..`last`, from the folders of these days only."""
        if not folder_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        rows = self._stored()
        if first:
            ends = [F.lit(day).cast("date") for day in (first, last or first)]
            day, size = F.col("dt"), len("yyyy-MM-dd") if self.grain == "day" else len("yyyy-MM")
            rows = rows.filter(F.col(self._folder).between(first[:size], (last or first)[:size]))
            rows = rows.filter(day.between(*ends))
        return rows.select(*self.schema.fieldNames())

    def read_parts(self, parts: Sequence[str]) -> DataFrame:
        """Rows of some folders."""
        if not folder_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        rows = self._stored().filter(F.col(self._folder).isin(list(parts)))
        return rows.select(*self.schema.fieldNames())

    def merge(self, rows: DataFrame, commit: str) -> list[str]:
        """Upsert rows; gives the folders that were touched. `commit` names the change."""
        staged = f"{self.path}-staged/{commit}"
        if folder_exists(self.spark, f"{staged}/_SUCCESS"):
            return self._publish(staged)
        new = rows.select(*self.schema.fieldNames()).withColumn("_new", F.lit(1))
        both, merging = new, folder_exists(self.spark, self.path)
        if merging:
            new.persist()
        try:
            if merging:
                # As many values as the calendar has days at most.
                touched = [r[0] for r in new.select(self._part(F.col("dt"))).distinct().collect()]
                both = self.read_parts(touched).withColumn("_new", F.lit(0)).unionByName(new)
            order = [F.col(self.version).desc()] if self.version else []
            # Rows that lie by a part of the key already, as after a join, stay where they are: a hot part is
            # split by the join, and only then they move by the whole key.
            merged = latest_per_key(both, ["dt", *self.keys], [*order, F.col("_new").desc()])
            self._write(merged.drop("_new"), staged)
        finally:
            if merging:
                new.unpersist()
        return self._publish(staged)

    def replace(self, rows: DataFrame, parts: Sequence[str], commit: str) -> None:
        """Let `rows` be all there is in some folders."""
        staged = f"{self.path}-staged/{commit}"
        if not folder_exists(self.spark, f"{staged}/_SUCCESS"):
            self._write(rows.select(*self.schema.fieldNames()), staged)
        written = self._publish(staged)
        for part in set(parts) - set(written):
            replace_folder(self.spark, None, f"{self.path}/{self._folder}={part}")

    def _write(self, rows: DataFrame, staged: str) -> None:
        placed = rows.withColumn(self._folder, self._part(F.col("dt"))).hint("rebalance", self._folder)
        size = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(self.file_bytes)}
        with conf_override(self.spark, size):
            placed.sortWithinPartitions(self._folder, "dt", *self.keys).write.mode("overwrite").partitionBy(
                self._folder
            ).parquet(staged)

    def _publish(self, staged: str) -> list[str]:
        """Move the staged folders into place. What was moved before is there already."""
        names = [n for n in folder_names(self.spark, staged) if n.startswith(f"{self._folder}=")]
        for name in names:
            replace_folder(self.spark, f"{staged}/{name}", f"{self.path}/{name}")
        return [name.partition("=")[2] for name in names]
