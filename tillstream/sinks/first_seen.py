"""Devices by the day they were first seen, kept from day to day.

A merge reads the rows it is given and, of what is stored, only what concerns their devices. In front of the
stored days stands a Bloom filter: a table of 64-bit words, one per `DEVICES_PER_WORD` devices, each device
setting `BITS` bits of one word. A device whose bits are not all set is new without a look at the stored
days; the others are looked up, so a false positive costs a lookup and changes nothing.

The days are a log of `(mid, dt, change)`: +1 for the first day of a device, and where an event of an
earlier day arrives later, -1 for the day taken back and +1 for the earlier one. A day's new devices are the
sum of its changes, so a report reads the folders of its days and no devices.

Defined results: rows without a device or time count for nothing; repeated rows change nothing. A commit
given again replaces itself, as long as it is the last one. One writer per store.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.times import date_range
from ..session import folder_exists, folder_names, replace_folder

DEVICES_PER_WORD = 6
BITS = 4
_LOG = "mid STRING, change INT, commit STRING, dt DATE"
_WORDS = "word BIGINT, bits BIGINT"


def _bits(mid: Column) -> Column:
    """The bits a device sets in its word: `BITS` numbers of six binary digits of a hash."""
    digits = F.xxhash64(mid, F.lit("bits"))
    one = F.lit(1).cast("bigint")
    places = [F.shiftrightunsigned(digits, 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(BITS)]
    out = F.lit(0).cast("bigint")
    for place in places:
        # The amount of a shift may be a column in SQL only.
        out = out.bitwiseOR(F.call_function("shiftleft", one, place))
    return out


@dataclass(frozen=True)
class FirstSeen:
    """First days of devices below `path`."""

    spark: SparkSession
    path: str

    # ---- what is stored ----

    def log(self) -> DataFrame:
        return self.spark.read.schema(_LOG).parquet(f"{self.path}/log")

    def _words_of(self, mids: DataFrame, words: int) -> DataFrame:
        word = F.pmod(F.xxhash64("mid"), F.lit(words)).alias("word")
        return mids.select(word, _bits(F.col("mid")).alias("bits"))

    def _filter_state(self) -> tuple[str, int] | None:
        """Name of the newest filter and its number of words; a filter counts once it is whole."""
        whole = [
            name for name in folder_names(self.spark, f"{self.path}/filter")
            if folder_exists(self.spark, f"{self.path}/filter/{name}/_SUCCESS")
        ]
        if not whole:
            return None
        newest = max(whole)
        return newest, int(newest.partition("-")[2])

    def maybe_known(self, mids: DataFrame) -> DataFrame:
        """`mids` with a flag: false for devices that no merge has seen."""
        state = self._filter_state()
        if state is None:
            return mids.withColumn("maybe", F.lit(False))
        name, words = state
        held = self.spark.read.schema(_WORDS).parquet(f"{self.path}/filter/{name}")
        asked = mids.select(
            "*", F.pmod(F.xxhash64("mid"), F.lit(words)).alias("word"), _bits(F.col("mid")).alias("_mask")
        )
        found = asked.join(held, "word", "left")
        inside = F.coalesce(F.col("bits").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False))
        return found.withColumn("maybe", inside).drop("word", "bits", "_mask")

    # ---- merge ----

    def merge(self, events: DataFrame, commit: str) -> None:
        """Take in rows with `mid` and `ts`: any number of days, in any order."""
        seen = events.filter("mid is not null and ts is not null").groupBy("mid").agg(
            F.to_date(F.min("ts")).alias("dt")
        )
        folder = f"{self.path}/log/commit={commit}"
        # A commit given again is judged by what was there before it.
        before = [n for n in folder_names(self.spark, f"{self.path}/log") if n not in (f"commit={commit}", "_SUCCESS")]
        changes = seen.select("mid", F.lit(1).alias("change"), "dt")
        if before:
            flagged = self.maybe_known(seen).persist()
            try:
                self._write(self._changes(flagged, commit), folder)
            finally:
                flagged.unpersist()
        else:
            self._write(changes, folder)
        self._grow(commit)

    def _changes(self, flagged: DataFrame, commit: str) -> DataFrame:
        asked = flagged.filter("maybe").select("mid", "dt")
        stored = self.log().filter((F.col("commit") != commit) & (F.col("change") > 0))
        known = (
            stored.join(asked.select("mid"), "mid", "left_semi")
            .groupBy("mid").agg(F.min("dt").alias("known"))
        )
        looked_up = asked.join(known, "mid", "left")
        earlier = looked_up.filter("known is null or dt < known")
        back = F.when(F.col("known").isNotNull(), F.struct(F.lit(-1).alias("change"), F.col("known").alias("dt")))
        now = F.struct(F.lit(1).alias("change"), F.col("dt"))
        corrected = earlier.select("mid", F.explode(F.array_compact(F.array(now, back))).alias("c"))
        new = flagged.filter(~F.col("maybe")).select("mid", F.lit(1).alias("change"), "dt")
        return new.unionByName(corrected.select("mid", "c.change", "c.dt"))

    def _write(self, changes: DataFrame, folder: str) -> None:
        staged = f"{self.path}/staged"
        placed = changes.hint("rebalance", "dt")
        placed.write.mode("overwrite").partitionBy("dt").parquet(staged)
        replace_folder(self.spark, staged, folder)

    def _grow(self, commit: str) -> None:
        """The filter with the devices of a commit; with twice the words and from all devices where it
        has become too full."""
        state = self._filter_state()
        firsts = self.log().filter("change > 0")
        needed = firsts.count() // DEVICES_PER_WORD + 1
        number = int(state[0].partition("-")[0]) + 1 if state else 0
        if state and state[1] >= needed:
            words = state[1]
            held = self.spark.read.schema(_WORDS).parquet(f"{self.path}/filter/{state[0]}")
            added = firsts.filter(F.col("commit") == commit)
            rows = held.unionByName(self._words_of(added, words))
        else:
            words = 1 << (2 * needed - 1).bit_length()
            rows = self._words_of(firsts, words)
        filled = rows.groupBy("word").agg(F.bit_or("bits").alias("bits"))
        filled.write.parquet(f"{self.path}/filter/{number:08d}-{words}")
        if state:
            replace_folder(self.spark, None, f"{self.path}/filter/{state[0]}")

    # ---- reports ----

    def new_by_day(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """`dt` (text) and how many devices were first seen then, from the folders of the days asked for."""
        rows = self.log()
        if first:
            rows = rows.filter(date_range(F.col("dt"), first, last or first))
        sums = rows.groupBy(F.date_format("dt", "yyyy-MM-dd").alias("dt")).agg(
            F.sum("change").alias("new_devices")
        )
        return sums.filter("new_devices <> 0")
