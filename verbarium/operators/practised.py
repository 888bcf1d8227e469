"""Distinct words that learners practised, from daily bitmaps that merge without the words."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..stored import BUCKETS, StoredTable

#: The number of a row in its partition is in these bits of Spark's increasing ids.
ROW = (1 << 33) - 1


def _one_number(rows: DataFrame) -> DataFrame:
    return rows.groupBy("word_id").agg(F.min("number").alias("number"))


@dataclass(frozen=True)
class WordNumbers:
    """Dense numbers of word ids from 0 on, kept below ``path``; a word's number never changes.

    ``add`` gives the words of a numbered batch that have none yet the next numbers, in the order
    of their ids; a batch that was added before does nothing. No task sees all words: they are
    sorted by ranges, and a range's first number is the sum of the sizes of those before it.
    """

    path: str
    buckets: int = BUCKETS

    @property
    def table(self) -> StoredTable:
        return StoredTable(f"{self.path}/numbers", ("word_id",), _one_number, self.buckets)

    def read(self, spark: SparkSession) -> DataFrame:
        """(word_id, number) of all words so far."""
        rows = self.table.read(spark)
        return spark.createDataFrame([], "word_id string, number bigint") if rows is None else rows

    def add(self, words: DataFrame, batch: int) -> bool:
        """Number the new ones among ``words`` (word_id; nulls are left out, repetitions are one); False if the batch was added before."""
        spark, last = words.sparkSession, self.table.last_batch(words.sparkSession)
        if last is not None and batch <= last:
            return False
        known, placed = self.read(spark), f"{self.path}/placed/batch={batch}"
        free = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
        new = words.select("word_id").where("word_id is not null").distinct().join(known, "word_id", "left_anti")
        ranges = new.repartitionByRange("word_id").sortWithinPartitions("word_id")
        place = F.monotonically_increasing_id().bitwiseAND(F.lit(ROW))
        ranges.select("word_id", F.spark_partition_id().alias("part"), place.alias("place")).write.mode("overwrite").parquet(placed)
        rows = spark.read.schema("word_id string, part int, place bigint").parquet(placed)
        before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        starts = rows.groupBy("part").agg(F.count("*").alias("n")).select("part", before.alias("start"))  # a row a partition
        numbered = rows.join(F.broadcast(starts), "part").select("word_id", (F.col("start") + F.col("place") + free).alias("number"))
        return self.table.apply(numbered, batch)


def daily_bitmaps(attempts: DataFrame, numbers: DataFrame) -> DataFrame:
    """The words that each learner practised on each day, as exact bitmaps of word numbers.

    ``attempts`` has user_id, word_id and when, ``numbers`` the numbers of the words. The rows have user_id,
    day, block and bits: a bitmap of 32,768 numbers from a block's first one on, without the bytes after its last bit. Attempts without a
    learner, a word of ``numbers`` or a time are left out; repetitions count once, so the same attempts may come
    again. A learner's rows of a day and block are brought together as distinct numbers, at most
    32,768 of them, before they take the 4 KB of a bitmap.
    """
    numbered = attempts.where("user_id is not null and when is not null").select("user_id", "word_id", F.col("when").cast("date").alias("day")).distinct().join(numbers, "word_id")
    placed = numbered.select("user_id", "day", F.bitmap_bucket_number("number").alias("block"), F.bitmap_bit_position("number").alias("bit"))
    made = placed.repartition("user_id", "day", "block").groupBy("user_id", "day", "block").agg(F.bitmap_construct_agg("bit").alias("bits"), (F.max("bit") / 8 + 1).cast("int").alias("_bytes"))
    return made.select("user_id", "day", "block", _cut("bits", "_bytes"))


def _cut(bits: str, size: str) -> Column:
    """The first ``size`` bytes of a bitmap, after which it has no bit."""
    return F.substring(F.col(bits), F.lit(1), F.col(size)).alias("bits")


def merged(bitmaps: DataFrame, *by: str) -> DataFrame:
    """``bitmaps`` brought together by the columns ``by`` (user_id and day without any) and block."""
    keys = (*(by or ("user_id", "day")), "block")
    # Dealt before they are brought together: what a partial aggregation would send has all 4 KB.
    made = bitmaps.repartition(*keys).groupBy(*keys).agg(F.bitmap_or_agg("bits").alias("bits"), F.max(F.length("bits")).alias("_bytes"))
    return made.select(*keys, _cut("bits", "_bytes"))


def stored_practice(path: str, buckets: int = BUCKETS) -> StoredTable:
    """Daily bitmaps that are kept below ``path``; ``apply`` takes ``daily_bitmaps`` of a numbered batch, once."""
    return StoredTable(path, ("user_id",), merged, buckets)


def words_practised(bitmaps: DataFrame, *by: str) -> DataFrame:
    """How many distinct words there are in ``bitmaps`` for each value of the columns ``by``, as ``words``."""
    return merged(bitmaps, *by).groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias("words"))
