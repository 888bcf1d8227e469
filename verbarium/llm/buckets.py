"""Pairs of a bucket that are still in different components: dealt to tasks, linear in near copies."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, small

#: Members, and weight of members, that one side of a run has at most, about.
BLOCK, WEIGHT = 2048, 2 << 20
#: Over so many blocks of members outside its largest component, a bucket gets another round of stars first.
CROWD = 8
#: The columns that name a run, and a member's place in it.
RUN = ("bucket", "left", "right")
DEALT = "bucket long, left int, right int, own int, main boolean"


def mixed(placed: DataFrame, seed: int = 0) -> DataFrame:
    """The buckets with members of several components.

    ``placed`` has bucket, node, component and weight. Returns _bucket, _main (its largest
    component), _head (a member of that, another for another ``seed``), _n (all members),
    _others (members outside it), _heavy and _light (blocks by weight of both sides).
    """
    any_of = F.struct(F.xxhash64("node", F.lit(seed)).alias("h"), F.col("node").alias("node"))
    parts = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum("weight").alias("w"), F.min(any_of)["node"].alias("head"))
    largest = F.max(F.struct("n", "component", "head", "w"))
    found = parts.groupBy("bucket").agg(largest.alias("m"), F.sum("n").alias("n"), F.sum("w").alias("w"), F.count("*").alias("k")).where("k > 1")
    return found.select(
        F.col("bucket").alias("_bucket"), F.col("m.component").alias("_main"), F.col("m.head").alias("_head"), F.col("n").alias("_n"), (F.col("n") - F.col("m.n")).alias("_others"),
        F.ceil((F.col("w") - F.col("m.w")) / WEIGHT).alias("_heavy"), F.ceil(F.col("m.w") / WEIGHT).alias("_light"),
    )


def star_pairs(placed: DataFrame, buckets: DataFrame) -> DataFrame:
    """(a, b): every member outside its bucket's largest component, with that component's head."""
    joined = placed.join(small(buckets), F.col("bucket") == F.col("_bucket")).where(F.col("component") != F.col("_main"))
    return joined.select(F.col("_head").alias("a"), F.col("node").alias("b")).distinct()


def deal(placed: DataFrame, buckets: DataFrame, *columns: str) -> DataFrame:
    """The members of the mixed ``buckets`` in runs, with their ``columns``.

    A run has the pairs of one bucket and two of its blocks, of which the left one holds
    members outside the largest component. A bucket of few members is a single run. Rows
    grow with the members by the blocks of the others only, so a group of near copies of
    any size with few strangers gives each member once.
    """
    rows = placed.join(small(buckets), F.col("bucket") == F.col("_bucket")).withColumn("main", F.col("component") == F.col("_main"))
    one = (F.col("_n") <= BLOCK) & (F.col("_heavy") <= 1) & (F.col("_light") <= 1)
    left = F.when(one, 1).otherwise(F.greatest(F.ceil(F.col("_others") / BLOCK), "_heavy")).cast("int")
    right = F.when(one, 0).otherwise(F.greatest(F.ceil((F.col("_n") - F.col("_others")) / BLOCK), "_light")).cast("int")
    rows = rows.withColumn("_left", left).withColumn("_right", right).withColumn("_hash", F.xxhash64("node", F.lit(7)))
    own = F.when(~F.col("main"), F.pmod("_hash", "_left")).when(F.col("_right") == 0, 0).otherwise(F.col("_left") + F.pmod("_hash", F.greatest("_right", F.lit(1))))
    rows = rows.withColumn("own", own.cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_left") - 1 + F.when(F.col("main"), 0).otherwise(F.col("_right"))))
    rows = rows.withColumn("_other", other)
    return rows.select("bucket", F.least("own", "_other").alias("left"), F.greatest("own", "_other").alias("right"), "own", "main", *columns)


def gathered(rows: DataFrame) -> DataFrame:
    """``rows`` of runs with each run in one task, in order."""
    return rows.repartition(shuffle_partitions(rows.sparkSession), *RUN).sortWithinPartitions(*RUN)


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each run, which arrive sorted by its columns."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(len(RUN))]
        cuts = np.flatnonzero(np.logical_or.reduce([np.diff(k) != 0 for k in keys])) + 1
        if kept and any(kept[-1].column(k)[kept[-1].num_rows - 1].as_py() != batch.column(k)[0].as_py() for k in range(len(RUN))):
            yield pa.Table.from_batches(kept)
            kept = []
        starts = [0, *cuts.tolist(), batch.num_rows]
        for lo, hi in zip(starts[:-1], starts[1:], strict=True):
            kept.append(batch.slice(lo, hi - lo))
            if hi < batch.num_rows:
                yield pa.Table.from_batches(kept)
                kept = []
    if kept:
        yield pa.Table.from_batches(kept)


class Sides:
    """Which rows of a run are to be paired: ``first``, and for each of them ``second(i)``."""

    def __init__(self, left: np.ndarray, right: np.ndarray, own: np.ndarray, main: np.ndarray):
        self.same = left[0] == right[0]
        self.first = np.flatnonzero(~main & (own == left))
        self.others = np.flatnonzero(main) if self.same else np.flatnonzero(own == right)

    def second(self, i: int) -> np.ndarray:
        return np.concatenate([self.first[self.first > i], self.others]) if self.same else self.others
