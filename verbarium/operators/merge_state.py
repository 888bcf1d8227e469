"""The merge of words as a state that is kept: further vocabularies join it without the rows of earlier ones."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import counted_contents, identified, merge_contents

#: Runs of one level that are merged into one of the next.
RUNS = 8
_COUNTS = ("_rows", "_low", "_high")


def combine(rows: DataFrame) -> DataFrame:
    """Each content once, of rows that several runs have of it."""
    sums = (F.sum("_rows").alias("_rows"), F.min("_low").alias("_low"), F.max("_high").alias("_high"))
    return rows.groupBy(*[c for c in rows.columns if c not in _COUNTS]).agg(*sums).select(*rows.columns)


@dataclass(frozen=True)
class MergedVocabulary:
    """A merged vocabulary below ``path``: runs of distinct contents, with how often, first and last they came.

    ``add`` takes the words of a further source (or any part of one), whose ``_ord`` are places in
    the order of all sources, in any order of batches. It writes a run of the batch's own contents;
    what was merged before is neither read nor written, but for each ``runs``-th run of a level,
    with which those of the level become one of the next: a content is rewritten as often as there
    are levels, the logarithm of the batches. ``read`` deals the contents of all runs by id once,
    and merges them as ``merge_words`` does.

    A run is at ``level=L/batch=N``, where N is the last batch in it. It takes the place of all runs
    of lower levels up to N, which the next batch deletes. It counts from when it is whole; a batch that
    broke off is written over, and a number that isn't above the last one's does nothing. One writer at a time.
    """

    path: str
    runs: int = RUNS

    def _levels(self, spark: SparkSession) -> dict[int, list[int]]:
        """The batches of the whole runs of each level."""
        home = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = home.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        found: dict[int, list[int]] = {}
        for level in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(home, "level=*/batch=*/_SUCCESS")) or ():
            run = level.getPath().getParent()
            found.setdefault(int(run.getParent().getName().removeprefix("level=")), []).append(int(run.getName().removeprefix("batch=")))
        return found

    @staticmethod
    def _live(levels: dict[int, list[int]]) -> set[tuple[int, int]]:
        """(level, batch) of the runs that no run of a higher level holds."""
        return {(k, n) for k, own in levels.items() for n in own if not any(n <= m for j, others in levels.items() if j > k for m in others)}

    def _run(self, level: int, batch: int) -> str:
        return f"{self.path}/level={level}/batch={batch}"

    def _rows(self, spark: SparkSession, runs: set[tuple[int, int]]) -> DataFrame:
        return reduce(DataFrame.unionByName, [spark.read.parquet(self._run(*r)) for r in sorted(runs)])

    def add(self, words: DataFrame, batch: int) -> bool:
        """Merge ``words`` in; False if the batch was there."""
        spark = words.sparkSession
        levels = self._levels(spark)
        if any(batch <= n for own in levels.values() for n in own):
            return False
        live = self._live(levels)
        for run in {(k, n) for k, own in levels.items() for n in own} - live:
            self._delete(spark, self._run(*run))
        counted_contents(words).write.mode("overwrite").parquet(self._run(0, batch))
        live.add((0, batch))
        level = 0
        while len(full := {r for r in live if r[0] == level}) >= self.runs:
            combine(self._rows(spark, full)).write.mode("overwrite").parquet(self._run(level + 1, batch))
            live, level = live - full | {(level + 1, batch)}, level + 1
        return True

    def read(self, spark: SparkSession) -> DataFrame | None:
        """The merged words, or None before the first batch."""
        live = self._live(self._levels(spark))
        return merge_contents(identified(self._rows(spark, live))) if live else None

    @staticmethod
    def _delete(spark: SparkSession, path: str) -> None:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
