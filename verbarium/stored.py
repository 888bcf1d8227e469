"""Tables that are kept between runs: a batch of changes rewrites the buckets that it touches."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


@dataclass(frozen=True)
class StoredTable:
    """A table below ``path``, in ``buckets`` parts by a hash of ``keys``.

    ``combine`` brings rows together that several batches have of a key; it must not matter in
    which groups it gets them. The table's rows are its results, and so are a batch's.

    A batch writes the new contents of its buckets to ``data/batch=N``, and then, as its commit,
    ``parts/batch=N``: for every bucket the batch that holds it. A batch whose number isn't
    above the last one's has been applied before, and does nothing; one that broke off before
    its commit is written over. Buckets that it doesn't touch are neither read nor written.
    One writer at a time.
    """

    path: str
    keys: tuple[str, ...]
    combine: Callable[[DataFrame], DataFrame]
    buckets: int = BUCKETS

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _committed(self, spark: SparkSession) -> list[int]:
        """The numbers of the batches that are whole, in order."""
        home = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/parts")
        files = home.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        if not files.exists(home):
            return []
        names = [s.getPath() for s in files.listStatus(home)]
        done = [p.getName() for p in names if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(n.removeprefix("batch=")) for n in done if n.startswith("batch="))

    def last_batch(self, spark: SparkSession) -> int | None:
        """The number of the last batch that was applied."""
        return next(reversed(self._committed(spark)), None)

    def parts(self, spark: SparkSession, batch: int | None = None) -> dict[int, int]:
        """For each bucket that has rows the batch that holds it, as of a batch (the last one)."""
        done = [k for k in self._committed(spark) if batch is None or k <= batch]
        if not done:
            return {}
        return {r["bucket"]: r["held_by"] for r in spark.read.parquet(f"{self.path}/parts/batch={done[-1]}").collect()}  # as many rows as buckets

    def _rows(self, spark: SparkSession, parts: dict[int, int]) -> DataFrame | None:
        if not parts:
            return None
        folders = [f"{self.path}/data/batch={batch}/bucket={bucket}" for bucket, batch in sorted(parts.items())]
        return spark.read.parquet(*folders)

    def read(self, spark: SparkSession, batch: int | None = None) -> DataFrame | None:
        """The rows as of a batch (the last one), or None before the first."""
        return self._rows(spark, self.parts(spark, batch))

    def apply(self, rows: DataFrame, batch: int) -> bool:
        """Combine a batch of ``rows`` with the table; False if it was applied before."""
        spark = rows.sparkSession
        last = self.last_batch(spark)
        if last is not None and batch <= last:
            return False
        held = self.parts(spark)
        # The batch's own rows first: they are combined and dealt once, then known by their buckets.
        staged = f"{self.path}/staged/batch={batch}"
        dealt = self.combine(rows).withColumn("bucket", self._bucket())
        dealt.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(staged)
        new = spark.read.schema(dealt.schema).parquet(staged)  # a batch without rows has no file to tell it
        touched = {r["bucket"] for r in new.select("bucket").distinct().collect()}  # as many rows as buckets at most
        own = new.drop("bucket")
        old = self._rows(spark, {b: n for b, n in held.items() if b in touched})
        merged = own if old is None else self.combine(old.unionByName(own))
        merged.withColumn("bucket", self._bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/batch={batch}")
        now = held | dict.fromkeys(touched, batch)
        if now:
            table = spark.createDataFrame(sorted(now.items()), "bucket int, held_by bigint").coalesce(1)
        else:
            table = spark.createDataFrame([], "bucket int, held_by bigint")
        table.write.mode("overwrite").parquet(f"{self.path}/parts/batch={batch}")
        self._delete(spark, staged)
        return True

    def forget(self, spark: SparkSession, keep: int = 1) -> None:
        """Delete what only batches before the last ``keep`` need."""
        done = self._committed(spark)
        needed = {batch for k in done[-keep:] for batch in self.parts(spark, k).values()}
        for k in done[:-keep]:
            self._delete(spark, f"{self.path}/parts/batch={k}")
        for k in done:
            if k not in needed:
                self._delete(spark, f"{self.path}/data/batch={k}")

    @staticmethod
    def _delete(spark: SparkSession, path: str) -> None:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
