"""Shared plumbing of the training-data operators: tables, stored intermediates, bounds."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Most rows that a broadcast may hold; beyond it the plan shuffles instead.
BROADCAST_ROWS = 200_000
#: Most bytes that it may have, as stored.
BROADCAST_BYTES = 64 << 20
#: Bytes of rows, about, that a Python worker gets at once.
BATCH_BYTES = 8 << 20

_stored: dict[str, SparkSession] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(column: Column | str) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(column, UPPER, UPPER.lower())


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where the session has none, a temporary folder is set if all runs on this machine
    (a local master, as in tests); on a cluster that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="verbarium-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder, removed when the driver exits."""
    path = f"{shared_dir(spark)}/verbarium/{name}-{uuid.uuid4().hex}"
    if not _stored:
        atexit.register(_drop_all)
    _stored[path] = spark
    return path


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query are deleted when it ends, for steps that store what later ones read."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def in_batches(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` with batches of about BATCH_BYTES, so that long texts don't fill an executor's memory."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def drop(df: DataFrame) -> None:
    """Delete what ``store`` wrote for ``df``; nothing may read it afterwards."""
    path = getattr(df, "_stored_at", None)
    if path:
        _delete(df.sparkSession, path)
        _stored.pop(path, None)


def stored() -> set[str]:
    """The folders written so far and not dropped."""
    return set(_stored)


def drop_since(before: set[str], *kept: DataFrame) -> None:
    """Delete what was stored since ``before = stored()``, but for the stored tables ``kept``."""
    stays = {getattr(df, "_stored_at", None) for df in kept}
    for path in [p for p in _stored if p not in before and p not in stays]:
        _delete(_stored.pop(path), path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def _drop_all() -> None:
    for path, spark in list(_stored.items()):
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001 - the session may be gone at exit
            return


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows and BROADCAST_BYTES, else as it is (a shuffle join).

    ``df`` should be cheap to count, such as columns of a stored table; its bytes are those that
    the planner knows, from the files.
    """
    stored = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if stored <= BROADCAST_BYTES and df.count() <= rows else df


def sample(df: DataFrame, key: str, rows: int, salt: int = 0) -> DataFrame:
    """The ``rows`` rows of smallest hash of ``key``, all if there are fewer.

    Rows over a cut-off that the count of all rows gives are dropped before the sort, so
    that the sort gets a few times ``rows`` whatever the input's size.
    """
    share = min(1.0, (2.0 * rows + 100) / max(1, df.count()))
    hashed = F.xxhash64(key, F.lit(salt))
    cut = int(-(2**63) + share * (2**64 - 1))
    return df.where(hashed <= F.lit(min(cut, 2**63 - 1))).orderBy(hashed).limit(rows)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
