"""Folders that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, removed when the driver exits.

    A temporary folder is set only where the session has none and all runs on this machine, as in tests.
    """
    home = spark.conf.get("spark.checkpoint.dir", None)
    if not home:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        home = tempfile.mkdtemp(prefix="verbarium-")
        spark.conf.set("spark.checkpoint.dir", home)
    path = f"{home.rstrip('/')}/verbarium-{name}-{uuid.uuid4().hex}"

    def remove() -> None:
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
        except Exception:  # noqa: BLE001 - the session may be gone at exit
            return

    atexit.register(remove)
    return path
