"""A Spark session with the settings that the engine's results rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(master: str = "local[*]", app: str = "verbarium", **conf: str) -> SparkSession:
    """A session in UTC and ANSI mode with adaptive execution; keyword settings come on top."""
    builder = SparkSession.builder.master(master).appName(app)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in (settings | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
