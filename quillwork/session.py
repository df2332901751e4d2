"""Sessions with the settings that the engine assumes."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "quillwork", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; conf overrides anything."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    return builder.config(map=settings).getOrCreate()
