"""SparkSession with the settings that results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "quarrylake", **conf: str) -> SparkSession:
    """A session in UTC with ANSI semantics and adaptive execution; ``conf`` overrides (dots as ``__``)."""
    builder = SparkSession.builder.appName(name)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    return builder.config(map=settings).getOrCreate()
