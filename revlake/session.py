"""Session defaults: UTC, adaptive execution with skew handling, and partitions overwritten one by one."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "revlake", **conf: str) -> SparkSession:
    return SparkSession.builder.appName(app).config(map=DEFAULTS | conf).getOrCreate()
