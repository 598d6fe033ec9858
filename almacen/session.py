"""Session settings the jobs are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # HotSpot does not compile methods over 8000 bytes of bytecode. The cleaning
    # projection is larger when generated as one method; over this limit Spark
    # generates it as many small ones instead, which halves its run time.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording the Python line of every column expression costs more than the
    # planning of these queries; switch it on to debug.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder
