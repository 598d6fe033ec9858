"""Writing large tables in passes, so that what is shuffled for them never lies on disk all at once."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_COMPRESSED = r"\.(gz|bz2|zst|zstd|lz4|snappy|deflate|xz)$"
# Text holds about so many times the bytes of its compressed file.
_EXPANSION = 8


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Each job within removes its shuffle files when it ends, not when the driver happens to collect garbage.

    Meant for what runs once, such as writes: a DataFrame collected twice would shuffle twice.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def passes_for(size: int, most: int) -> int:
    """How many passes keep each at ``most``; at least one."""
    return max(1, -(-size // most))


def in_pass(number: int, passes: int, *columns: str) -> Column:
    """Whether a row belongs to a pass; rows that are equal in the columns share one."""
    return pass_of(passes, *columns) == number


def pass_of(passes: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(passes)).cast("int")


def text_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a text file or folder, about those of the text where files are compressed."""
    size = F.when(F.col("path").rlike(_COMPRESSED), F.col("length") * _EXPANSION).otherwise(F.col("length"))
    with shuffles_released(spark):
        return spark.read.format("binaryFile").load(path).agg(F.sum(size)).first()[0] or 0


def write_in_passes(parts: Iterator[DataFrame], path: str) -> None:
    """Replace the Parquet table at ``path`` by the rows of all parts, one written after the other."""
    for number, part in enumerate(parts):
        with shuffles_released(part.sparkSession):
            mode = "append" if number else "overwrite"
            part.write.mode(mode).option("compression", "zstd").parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate files."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
