"""The star schema on storage: Parquet tables published together, by version.

A load writes all its tables into a folder of its own and then appends one
row to the publication log. Readers look up the log, so they see either all
tables of a load or none, and a load that dies half-way leaves the published
version as it was. Loads may overlap: each claims the number after the version
it was built on, one of them gets it, and the others build on the winner's tables.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession

from almacen import schemas
from almacen.model import DIMENSIONS, FACT_TABLE, STAR_TABLES
from almacen.operators.facts import gapless_ids
from almacen.operators.joins import fits
from almacen.sources.passes import write_in_passes

_LOG_SCHEMA = "version int, folder string, filas map<string, bigint>"


@dataclass(frozen=True)
class Star:
    """The five tables of one published version and their row counts."""

    dim_fecha: DataFrame
    dim_region: DataFrame
    dim_cliente: DataFrame
    dim_producto: DataFrame
    fact_ventas: DataFrame
    rows: dict[str, int] = field(default_factory=dict)

    def is_small(self, name: str) -> bool:
        """Whether the table is proven to fit in a broadcast; False when its size is unknown."""
        return fits(self.rows.get(name), schemas.WAREHOUSE[name], schemas.TEXT_LENGTHS[name])

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def create_views(self) -> None:
        """Register the tables for ``spark.sql``, under their own names."""
        for name in STAR_TABLES:
            self.table(name).createOrReplaceTempView(name)


class Staging:
    """The unpublished tables of a running load."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.rows: dict[str, int] = {}

    def write(self, name: str, table: DataFrame) -> DataFrame:
        """Write the table, note its row count and return it read back."""
        return self.write_parts(name, iter([table]))

    def write_parts(self, name: str, parts: Iterator[DataFrame]) -> DataFrame:
        """``write`` for a table in parts, which are written one after the other."""
        write_in_passes(parts, f"{self.folder}/{name}")
        stored = self.read(name)
        self.rows[name] = stored.count()  # answered from the file footers
        return stored

    def is_small(self, name: str) -> bool:
        return fits(self.rows.get(name), schemas.WAREHOUSE[name], schemas.TEXT_LENGTHS[name])

    def dimensions(self) -> dict[str, DataFrame]:
        return {d.table: self.read(d.table) for d in DIMENSIONS}

    def star(self) -> Star:
        counts = {name: self.rows[name] for name in STAR_TABLES}
        return Star(**{name: self.read(name) for name in STAR_TABLES}, rows=counts)

    def read(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.folder}/{name}", name)


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    schema = schemas.WAREHOUSE.get(name)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _log(self) -> DataFrame:
        log = self.spark.read.schema(_LOG_SCHEMA).json(f"{self.root}/published")
        return log.filter("version is not null")  # a number is claimed before its row is there

    def _published(self, version: int | None) -> Row | None:
        try:
            log = self._log()
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        if version is not None:
            log = log.filter(log.version == version)
        return log.orderBy(log.version.desc()).first()

    def version(self) -> int:
        """The number of the latest published version, 0 before the first."""
        latest = self._published(None)
        return latest.version if latest else 0

    def read(self, version: int | None = None) -> Star | None:
        """The tables of a version (the latest by default); None when there is none."""
        entry = self._published(version)
        if entry is None:
            return None
        folder = f"{self.root}/{entry.folder}"
        tables = {n: read_table(self.spark, f"{folder}/{n}", n) for n in STAR_TABLES}
        tables[FACT_TABLE] = gapless_ids(tables[FACT_TABLE])
        return Star(**tables, rows=dict(entry.filas or {}))

    def stage(self) -> Staging:
        return Staging(self.spark, f"{self.root}/loads/{uuid.uuid4().hex}")

    def publish(self, staging: Staging, after: int | None = None) -> int:
        """Append a version to the log and return its number.

        The number is claimed by creating its log file, which only one loader can. A load
        that merged its dimensions with version ``after`` may only become the next one:
        if another load has taken that number, PublishConflict says so.
        """
        version = (self.version() if after is None else after) + 1
        folder = staging.folder[len(self.root) + 1 :]
        counts = {name: staging.rows[name] for name in STAR_TABLES}
        entry = json.dumps({"version": version, "folder": folder, "filas": counts})
        if version <= self.version():
            raise PublishConflict(version)
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/published/version-{version:08}.json")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        try:
            out = files.create(path, False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.toString():
                raise PublishConflict(version) from error
            raise
        out.write(bytearray(f"{entry}\n".encode()))
        out.close()
        return version

    def orphans(self) -> list[str]:
        """Folders of loads that were never published: failed ones and those still running."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/loads")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        found = [f"loads/{status.getPath().getName()}" for status in files.listStatus(path)]
        known = {r.folder for r in self._log().select("folder").collect()} if self.version() else set()
        return sorted(f"{self.root}/{folder}" for folder in found if folder not in known)


class PublishConflict(Exception):
    """Another load has published the version that this one was to become."""

    def __init__(self, version: int):
        super().__init__(f"version {version} was published by another load")
        self.version = version
