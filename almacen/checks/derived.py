"""Tables the checks derive from the test tables, written once for each session.

Each is built by the library's own jobs the first time a check asks for it.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almacen.checks import mapping
from almacen.plans.cleaning_run import CleaningRun, run_cleaning
from almacen.plans.star_load import load_star
from almacen.session import SETTINGS
from almacen.sources import files, passes
from almacen.sources.warehouse import Star, Warehouse
from almacen.sources.workspace import shared_folder


# Line items that are joined at once for the raw file.
_PASS_ITEMS = 20_000_000
# Rows of a raw file, which is compressed and so read by one task.
_FILE_ROWS = 200_000


class Derived:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        # The caller's session need not come from ``session.configure``.
        limit = "spark.sql.codegen.hugeMethodLimit"
        spark.conf.set(limit, SETTINGS[limit])
        self.folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"

    @cached_property
    def tidy(self) -> DataFrame:
        """The tidy sales as a stored clean dataset."""
        path = f"{self.folder}/tidy"
        files.export_clean(mapping.tidy_sales(self.spark, self.sf_dir), path)
        return self.spark.read.parquet(path)

    @property
    def recent(self) -> DataFrame:
        return self.tidy.filter(F.col("fecha") >= mapping.RECENT)

    @cached_property
    def warehouse(self) -> Warehouse:
        """A warehouse whose version 1 holds all tidy sales."""
        warehouse = Warehouse(self.spark, f"{self.folder}/warehouse")
        load_star(self.tidy, warehouse)
        return warehouse

    @cached_property
    def star(self) -> Star:
        return self.warehouse.read(1)

    @cached_property
    def reloaded(self) -> Star:
        """The star after a second load, of the recent sales only: old members stay."""
        return self.warehouse.read(load_star(self.recent, self.warehouse).version)

    @cached_property
    def grown(self) -> Star:
        """A star loaded twice: first the older sales, then all of them."""
        warehouse = Warehouse(self.spark, f"{self.folder}/grown")
        load_star(self.tidy.filter(F.col("fecha") < mapping.RECENT), warehouse)
        return warehouse.read(load_star(self.tidy, warehouse).version)

    @cached_property
    def raw_path(self) -> str:
        """The raw file, compressed and written in passes: at any time the disk holds the joins of one."""
        path = f"{self.folder}/raw_csv"
        items = mapping.table(self.spark, self.sf_dir, "lineitem").count()
        number = passes.passes_for(items, _PASS_ITEMS)
        for i in range(number):
            with passes.shuffles_released(self.spark):
                (
                    mapping.raw_sales(self.spark, self.sf_dir, (i, number))
                    .write.mode("append")
                    .option("header", True)
                    .option("escape", '"')
                    .option("ignoreLeadingWhiteSpace", False)
                    .option("ignoreTrailingWhiteSpace", False)
                    .option("maxRecordsPerFile", _FILE_ROWS)
                    .csv(path, compression="gzip")
                )
        return path

    @property
    def raw(self) -> DataFrame:
        return files.load_raw(self.spark, self.raw_path)

    @cached_property
    def cleaning(self) -> CleaningRun:
        """The cleaning run over the raw file: clean and rejected rows and the audit."""
        return run_cleaning(self.spark, self.raw_path, f"{self.folder}/clean")

    @cached_property
    def cleaned(self) -> DataFrame:
        """The clean dataset that the cleaning run stored."""
        assert self.cleaning
        return self.spark.read.parquet(f"{self.folder}/clean")

    @cached_property
    def clean_csv_path(self) -> str:
        path = f"{self.folder}/clean_csv"
        files.export_clean_csv(self.cleaned, path, compression="gzip")
        return path

    @cached_property
    def cleaned_star(self) -> Star:
        """The star loaded from the cleaned raw file."""
        warehouse = Warehouse(self.spark, f"{self.folder}/cleaned_warehouse")
        return warehouse.read(load_star(self.cleaned, warehouse).version)


_derived: dict[tuple[str, str], Derived] = {}


def derived(spark: SparkSession, sf_dir: str) -> Derived:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _derived:
        _derived[key] = Derived(spark, sf_dir)
    return _derived[key]
