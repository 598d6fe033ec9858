"""The cleaning run: raw file in, clean dataset out."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almacen.functions.dates import voted_format
from almacen.model import CleaningRules
from almacen.operators import cleaning as c
from almacen.operators import profiling
from almacen.sources import files, passes
from almacen.sources.workspace import shared_folder

RULES = c.RULES

# Text that is grouped at once; a larger file is grouped in passes.
PASS_BYTES = 1 << 30
_PASS = "_pass"


def _standardise(named: DataFrame, rules: CleaningRules) -> DataFrame:
    return (
        named.transform(c.clean_text_columns, rules)
        .transform(c.standardise_case, rules)
        .transform(c.convert_types, rules)
    )


def prepare(raw: DataFrame, rules: CleaningRules = RULES) -> DataFrame:
    """Names, text, case and types; the input of the business rules and of the audit."""
    return _standardise(c.normalise_names(raw), rules)


def kept(raw: DataFrame, rules: CleaningRules = RULES) -> DataFrame:
    """The prepared rows that pass the business rules."""
    named = raw.transform(c.normalise_names).transform(c.complete_texts, rules)
    typed_rules = replace(rules, critical=tuple(x for x in rules.critical if x not in rules.text))
    return _standardise(named, rules).transform(c.apply_business_rules, typed_rules)


def clean(raw: DataFrame, rules: CleaningRules = RULES) -> DataFrame:
    """The whole cleaning as one lazy plan with one shuffle, that of the duplicates.

    The order matters: duplicates go before defaults are filled in, so rows
    that differ only in null against default both stay; segments are given
    before a missing customer type gets its default.
    """
    return (
        kept(raw, rules)
        .transform(c.remove_duplicates)
        .transform(c.derive_columns, rules)
        .transform(c.fill_nulls, rules)
        .transform(c.order_columns, rules)
    )


def rejected(raw: DataFrame, rules: CleaningRules = RULES) -> DataFrame:
    """The rows the business rules leave out, each with its reason."""
    reason = c.rejection_reason(rules)
    return prepare(raw, rules).withColumn("motivo", reason).filter(F.col("motivo").isNotNull())


def _with_reasons(raw: DataFrame, rules: CleaningRules) -> DataFrame:
    """Every row of the file, typed, with ``motivo`` and ``celdas`` (see ``grouped``)."""
    named = c.normalise_names(raw)
    cells = F.struct(*[F.col(name) for name in named.columns]).alias("_celdas")
    typed = _standardise(named.select("*", cells), rules)
    reason = typed.withColumn("motivo", c.rejection_reason(rules))
    celdas = F.when(F.col("motivo").isNotNull(), F.col("_celdas"))
    return reason.withColumn("celdas", celdas).drop("_celdas")


def _counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copias"))


def grouped(raw: DataFrame, rules: CleaningRules = RULES) -> DataFrame:
    """Every row of the file, typed, with ``motivo``, ``celdas`` and ``copias``.

    motivo says why a row is left out and is null where it stays; celdas holds the
    cells as they were read, of rows left out only; copias counts equal rows. The
    copies collapse on the map side, so the one shuffle carries distinct rows.
    """
    return _counted(_with_reasons(raw, rules))


def _grouped_in_passes(raw: DataFrame, rules: CleaningRules, number: int) -> Iterator[DataFrame]:
    """``grouped`` in parts, to be written one after the other.

    The file is still read and cleaned once: the typed rows are written, by a hash that
    equal rows share, and each part is grouped from its own. They take a fraction of
    their shuffle, for they are compressed by column, and go when their part is written.
    """
    rows = _with_reasons(raw, rules)
    typed = [name for name in rows.columns if name != "celdas"]
    rows = rows.withColumn(_PASS, passes.pass_of(number, *typed))
    spark, path = raw.sparkSession, f"{shared_folder(raw.sparkSession)}/typed-{uuid.uuid4().hex}"
    try:
        rows.write.partitionBy(_PASS).option("compression", "zstd").parquet(path)
        stored = spark.read.schema(rows.schema).parquet(path)
        for i in range(number):
            yield _counted(stored.filter(F.col(_PASS) == i).drop(_PASS))
            passes.remove(spark, f"{path}/{_PASS}={i}")
    finally:
        passes.remove(spark, path)


@dataclass(frozen=True)
class CleaningRun:
    """What one pass over a raw file gave: every output is read from ``rows`` (see ``grouped``)."""

    rows: DataFrame
    rules: CleaningRules = RULES

    def _typed(self) -> DataFrame:
        return self.rows.filter("motivo is null").drop("motivo", "celdas", "copias")

    @property
    def clean(self) -> DataFrame:
        return (
            self._typed()
            .transform(c.derive_columns, self.rules)
            .transform(c.fill_nulls, self.rules)
            .transform(c.order_columns, self.rules)
        )

    @property
    def rejected(self) -> DataFrame:
        """The rows left out, each once with its reason, its cells as read and its copies."""
        return self.rows.filter("motivo is not null")

    @property
    def audit(self) -> DataFrame:
        """Row counts of the stages, one row: read, left out by reason, duplicates, kept."""
        return profiling.audit_of_groups(self.rows)

    @property
    def filled(self) -> DataFrame:
        """Nulls that defaults filled, by column, and nulls that remain in all others."""
        unique = c.derive_columns(self._typed(), self.rules)
        return profiling.filled_nulls(unique, self.rules.null_defaults)


def _refuse_unreadable_dates(run: CleaningRun) -> None:
    """An error where there are dates and none could be read; only for runs that kept no row."""
    date = run.rules.date
    given, read = run.rejected.agg(F.count(f"celdas.{date}"), F.count(date)).first()
    if given and not read:
        formats = ", ".join(run.rules.date_formats)
        rows = run.rejected.agg(F.sum(F.when(F.col(f"celdas.{date}").isNotNull(), F.col("copias"))))
        raise ValueError(f"all {rows.first()[0]} values of {date} are unreadable as {formats}")


def clean_once(
    spark: SparkSession,
    raw_path: str,
    run_path: str,
    rules: CleaningRules = RULES,
    multiline: bool = False,
    date_candidates: Sequence[str] | None = None,
) -> CleaningRun:
    """Read and clean the file at ``raw_path`` once, and keep every row of it at ``run_path``.

    With ``date_candidates`` all dates vote on their format first, which reads the
    file's dates once more. A file with dates of which none is readable is an error.
    More than ``PASS_BYTES`` of text is grouped in passes, one shuffle after the other.
    """
    raw = files.load_raw(spark, raw_path, multiline, rules.na_tokens)
    if date_candidates:
        winner = voted_format(c.normalise_names(raw), rules.date, date_candidates)
        rules = replace(rules, date_formats=(winner,))
    number = passes.passes_for(passes.text_bytes(spark, raw_path), PASS_BYTES)
    parts = _grouped_in_passes(raw, rules, number) if number > 1 else iter([grouped(raw, rules)])
    passes.write_in_passes(parts, run_path)
    run = CleaningRun(spark.read.parquet(run_path), rules)
    if run.rows.filter("motivo is null").isEmpty():
        _refuse_unreadable_dates(run)
    return run


def run_cleaning(
    spark: SparkSession,
    raw_path: str,
    clean_path: str,
    rules: CleaningRules = RULES,
    multiline: bool = False,
    rejected_path: str | None = None,
    run_path: str | None = None,
    date_candidates: Sequence[str] | None = None,
) -> CleaningRun:
    """Clean the file at ``raw_path`` into ``clean_path``; the run has the audit and the rejects.

    The rows of the run are kept at ``run_path``, by default in the session's work folder.
    """
    run_path = run_path or f"{shared_folder(spark)}/cleaning-{uuid.uuid4().hex}"
    run = clean_once(spark, raw_path, run_path, rules, multiline, date_candidates)
    files.export_clean(run.clean, clean_path)
    if rejected_path:
        run.rejected.write.mode("overwrite").parquet(rejected_path)
    return run
