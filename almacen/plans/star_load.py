"""The star-schema load: clean sales in, a published warehouse version out."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almacen import schemas
from almacen.model import DIM_CLIENTE, DIM_FECHA, DIM_PRODUCTO, DIM_REGION, FACT_TABLE
from almacen.operators import boundary, constraints, dimensions, facts
from almacen.operators.joins import fits, join_dimension
from almacen.sources import files, passes
from almacen.sources.warehouse import PublishConflict, Star, Staging, Warehouse
from almacen.sources.workspace import shared_folder

# A customer profile by its labels: the dimension's key with the region spelled out.
_PROFILE = ["tipo_cliente", "segmento_cliente", "tipo_venta", "ciudad", "pais"]
_PROFILE_LENGTHS = schemas.TEXT_LENGTHS["dim_cliente"] | schemas.TEXT_LENGTHS["dim_region"]
# Sales that are joined at once with dimensions too large to broadcast; more are joined in passes.
PASS_SALES = 20_000_000


@dataclass(frozen=True)
class LoadResult:
    """The published version, the rows of its tables, the sales read, and those left out by stage."""

    version: int
    rows: dict[str, int]
    read: int = 0
    left_out: dict[str, int] = field(default_factory=dict)


def incoming(clean: DataFrame) -> DataFrame:
    """Clean sales as the load takes them, incomplete rows included, dates at day grain.

    Dates carry the calendar parts of the clean file; the time of day is dropped,
    so a sale with one keeps its calendar row instead of losing its fact row.
    """
    return (
        clean.transform(boundary.require_columns)
        .transform(boundary.blank_tokens_to_null)
        .transform(boundary.type_clean_columns)
        .transform(facts.default_columns)
        .transform(facts.day_grain)
    )


def _distinct_keys(sales: DataFrame) -> DataFrame:
    """The distinct profiles, products and dates of the sales, told apart by ``kind``.

    One pass over the sales finds the members of all dimensions: the three
    groupings are aggregated side by side and collapse on the map side.
    """
    calendar = [*DIM_FECHA.natural_key, *DIM_FECHA.attributes]
    product = list(DIM_PRODUCTO.natural_key)
    groups = sales.groupingSets([_PROFILE, product, calendar], *_PROFILE, *product, *calendar)
    kind = F.when(F.grouping("ciudad") == 0, "profile").when(F.grouping("producto") == 0, "product")
    return groups.agg(kind.otherwise("date").alias("kind"), F.count(F.lit(1)).alias("ventas"))


def _load_profiles(profiles: DataFrame, existing: Star | None, staging: Staging) -> DataFrame:
    """Write dim_region and dim_cliente; return the profile labels with their id_cliente.

    Both come from the profiles, so the sales are joined once for the two.
    """
    with_region = dimensions.load_dimension(
        profiles, existing and existing.dim_region, DIM_REGION, staging
    )
    with_both = dimensions.load_dimension(
        with_region, existing and existing.dim_cliente, DIM_CLIENTE, staging
    )
    return staging.write("profile_ids", with_both.select(*_PROFILE, "id_cliente"))


def _few_profiles(profile_ids: DataFrame, staging: Staging) -> bool:
    return fits(staging.rows["profile_ids"], profile_ids.schema, _PROFILE_LENGTHS)


def with_ids(sales: DataFrame, existing: Star | None, staging: Staging) -> DataFrame:
    """Load the four dimensions and add their ids to the sales."""
    keys = staging.write("keys", _distinct_keys(sales))
    profiles = keys.filter(keys.kind == "profile").select(*_PROFILE)
    profile_ids = _load_profiles(profiles, existing, staging)
    identified = join_dimension(sales, profile_ids, _PROFILE, _few_profiles(profile_ids, staging), "left")
    for kind, dimension in (("product", DIM_PRODUCTO), ("date", DIM_FECHA)):
        found = keys.filter(keys.kind == kind)
        known = existing and existing.table(dimension.table)
        table = dimensions.load_members(found, known, dimension, staging)
        small = staging.is_small(dimension.table)
        identified = dimensions.lookup_id(identified, table, dimension, small)
    return identified


def _fact_parts(identified: DataFrame, number: int, staging: Staging) -> Iterator[DataFrame]:
    """The fact in parts, each of other sales, to be written one after the other."""
    for i in range(number):
        some = identified.filter(passes.in_pass(i, number, *schemas.MEASURE_TYPES, *_PROFILE, "fecha"))
        fact = facts.fact_rows(some if number > 1 else identified)
        yield facts.number_rows(fact, first_part=facts.parts_numbered(staging.read(FACT_TABLE)) if i else 0)


def load_star(
    clean: DataFrame, warehouse: Warehouse, check_fact: bool = True, attempts: int = 5
) -> LoadResult:
    """Merge the dimensions, replace the fact, check, publish.

    ``clean`` is read twice, for the dimensions and for the fact; give it as a
    stored dataset, not as the plan that cleans it. Where a dimension is too large to
    broadcast, it is read for each further ``PASS_SALES`` sales once more. Members already
    known keep their ids and stay, also when no sale names them any more. If another load
    publishes meanwhile, this one starts again from that load's members.
    """
    for attempt in range(attempts):
        try:
            return _load_once(clean, warehouse, check_fact)
        except PublishConflict:
            if attempt == attempts - 1:
                raise
    raise ValueError("no attempts")


def _load_once(clean: DataFrame, warehouse: Warehouse, check_fact: bool) -> LoadResult:
    after = warehouse.version()
    existing = warehouse.read(after) if after else None
    staging = warehouse.stage()
    arrived = incoming(clean)
    sales = boundary.drop_incomplete(arrived)
    identified = with_ids(sales, existing, staging)
    # Before any sale is joined: a member that breaks a rule stops the load here.
    checks = constraints.dimension_violations(staging.dimensions())
    constraints.enforce(constraints.union(checks), f"{staging.folder}/violations")
    complete = staging.read("keys").filter("kind = 'date'").agg(F.sum("ventas")).first()[0] or 0
    small = _few_profiles(staging.read("profile_ids"), staging)
    small = small and all(staging.is_small(d.table) for d in (DIM_PRODUCTO, DIM_FECHA))
    number = 1 if small else passes.passes_for(complete, PASS_SALES)
    staging.write_parts(FACT_TABLE, _fact_parts(identified, number, staging))
    star = staging.star()
    if check_fact:
        # Ids come from the members just checked, so only the fact's own columns are left.
        violations = constraints.fact_column_violations(star)
        constraints.enforce(violations, f"{staging.folder}/fact_violations")
    read = clean.count()
    left_out = {"incomplete": read - complete, "null measure": complete - star.rows[FACT_TABLE]}
    return LoadResult(warehouse.publish(staging, after), star.rows, read, left_out)


def rejected(clean: DataFrame, star: Star) -> DataFrame:
    """The sales that a load of ``clean`` into ``star`` left out, each with its reason."""
    sales = incoming(clean)
    incomplete = boundary.rejected(sales)
    complete = boundary.drop_incomplete(sales)
    for dimension in (DIM_REGION, DIM_CLIENTE, DIM_PRODUCTO, DIM_FECHA):
        table, small = star.table(dimension.table), star.is_small(dimension.table)
        complete = dimensions.lookup_id(complete, table, dimension, small)
    unloaded = facts.rejected_facts(complete)
    columns = [*clean.columns, "motivo"]
    return incomplete.select(*columns).unionByName(unloaded.select(*columns))


def run_load(
    spark: SparkSession, clean_path: str, warehouse_path: str, csv: bool = False, multiline: bool = False
) -> LoadResult:
    """Load the clean dataset at ``clean_path`` into the warehouse at ``warehouse_path``.

    ``csv`` takes a clean CSV export, typed once into the session's work folder.
    """
    if csv:
        typed = boundary.type_clean_columns(files.load_clean_csv(spark, clean_path, multiline))
        clean_path = f"{shared_folder(spark)}/clean-{uuid.uuid4().hex}"
        files.export_clean(typed, clean_path)
    return load_star(spark.read.parquet(clean_path), Warehouse(spark, warehouse_path))
