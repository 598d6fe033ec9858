"""The star-schema load: dimensions, ids, fact, constraints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almacen.checks import mapping
from almacen.checks import oracle_parts as o
from almacen.checks.derived import Derived
from almacen.checks.mapping import table
from almacen.checks.registry import check
from almacen.model import (
    DIM_CLIENTE,
    DIM_FECHA,
    DIM_PRODUCTO,
    DIM_REGION,
    DIMENSIONS,
    STAR_TABLES,
    Dimension,
)
from almacen.operators import constraints, dimensions, facts, profiling
from almacen.plans import star_load
from almacen.schemas import MEASURE_TYPES
from almacen.sources.warehouse import Star


def _keys(df: DataFrame, d: Dimension, *columns) -> DataFrame:
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in d.natural_key])
    return df.select(F.lit(d.table).alias("dimension"), *columns, key.alias("clave"))


def _union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _with_region(d: Derived) -> DataFrame:
    sales = facts.day_grain(d.tidy)
    return dimensions.lookup_id(sales, d.star.dim_region, DIM_REGION, d.star.is_small("dim_region"))


def _with_ids(sales: DataFrame, star: Star) -> DataFrame:
    for dimension in (DIM_REGION, DIM_CLIENTE, DIM_PRODUCTO, DIM_FECHA):
        table_, small = star.table(dimension.table), star.is_small(dimension.table)
        sales = dimensions.lookup_id(sales, table_, dimension, small)
    return sales


_KEY_SQL = {
    "dim_region": "ciudad || '|' || pais",
    "dim_cliente": "tipo_cliente || '|' || segmento_cliente || '|' || tipo_venta || '|' || id_region",
    "dim_producto": "producto || '|' || tipo_producto",
    "dim_fecha": "strftime(fecha, '%Y-%m-%d')",
}
_ALL_KEYS = " union all ".join(
    f"select '{t}' as dimension, {key} as clave from {t}" for t, key in _KEY_SQL.items()
)
_ALL_IDS = " union all ".join(
    f"select '{d.table}' as dimension, cast({d.id_column} as bigint) as id, "
    f"{_KEY_SQL[d.table]} as clave from {d.table}"
    for d in DIMENSIONS
)


@check("s04_dimension_read_back", f"with {o.DIMENSIONS} {_ALL_IDS}")
def read_back(d: Derived) -> DataFrame:
    return _union(
        _keys(d.star.table(m.table), m, F.col(m.id_column).alias("id")) for m in DIMENSIONS
    )


_FACT_SQL = """
select cast(id_fecha as bigint) as id_fecha, cast(id_producto as bigint) as id_producto,
       cast(id_cliente as bigint) as id_cliente, cast(cantidad as double) as cantidad,
       cast(precio_unitario as double) as precio_unitario, cast(descuento as double) as descuento,
       cast(costo_envio as double) as costo_envio, cast(total as double) as total
from sales
join dim_region using (ciudad, pais)
join dim_cliente using (tipo_cliente, segmento_cliente, tipo_venta, id_region)
join dim_producto using (producto, tipo_producto)
join dim_fecha using (fecha)"""


@check(
    "s05_fact_reload",
    f"with {o.DIMENSIONS} {_FACT_SQL} where fecha >= date '{mapping.RECENT}'",
)
def fact_reload(d: Derived) -> DataFrame:
    """The fact after a second load holds that load's sales only."""
    return d.reloaded.fact_ventas.drop("id_venta")


@check("d01_dimension_members", f"with {o.DIMENSIONS} {_ALL_KEYS}")
def members(d: Derived) -> DataFrame:
    sales = _with_region(d)
    return _union(_keys(dimensions.members(sales, m), m) for m in DIMENSIONS)


_OLDER = "(select * from sales where fecha < date '%s')" % mapping.RECENT
_CLIENTE = ["tipo_cliente", "segmento_cliente", "tipo_venta", "id_region"]


def _grown(name: str, id_column: str, keys: list[str], old: str, every: str) -> str:
    """A dimension loaded from the rows ``old`` and then from ``every``: new members follow."""
    named = ", ".join(keys)
    late = f"(select distinct {named} from {every} e anti join older_{name} using ({named})) n"
    return ", ".join(
        [
            o.numbered(f"older_{name}", id_column, keys, old),
            o.numbered(f"late_{name}", id_column, keys, late, f"(select max({id_column}) from older_{name})"),
            f"""grown_{name} as (
                select * from older_{name} union all by name select * from late_{name})""",
        ]
    )


_PLACED = "%s p join grown_dim_region using (ciudad, pais)"
_GROWN_SQL = f"""
with {o.SALES},
{_grown("dim_region", "id_region", ["ciudad", "pais"], _OLDER + " s", "sales")},
{_grown("dim_cliente", "id_cliente", _CLIENTE, _PLACED % _OLDER, f"(select * from {_PLACED % 'sales'})")},
{_grown("dim_producto", "id_producto", ["producto", "tipo_producto"], _OLDER + " s", "sales")},
{_grown("dim_fecha", "id_fecha", ["fecha"], _OLDER + " s", "sales")}
""" + " union all ".join(
    f"select '{d.table}' as dimension, cast({d.id_column} as bigint) as id, "
    f"{_KEY_SQL[d.table]} as clave from grown_{d.table}"
    for d in DIMENSIONS
)


@check("d02_insert_if_absent", _GROWN_SQL)
def grown(d: Derived) -> DataFrame:
    """Loaded with the older sales, then with all: old ids stay, new ones follow."""
    return _union(
        _keys(d.grown.table(m.table), m, F.col(m.id_column).alias("id"))
        for m in DIMENSIONS
    )


@check(
    "d03_surrogate_ids",
    f"""with {o.numbered("parts", "id_producto", ["producto", "tipo_producto"],
                         "(select p_name as producto, p_type as tipo_producto from part)")}
        select cast(id_producto as bigint) as id_producto, producto, tipo_producto from parts""",
)
def ids(d: Derived) -> DataFrame:
    parts = table(d.spark, d.sf_dir, "part").select(
        F.col("p_name").alias("producto"), F.col("p_type").alias("tipo_producto")
    )
    return dimensions.assign_ids(dimensions.members(parts, DIM_PRODUCTO), DIM_PRODUCTO)


@check(
    "d04_constraint_checks",
    """
select 'part' as tabla, 'unique(p_name,p_type)' as restriccion, p_name || '|' || p_type as clave,
       count(*) as filas
from part group by p_name, p_type having count(*) > 1
union all
select 'lineitem', 'foreign_key(l_partkey)', cast(l_partkey as varchar), count(*)
from lineitem where l_partkey not in (select p_partkey from part where p_size <= 45)
group by l_partkey
union all
select 'orders', 'not_null(o_orderpriority)', '', count(*)
from orders where o_orderpriority = '4-NOT SPECIFIED' having count(*) > 0
union all
select 'orders', 'length(o_orderpriority)', '', count(*)
from orders where o_orderpriority <> '4-NOT SPECIFIED' and length(o_orderpriority) > 6
having count(*) > 0""",
)
def violations(d: Derived) -> DataFrame:
    part = table(d.spark, d.sf_dir, "part")
    items = table(d.spark, d.sf_dir, "lineitem")
    orders = table(d.spark, d.sf_dir, "orders").select(
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("o_orderpriority")
    )
    parents = part.filter("p_size <= 45")
    return constraints.union(
        [
            constraints.not_unique(part, "part", ["p_name", "p_type"]),
            constraints.orphans(items, "lineitem", "l_partkey", parents, "p_partkey"),
            constraints.column_checks(
                orders, "orders", ["o_orderpriority"], {"o_orderpriority": 6}
            ),
        ]
    )


@check(
    "d04b_star_constraints",
    "select '' as tabla, '' as restriccion, '' as clave, count(*) as filas from region having false",
)
def star_holds(d: Derived) -> DataFrame:
    """The loaded star breaks none of its constraints: no rows."""
    return constraints.star_violations(d.star)


@check(
    "d05_column_defaults",
    f"""with {o.SALES} select cast(descuento as double) as descuento,
        cast(0 as bigint) as costo_envio, cast(total as double) as total from sales""",
)
def column_defaults(d: Derived) -> DataFrame:
    rows = facts.default_columns(d.tidy.drop("costo_envio"))
    return rows.select("descuento", "costo_envio", "total")


@check(
    "d06_key_lookup",
    f"""with {o.DIMENSIONS}
select cast(id_region as bigint) as id_region, cast(id_cliente as bigint) as id_cliente,
       cast(id_producto as bigint) as id_producto, cast(id_fecha as bigint) as id_fecha,
       cast(cantidad as double) as cantidad, cast(total as double) as total
from sales
left join dim_region using (ciudad, pais)
left join dim_cliente using (tipo_cliente, segmento_cliente, tipo_venta, id_region)
left join dim_producto using (producto, tipo_producto)
left join dim_fecha using (fecha)""",
)
def lookups(d: Derived) -> DataFrame:
    return _with_ids(facts.day_grain(d.tidy), d.star).select(
        "id_region", "id_cliente", "id_producto", "id_fecha", "cantidad", "total"
    )


@check(
    "d07_day_grain",
    f"""with {o.DIMENSIONS}
select cast(id_fecha as bigint) as id_fecha, count(*) as filas,
       sum(cast(cantidad as bigint))::bigint as unidades
from sales join dim_fecha using (fecha) group by id_fecha""",
)
def day_grain(d: Derived) -> DataFrame:
    """Sales with a time of day find the calendar row of their day."""
    hours = F.least(F.col("cantidad"), F.lit(23)).cast("int")
    later = d.tidy.withColumn("fecha", F.col("fecha") + F.make_dt_interval(F.lit(0), hours))
    found = dimensions.lookup_id(facts.day_grain(later), d.star.dim_fecha, DIM_FECHA)
    return found.groupBy("id_fecha").agg(
        F.count(F.lit(1)).alias("filas"), F.sum(F.col("cantidad").cast("long")).alias("unidades")
    )


@check("d08_fact_build", f"with {o.DIMENSIONS} {_FACT_SQL} where descuento <> 0.05")
def fact_build(d: Derived) -> DataFrame:
    """A sale with a null measure gives no fact row."""
    gaps = d.tidy.withColumn(
        "descuento", F.when(F.col("descuento") != 0.05, F.col("descuento"))
    )
    return facts.fact_rows(_with_ids(facts.day_grain(gaps), d.star))


_ARRIVED_COUNTS = """
select 'dim_region' as tabla, count(distinct (ciudad, pais)) as filas from accepted
union all
select 'dim_cliente', count(distinct (tipo_cliente, segmento_cliente, tipo_venta, ciudad, pais))
from accepted
union all
select 'dim_producto', count(distinct (producto, tipo_producto)) from accepted
union all
select 'dim_fecha', count(distinct fecha) from accepted
union all
select 'fact_ventas', count(*) from accepted"""


@check("d09_load_pipeline", f"with {o.UP_TO_ACCEPTED} {_ARRIVED_COUNTS}")
def load_pipeline(d: Derived) -> DataFrame:
    """Rows of each table after raw file, cleaning and load."""
    return _union(
        d.cleaned_star.table(t).select(F.lit(t).alias("tabla")).groupBy("tabla").agg(
            F.count(F.lit(1)).alias("filas")
        )
        for t in STAR_TABLES
    )


@check(
    "d09b_loaded_sales",
    f"""with {o.UP_TO_ACCEPTED}
select {o.DAY} as fecha, producto, tipo_producto, tipo_cliente, segmento_cliente, tipo_venta,
       ciudad, pais, cantidad, precio_unitario, descuento, costo_envio, total from accepted""",
)
def loaded_sales(d: Derived) -> DataFrame:
    """Every sale of the raw file as the star gives it back."""
    star = d.cleaned_star
    # Products first: if they are too many to broadcast, only ids and measures are shuffled.
    rows = star.fact_ventas.drop("id_venta").join(star.dim_producto, "id_producto")
    rows = rows.join(star.dim_cliente, "id_cliente").join(star.dim_region, "id_region")
    rows = rows.join(star.dim_fecha, "id_fecha")
    customer = ("tipo_cliente", "segmento_cliente", "tipo_venta")
    return rows.select(
        *MEASURE_TYPES, *customer, "ciudad", "pais", "producto", "tipo_producto", "fecha"
    )


@check(
    "d10_fact_row_id",
    """select count(*) as filas, count(*) as distintas, cast(0 as bigint) as nulas,
              cast(1 as bigint) as minimo, count(*) as maximo from lineitem""",
)
def row_ids(d: Derived) -> DataFrame:
    return d.star.fact_ventas.groupBy("id_venta").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("filas"),
        F.count("id_venta").alias("distintas"),
        F.count_if(F.col("id_venta").isNull()).alias("nulas"),
        F.min("id_venta").alias("minimo"),
        F.max("id_venta").alias("maximo"),
    )


@check(
    "d11_load_region",
    f"""with {o.DIMENSIONS}
        select cast(id_region as bigint) as id_region, ciudad, pais from dim_region""",
)
def dim_region(d: Derived) -> DataFrame:
    return d.star.dim_region


@check(
    "d12_load_cliente",
    f"""with {o.DIMENSIONS}
        select cast(id_cliente as bigint) as id_cliente, tipo_cliente, segmento_cliente, tipo_venta,
               cast(id_region as bigint) as id_region from dim_cliente""",
)
def dim_cliente(d: Derived) -> DataFrame:
    return d.star.dim_cliente


@check(
    "d13_load_producto",
    f"""with {o.DIMENSIONS}
        select cast(id_producto as bigint) as id_producto, producto, tipo_producto
        from dim_producto""",
)
def dim_producto(d: Derived) -> DataFrame:
    return d.star.dim_producto


@check(
    "d14_load_fecha",
    f"""with {o.DIMENSIONS}
        select cast(id_fecha as bigint) as id_fecha, {o.DAY} as fecha,
               cast(year(fecha) as bigint) as year, cast(month(fecha) as bigint) as month,
               strftime(fecha, '%Y-%m') as year_month from dim_fecha""",
)
def dim_fecha(d: Derived) -> DataFrame:
    return d.star.dim_fecha


@check(
    "m01b_load_audit",
    f"""with {o.UP_TO_ARRIVED}
        select {o.REASON} as motivo, count(*) as filas from arrived
        where {o.REASON} is not null group by all""",
)
def load_audit(d: Derived) -> DataFrame:
    return profiling.load_audit(star_load.rejected(d.cleaned, d.cleaned_star))


@check(
    "m06_unique_members",
    f"with {o.DIMENSIONS} select dimension, count(*) as miembros from ({_ALL_KEYS}) k group by all",
)
def unique_members(d: Derived) -> DataFrame:
    return profiling.unique_members(_with_region(d), DIMENSIONS)
