"""The SQL features the reports are made of, one small query each, over the star.

Those with an id shared by many sales sum by it first, as the reports do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almacen.checks import mapping
from almacen.checks import oracle_parts as o
from almacen.checks.derived import Derived
from almacen.checks.registry import check
from almacen.functions.numbers import mean_2dp, percent_2dp
from almacen.model import DIM_CLIENTE, DIM_FECHA, DIM_PRODUCTO, DIM_REGION
from almacen.plans import reports

_VENTAS = o.number("sum(total)", "ventas")
_FILAS = o.whole("count(*)", "filas")


def _sales(select: str) -> str:
    return f"with {o.SALES} {select}"


def _by_channel(d: Derived) -> DataFrame:
    """Sales and rows of each sales channel."""
    sums = d.star.fact_ventas.groupBy("id_cliente").agg(reports.total_of(), reports.rows_of())
    return (
        reports.label(sums, d.star, DIM_CLIENTE, "tipo_venta")
        .groupBy("tipo_venta")
        .agg(F.sum("total").alias("ventas"), F.sum("n").alias("filas"))
    )


def _by_city(d: Derived) -> DataFrame:
    sums = reports.sums_by_place(d.star, ["pais", "ciudad"], reports.total_of(), reports.rows_of())
    return sums.groupBy("pais", "ciudad").agg(
        F.sum("total").alias("ventas"), F.sum("n").alias("filas")
    )


@check(
    "b01_inner_join",
    _sales(
        """select pais, ciudad, producto, tipo_producto, strftime(fecha, '%Y-%m-%d') as fecha,
                  cast(total as double) as total from sales"""
    ),
)
def inner_join(d: Derived) -> DataFrame:
    rows = d.star.fact_ventas.select("id_cliente", "id_producto", "id_fecha", "total")
    rows = reports.label(rows, d.star, DIM_CLIENTE, "id_region")
    rows = reports.label(rows, d.star, DIM_REGION, "pais", "ciudad")
    rows = reports.label(rows, d.star, DIM_PRODUCTO, "producto", "tipo_producto")
    rows = reports.label(rows, d.star, DIM_FECHA, "fecha")
    return rows.select("pais", "ciudad", "producto", "tipo_producto", "fecha", "total")


@check(
    "b02_anti_join",
    _sales(
        f"""select distinct producto, tipo_producto from sales
            except select producto, tipo_producto from sales
            where fecha >= date '{mapping.RECENT}'"""
    ),
)
def anti_join(d: Derived) -> DataFrame:
    sold = d.reloaded.fact_ventas.select("id_producto").dropDuplicates()
    unsold = d.reloaded.dim_producto.join(sold, "id_producto", "left_anti")
    return unsold.select("producto", "tipo_producto")


@check(
    "b03_count_sum_avg",
    _sales(f"select {_FILAS}, {_VENTAS}, {o.mean('sum(total)', 'count(*)')} as media from sales"),
)
def count_sum_avg(d: Derived) -> DataFrame:
    sums = d.star.fact_ventas.agg(
        F.count(F.lit(1)).alias("filas"), F.sum("total").alias("ventas")
    )
    return sums.withColumn("media", mean_2dp(F.col("ventas"), F.col("filas")))


@check(
    "b04_group_by", _sales(f"select tipo_venta, {_VENTAS}, {_FILAS} from sales group by tipo_venta")
)
def group_by(d: Derived) -> DataFrame:
    return _by_channel(d)


@check(
    "b05_group_by_expression",
    _sales(f"select cantidad >= 25 as grande, {_VENTAS}, {_FILAS} from sales group by 1"),
)
def group_by_expression(d: Derived) -> DataFrame:
    return d.star.fact_ventas.groupBy((F.col("cantidad") >= 25).alias("grande")).agg(
        F.sum("total").alias("ventas"), F.count(F.lit(1)).alias("filas")
    )


@check(
    "b06_rollup",
    _sales(
        f"""select pais, ciudad, {_VENTAS}, cast(grouping_id(pais, ciudad) as bigint) as nivel
            from sales group by rollup (pais, ciudad)"""
    ),
)
def rollup(d: Derived) -> DataFrame:
    return (
        _by_city(d)
        .rollup("pais", "ciudad")
        .agg(F.sum("ventas").alias("ventas"), F.grouping_id().alias("nivel"))
    )


@check(
    "b07_dense_rank",
    _sales(
        f"""select pais, ciudad, {_FILAS},
                   cast(dense_rank() over (partition by pais order by count(*) desc) as bigint)
                     as puesto
            from sales group by pais, ciudad"""
    ),
)
def dense_rank(d: Derived) -> DataFrame:
    by_rows = Window.partitionBy("pais").orderBy(F.desc("filas"))
    return _by_city(d).select(
        "pais", "ciudad", "filas", F.dense_rank().over(by_rows).alias("puesto")
    )


@check(
    "b08_row_number",
    _sales(
        f"""select pais, ciudad, {_VENTAS},
                   row_number() over (partition by pais order by sum(total) desc, ciudad) as n
            from sales group by pais, ciudad"""
    ),
)
def row_number(d: Derived) -> DataFrame:
    by_sales = Window.partitionBy("pais").orderBy(F.desc("ventas"), "ciudad")
    return _by_city(d).select("pais", "ciudad", "ventas", F.row_number().over(by_sales).alias("n"))


def _months(d: Derived) -> DataFrame:
    return reports.sums_by_period(d.star, "year", "year_month").withColumnRenamed("total", "ventas")


_MONTHS = "(select year, year_month, sum(total) as ventas from sales group by all) m"


@check(
    "b09_lag",
    _sales(
        f"""select year_month, cast(ventas as double) as ventas,
                   cast(lag(ventas) over (order by year_month) as double) as anterior
            from {_MONTHS}"""
    ),
)
def lag(d: Derived) -> DataFrame:
    previous = F.lag("ventas").over(Window.orderBy("year_month"))
    return _months(d).select("year_month", "ventas", previous.alias("anterior"))


@check(
    "b10_window_total",
    _sales(
        f"""select tipo_venta, {_VENTAS},
                   cast(sum(sum(total)) over () as double) as todas
            from sales group by tipo_venta"""
    ),
)
def window_total(d: Derived) -> DataFrame:
    everything = F.sum("ventas").over(Window.partitionBy())
    return _by_channel(d).select("tipo_venta", "ventas", everything.alias("todas"))


@check(
    "b11_running_sum",
    _sales(
        f"""select year_month, cast(ventas as double) as ventas,
                   cast(sum(ventas) over (partition by year order by year_month) as double)
                     as acumulado
            from {_MONTHS}"""
    ),
)
def running_sum(d: Derived) -> DataFrame:
    so_far = Window.partitionBy("year").orderBy("year_month")
    return _months(d).select(
        "year_month", "ventas", F.sum("ventas").over(so_far).alias("acumulado")
    )


@check(
    "b12_moving_average",
    _sales(
        f"""select fecha, cast(ventas as double) as ventas,
                   {o.mean("(sum(ventas) over w)", "(count(*) over w)")} as media
            from (select {o.DAY} as fecha, year_month, sum(total) as ventas from sales group by all) f
            window w as (partition by year_month order by fecha
                         rows between 6 preceding and current row)"""
    ),
)
def moving_average(d: Derived) -> DataFrame:
    week = Window.partitionBy("year_month").orderBy("fecha").rowsBetween(-6, 0)
    days = reports.sums_by_period(d.star, "fecha", "year_month")
    media = mean_2dp(F.sum("total").over(week), F.count("total").over(week))
    return days.select("fecha", F.col("total").alias("ventas"), media.alias("media"))


@check(
    "b13_window_over_aggregate",
    _sales(
        f"""select tipo_venta, {_FILAS}, cast(rank() over (order by count(*) desc) as bigint) as puesto
            from sales group by tipo_venta"""
    ),
)
def window_over_aggregate(d: Derived) -> DataFrame:
    puesto = F.rank().over(Window.orderBy(F.desc("filas")))
    return _by_channel(d).select("tipo_venta", "filas", puesto.alias("puesto"))


@check(
    "b14_order_by",
    _sales(f"select pais, ciudad, {_VENTAS} from sales group by pais, ciudad order by 1, 3 desc"),
)
def order_by(d: Derived) -> DataFrame:
    return _by_city(d).select("pais", "ciudad", "ventas").orderBy("pais", F.desc("ventas"))


@check(
    "b15_nulls_last",
    _sales(
        f"select pais, {_FILAS} from sales group by rollup (pais) order by pais nulls last"
    ),
)
def nulls_last(d: Derived) -> DataFrame:
    levels = _by_city(d).rollup("pais").agg(F.sum("filas").alias("filas"))
    return levels.orderBy(F.asc_nulls_last("pais"))


@check(
    "b16_limit",
    _sales(
        f"select ciudad, {_VENTAS} from sales group by ciudad order by sum(total) desc, ciudad limit 3"
    ),
)
def top_k(d: Derived) -> DataFrame:
    cities = _by_city(d).select("ciudad", "ventas")
    return cities.orderBy(F.desc("ventas"), "ciudad").limit(3)


@check(
    "b17_cte",
    _sales(
        f"""select tipo_cliente, {_VENTAS} from sales group by tipo_cliente
            having sum(total) > (select sum(total) / count(distinct tipo_cliente) from sales)"""
    ),
)
def cte(d: Derived) -> DataFrame:
    return d.spark.sql(
        """
        with by_id as (select id_cliente, sum(total) as total from {fact} group by id_cliente),
             by_type as (
               select tipo_cliente, sum(total) as ventas
               from by_id join {cliente} using (id_cliente) group by tipo_cliente)
        select tipo_cliente, ventas from by_type where ventas > (select avg(ventas) from by_type)
        """,
        fact=d.star.fact_ventas,
        cliente=d.star.dim_cliente,
    )


@check(
    "b18_derived_table",
    _sales(f"select max(ventas)::double as mejor, min(ventas)::double as peor from {_MONTHS}"),
)
def derived_table(d: Derived) -> DataFrame:
    return d.spark.sql(
        """
        select max(ventas) as mejor, min(ventas) as peor
        from (select year_month, sum(total) as ventas
              from (select id_fecha, sum(total) as total from {fact} group by id_fecha)
              join {fecha} using (id_fecha) group by year_month)
        """,
        fact=d.star.fact_ventas,
        fecha=d.star.dim_fecha,
    )


@check(
    "b19_case_when",
    _sales(
        f"""select case when total >= 75000 then 'alta' when total >= 25000 then 'media'
                        else 'baja' end as banda, {_FILAS}
            from sales group by 1"""
    ),
)
def case_when(d: Derived) -> DataFrame:
    band = F.when(F.col("total") >= 75000, "alta").when(F.col("total") >= 25000, "media")
    return d.star.fact_ventas.groupBy(band.otherwise("baja").alias("banda")).agg(
        F.count(F.lit(1)).alias("filas")
    )


@check(
    "b20_coalesce_nullif",
    _sales(
        f"""select coalesce(nullif(tipo_venta, '4-NOT SPECIFIED'), 'Desconocido') as canal, {_FILAS}
            from sales group by 1"""
    ),
)
def coalesce_nullif(d: Derived) -> DataFrame:
    known = F.nullif(F.col("tipo_venta"), F.lit("4-NOT SPECIFIED"))
    return _by_channel(d).select(F.coalesce(known, F.lit("Desconocido")).alias("canal"), "filas")


@check(
    "b21_round",
    _sales(
        """select cast(round(total, 1) as double) as total, cast(round(costo_envio, 0) as double)
                  as costo_envio from sales"""
    ),
)
def rounding(d: Derived) -> DataFrame:
    return d.star.fact_ventas.select(
        F.round("total", 1).alias("total"), F.round("costo_envio", 0).alias("costo_envio")
    )


@check(
    "b22_decimal_arithmetic",
    _sales(
        f"""select tipo_venta, cast(sum(total) - sum(costo_envio) as double) as neto,
                   cast(sum(total * 2 + costo_envio) as double) as doble,
                   {o.percent("sum(total) - sum(costo_envio)", "sum(total)")} as parte
            from sales group by tipo_venta"""
    ),
)
def decimal_arithmetic(d: Derived) -> DataFrame:
    sums = d.star.fact_ventas.groupBy("id_cliente").agg(
        F.sum("total").alias("total"), F.sum("costo_envio").alias("envio")
    )
    total, shipping = F.sum("total"), F.sum("envio")
    return (
        reports.label(sums, d.star, DIM_CLIENTE, "tipo_venta")
        .groupBy("tipo_venta")
        .agg(
            (total - shipping).alias("neto"),
            (total * 2 + shipping).alias("doble"),
            percent_2dp(total - shipping, total).alias("parte"),
        )
    )


@check(
    "b23_filter",
    _sales(
        """select cast(total as double) as total, cast(cantidad as double) as cantidad from sales
           where total > 90000 and descuento < 0.05"""
    ),
)
def comparison(d: Derived) -> DataFrame:
    # the literals carry the columns' types, so both tests reach the Parquet scan
    rows = d.star.fact_ventas.filter(
        (F.col("total") > F.lit("90000").cast("decimal(14,2)"))
        & (F.col("descuento") < F.lit("0.05").cast("decimal(5,2)"))
    )
    return rows.select("total", "cantidad")


@check("b24_alias", _sales("select pais as country, ciudad as city from sales group by all"))
def alias(d: Derived) -> DataFrame:
    return d.star.dim_region.select(F.col("pais").alias("country"), F.col("ciudad").alias("city"))
