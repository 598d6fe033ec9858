"""The fourteen reports, the exploratory figures and the key figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almacen.checks import mapping
from almacen.checks import oracle_parts as o
from almacen.checks.derived import Derived
from almacen.checks.registry import check
from almacen.plans import explore, reports

_TOTAL = o.number("sum(total)", "total_sales")
_COUNT = o.whole("count(*)", "num_transactions")
_MONTHS = """
months as (select cast(year as bigint) as year, cast(month as bigint) as month, year_month,
                  sum(total) as total from sales group by all)"""


def _sales(select: str, *parts: str) -> str:
    return f"with {','.join([o.SALES, *parts])} {select}"


REPORT_SQL = {
    "q01_sales_by_region": _sales(
        f"""select pais, ciudad, {o.whole("count(*)", "total_transactions")}, {_TOTAL},
                   {o.mean("sum(total)", "count(*)")} as avg_sale
            from sales group by pais, ciudad"""
    ),
    "q02_top_products": _sales(
        f"""select producto, tipo_producto as category, {_TOTAL},
                   {o.number("sum(cantidad)", "units_sold")},
                   {o.mean("sum(precio_unitario)", "count(*)")} as avg_unit_price
            from sales group by producto, tipo_producto
            order by sum(total) desc, producto, tipo_producto limit 5"""
    ),
    "q03_average_ticket": _sales(
        f"""select tipo_cliente, segmento_cliente, {o.whole("count(*)", "total_purchases")},
                   {o.mean("sum(total)", "count(*)")} as avg_ticket,
                   {o.number("sum(total)", "total_revenue")}
            from sales group by tipo_cliente, segmento_cliente"""
    ),
    "q04_inactive_customers": f"""with {o.DIMENSIONS}
        select cast(id_cliente as bigint) as id_cliente, tipo_cliente, segmento_cliente, pais, ciudad
        from dim_cliente join dim_region using (id_region)
        where not exists (
          select 1 from sales s
          where s.fecha >= date '{mapping.RECENT}' and s.tipo_cliente = dim_cliente.tipo_cliente
            and s.segmento_cliente = dim_cliente.segmento_cliente
            and s.tipo_venta = dim_cliente.tipo_venta
            and s.ciudad = dim_region.ciudad and s.pais = dim_region.pais)""",
    "q05_category_by_country": _sales(
        f"""select pais, tipo_producto, {_TOTAL}, {_COUNT},
                   {o.mean("sum(descuento)", "count(descuento)")} as avg_discount
            from sales group by pais, tipo_producto"""
    ),
    "q06_customer_ranking": _sales(
        f"""select tipo_cliente, segmento_cliente, {_TOTAL},
                   cast(dense_rank() over (order by sum(total) desc) as bigint) as sales_rank
            from sales group by tipo_cliente, segmento_cliente"""
    ),
    "q07_yoy_growth": _sales(
        f"""select cast(year as bigint) as year, cast(total as double) as total_sales,
                   cast(previous as double) as prev_year_sales,
                   {o.percent("total - previous", "previous")} as yoy_growth_pct
            from (select year, total, lag(total) over (order by year) as previous
                  from (select year, sum(total) as total from sales group by year) y) y""",
    ),
    "q08_category_share": _sales(
        f"""select tipo_producto, cast(total as double) as total_sales,
                   {o.percent("total", "everything")} as sales_percentage
            from (select tipo_producto, sum(total) as total from sales group by tipo_producto) c,
                 (select sum(total) as everything from sales) e"""
    ),
    "q09_cumulative_sales": _sales(
        """select year, month, year_month, cast(total as double) as monthly_sales,
                  cast((select sum(earlier.total) from months earlier
                        where earlier.year = months.year and earlier.month <= months.month)
                       as double) as cumulative_sales
           from months""",
        _MONTHS,
    ),
    "q10_moving_average": _sales(
        f"""select year_month, cast(total as double) as monthly_sales,
                   {o.mean("(sum(total) over w)", "(count(*) over w)")} as moving_avg_3m
            from months window w as (order by year_month rows between 2 preceding and current row)""",
        _MONTHS,
    ),
    "q11_revenue_rollup": _sales(
        f"""select pais, tipo_producto as categoria, {_TOTAL}, {_COUNT}
            from sales group by pais, tipo_producto
            union all
            select pais, '--- Subtotal ---', sum(total)::double, count(*) from sales group by pais
            union all
            select '*** GRAND TOTAL ***', '--- Subtotal ---', sum(total)::double, count(*)
            from sales"""
    ),
    "q12_best_product_by_country": _sales(
        """select pais, producto, tipo_producto, cast(total as double) as total_sales
           from (select pais, producto, tipo_producto, sum(total) as total from sales group by all) p
           qualify row_number() over (
             partition by pais order by total desc, producto, tipo_producto) = 1"""
    ),
    "q13_discount_impact": _sales(
        f"""select if(descuento > 0, 'Discounted', 'Full Price') as sale_type, {_COUNT},
                   {o.number("sum(total)", "total_revenue")},
                   {o.mean("sum(total)", "count(*)")} as avg_ticket,
                   {o.mean("sum(descuento)", "count(descuento)")} as avg_discount
            from sales group by 1"""
    ),
    "q14_shipping_share": _sales(
        f"""select pais, {o.number("sum(costo_envio)", "total_shipping")},
                   {o.number("sum(total)", "total_revenue")},
                   {o.percent("sum(costo_envio)", "sum(total)")} as shipping_pct_of_revenue
            from sales group by pais"""
    ),
}


def _register_report(key: str, report) -> None:
    @check(key, REPORT_SQL[key])
    def run(d: Derived) -> DataFrame:
        # Q4 reads the star after a second load: only then are there profiles without sales
        return report(d.reloaded if key == "q04_inactive_customers" else d.star)


for _key, _report in reports.REPORTS.items():
    _register_report(_key, _report)


# --- exploratory figures ---------------------------------------------------------

_VENTAS = o.number("sum(total)", "ventas")
_TRANSACCIONES = o.whole("count(*)", "transacciones")


@check(
    "e01_sales_histogram",
    _sales(
        """select cast(b as bigint) as bin,
                  (low + (high - low) * b / 20) / 100 as desde,
                  (low + (high - low) * (b + 1) / 20) / 100 as hasta,
                  (select count(*) from sales
                   where least((cast(total * 100 as bigint) - low) * 20 // (high - low), 19) = b)
                    as filas
           from range(20) bins(b), ends""",
        """ends as (select cast(min(total) * 100 as bigint) as low,
                           cast(max(total) * 100 as bigint) as high from sales)""",
    ),
)
def histogram(d: Derived) -> DataFrame:
    return explore.sales_histogram(d.star)


@check(
    "e02_sales_box_plot",
    _sales(
        """select round(q1, 4) as q1, round(mediana, 4) as mediana, round(q3, 4) as q3,
                  round(q1 - 1.5 * (q3 - q1), 5) as limite_inferior,
                  round(q3 + 1.5 * (q3 - q1), 5) as limite_superior, minimo, maximo,
                  (select count(*) from sales
                   where total < q1 - 1.5 * (q3 - q1) or total > q3 + 1.5 * (q3 - q1)) as atipicos,
                  filas
           from (select quantile_cont(cast(total as double), 0.25) as q1,
                        quantile_cont(cast(total as double), 0.5) as mediana,
                        quantile_cont(cast(total as double), 0.75) as q3,
                        cast(min(total) as double) as minimo, cast(max(total) as double) as maximo,
                        count(*) as filas from sales) box"""
    ),
)
def box_plot(d: Derived) -> DataFrame:
    box = explore.sales_box_plot(d.star)
    quartiles = {c: F.round(c, 4) for c in ("q1", "mediana", "q3")}
    fences = {c: F.round(c, 5) for c in ("limite_inferior", "limite_superior")}
    return box.withColumns(quartiles | fences)


@check(
    "e03_sales_by_country",
    _sales(f"select pais, {_VENTAS}, {_TRANSACCIONES} from sales group by pais"),
)
def by_country(d: Derived) -> DataFrame:
    return explore.sales_by_country(d.star)


@check(
    "e04_sales_by_category",
    _sales(f"select tipo_producto, {_VENTAS} from sales group by tipo_producto"),
)
def by_category(d: Derived) -> DataFrame:
    return explore.sales_by_category(d.star)


@check(
    "e05_top_products",
    _sales(
        f"""select producto, tipo_producto as category, {_TOTAL},
                   {o.number("sum(cantidad)", "units_sold")},
                   {o.mean("sum(precio_unitario)", "count(*)")} as avg_unit_price
            from sales group by producto, tipo_producto
            order by sum(total) desc, producto, tipo_producto limit 10"""
    ),
)
def top_ten(d: Derived) -> DataFrame:
    return explore.top_products(d.star)


@check(
    "e05b_top_segments",
    _sales(
        f"""select segmento_cliente, {_VENTAS}, {_TRANSACCIONES} from sales
            group by segmento_cliente order by sum(total) desc, segmento_cliente limit 10"""
    ),
)
def top_segments(d: Derived) -> DataFrame:
    return explore.top_segments(d.star)


_CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@check(
    "e06_country_category_matrix",
    _sales(
        "select pais, "
        + ", ".join(
            f"cast(sum(case when tipo_producto = '{c}' then total end) as double) as \"{c}\""
            for c in _CATEGORIES
        )
        + " from sales group by pais"
    ),
)
def matrix(d: Derived) -> DataFrame:
    return explore.country_category_matrix(d.star, _CATEGORIES).drop("otras")


@check(
    "e06b_country_category_sales",
    _sales(
        f"""select pais, tipo_producto, {o.number("sum(total)", "total")}
            from sales group by pais, tipo_producto"""
    ),
)
def country_category_sales(d: Derived) -> DataFrame:
    return explore.country_category_sales(d.star)


@check(
    "e06c_matrix_with_others",
    _sales(
        f"""select pais,
                   {o.number("sum(case when tipo_producto = 'ECONOMY' then total end)", '"ECONOMY"')},
                   {o.number("sum(case when tipo_producto <> 'ECONOMY' then total end)", "otras")}
            from sales group by pais"""
    ),
)
def matrix_with_others(d: Derived) -> DataFrame:
    return explore.country_category_matrix(d.star, ["ECONOMY"])


@check(
    "k01_key_figures",
    _sales(
        f"""select {o.number("sum(total)", "ventas_totales")},
                   {o.mean("sum(total)", "count(*)")} as ticket_promedio,
                   {o.number("sum(cantidad)", "unidades")},
                   {o.whole("count(distinct pais)", "paises")} from sales"""
    ),
)
def key_figures(d: Derived) -> DataFrame:
    return explore.key_figures(d.star)


@check(
    "k02_revenue_by_segment",
    _sales(
        f"""select segmento_cliente, {_VENTAS}, {_TRANSACCIONES}
            from sales group by segmento_cliente"""
    ),
)
def by_segment(d: Derived) -> DataFrame:
    return explore.revenue_by_segment(d.star)


@check(
    "k03_sales_trend",
    _sales(
        f"""select cast(year as bigint) as year, year_month, {_VENTAS}, {_TRANSACCIONES},
                   cast(0 as bigint) as nivel from sales group by year, year_month
            union all
            select year, null, sum(total)::double, count(*), 1 from sales group by year
            union all
            select null, null, sum(total)::double, count(*), 3 from sales"""
    ),
)
def trend(d: Derived) -> DataFrame:
    return explore.sales_trend(d.star)


@check(
    "k04_top_clients",
    _sales(
        f"""select tipo_cliente, segmento_cliente, tipo_venta, ciudad, pais, {_VENTAS},
                   {_TRANSACCIONES}
            from sales group by 1, 2, 3, 4, 5
            order by sum(total) desc, 1, 2, 3, 4, 5 limit 5"""
    ),
)
def top_clients(d: Derived) -> DataFrame:
    return explore.top_clients(d.star)


@check(
    "k04b_top_products",
    REPORT_SQL["q02_top_products"],
)
def top_five(d: Derived) -> DataFrame:
    return explore.top_products(d.star, 5)


@check("k05_category_participation", REPORT_SQL["q08_category_share"])
def participation(d: Derived) -> DataFrame:
    return explore.category_participation(d.star)
