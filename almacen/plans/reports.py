"""The fourteen analytical reports over a star schema.

Each function takes a ``Star`` and returns a lazy DataFrame. Two habits keep
them flat at any fact size:

* sums are taken by surrogate id first and labelled with the dimension
  afterwards, so the join never sees more rows than the dimension has members
  and a member with a third of the sales is reduced to one row in every task.
  Where two dimensions meet, the sums are by pairs of ids, unless one side is
  proven to be small enough for every task to hold it: then no sale is shuffled;
* windows run over the aggregated rows (months, years, categories), never over
  the fact.

Money stays decimal; means and percentages are exact and rounded once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almacen import schemas
from almacen.functions.numbers import mean_2dp, percent_2dp
from almacen.model import (
    DIM_CLIENTE,
    DIM_FECHA,
    DIM_PRODUCTO,
    DIM_REGION,
    DISCOUNTED_LABEL,
    FULL_PRICE_LABEL,
    GRAND_TOTAL_LABEL,
    SUBTOTAL_LABEL,
    Dimension,
)
from almacen.operators.joins import fits, join_dimension
from almacen.sources.warehouse import Star


def _sum(name: str) -> Column:
    return F.sum(name).alias(name)


def rows_of() -> Column:
    return F.count(F.lit(1)).alias("n")


def total_of() -> Column:
    return _sum("total")


def label(rows: DataFrame, star: Star, dimension: Dimension, *columns: str) -> DataFrame:
    """Join the dimension's columns to rows that hold its id."""
    table = star.table(dimension.table).select(dimension.id_column, *columns)
    return join_dimension(rows, table, [dimension.id_column], star.is_small(dimension.table))


def sums_by_place(star: Star, by: list[str], *measures: Column) -> DataFrame:
    """Measures summed by customer profile, labelled with region columns, not yet regrouped."""
    sums = star.fact_ventas.groupBy("id_cliente").agg(*measures)
    placed = label(sums, star, DIM_CLIENTE, "id_region")
    return label(placed, star, DIM_REGION, *by)


def _countries(star: Star) -> tuple[DataFrame, bool]:
    """(id_cliente, pais) of every customer profile, and whether that is proven to be small."""
    places = label(star.dim_cliente.select("id_cliente", "id_region"), star, DIM_REGION, "pais")
    places = places.select("id_cliente", "pais")
    rows = star.rows.get(DIM_CLIENTE.table)
    return places, fits(rows, places.schema, schemas.TEXT_LENGTHS[DIM_REGION.table])


def sums_by_country_and_product_id(star: Star, *measures: str, counted: Sequence[str] = ()) -> DataFrame:
    """Sums of measures, rows (n) and non-null counts (n_...) by country and product id.

    Where customer profiles are few, each task has them all and sums straight by country.
    Else the sums are taken by customer and product id first, on the map side: only
    these sums are shuffled, and the join sees each such pair once.
    """
    first = [rows_of(), *map(_sum, measures), *[F.count(c).alias(f"n_{c}") for c in counted]]
    again = [_sum("n"), *map(_sum, measures), *[_sum(f"n_{c}") for c in counted]]
    places, few = _countries(star)
    rows = star.fact_ventas.select("id_cliente", "id_producto", *measures)
    if not few:
        rows = rows.groupBy("id_cliente", "id_producto").agg(*first)
    placed = join_dimension(rows, places, ["id_cliente"], few)
    return placed.groupBy("pais", "id_producto").agg(*(first if few else again))


def sums_by_country_and_category(star: Star, with_discount: bool = False) -> DataFrame:
    """Total, rows and (if asked) discount sum and count by country and category."""
    discount = ("descuento",) if with_discount else ()
    sums = sums_by_country_and_product_id(star, "total", *discount, counted=discount)
    labelled = label(sums, star, DIM_PRODUCTO, "tipo_producto")
    again = [total_of(), _sum("n"), *[_sum(c) for d in discount for c in (d, f"n_{d}")]]
    return labelled.groupBy("pais", "tipo_producto").agg(*again)


def sums_by_country_and_product(star: Star) -> DataFrame:
    """Total by country and product; the join sees one row for each such pair."""
    sums = sums_by_country_and_product_id(star, "total")
    return label(sums, star, DIM_PRODUCTO, "producto", "tipo_producto")


def sums_by_customer_type(star: Star) -> DataFrame:
    sums = star.fact_ventas.groupBy("id_cliente").agg(total_of(), rows_of())
    labelled = label(sums, star, DIM_CLIENTE, "tipo_cliente", "segmento_cliente")
    return labelled.groupBy("tipo_cliente", "segmento_cliente").agg(total_of(), _sum("n"))


def sums_by_product(star: Star, *measures: Column) -> DataFrame:
    sums = star.fact_ventas.groupBy("id_producto").agg(*measures)
    return label(sums, star, DIM_PRODUCTO, "producto", "tipo_producto")


def sums_by_category(star: Star) -> DataFrame:
    return sums_by_product(star, total_of()).groupBy("tipo_producto").agg(total_of())


def sums_by_period(star: Star, *period: str) -> DataFrame:
    sums = star.fact_ventas.groupBy("id_fecha").agg(total_of())
    return label(sums, star, DIM_FECHA, *period).groupBy(*period).agg(total_of())


def sales_by_region(star: Star) -> DataFrame:
    """Q1: transactions, sales and mean sale of each city."""
    sums = sums_by_place(star, ["pais", "ciudad"], total_of(), rows_of())
    return (
        sums.groupBy("pais", "ciudad")
        .agg(total_of(), _sum("n"))
        .select(
            "pais",
            "ciudad",
            F.col("n").alias("total_transactions"),
            F.col("total").alias("total_sales"),
            mean_2dp(F.col("total"), F.col("n")).alias("avg_sale"),
        )
        .orderBy(F.desc("total_sales"), "pais", "ciudad")
    )


def top_products(star: Star, limit: int = 5) -> DataFrame:
    """Q2: the products with the most sales; equal sales in name order."""
    sums = sums_by_product(star, total_of(), rows_of(), _sum("cantidad"), _sum("precio_unitario"))
    return sums.select(
        "producto",
        F.col("tipo_producto").alias("category"),
        F.col("total").alias("total_sales"),
        F.col("cantidad").alias("units_sold"),
        mean_2dp(F.col("precio_unitario"), F.col("n")).alias("avg_unit_price"),
    ).orderBy(F.desc("total_sales"), "producto", "category").limit(limit)


def average_ticket(star: Star) -> DataFrame:
    """Q3: purchases, mean ticket and revenue of each customer type."""
    return (
        sums_by_customer_type(star)
        .select(
            "tipo_cliente",
            "segmento_cliente",
            F.col("n").alias("total_purchases"),
            mean_2dp(F.col("total"), F.col("n")).alias("avg_ticket"),
            F.col("total").alias("total_revenue"),
        )
        .orderBy(F.desc("avg_ticket"), "tipo_cliente", "segmento_cliente")
    )


def inactive_customers(star: Star) -> DataFrame:
    """Q4: customer profiles without a sale.

    The fact's ids are made distinct on the map side before the anti-join.
    """
    active = star.fact_ventas.select("id_cliente").dropDuplicates()
    inactive = star.dim_cliente.join(active, "id_cliente", "left_anti")
    return label(inactive, star, DIM_REGION, "pais", "ciudad").select(
        "id_cliente", "tipo_cliente", "segmento_cliente", "pais", "ciudad"
    )


def category_by_country(star: Star) -> DataFrame:
    """Q5: sales, transactions and mean discount of each category in each country."""
    return (
        sums_by_country_and_category(star, with_discount=True)
        .select(
            "pais",
            "tipo_producto",
            F.col("total").alias("total_sales"),
            F.col("n").alias("num_transactions"),
            mean_2dp(F.col("descuento"), F.col("n_descuento")).alias("avg_discount"),
        )
        .orderBy("pais", F.desc("total_sales"), "tipo_producto")
    )


def customer_ranking(star: Star) -> DataFrame:
    """Q6: customer types ranked by sales, equal sales sharing a rank without gaps."""
    by_sales = Window.orderBy(F.desc("total_sales"))
    return (
        sums_by_customer_type(star)
        .select("tipo_cliente", "segmento_cliente", F.col("total").alias("total_sales"))
        .withColumn("sales_rank", F.dense_rank().over(by_sales))
    )


def yearly_growth(star: Star) -> DataFrame:
    """Q7: sales of each year against the year before it in the data."""
    previous = F.lag("total").over(Window.orderBy("year"))
    return (
        sums_by_period(star, "year")
        .withColumn("previous", previous)
        .select(
            "year",
            F.col("total").alias("total_sales"),
            F.col("previous").alias("prev_year_sales"),
            percent_2dp(F.col("total") - F.col("previous"), F.col("previous")).alias(
                "yoy_growth_pct"
            ),
        )
        .orderBy("year")
    )


def category_share(star: Star) -> DataFrame:
    """Q8: each category's share of all sales."""
    everything = star.fact_ventas.agg(F.sum("total")).scalar()
    return (
        sums_by_category(star)
        .select(
            "tipo_producto",
            F.col("total").alias("total_sales"),
            percent_2dp(F.col("total"), everything).alias("sales_percentage"),
        )
        .orderBy(F.desc("sales_percentage"), "tipo_producto")
    )


def cumulative_sales(star: Star) -> DataFrame:
    """Q9: monthly sales and their running total within the year."""
    so_far = Window.partitionBy("year").orderBy("month")
    return (
        sums_by_period(star, "year", "month", "year_month")
        .select(
            "year",
            "month",
            "year_month",
            F.col("total").alias("monthly_sales"),
            F.sum("total").over(so_far).alias("cumulative_sales"),
        )
        .orderBy("year", "month")
    )


def moving_average(star: Star, months: int = 3) -> DataFrame:
    """Q10: mean of each month in the data and the ones before it."""
    recent = Window.orderBy("year_month").rowsBetween(1 - months, 0)
    return (
        sums_by_period(star, "year_month")
        .select(
            "year_month",
            F.col("total").alias("monthly_sales"),
            mean_2dp(F.sum("total").over(recent), F.count("total").over(recent)).alias(
                f"moving_avg_{months}m"
            ),
        )
        .orderBy("year_month")
    )


def revenue_rollup(star: Star) -> DataFrame:
    """Q11: sales by country and category with subtotals and the grand total.

    Rolled up from the country and category sums, so the fact is not multiplied.
    Rows are ordered before they are labelled: a country's subtotal leads it
    and the grand total comes last, wherever their labels would sort.
    """
    levels = (
        sums_by_country_and_category(star)
        .rollup("pais", "tipo_producto")
        .agg(total_of(), _sum("n"), F.grouping_id().alias("level"))
    )
    everything, country = F.col("level") == 3, F.col("level") >= 1
    return (
        levels.orderBy(
            everything, F.asc_nulls_last("pais"), F.desc("total"), F.desc("level"), "tipo_producto"
        )
        .select(
            F.when(everything, GRAND_TOTAL_LABEL).otherwise(F.col("pais")).alias("pais"),
            F.when(country, SUBTOTAL_LABEL).otherwise(F.col("tipo_producto")).alias("categoria"),
            F.col("total").alias("total_sales"),
            F.col("n").alias("num_transactions"),
        )
    )


def best_product_by_country(star: Star) -> DataFrame:
    """Q12: the product with the most sales in each country; equal sales in name order.

    A minimum over (minus sales, names) is an aggregate with map-side
    combining, so no task has to sort all products of a large country.
    """
    best = F.min(
        F.struct((-F.col("total")).alias("negated"), F.col("producto"), F.col("tipo_producto"))
    )
    return (
        sums_by_country_and_product(star)
        .groupBy("pais")
        .agg(best.alias("best"))
        .select(
            "pais",
            "best.producto",
            "best.tipo_producto",
            (-F.col("best.negated")).alias("total_sales"),
        )
        .orderBy(F.desc("total_sales"), "pais")
    )


def discount_impact(star: Star) -> DataFrame:
    """Q13: discounted against full-price sales; a missing discount counts as none."""
    kind = F.when(F.col("descuento") > 0, DISCOUNTED_LABEL).otherwise(FULL_PRICE_LABEL)
    sums = star.fact_ventas.groupBy(kind.alias("sale_type")).agg(
        rows_of(), total_of(), _sum("descuento"), F.count("descuento").alias("n_descuento")
    )
    return sums.select(
        "sale_type",
        F.col("n").alias("num_transactions"),
        F.col("total").alias("total_revenue"),
        mean_2dp(F.col("total"), F.col("n")).alias("avg_ticket"),
        mean_2dp(F.col("descuento"), F.col("n_descuento")).alias("avg_discount"),
    )


def shipping_share(star: Star) -> DataFrame:
    """Q14: shipping cost as a share of revenue in each country."""
    sums = sums_by_place(star, ["pais"], total_of(), _sum("costo_envio"))
    return (
        sums.groupBy("pais")
        .agg(total_of(), _sum("costo_envio"))
        .select(
            "pais",
            F.col("costo_envio").alias("total_shipping"),
            F.col("total").alias("total_revenue"),
            percent_2dp(F.col("costo_envio"), F.col("total")).alias("shipping_pct_of_revenue"),
        )
        .orderBy(F.desc_nulls_first("shipping_pct_of_revenue"), "pais")
    )


REPORTS = {
    "q01_sales_by_region": sales_by_region,
    "q02_top_products": top_products,
    "q03_average_ticket": average_ticket,
    "q04_inactive_customers": inactive_customers,
    "q05_category_by_country": category_by_country,
    "q06_customer_ranking": customer_ranking,
    "q07_yoy_growth": yearly_growth,
    "q08_category_share": category_share,
    "q09_cumulative_sales": cumulative_sales,
    "q10_moving_average": moving_average,
    "q11_revenue_rollup": revenue_rollup,
    "q12_best_product_by_country": best_product_by_country,
    "q13_discount_impact": discount_impact,
    "q14_shipping_share": shipping_share,
}
