"""The figures behind the exploratory charts and the dashboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almacen.functions.numbers import mean_2dp
from almacen.model import DIM_CLIENTE, DIM_FECHA, DIM_REGION
from almacen.operators import distribution
from almacen.plans import reports
from almacen.plans.reports import rows_of, total_of
from almacen.sources.warehouse import Star


def sales_histogram(star: Star, bins: int = 20) -> DataFrame:
    """E1: sales amounts in equal-width bins."""
    return distribution.histogram(star.fact_ventas, "total", bins)


def sales_box_plot(star: Star) -> DataFrame:
    """E2: quartiles, fences and outliers of the sales amounts."""
    return distribution.box_plot(star.fact_ventas, "total")


def sales_by_country(star: Star) -> DataFrame:
    """E3: sales and transactions of each country."""
    sums = reports.sums_by_place(star, ["pais"], total_of(), rows_of())
    return (
        sums.groupBy("pais")
        .agg(F.sum("total").alias("ventas"), F.sum("n").alias("transacciones"))
        .orderBy(F.desc("ventas"), "pais")
    )


def sales_by_category(star: Star) -> DataFrame:
    """E4: sales of each category."""
    return (
        reports.sums_by_category(star)
        .select("tipo_producto", F.col("total").alias("ventas"))
        .orderBy(F.desc("ventas"), "tipo_producto")
    )


def top_products(star: Star, limit: int = 10) -> DataFrame:
    """E5, first part: the products with the most sales."""
    return reports.top_products(star, limit)


def top_segments(star: Star, limit: int = 10) -> DataFrame:
    """E5, second part: the customer segments with the most sales."""
    return revenue_by_segment(star).orderBy(F.desc("ventas"), "segmento_cliente").limit(limit)


def country_category_sales(star: Star) -> DataFrame:
    """E6 in long form: sales by country and category, however many there are."""
    return reports.sums_by_country_and_category(star).select("pais", "tipo_producto", "total")


def country_category_matrix(star: Star, columns: Sequence[str], others: str = "otras") -> DataFrame:
    """E6: sales by country (rows) and the given categories (columns); null where there is none.

    Sales of every other category, and of none, are summed in the column ``others``.
    """
    if others in columns:
        raise ValueError(f"{others} names a category")
    category, total = F.col("tipo_producto"), F.col("total")
    sums = [F.sum(F.when(category == c, total)).alias(c) for c in columns]
    given = F.coalesce(category.isin(*columns), F.lit(False))
    return (
        country_category_sales(star)
        .groupBy("pais")
        .agg(*sums, F.sum(F.when(~given, total)).alias(others))
        .orderBy("pais")
    )


def key_figures(star: Star) -> DataFrame:
    """K1: total sales, mean ticket, units and countries, one row."""
    sums = reports.sums_by_place(star, ["pais"], total_of(), rows_of(), F.sum("cantidad").alias("cantidad"))
    countries = sums.groupBy("pais").agg(total_of(), F.sum("n").alias("n"), F.sum("cantidad").alias("c"))
    return countries.agg(
        total_of(), F.sum("n").alias("n"), F.sum("c").alias("c"), F.count("pais").alias("paises")
    ).select(
        F.col("total").alias("ventas_totales"),
        mean_2dp(F.col("total"), F.col("n")).alias("ticket_promedio"),
        F.col("c").alias("unidades"),
        "paises",
    )


def revenue_by_segment(star: Star) -> DataFrame:
    """K2: the customer segments and their revenue."""
    sums = star.fact_ventas.groupBy("id_cliente").agg(total_of(), rows_of())
    return (
        reports.label(sums, star, DIM_CLIENTE, "segmento_cliente")
        .groupBy("segmento_cliente")
        .agg(F.sum("total").alias("ventas"), F.sum("n").alias("transacciones"))
    )


def sales_trend(star: Star) -> DataFrame:
    """K3: sales by year and, below each year, by month; the first row is the total."""
    sums = star.fact_ventas.groupBy("id_fecha").agg(total_of(), rows_of())
    months = (
        reports.label(sums, star, DIM_FECHA, "year", "year_month")
        .groupBy("year", "year_month")
        .agg(total_of(), F.sum("n").alias("n"))
    )
    return (
        months.rollup("year", "year_month")
        .agg(
            F.sum("total").alias("ventas"),
            F.sum("n").alias("transacciones"),
            F.grouping_id().alias("nivel"),
        )
        .orderBy(F.asc_nulls_first("year"), F.asc_nulls_first("year_month"))
    )


def top_clients(star: Star, limit: int = 5) -> DataFrame:
    """K4: the customer profiles with the most sales, by their labels."""
    sums = star.fact_ventas.groupBy("id_cliente").agg(total_of(), rows_of())
    columns = ["tipo_cliente", "segmento_cliente", "tipo_venta", "id_region"]
    labelled = reports.label(sums, star, DIM_CLIENTE, *columns)
    return (
        reports.label(labelled, star, DIM_REGION, "ciudad", "pais")
        .select(
            "tipo_cliente",
            "segmento_cliente",
            "tipo_venta",
            "ciudad",
            "pais",
            F.col("total").alias("ventas"),
            F.col("n").alias("transacciones"),
        )
        .orderBy(
            F.desc("ventas"), "tipo_cliente", "segmento_cliente", "tipo_venta", "ciudad", "pais"
        )
        .limit(limit)
    )


def category_participation(star: Star) -> DataFrame:
    """K5: each category's share of all sales."""
    return reports.category_share(star)
