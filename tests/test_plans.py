"""What the physical plans must and must not hold."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from almacen import schemas
from almacen.checks.catalog import CHECKS
from almacen.checks.derived import derived
from almacen.model import DIM_PRODUCTO
from almacen.operators import joins
from almacen.operators.dimensions import lookup_id
from almacen.plans import cleaning_run, explore, reports
from almacen.sources.warehouse import Star

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark):
    return derived(spark, SF_DIR).star


@pytest.mark.parametrize("key", CHECKS)
def test_no_python_and_no_cross_join(spark, key):
    plan = plan_of(CHECKS[key](spark, SF_DIR))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_cleaning_shuffles_once(spark):
    plan = plan_of(cleaning_run.clean(derived(spark, SF_DIR).raw))
    assert plan.count("Exchange") == 1


def test_reports_read_only_their_columns(spark, star):
    plan = plan_of(reports.sales_by_region(star))
    assert "ReadSchema: struct<id_cliente:bigint,total:decimal(14,2)>" in plan


def test_reports_sum_before_they_join(spark, star):
    for report in (reports.sales_by_region, reports.top_products, reports.yearly_growth):
        plan = plan_of(report(star))
        # the tree is printed from the result down; the fact is below the lowest aggregates
        assert plan.index("BroadcastHashJoin") < plan.rindex("HashAggregate")


@pytest.mark.parametrize(
    "report",
    [
        reports.category_by_country,
        reports.revenue_rollup,
        reports.best_product_by_country,
        explore.country_category_sales,
    ],
)
def test_large_dimensions_meet_sums_and_never_sales(spark, star, report):
    """Customers and products too many to broadcast: the first shuffle carries partial sums."""
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name, None) for name in settings}
    unknown = Star(**{n: star.table(n) for n in schemas.WAREHOUSE})  # no row counts: nothing is small
    try:
        for name in settings:
            spark.conf.set(name, "-1")
        plan = plan_of(report(unknown))
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    lines = plan.splitlines()
    fact = next(i for i, line in enumerate(lines) if "FileScan" in line and "total#" in line)
    above = [line for line in lines[:fact] if "Exchange" in line or "partial_sum" in line]
    assert "partial_sum" in above[-1]


def test_quantiles_sort_and_gather_nothing(spark, star):
    plan = plan_of(explore.sales_box_plot(star))
    assert "Window" not in plan and "Sort" not in plan


def test_filters_reach_the_scan(spark):
    plan = plan_of(entry_points.queries()["b23_filter"](spark, SF_DIR))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    assert "GreaterThan(total,90000.00)" in pushed and "LessThan(descuento,0.05)" in pushed


def test_only_bounded_tables_are_broadcast():
    schema, lengths = schemas.WAREHOUSE["dim_producto"], schemas.TEXT_LENGTHS["dim_producto"]
    assert joins.fits(30_000, schema, lengths)
    assert not joins.fits(1_000_000, schema, lengths)
    assert not joins.fits(None, schema, lengths)
    assert not joins.fits(1, schema, {})  # no length, no bound


def test_a_hot_key_is_split_when_the_dimension_is_large(spark):
    """A third of the sales names one product; its partition is read by several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "20",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        members = spark.range(2000).select(
            F.col("id").alias("id_producto"),
            F.concat(F.lit("p"), "id").alias("producto"),
            F.lit("t").alias("tipo_producto"),
        )
        number = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 2000)
        rows = spark.range(0, 300_000, 1, 8).select(
            F.concat(F.lit("p"), number).alias("producto"), F.lit("t").alias("tipo_producto"), "id"
        )
        joined = lookup_id(rows, members, DIM_PRODUCTO, small=False)
        assert joined.filter("id_producto is null").count() == 0
        result = joined.select("id", "id_producto")
        result.collect()
        assert "skew=true" in plan_of(result)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
