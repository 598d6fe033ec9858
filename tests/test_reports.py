from __future__ import annotations

from decimal import Decimal

import numpy as np
import pytest
from builders import star
from pyspark.sql import functions as F

from almacen import schemas
from almacen.operators import distribution
from almacen.plans import explore, reports
from almacen.sources.warehouse import Star


def money(text):
    return Decimal(text)


def bare_star(spark, fact_rows, **tables):
    """A star with hand-made fact rows, past the rules that cleaning would apply."""
    schema = schemas.WAREHOUSE
    defaults = {
        "dim_fecha": [(1, None, 2021, 1, "2021-01"), (2, None, 2022, 1, "2022-01")],
        "dim_region": [(1, "Cali", "Colombia")],
        "dim_cliente": [(1, "Gobierno", "Enterprise", "Tienda", 1)],
        "dim_producto": [(1, "Pan", "Comida")],
    }
    made = {}
    for name, rows in (defaults | tables).items():
        made[name] = spark.createDataFrame(rows, schema[name].simpleString()[7:-1].replace(":", " "))
    fact = spark.createDataFrame(
        fact_rows, schema["fact_ventas"].simpleString()[7:-1].replace(":", " ")
    )
    return Star(**made, fact_ventas=fact)


def fact_row(n, total, date=1, discount="0"):
    return (n, date, 1, 1, money(1), money(1), discount and money(discount), money(0), money(total))


def test_growth_compares_with_the_year_before_in_the_data(spark, tmp_path):
    loaded = star(
        spark,
        tmp_path,
        {"fecha": "2021-05-01", "total": 100.0},
        {"fecha": "2023-05-01", "total": 125.0},
    )
    rows = reports.yearly_growth(loaded).collect()
    assert [(r.year, r.prev_year_sales, r.yoy_growth_pct) for r in rows] == [
        (2021, None, None),
        (2023, money("100.00"), money("25.00")),
    ]


def test_growth_over_nothing_is_null(spark):
    loaded = bare_star(spark, [fact_row(1, "0"), fact_row(2, "5", date=2)])
    assert [r.yoy_growth_pct for r in reports.yearly_growth(loaded).collect()] == [None, None]


def test_moving_average_takes_months_in_the_data(spark, tmp_path):
    months = [("2024-01-01", 10.0), ("2024-02-01", 20.0), ("2024-04-01", 40.0)]
    loaded = star(spark, tmp_path, *[{"fecha": f, "total": t} for f, t in months])
    found = [r.moving_avg_3m for r in reports.moving_average(loaded).collect()]
    assert found == [money("10.00"), money("15.00"), money("23.33")]


def test_equal_sales_share_a_rank(spark, tmp_path):
    loaded = star(
        spark,
        tmp_path,
        {"tipo_cliente": "A", "total": 10.0},
        {"tipo_cliente": "B", "total": 10.0},
        {"tipo_cliente": "C", "total": 5.0},
    )
    ranks = {r.tipo_cliente: r.sales_rank for r in reports.customer_ranking(loaded).collect()}
    assert ranks == {"A": 1, "B": 1, "C": 2}


def test_equal_best_products_go_by_name(spark, tmp_path):
    loaded = star(spark, tmp_path, {"producto": "Te"}, {"producto": "Pan"}, {"pais": "Peru"})
    best = {r.pais: r.producto for r in reports.best_product_by_country(loaded).collect()}
    assert best == {"Colombia": "Pan", "Peru": "Café"}
    assert [r.producto for r in reports.top_products(loaded, 3).collect()] == ["Café", "Pan", "Te"]


def test_rollup_order(spark, tmp_path):
    loaded = star(
        spark,
        tmp_path,
        {"pais": "Peru"},
        {"pais": "Chile", "tipo_producto": "Pan"},
        {"pais": "Chile", "total": 30.0},
    )
    rows = [(r.pais, r.categoria, r.total_sales) for r in reports.revenue_rollup(loaded).collect()]
    assert rows == [
        ("Chile", "--- Subtotal ---", money("40.00")),
        ("Chile", "Bebidas", money("30.00")),
        ("Chile", "Pan", money("10.00")),
        ("Peru", "--- Subtotal ---", money("10.00")),
        ("Peru", "Bebidas", money("10.00")),
        ("*** GRAND TOTAL ***", "--- Subtotal ---", money("50.00")),
    ]


def test_means_are_not_rounded_twice(spark):
    one = bare_star(spark, [fact_row(1, "10049.99")])
    zeros = spark.range(2_009_999).select(
        (F.col("id") + 2).alias("id_venta"),
        *[
            F.lit(1 if f.name.startswith("id_") else 0).cast(f.dataType).alias(f.name)
            for f in one.fact_ventas.schema.fields[1:]
        ],
    )
    fact = one.fact_ventas.unionByName(zeros)
    loaded = Star(one.dim_fecha, one.dim_region, one.dim_cliente, one.dim_producto, fact)
    assert reports.average_ticket(loaded).first().avg_ticket == money("0.00")


def test_a_null_discount_is_full_price_and_not_averaged(spark):
    loaded = bare_star(
        spark, [fact_row(1, "5", discount=None), fact_row(2, "7"), fact_row(3, "9", discount="0.5")]
    )
    rows = {r.sale_type: r for r in reports.discount_impact(loaded).collect()}
    assert rows["Full Price"].num_transactions == 2
    assert rows["Full Price"].avg_discount == money("0.00")
    assert rows["Discounted"].avg_discount == money("0.50")


def test_shipping_without_revenue_is_null_and_leads(spark):
    loaded = bare_star(spark, [fact_row(1, "0")])
    assert reports.shipping_share(loaded).first().shipping_pct_of_revenue is None


@pytest.fixture(scope="module")
def random_star(spark, tmp_path_factory):
    chosen = np.random.default_rng(5)
    changes = [
        {
            "fecha": f"{2020 + int(chosen.integers(3))}-{1 + int(chosen.integers(12)):02d}-03",
            "producto": f"p{chosen.integers(9)}",
            "tipo_producto": f"t{chosen.integers(3)}",
            "ciudad": f"c{chosen.integers(4)}",
            "pais": f"n{chosen.integers(2)}",
            "tipo_cliente": f"k{chosen.integers(3)}",
            # a third of all sales has the same amount
            "total": 7.77 if chosen.random() < 0.34 else round(float(chosen.lognormal(3, 2)) + 0.01, 2),
        }
        for _ in range(700)
    ]
    return star(spark, tmp_path_factory.mktemp("random"), *changes), changes


def test_reports_agree_with_each_other(random_star):
    loaded, changes = random_star
    everything = sum(Decimal(str(c["total"])) for c in changes)
    by_region = reports.sales_by_region(loaded).collect()
    assert sum(r.total_transactions for r in by_region) == 700
    assert sum(r.total_sales for r in by_region) == everything
    assert reports.revenue_rollup(loaded).collect()[-1].total_sales == everything
    shares = [r.sales_percentage for r in reports.category_share(loaded).collect()]
    assert abs(sum(shares) - 100) <= Decimal("0.02")
    last = {r.year: r.cumulative_sales for r in reports.cumulative_sales(loaded).collect()}
    yearly = {r.year: r.total_sales for r in reports.yearly_growth(loaded).collect()}
    assert last == yearly
    assert explore.key_figures(loaded).first().ventas_totales == everything
    trend = explore.sales_trend(loaded).collect()
    assert trend[0].ventas == everything and trend[0].nivel == 3


def test_reports_do_not_depend_on_broadcasts(random_star):
    loaded, _ = random_star
    unknown = Star(**{n: loaded.table(n) for n in schemas.WAREHOUSE})  # no row counts
    assert loaded.is_small("dim_producto") and not unknown.is_small("dim_producto")
    for report in reports.REPORTS.values():
        assert report(loaded).collect() == report(unknown).collect()


@pytest.mark.parametrize("probabilities", [(0.25, 0.5, 0.75), (0.0, 0.1, 0.333, 0.999, 1.0)])
def test_quantiles_match_numpy(random_star, probabilities):
    loaded, changes = random_star
    found = distribution.exact_quantiles(loaded.fact_ventas, "total", probabilities).collect()
    expected = np.quantile([c["total"] for c in changes], probabilities)
    assert [r.quantile for r in sorted(found)] == pytest.approx(list(expected))


@pytest.mark.parametrize("digit", [1, 3, 60])
def test_quantiles_do_not_depend_on_the_digit(random_star, monkeypatch, digit):
    loaded, changes = random_star
    monkeypatch.setattr(distribution, "DIGIT", digit)
    found = distribution.exact_quantiles(loaded.fact_ventas, "total", (0.25, 0.8)).collect()
    expected = np.quantile([c["total"] for c in changes], (0.25, 0.8))
    assert [r.quantile for r in sorted(found)] == pytest.approx(list(expected))


def test_order_statistics_of_negative_and_repeated_values(spark):
    draw = np.random.default_rng(2)
    numbers = np.concatenate([draw.integers(-(10**17), 10**17, 200), np.full(300, -5), [7, 7]])
    values = spark.createDataFrame([(int(v),) for v in numbers], "v long")
    ranks = [0, 1, 99, 100, 250, 399, 400, 501]
    low, high = int(numbers.min()), int(numbers.max())
    found = distribution.order_statistics(values, low, high, ranks)
    assert found == {rank: int(np.sort(numbers)[rank]) for rank in ranks}


def test_quantiles_of_nothing_and_of_one_value(spark):
    one = spark.createDataFrame([(money("3.50"),), (None,)], "total decimal(14,2)")
    assert [tuple(r) for r in distribution.exact_quantiles(one, "total", (0.0, 0.9)).collect()] == [
        (0.0, 3.5),
        (0.9, 3.5),
    ]
    none = one.filter("total < 0")
    assert distribution.exact_quantiles(none, "total", (0.5,)).count() == 0
    row = distribution.box_plot(none, "total").first()
    assert row.q1 is None and row.maximo is None and (row.filas, row.atipicos) == (0, 0)
    with pytest.raises(TypeError):
        distribution.exact_quantiles(one.select(F.col("total").cast("double")), "total", (0.5,))


def test_box_plot(random_star):
    loaded, changes = random_star
    totals = np.array([c["total"] for c in changes])
    q1, q3 = np.quantile(totals, (0.25, 0.75))
    row = explore.sales_box_plot(loaded).first()
    outside = (totals < q1 - 1.5 * (q3 - q1)) | (totals > q3 + 1.5 * (q3 - q1))
    assert row.atipicos == outside.sum() and row.filas == 700


def test_histogram_matches_numpy(random_star):
    loaded, changes = random_star
    cents = [round(c["total"] * 100) for c in changes]
    low, high = min(cents), max(cents)
    expected = [0] * 20
    for c in cents:
        expected[min((c - low) * 20 // (high - low), 19)] += 1
    assert [r.filas for r in explore.sales_histogram(loaded).collect()] == expected


def test_histogram_of_one_value(spark):
    loaded = bare_star(spark, [fact_row(1, "5"), fact_row(2, "5")])
    assert [r.filas for r in explore.sales_histogram(loaded, 3).collect()] == [2, 0, 0]


def test_matrix_sums_what_is_not_named(random_star):
    loaded, _ = random_star
    whole = explore.country_category_matrix(loaded, ["t0", "t1", "t2"])
    assert whole.columns == ["pais", "t0", "t1", "t2", "otras"]
    part = {r.pais: r for r in explore.country_category_matrix(loaded, ["t1"]).collect()}
    for r in whole.collect():
        assert r.otras is None and part[r.pais].t1 == r.t1
        left = [x for x in (r.t0, r.t2) if x is not None]
        assert part[r.pais].otras == (sum(left) if left else None)
