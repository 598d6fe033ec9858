from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from builders import sales, star
from pyspark.sql import functions as F

from almacen.model import DIM_PRODUCTO, DIM_REGION, DIMENSIONS
from almacen.operators import constraints, dimensions, facts
from almacen.plans import reports, star_load
from almacen.sources import files
from almacen.sources.warehouse import PublishConflict, Star, Warehouse


def contents(table):
    return sorted(map(tuple, table.collect()))


def dims(loaded: Star):
    return {d.table: contents(loaded.table(d.table)) for d in DIMENSIONS}


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def test_nothing_is_published_before_the_first_load(warehouse):
    assert warehouse.version() == 0 and warehouse.read() is None


def test_loading_twice_changes_nothing(spark, warehouse):
    rows = sales(spark, {}, {"ciudad": "Bogota"}, {"producto": "Pan", "fecha": "2024-02-01"})
    first = star_load.load_star(rows, warehouse)
    again = star_load.load_star(rows, warehouse)
    assert (first.version, again.version) == (1, 2) and first.rows == again.rows
    assert dims(warehouse.read(1)) == dims(warehouse.read(2))
    assert warehouse.read().fact_ventas.count() == 3


def test_members_stay_and_new_ones_follow(spark, warehouse):
    star_load.load_star(sales(spark, {}, {"ciudad": "Bogota"}), warehouse)
    star_load.load_star(sales(spark, {"ciudad": "Quito", "pais": "Ecuador"}), warehouse)
    before, after = dims(warehouse.read(1)), dims(warehouse.read(2))
    assert [row for row in after["dim_region"] if row[0] <= 2] == before["dim_region"]
    assert after["dim_region"][2:] == [(3, "Quito", "Ecuador")]
    loaded = warehouse.read()
    assert loaded.fact_ventas.count() == 1  # the fact is replaced
    inactive = reports.inactive_customers(loaded).collect()
    assert sorted(row.ciudad for row in inactive) == ["Bogota", "Cali"]


def test_ids_do_not_depend_on_partitioning(spark):
    found = spark.range(20000).select(
        F.concat(F.lit("p"), "id").alias("producto"), F.lit("t").alias("tipo_producto")
    )
    one = contents(dimensions.assign_ids(found.coalesce(1), DIM_PRODUCTO, 7))
    many = contents(dimensions.assign_ids(found.repartition(13), DIM_PRODUCTO, 7))
    assert one == many and [row[0] for row in one] == list(range(8, 20008))


def test_a_sale_with_a_time_of_day_keeps_its_day(spark, tmp_path):
    loaded = star(spark, tmp_path, {"fecha": "2024-01-15 10:00:00"}, {"fecha": "2024-01-15"})
    assert [row[1] for row in contents(loaded.dim_fecha)] == [datetime.date(2024, 1, 15)]
    assert loaded.fact_ventas.count() == 2


def test_a_null_measure_gives_no_fact_row(spark, tmp_path):
    changes = [{"descuento": None, "producto": "Pan"}, {"costo_envio": None}, {}]
    loaded = star(spark, tmp_path, *changes)
    assert loaded.fact_ventas.count() == 1 and loaded.dim_producto.count() == 2
    lost = star_load.rejected(sales(spark, *changes), loaded).collect()
    assert sorted(row.motivo for row in lost) == ["null costo_envio", "null descuento"]


def test_rejected_sales_are_named(spark, tmp_path):
    changes = [{"ciudad": ""}, {"tipo_venta": "None"}, {"pais": None}, {}]
    loaded = star(spark, tmp_path, *changes)
    lost = star_load.rejected(sales(spark, *changes), loaded).collect()
    assert sorted(row.motivo for row in lost) == ["null ciudad", "null pais", "null tipo_venta"]
    assert loaded.fact_ventas.count() == 1


def test_absent_measures_get_their_default(spark, warehouse):
    star_load.load_star(sales(spark, {}).drop("descuento"), warehouse)
    assert warehouse.read().fact_ventas.first().descuento == Decimal("0.00")


def test_a_failed_load_leaves_the_published_version(spark, warehouse):
    star_load.load_star(sales(spark, {}), warehouse)
    with pytest.raises(constraints.ConstraintViolation, match=r"length\(ciudad\)"):
        star_load.load_star(sales(spark, {"ciudad": "x" * 101}), warehouse)
    with pytest.raises(Exception, match="descuento does not fit"):
        star_load.load_star(sales(spark, {"descuento": 1000.0}), warehouse)
    assert warehouse.version() == 1
    assert [row[1] for row in contents(warehouse.read().dim_region)] == ["Cali"]


def test_overlapping_loads_lose_no_member_and_share_no_id(spark, warehouse, monkeypatch):
    star_load.load_star(sales(spark, {}), warehouse)
    stage, other = warehouse.stage, sales(spark, {"ciudad": "Lima", "pais": "Peru"})

    def another_load_comes_first():
        staging = stage()
        monkeypatch.setattr(warehouse, "stage", stage)
        assert star_load.load_star(other, warehouse).version == 2
        return staging

    monkeypatch.setattr(warehouse, "stage", another_load_comes_first)
    mine = star_load.load_star(sales(spark, {"ciudad": "Quito", "pais": "Ecuador"}), warehouse)
    assert mine.version == 3
    regions = {r.ciudad: r.id_region for r in warehouse.read().dim_region.collect()}
    assert sorted(regions) == ["Cali", "Lima", "Quito"] and len(set(regions.values())) == 3
    assert [r.ciudad for r in warehouse.read(2).dim_region.orderBy("id_region").collect()] == ["Cali", "Lima"]
    assert len(warehouse.orphans()) == 1


def test_a_version_is_claimed_once(spark, warehouse):
    star_load.load_star(sales(spark, {}), warehouse)
    staging = warehouse.stage()
    staging.rows = dict(warehouse.read().rows)
    assert warehouse.publish(staging, 1) == 2
    with pytest.raises(PublishConflict):
        warehouse.publish(staging, 1)


def test_the_load_counts_what_it_leaves_out(spark, warehouse):
    rows = sales(spark, {}, {}, {"pais": None}, {"descuento": None})
    loaded = star_load.load_star(rows, warehouse)
    assert loaded.read == 4 and loaded.left_out == {"incomplete": 1, "null measure": 1}
    assert loaded.rows["fact_ventas"] == 2


def test_a_clean_csv_is_loaded_straight(spark, tmp_path):
    files.export_clean_csv(sales(spark, {}, {"ciudad": "Bogo\ntá"}), str(tmp_path / "csv"))
    loaded = star_load.run_load(
        spark, str(tmp_path / "csv"), str(tmp_path / "house"), csv=True, multiline=True
    )
    assert loaded.rows["fact_ventas"] == 2
    cities = Warehouse(spark, str(tmp_path / "house")).read().dim_region.collect()
    assert sorted(r.ciudad for r in cities) == ["Bogo\ntá", "Cali"]


def test_a_failed_load_writes_every_violation(spark, tmp_path):
    rows = spark.range(21).selectExpr("'t' as tabla", "'c' as restriccion", "string(id) as clave", "1L as filas")
    with pytest.raises(constraints.ConstraintViolation, match=r"t c \(21 rows\)") as raised:
        constraints.enforce(rows, str(tmp_path / "violations"))
    assert spark.read.parquet(raised.value.path).count() == 21
    constraints.enforce(rows.limit(0), str(tmp_path / "none"))


def test_every_constraint_finds_its_breach(spark, tmp_path):
    good = star(spark, tmp_path, {}, {})
    assert constraints.star_violations(good).collect() == []
    region = spark.createDataFrame(
        [(1, "Cali", "Colombia"), (2, "Cali", "Colombia"), (2, None, "Peru"), (3, "y" * 101, "P")],
        "id_region long, ciudad string, pais string",
    )
    fact = good.fact_ventas.withColumns({"id_venta": F.lit(1), "id_fecha": F.lit(99)})
    bad = Star(good.dim_fecha, region, good.dim_cliente, good.dim_producto, fact)
    found = {(r.tabla, r.restriccion, r.clave) for r in constraints.star_violations(bad).collect()}
    assert found == {
        ("dim_region", "unique(id_region)", "2"),
        ("dim_region", "unique(ciudad,pais)", "Cali|Colombia"),
        ("dim_region", "not_null(ciudad)", ""),
        ("dim_region", "length(ciudad)", ""),
        ("fact_ventas", "unique(id_venta)", "1"),
        ("fact_ventas", "foreign_key(id_fecha)", "99"),
    }
    empty = bad.dim_region.filter("false")
    orphan = Star(good.dim_fecha, empty, good.dim_cliente, good.dim_producto, good.fact_ventas)
    assert {r.restriccion for r in constraints.star_violations(orphan).collect()} == {
        "foreign_key(id_region)"
    }


def test_disagreeing_attributes_resolve_the_same_way_every_time(spark):
    rows = sales(spark, {}, {}).withColumn("month", F.lit(7)).union(sales(spark, {}))
    found = dimensions.members(facts.day_grain(rows), DIMENSIONS[3]).collect()
    assert [(r.month, r.year) for r in found] == [(1, 2024)]


def test_lookup_keeps_unknown_rows(spark):
    rows = sales(spark, {}, {"ciudad": "Lima"})
    table = dimensions.assign_ids(dimensions.members(sales(spark, {}), DIM_REGION), DIM_REGION)
    found = dimensions.lookup_id(rows, table, DIM_REGION)
    assert sorted((r.ciudad, r.id_region) for r in found.collect()) == [("Cali", 1), ("Lima", None)]


def test_views_answer_sql(spark, tmp_path):
    star(spark, tmp_path, {}, {"total": 5.0}).create_views()
    row = spark.sql(
        """select r.pais, sum(f.total) as ventas from fact_ventas f
           join dim_cliente c on f.id_cliente = c.id_cliente
           join dim_region r on c.id_region = r.id_region group by r.pais"""
    ).first()
    assert tuple(row) == ("Colombia", Decimal("15.00"))


def test_fact_ids_count_from_one(spark, tmp_path):
    def written(name, rows):
        rows.transform(facts.number_rows).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    rows = spark.range(0, 1000, 1, 7).filter("id not between 200 and 450")  # one partition is empty
    stored = written("gaps", rows)
    assert stored.agg(F.max("id_venta")).first()[0] > 1 << 33
    found = facts.gapless_ids(stored)
    numbered = contents(found)
    assert [n for n, _ in numbered] == list(range(1, 750))
    assert [i for _, i in numbered] == [i for i in range(1000) if not 200 <= i <= 450]
    assert contents(facts.gapless_ids(stored.repartition(3))) == numbered
    assert facts.gapless_ids(written("empty", rows.limit(0))).count() == 0


def test_ids_are_counted_only_where_they_are_used(spark, tmp_path):
    fact = star(spark, tmp_path, {}, {"total": 5.0}, {"ciudad": "Lima"}).fact_ventas
    assert sorted(r.id_venta for r in fact.collect()) == [1, 2, 3]
    plan = fact.groupBy("id_producto").agg(F.sum("total"))._jdf.queryExecution().executedPlan().toString()
    assert "ubquery" not in plan and "id_venta" not in plan
