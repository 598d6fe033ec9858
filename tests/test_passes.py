"""Large tables are written in passes, and what a pass shuffles goes when it ends."""

from __future__ import annotations

import glob
import gzip
import os
import time

from builders import raw, sales

from almacen.checks import derived, mapping
from almacen.checks.catalog import CHECKS
from almacen.operators import boundary, facts, joins
from almacen.plans import cleaning_run, star_load
from almacen.plans.star_load import load_star
from almacen.sources import files, passes
from almacen.sources.warehouse import Warehouse
from almacen.sources.workspace import shared_folder

SMALL = "/root/testdata/sf0.001"


def _shuffle_files(spark) -> set[str]:
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = (glob.glob(f"{d}/**/shuffle_*.data", recursive=True) for d in map(str, blocks.localDirsString()))
    # A look at whether a table is empty shuffles a row without columns.
    return {f for some in found for f in some if os.path.exists(f) and os.path.getsize(f) > 150}


def _left_over(spark, before: set[str]) -> set[str]:
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    return _shuffle_files(spark) - before


def _rows(df) -> list[str]:
    return sorted(map(str, df.collect()))


def _csv(spark, folder, *changes) -> str:
    files.export_clean_csv(raw(spark, *changes), str(folder))
    return str(folder)


def test_a_file_grouped_in_passes_gives_the_same_rows(spark, tmp_path, monkeypatch):
    twice = [{"descuento": "0"}, {"descuento": "-0.0"}, {"descuento": "0.00", "pais": " BRASIL "}]
    left_out = [{"total": "-1"}, {"total": "-1"}, {"total": "-1", "pais": None}, {"fecha": "x"}]
    others = [{"cantidad": str(i), "ciudad": None if i % 3 else "Cali"} for i in range(1, 40)]
    path = _csv(spark, tmp_path / "raw", *twice, *left_out, *others, *others[:7])
    expected = _rows(cleaning_run.grouped(files.load_raw(spark, path)))
    written = []
    write = passes.write_in_passes
    monkeypatch.setattr(
        passes, "write_in_passes", lambda parts, to: write((written.append(p) or p for p in parts), to)
    )
    monkeypatch.setattr(cleaning_run, "PASS_BYTES", 2500)
    before = _shuffle_files(spark)
    run = cleaning_run.clean_once(spark, path, str(tmp_path / "run"))
    assert not _left_over(spark, before)
    assert len(written) == passes.passes_for(passes.text_bytes(spark, path), 2500) > 1
    assert _rows(run.rows) == expected
    assert run.rows.filter("motivo is null and copias = 3").count() == 1
    folder = shared_folder(spark).removeprefix("file:")
    assert not glob.glob(f"{folder}/typed-*")


def test_a_cleaning_run_leaves_no_shuffle_files(spark, tmp_path):
    path = _csv(spark, tmp_path / "raw", {}, {}, {"total": "-1"})
    before = _shuffle_files(spark)
    cleaning_run.run_cleaning(spark, path, str(tmp_path / "clean"))
    assert not _left_over(spark, before)


def test_the_raw_file_of_the_checks_is_written_in_passes_and_compressed(spark, monkeypatch):
    inputs = derived.Derived(spark, SMALL)
    monkeypatch.setattr(derived, "_PASS_ITEMS", 2000)
    monkeypatch.setattr(derived, "_FILE_ROWS", 1000)
    before = _shuffle_files(spark)
    path = inputs.raw_path.removeprefix("file:")
    assert not _left_over(spark, before)
    written = glob.glob(f"{path}/part-*")
    assert all(f.endswith(".csv.gz") for f in written)
    text = sum(len(gzip.open(f).read()) for f in written)
    assert sum(map(os.path.getsize, written)) < text / 2
    assert text / 3 < passes.text_bytes(spark, path) < text * 3
    lines = [len(gzip.open(f, "rt", encoding="utf-8", newline="\n").readlines()) for f in written]
    assert max(lines) <= 1001
    plain = spark.read.option("header", True).option("escape", '"').csv(path).select(*mapping.RAW_HEADERS.values())
    mapping.raw_sales(spark, SMALL).write.option("header", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(f"{path}-once")
    once = spark.read.option("header", True).option("escape", '"').csv(f"{path}-once")
    assert _rows(plain) == _rows(once.select(*mapping.RAW_HEADERS.values()))


def test_parts_of_the_line_items_make_the_whole(spark):
    whole = mapping.line_items(spark, SMALL)
    parts = [mapping.line_items(spark, SMALL, (i, 3)) for i in range(3)]
    counts = [p.count() for p in parts]
    assert min(counts) > 0 and sum(counts) == whole.count()
    assert _rows(parts[0].union(parts[1]).union(parts[2])) == _rows(whole)


def test_text_bytes_of_an_empty_folder_is_nothing(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    assert passes.text_bytes(spark, str(tmp_path)) == 0
    assert [passes.passes_for(n, 10) for n in (0, 1, 10, 11, 20, 21)] == [1, 1, 1, 2, 2, 3]


def test_a_fact_loaded_in_passes_is_the_same_fact(spark, tmp_path, monkeypatch):
    changes = [{"producto": f"p{i % 9}", "total": float(i), "ciudad": "Cali" if i % 4 else "Lima"} for i in range(60)]
    clean = sales(spark, *changes, {"pais": None}, {"cantidad": None})
    columns = ["producto", "ciudad", "total", "cantidad"]

    def load(name):
        warehouse = Warehouse(spark, str(tmp_path / name))
        result = load_star(clean, warehouse)
        star = warehouse.read()
        rows = star.fact_ventas.join(star.dim_producto, "id_producto").join(star.dim_cliente, "id_cliente")
        return result, star, _rows(rows.join(star.dim_region, "id_region").select(*columns))

    result, _, expected = load("once")
    monkeypatch.setattr(star_load, "PASS_SALES", 25)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    numbers = []
    number_rows = facts.number_rows
    monkeypatch.setattr(
        facts, "number_rows", lambda fact, first_part: numbers.append(first_part) or number_rows(fact, first_part=first_part)
    )
    again, star, rows = load("passes")
    assert len(numbers) == 3 and numbers == sorted(set(numbers))
    assert rows == expected and len(rows) == 60
    assert (again.rows, again.read, again.left_out) == (result.rows, result.read, result.left_out)
    ids = sorted(r.id_venta for r in star.fact_ventas.select("id_venta").collect())
    assert ids == list(range(1, 61))


def test_loaded_sales_meet_their_products_first(spark):
    plan = CHECKS["d09b_loaded_sales"](spark, SMALL)
    tree = plan._jdf.queryExecution().analyzed().toString().split("\n")
    found = [line for line in tree if "Join Inner, (id_" in line]
    assert len(found) == 4 and "(id_producto" in found[-1]  # the innermost


def test_staged_tables_leave_no_shuffle_files(spark, tmp_path):
    before = _shuffle_files(spark)
    staging = Warehouse(spark, str(tmp_path)).stage()
    rows = spark.range(3000).repartition(3)
    stored = staging.write("keys", rows.groupBy("id").count())
    assert stored.count() == staging.rows["keys"] == 3000
    assert not _left_over(spark, before)


def test_the_clean_csv_of_the_checks_is_compressed(spark):
    inputs = derived.Derived(spark, SMALL)
    path = inputs.clean_csv_path.removeprefix("file:")
    written = glob.glob(f"{path}/part-*")
    assert written and all(f.endswith(".csv.gz") for f in written)
    rows = boundary.type_clean_columns(files.load_clean_csv(spark, path))
    assert _rows(rows) == _rows(boundary.blank_tokens_to_null(inputs.cleaned))
