"""Hand-made raw rows, one for each rule, through cleaning and the load boundary."""

from __future__ import annotations

import datetime

import pytest
from builders import BASE, raw

from almacen.checks.derived import derived
from almacen.functions import dates
from almacen.model import CLEAN_COLUMNS, NULL_DEFAULTS
from almacen.operators import boundary, cleaning, profiling
from almacen.plans import cleaning_run
from almacen.sources import files
from almacen.sources.workspace import shared_folder


def cleaned(spark, *changes):
    # null in place of tokens, as the file reader gives them
    rows = boundary.blank_tokens_to_null(raw(spark, *changes))
    return cleaning_run.clean(rows).collect()


def one(spark, **change):
    rows = cleaned(spark, change)
    assert len(rows) == 1
    return rows[0]


def after_boundary(spark, **change):
    """None when the row enters the star, else why not."""
    rows = cleaning_run.clean(boundary.blank_tokens_to_null(raw(spark, change)))
    lost = boundary.rejected(boundary.blank_tokens_to_null(rows)).collect()
    return lost[0].motivo if lost else None


def test_base_row(spark):
    row = one(spark)
    assert row.__fields__ == list(CLEAN_COLUMNS)
    assert tuple(row) == (
        datetime.datetime(2024, 1, 15),
        2024,
        1,
        "2024-01",
        "Café Molido",
        "Bebidas Calientes",
        2.0,
        10.5,
        0.1,
        5.0,
        18.9,
        "En Linea",
        "Corporativo",
        "Enterprise",
        "São Paulo",
        "Brasil",
    )
    assert after_boundary(spark) is None


def test_rows_equal_after_cleaning_are_duplicates(spark):
    assert len(cleaned(spark, {}, {"producto": "CAFÉ  MOLIDO"})) == 1


@pytest.mark.parametrize("total", ["-5", "0", "abc", "", "nan", "inf", "1e400"])
def test_totals_that_are_not_positive_numbers_are_dropped(spark, total):
    assert cleaned(spark, {"total": total}) == []


@pytest.mark.parametrize(
    "change",
    [
        {"fecha": "not a date"},
        {"fecha": "31/01/2024"},
        {"cantidad": ""},
        {"cantidad": "1,000"},
        {"producto": ""},
        {"precio_unitario": "N/A"},
    ],
)
def test_null_critical_columns_are_dropped(spark, change):
    assert cleaned(spark, change) == []


def test_numbers(spark):
    assert one(spark, cantidad=" 12 ").cantidad == 12.0
    assert one(spark, cantidad="1e3").cantidad == 1000.0
    assert one(spark, descuento="1d").descuento == 0.0


def test_duplicates_go_before_defaults_come(spark):
    rows = cleaned(spark, {"descuento": ""}, {"descuento": "0"})
    assert len(rows) == 2 and rows[0] == rows[1]


@pytest.mark.parametrize(
    "given, kind, segment",
    [
        ("NA", "Desconocido", "Retail"),
        ("gobierno", "Gobierno", "Enterprise"),
        ("MAYORISTA", "Mayorista", "Wholesale"),
        ("minorista", "Minorista", "Retail"),
    ],
)
def test_segments(spark, given, kind, segment):
    row = one(spark, tipo_cliente=given)
    assert (row.tipo_cliente, row.segmento_cliente) == (kind, segment)


def test_empty_texts_and_tokens_at_the_boundary(spark):
    assert one(spark, ciudad="").ciudad == "Desconocida"
    assert one(spark, ciudad="###").ciudad == ""
    assert one(spark, tipo_venta="none").tipo_venta == "None"
    assert one(spark, pais="").pais is None
    assert after_boundary(spark, ciudad="###") == "null ciudad"
    assert after_boundary(spark, producto="###") == "null producto"
    assert after_boundary(spark, tipo_venta="none") == "null tipo_venta"
    assert after_boundary(spark, pais="") == "null pais"
    assert after_boundary(spark, tipo_producto="") == "null tipo_producto"


def test_texts(spark):
    assert one(spark, producto="o'neil 3m x-large").producto == "O'Neil 3M X-Large"
    assert one(spark, producto="café\xa0　molido").producto == "Café Molido"
    assert one(spark, producto="coca_cola").producto == "Coca_Cola"
    assert one(spark, tipo_venta="coca_cola").tipo_venta == "Coca Cola"


def test_columns_outside_the_contract_count_for_duplicates_only(spark):
    from pyspark.sql import functions as F

    rows = raw(spark, {}, {})
    noted = rows.withColumn("nota", F.monotonically_increasing_id().cast("string"))
    noted = spark.createDataFrame(noted.collect(), noted.schema)
    result = cleaning_run.clean(noted).collect()
    assert len(result) == 2 and result[0] == result[1] and "nota" not in result[0]


def test_column_names(spark):
    frame = spark.createDataFrame([(1, 2)], [" Tipo Producto ", "Precio  Unitario"])
    assert cleaning.normalise_names(frame).columns == ["tipo_producto", "precio__unitario"]
    with pytest.raises(ValueError, match="total"):
        cleaning.normalise_names(spark.createDataFrame([(1, 2)], ["Total", " total "]))


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="total"):
        cleaning_run.clean(raw(spark, {}).drop("total"))
    with pytest.raises(ValueError, match="pais"):
        boundary.require_columns(raw(spark, {}).drop("pais"))


def test_early_and_late_null_rules_keep_the_same_rows(spark):
    rows = boundary.blank_tokens_to_null(
        raw(spark, {}, {"producto": ""}, {"producto": "###"}, {"fecha": ""}, {"total": "-1"})
    )
    late = cleaning.apply_business_rules(cleaning_run.prepare(rows))
    assert sorted(cleaning_run.kept(rows).collect()) == sorted(late.collect())


def test_audit_counts_add_up(spark):
    rows = boundary.blank_tokens_to_null(
        raw(spark, {}, {}, {}, {"total": "-5"}, {"total": ""}, {"cantidad": "x"}, {"total": "7"})
    )
    prepared = cleaning_run.prepare(rows)
    audit = profiling.cleaning_audit(prepared).first().asDict()
    assert audit == {
        "leidas": 7,
        "total_no_positivo": 2,
        "critica_nula": 1,
        "duplicadas": 2,
        "limpias": 2,
    }
    empty = profiling.cleaning_audit(prepared.filter("false")).first().asDict()
    assert set(empty.values()) == {0}
    reasons = sorted(r.motivo for r in cleaning_run.rejected(rows).collect())
    assert reasons == ["non_positive_total", "non_positive_total", "null_critical_column"]


def test_filled_nulls(spark):
    rows = boundary.blank_tokens_to_null(raw(spark, {"descuento": "", "pais": ""}, {"ciudad": ""}))
    counts = {r.columna: r.nulos for r in profiling.filled_nulls(rows, NULL_DEFAULTS).collect()}
    assert counts == {
        "descuento": 1,
        "costo_envio": 0,
        "tipo_venta": 0,
        "tipo_cliente": 0,
        "ciudad": 1,
        "(restantes)": 1,
    }


def test_csv_cells(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_bytes(
        '﻿a, B ,c\n"x ""q"" y","1,000",""\n"two\nlines",NA,none\n'.encode("utf-8")
    )
    rows = files.load_raw(spark, str(path), multiline=True)
    assert rows.columns == ["a", " B ", "c"]
    assert [tuple(r) for r in rows.collect()] == [
        ('x "q" y', "1,000", None),
        ("two\nlines", None, "none"),
    ]


@pytest.mark.parametrize(
    "line", ["2024-01-02,pan,6,extra", "2024-01-02,pan,6,", '2024-01-03,"a\nb",7', '2024-01-03,7,"a\nb"']
)
def test_malformed_lines_are_an_error_and_listed(spark, tmp_path, line):
    path = tmp_path / "raw.csv"
    path.write_text(f'a,b`x,c\n1,"x,y",2\n{line}\nshort\n', encoding="utf-8")
    assert files.malformed_lines(spark, str(path)).count() >= 1
    with pytest.raises(Exception, match="malformed line"):
        files.load_raw(spark, str(path)).select("a").collect()


def test_cells_of_a_million_quotes_need_no_recursion(spark, tmp_path):
    path = tmp_path / "raw.csv"
    cell = '"' + '"",' * 350_000 + '"'
    plain = '"' + "y" * 1_000_000 + '"'
    lines = [f"1,{cell}", f"2,{plain}", f"3,{cell},5", f"4,{cell},5,6", f"5,{plain},5,6"]
    path.write_text("a,b,c\n" + "\n".join(lines) + "\n", encoding="utf-8")
    bad = files.malformed_lines(spark, str(path)).collect()
    assert sorted(r.linea[0] for r in bad) == ["4", "5"]


@pytest.mark.parametrize("order", [1, 7])
def test_dates_vote_on_their_format(spark, order):
    texts = ["31/12/2023", "01/02/2024", "2024-01-15", None, "13/01/2024", "02-2024"]
    rows = spark.createDataFrame([(t,) for t in texts], "d string").repartition(order)
    formats = ("yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy")
    assert dates.voted_format(rows, "d", formats) == "dd/MM/yyyy"
    with pytest.raises(ValueError, match="may be read as MM/dd/yyyy or dd/MM/yyyy"):
        dates.voted_format(rows.filter("d = '01/02/2024'"), "d", formats)
    assert dates.voted_format(rows.filter("d = '2024-01-15'"), "d", ("yyyy-MM-dd", "yyyy-M-d")) == "yyyy-MM-dd"
    with pytest.raises(ValueError, match="all 1 values of d are unreadable"):
        dates.voted_format(rows.filter("d = '02-2024'"), "d", formats)


def test_a_file_is_read_in_the_format_its_dates_vote_for(spark, tmp_path):
    header = ",".join(c.upper().replace("_", " ") for c in BASE)
    line = ",".join({**BASE, "fecha": "15/01/2024"}.values())
    (tmp_path / "raw.csv").write_text(f"{header}\n{line}\n{line}\n", encoding="utf-8")
    run = cleaning_run.run_cleaning(
        spark,
        str(tmp_path / "raw.csv"),
        str(tmp_path / "clean"),
        date_candidates=("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy"),
    )
    assert [str(r.fecha)[:10] for r in run.clean.collect()] == ["2024-01-15"]
    assert run.audit.first().duplicadas == 1


def test_the_raw_file_is_scanned_once(spark, tmp_path):
    plan = cleaning_run.grouped(files.load_raw(spark, derived(spark, "/root/testdata/sf0.001").raw_path))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan csv") == 1 and text.count("Exchange") == 1
    run = derived(spark, "/root/testdata/sf0.001").cleaning
    for output in (run.clean, run.rejected, run.audit, run.filled):
        assert "FileScan csv" not in output._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("piece", [7, 40, 1 << 20])
def test_records_with_line_breaks_are_put_together_across_splits(spark, tmp_path, piece):
    folder = tmp_path / "raw"
    folder.mkdir()
    long = "x" * 30 + "\n" * 5 + '""' + "y,z" * 20
    cells = [
        ["1", "plain", "5"],
        ["2", "two\nlines", "6"],
        ["3", long.replace('""', '"'), "7"],
        ["4", 'an inch 5" mark', "8"],
        ["5", "\n\n", "9"],
        ["6", "", "end"],
    ]
    lines = ["a,b,c", "1,plain,5", '2,"two\nlines",6', f'3,"{long}",7', '4,an inch 5" mark,8']
    lines += ['5,"\n\n",9', "", '6,"",end']
    (folder / "one.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    (folder / "two.csv").write_bytes("\r\n".join(["a,b,c", '7,"a\nb",1', "8,z,2"]).encode())
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(piece))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        rows = files.load_raw(spark, str(folder), multiline=True)
        found = sorted(map(tuple, rows.collect()))
        splits = spark.read.text(str(folder)).rdd.getNumPartitions()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    expected = [tuple(x or None for x in row) for row in cells] + [("7", "a\nb", "1"), ("8", "z", "2")]
    assert found == sorted(expected)
    assert splits > 1 or piece > 1000


def test_short_lines_are_padded(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('a,b`x,c\n1,"x,y",2\nshort\n1,"a,b"\n', encoding="utf-8")
    rows = files.load_raw(spark, str(path))
    assert rows.columns == ["a", "b`x", "c"]
    assert sorted(map(tuple, rows.collect()), key=str) == [
        ("1", "a,b", None),
        ("1", "x,y", "2"),
        ("short", None, None),
    ]
    assert files.malformed_lines(spark, str(path)).isEmpty()


def test_a_file_of_unreadable_dates_is_an_error(spark, tmp_path):
    header = ",".join(c.upper().replace("_", " ") for c in BASE)
    line = ",".join({**BASE, "fecha": "15/01/2024"}.values())
    (tmp_path / "raw.csv").write_text(f"{header}\n{line}\n", encoding="utf-8")
    with pytest.raises(ValueError, match="all 1 values of fecha are unreadable"):
        cleaning_run.run_cleaning(spark, str(tmp_path / "raw.csv"), str(tmp_path / "clean"))


def test_cleaning_run_from_file_to_stored_dataset(spark, tmp_path):
    header = ",".join(c.upper().replace("_", " ") for c in BASE)
    lines = [header, ",".join(BASE.values()), ",".join({**BASE, "total": "-1"}.values())]
    (tmp_path / "raw.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    for _ in range(2):  # replaces its output
        run = cleaning_run.run_cleaning(
            spark,
            str(tmp_path / "raw.csv"),
            str(tmp_path / "clean"),
            rejected_path=str(tmp_path / "rejected"),
            run_path=str(tmp_path / "run"),
        )
        stored = spark.read.parquet(str(tmp_path / "clean"))
        assert stored.count() == 1 and stored.columns == list(CLEAN_COLUMNS)
    assert sorted(run.clean.collect()) == sorted(stored.collect())
    assert run.audit.first().asDict() == {
        "leidas": 2, "total_no_positivo": 1, "critica_nula": 0, "duplicadas": 0, "limpias": 1
    }
    left_out = run.rejected.first()
    assert (left_out.motivo, left_out.celdas.total, left_out.copias) == ("non_positive_total", "-1", 1)
    assert spark.read.parquet(str(tmp_path / "rejected")).first().motivo == "non_positive_total"
    files.export_clean_csv(stored, str(tmp_path / "csv"))
    back = boundary.type_clean_columns(files.load_clean_csv(spark, str(tmp_path / "csv")))
    assert back.collect() == stored.collect()


def test_unreadable_clean_cells_are_an_error(spark):
    rows = spark.createDataFrame([("yesterday",)], "fecha string")
    with pytest.raises(Exception, match="unreadable fecha: yesterday"):
        boundary.type_clean_columns(rows).collect()


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
