"""Sources, cleaning, filters and the load boundary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almacen.checks import oracle_parts as o
from almacen.checks.derived import Derived
from almacen.checks.mapping import RAW_HEADERS, table
from almacen.checks.registry import check
from almacen.functions.dates import calendar_columns, parse_date, voted_format
from almacen.functions.text import clean_text, title_case, underscores_to_spaces
from almacen.model import NULL_DEFAULTS, REQUIRED_COLUMNS
from almacen.operators import boundary, cleaning, facts, profiling
from almacen.plans import cleaning_run
from almacen.sources import files

_RAW_AS_LOADED = ", ".join(f'{c} as "{header}"' for c, header in RAW_HEADERS.items())
_TYPED_OUTPUT = """
  strftime(fecha, '%Y-%m-%d') as fecha, producto, tipo_producto, cantidad, precio_unitario,
  descuento, costo_envio, total, tipo_venta, tipo_cliente, ciudad, pais"""


def _with(parts: str, select: str) -> str:
    return f"with {parts} {select}"


def _named(d: Derived) -> DataFrame:
    return cleaning.normalise_names(d.raw)


# --- sources and sinks --------------------------------------------------------


@check("s01_raw_csv_scan", _with(o.RAW, f"select {_RAW_AS_LOADED} from raw"))
def raw_scan(d: Derived) -> DataFrame:
    return d.raw


@check(
    "s01b_malformed_lines",
    "select doc_id, true as mala from documents where doc_id % 3 = 1",
)
def malformed(d: Derived) -> DataFrame:
    """Lines of long cells full of quotes: too many cells, too few, and just enough."""
    docs = table(d.spark, d.sf_dir, "documents")
    flat = F.regexp_replace("text", r"[\r\n]", " ")
    cell = F.concat(F.lit('"'), F.replace(flat, F.lit('"'), F.lit('""')), F.lit('"'))
    quotes = F.concat(F.lit('"'), F.repeat(F.lit('"",'), 5000), F.lit('"'))
    rest = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(","), quotes))
    rest = rest.when(F.col("doc_id") % 3 == 1, F.lit(",b,c,d")).otherwise(F.lit(""))
    path = f"{d.folder}/malformed_csv"
    line = F.concat(F.col("doc_id").cast("string"), F.lit(","), cell, rest)
    # Each task writes a file of its own, so the first line of each task comes after a header.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    line = F.when(first, F.concat(F.lit("a,b,c\n"), line)).otherwise(line)
    header = d.spark.createDataFrame([("a,b,c",)], "value string")
    lines = header.union(docs.select(line.alias("value")))
    lines.write.mode("overwrite").option("maxRecordsPerFile", 0).text(path)
    bad = files.malformed_lines(d.spark, path)
    key = F.substring_index("linea", ",", 1).cast("long").alias("doc_id")
    return bad.select(key, F.lit(True).alias("mala"))


@check("s02_clean_csv_scan", _with(o.UP_TO_ACCEPTED, f"select {o.CLEAN_OUTPUT} from accepted"))
def clean_scan(d: Derived) -> DataFrame:
    rows = files.load_clean_csv(d.spark, d.clean_csv_path)
    return (
        rows.transform(boundary.require_columns)
        .transform(boundary.type_clean_columns)
        .transform(boundary.drop_incomplete)
    )


@check("s03_clean_export", _with(o.UP_TO_CLEAN, f"select {o.CLEAN_OUTPUT} from clean"))
def clean_export(d: Derived) -> DataFrame:
    path = f"{d.folder}/exported"
    files.export_clean(d.cleaned, path)
    return d.spark.read.parquet(path)


# --- transforms ---------------------------------------------------------------


@check("t01_column_names", _with(o.RAW, "select * from raw"))
def column_names(d: Derived) -> DataFrame:
    return _named(d)


@check("t02_clean_text", f"select doc_id, {o.clean_text('text')} as text from documents")
def cleaned_documents(d: Derived) -> DataFrame:
    docs = table(d.spark, d.sf_dir, "documents")
    return docs.select("doc_id", clean_text(F.col("text")).alias("text"))


@check("t03_clean_text_columns", _with(o.UP_TO_TEXT, "select * from cleaned_text"))
def cleaned_columns(d: Derived) -> DataFrame:
    return cleaning.clean_text_columns(_named(d))


@check("t04_title_case", f"select doc_id, {o.title('text')} as text from documents")
def cased_documents(d: Derived) -> DataFrame:
    docs = table(d.spark, d.sf_dir, "documents")
    return docs.select("doc_id", title_case(F.col("text")).alias("text"))


@check("t04b_standard_case", _with(o.UP_TO_CASE, "select * from cased"))
def cased_columns(d: Derived) -> DataFrame:
    return cleaning.standardise_case(cleaning.clean_text_columns(_named(d)))


@check(
    "t05_underscores",
    _with(
        o.RAW,
        """select replace(tipo_producto, '_', ' ') as tipo_producto,
                  replace(tipo_venta, '_', ' ') as tipo_venta from raw""",
    ),
)
def spaced(d: Derived) -> DataFrame:
    return _named(d).select(
        *[underscores_to_spaces(F.col(c)).alias(c) for c in ("tipo_producto", "tipo_venta")]
    )


_NUMBERS = ", ".join(f"{o.parsed_number(c)} as {c}" for c in o.MEASURES)


@check("t06_parse_numbers", _with(o.RAW, f"select {_NUMBERS} from raw"))
def numbers(d: Derived) -> DataFrame:
    return cleaning.convert_types(_named(d)).select(*o.MEASURES)


@check(
    "t07_parse_dates",
    _with(
        o.RAW,
        """select fecha as texto, strftime(try_strptime(fecha, '%Y-%m-%d'), '%Y-%m-%d') as fecha
           from raw""",
    ),
)
def dates(d: Derived) -> DataFrame:
    return cleaning.convert_types(_named(d).withColumn("texto", F.col("fecha"))).select(
        "texto", "fecha"
    )


_DATE_TEXT = """
  case when o_orderkey % 10 < 6 then strftime(o_orderdate, '%d/%m/%Y')
       when o_orderkey % 10 < 9 then strftime(o_orderdate, '%Y-%m-%d')
       else strftime(o_orderdate, '%m.%d.%Y') end"""
_VOTES = " union all ".join(
    f"select '{f}' as f, count(try_strptime(texto, '{f}')) as n from texts"
    for f in ("%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%m.%d.%Y")
)
DATE_CANDIDATES = ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "MM.dd.yyyy")


@check(
    "t07b_voted_dates",
    f"""with texts as (select o_orderkey, {_DATE_TEXT} as texto from orders),
        votes as ({_VOTES})
        select o_orderkey, texto, (select arg_max(f, n) from votes) as formato,
               strftime(try_strptime(texto, '%d/%m/%Y'), '%Y-%m-%d') as fecha
        from texts""",
)
def voted_dates(d: Derived) -> DataFrame:
    """Dates in three formats; the one that reads most of them is used for all."""
    day = F.col("o_orderdate")
    text = F.when(F.col("o_orderkey") % 10 < 6, F.date_format(day, "dd/MM/yyyy"))
    text = text.when(F.col("o_orderkey") % 10 < 9, F.date_format(day, "yyyy-MM-dd"))
    text = text.otherwise(F.date_format(day, "MM.dd.yyyy")).alias("texto")
    rows = table(d.spark, d.sf_dir, "orders").select("o_orderkey", text)
    winner = voted_format(rows, "texto", DATE_CANDIDATES)
    shown = winner.replace("dd", "%d").replace("MM", "%m").replace("yyyy", "%Y")
    return rows.select(
        "o_orderkey",
        "texto",
        F.lit(shown).alias("formato"),
        parse_date(F.col("texto"), [winner]).alias("fecha"),
    )


@check(
    "t08_calendar",
    """select o_orderkey, cast(year(o_orderdate) as bigint) as year,
              cast(month(o_orderdate) as bigint) as month,
              strftime(o_orderdate, '%Y-%m') as year_month from orders""",
)
def calendar(d: Derived) -> DataFrame:
    orders = table(d.spark, d.sf_dir, "orders")
    parts = calendar_columns(F.col("o_orderdate"))
    return orders.select("o_orderkey", *[c.alias(name) for name, c in parts.items()])


@check(
    "t09_segments",
    _with(
        o.UP_TO_UNIQUE,
        """select tipo_cliente, case when tipo_cliente in ('Corporativo', 'Gobierno') then 'Enterprise'
                  when tipo_cliente = 'Mayorista' then 'Wholesale' else 'Retail' end as segmento_cliente,
                  count(*) as filas
           from uniques group by all""",
    ),
)
def segments(d: Derived) -> DataFrame:
    rows = cleaning.derive_columns(_unique(d))
    return rows.groupBy("tipo_cliente", "segmento_cliente").agg(F.count(F.lit(1)).alias("filas"))


@check(
    "t10_null_defaults",
    _with(
        o.UP_TO_TYPES,
        """select coalesce(descuento, 0) as descuento, coalesce(costo_envio, 0) as costo_envio,
                  coalesce(tipo_venta, 'Desconocido') as tipo_venta,
                  coalesce(tipo_cliente, 'Desconocido') as tipo_cliente,
                  coalesce(ciudad, 'Desconocida') as ciudad, pais, producto, tipo_producto
           from typed""",
    ),
)
def defaults(d: Derived) -> DataFrame:
    rows = cleaning.fill_nulls(cleaning_run.prepare(d.raw))
    return rows.select(
        "descuento",
        "costo_envio",
        "tipo_venta",
        "tipo_cliente",
        "ciudad",
        "pais",
        "producto",
        "tipo_producto",
    )


@check(
    "t11_column_order",
    _with(
        o.UP_TO_TYPES,
        """select strftime(fecha, '%Y-%m-%d') as fecha, producto, tipo_producto, cantidad,
                  precio_unitario, descuento, total, tipo_venta, tipo_cliente, ciudad, pais
           from typed""",
    ),
)
def ordered(d: Derived) -> DataFrame:
    rows = cleaning_run.prepare(d.raw).withColumn("nota", F.lit("x")).drop("costo_envio")
    return cleaning.order_columns(rows)


@check(
    "t12_measure_types",
    _with(
        o.SALES,
        """select cast(cantidad as double) as cantidad,
                  cast(precio_unitario as double) as precio_unitario,
                  cast(descuento as double) as descuento, cast(costo_envio as double) as costo_envio,
                  cast(total as double) as total from sales""",
    ),
)
def measure_types(d: Derived) -> DataFrame:
    return facts.type_measures(d.tidy.select(*o.MEASURES))


# --- filters, duplicates, pipeline -----------------------------------------------


@check("f01_positive_sales", _with(o.UP_TO_TYPES, f"select {_TYPED_OUTPUT} from typed where total > 0"))
def positive(d: Derived) -> DataFrame:
    return cleaning.positive_sales(cleaning_run.prepare(d.raw))


@check(
    "f02_critical_nulls",
    _with(
        o.UP_TO_TYPES,
        f"""select {_TYPED_OUTPUT} from typed where fecha is not null and producto is not null
            and cantidad is not null and precio_unitario is not null""",
    ),
)
def complete(d: Derived) -> DataFrame:
    return cleaning.complete_sales(cleaning_run.prepare(d.raw))


def _unique(d: Derived) -> DataFrame:
    return cleaning.remove_duplicates(cleaning_run.kept(d.raw))


@check("f03_exact_dedup", _with(o.UP_TO_UNIQUE, f"select {_TYPED_OUTPUT} from uniques"))
def unique(d: Derived) -> DataFrame:
    return _unique(d)


@check("f04_cleaning_pipeline", _with(o.UP_TO_CLEAN, f"select {o.CLEAN_OUTPUT} from clean"))
def pipeline(d: Derived) -> DataFrame:
    return cleaning_run.clean(d.raw)


_RAW_REASON = f"""
  case when coalesce({o.parsed_number("total")}, 0) <= 0 then 'non_positive_total'
       when try_strptime(fecha, '%Y-%m-%d') is null or producto is null
         or {o.parsed_number("cantidad")} is null or {o.parsed_number("precio_unitario")} is null
         then 'null_critical_column' end"""
_RAW_CELLS = ("fecha", "producto", "cantidad", "precio_unitario", "total")


@check(
    "f04b_rejected_rows",
    _with(
        o.RAW,
        f"""select motivo, {", ".join(_RAW_CELLS)}, count(*) as copias
            from (select *, {_RAW_REASON} as motivo from raw) r where motivo is not null group by all""",
    ),
)
def rejected_rows(d: Derived) -> DataFrame:
    """What the run left out, with the offending cells as the file has them."""
    cells = [F.col(f"celdas.{c}").alias(c) for c in _RAW_CELLS]
    rows = d.cleaning.rejected.select("motivo", *cells, "copias")
    return rows.groupBy("motivo", *_RAW_CELLS).agg(F.sum("copias").alias("copias"))


# --- load boundary -----------------------------------------------------------------


@check(
    "l01_required_columns",
    _with(
        o.UP_TO_CLEAN,
        f"""select {o.DAY} as fecha, producto, tipo_producto, tipo_cliente, segmento_cliente,
                   tipo_venta, ciudad, pais, total from clean""",
    ),
)
def required(d: Derived) -> DataFrame:
    return boundary.require_columns(d.cleaned).select(*REQUIRED_COLUMNS)


@check(
    "l02_required_nulls",
    _with(
        o.UP_TO_ARRIVED,
        f"""select {o.REASON} as motivo, {o.CLEAN_OUTPUT} from arrived
            where {o.REASON} is not null""",
    ),
)
def incomplete(d: Derived) -> DataFrame:
    return boundary.rejected(boundary.blank_tokens_to_null(d.cleaned))


@check("l03_tokens_again", _with(o.UP_TO_ARRIVED, f"select {o.CLEAN_OUTPUT} from arrived"))
def tokens(d: Derived) -> DataFrame:
    return boundary.blank_tokens_to_null(d.cleaned)


# --- measures of the cleaning ----------------------------------------------------------


@check(
    "m01_stage_audit",
    _with(
        o.UP_TO_UNIQUE,
        """select (select count(*) from typed) as leidas,
                  (select count(*) from typed where coalesce(total, 0) <= 0) as total_no_positivo,
                  (select count(*) from typed where total > 0) - (select count(*) from kept)
                    as critica_nula,
                  (select count(*) from kept) - (select count(*) from uniques) as duplicadas,
                  (select count(*) from uniques) as limpias""",
    ),
)
def audit(d: Derived) -> DataFrame:
    return d.cleaning.audit


_TYPES = {c: "double" for c in o.MEASURES} | {"fecha": "timestamp_ntz"}
_NULL_ROWS = " union all ".join(
    f"""select '{c}' as columna, count(*) - count({c}) as nulos,
               '{_TYPES.get(c, "string")}' as tipo from typed"""
    for c in RAW_HEADERS
)


@check("m02_null_profile", _with(o.UP_TO_TYPES, _NULL_ROWS))
def null_profile(d: Derived) -> DataFrame:
    return profiling.null_profile(cleaning_run.prepare(d.raw))


_FILLED_ROWS = " union all ".join(
    f"select '{c}' as columna, count(*) - count({c}) as nulos from uniques" for c in NULL_DEFAULTS
)
_REMAINING = " + ".join(f"count(*) - count({c})" for c in RAW_HEADERS if c not in NULL_DEFAULTS)


@check(
    "m03_filled_nulls",
    _with(
        o.UP_TO_UNIQUE,
        f"{_FILLED_ROWS} union all select '(restantes)', cast({_REMAINING} as bigint) from uniques",
    ),
)
def filled(d: Derived) -> DataFrame:
    return d.cleaning.filled


@check(
    "m04_table_summary",
    _with(
        o.UP_TO_CLEAN,
        """select count(*) as filas, cast(16 as bigint) as columnas,
                  strftime(min(fecha), '%Y-%m-%d') as desde, strftime(max(fecha), '%Y-%m-%d') as hasta,
                  2 * count(*) - count(tipo_producto) - count(pais) as nulos
           from clean""",
    ),
)
def summary(d: Derived) -> DataFrame:
    return profiling.table_summary(d.cleaned)


@check(
    "m05_segment_counts",
    _with(
        o.UP_TO_CLEAN,
        "select segmento_cliente, count(*) as filas from clean group by segmento_cliente",
    ),
)
def segment_counts(d: Derived) -> DataFrame:
    return profiling.value_counts(d.cleaned, "segmento_cliente")
