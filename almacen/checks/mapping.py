"""The supplied test tables seen as sales: a tidy form and an untidy raw form.

Only the checks and the benchmark use this; the library does not know the
test tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almacen.functions.dates import calendar_columns
from almacen.model import CLEAN_COLUMNS
from almacen.sources.passes import in_pass

SEGMENTS = {"MACHINERY": "Enterprise", "AUTOMOBILE": "Enterprise", "BUILDING": "Wholesale"}

# From this date on, at the scale of the checks, many customer profiles have no sale.
RECENT = "2001-06-01"

# Untidy headers of the raw file, by the name cleaning gives them.
RAW_HEADERS = {
    "fecha": "Fecha",
    "producto": " Producto ",
    "tipo_producto": "Tipo Producto",
    "cantidad": "CANTIDAD",
    "precio_unitario": "Precio Unitario",
    "descuento": "descuento",
    "costo_envio": " Costo Envio",
    "total": "Total",
    "tipo_venta": "Tipo_Venta",
    "tipo_cliente": "Tipo Cliente ",
    "ciudad": "Ciudad",
    "pais": "PAIS",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def line_items(spark: SparkSession, sf_dir: str, part: tuple[int, int] = (0, 1)) -> DataFrame:
    """Every line item with its order, customer, place and part, money as decimals.

    Customers join the orders, so a line item is shuffled for its order and its part only;
    the few nations and regions come last and are carried by their keys until then.
    ``part`` (number, parts) takes the items of some of the orders; all parts make the whole.
    """
    items, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    if part[1] > 1:
        items = items.filter(in_pass(*part, "l_orderkey"))
        orders = orders.filter(in_pass(*part, "o_orderkey"))
    orders = orders.join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
    joined = (
        items.join(orders, F.expr("l_orderkey = o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    )
    return joined.withColumns(
        {
            "price": F.col("l_extendedprice").cast("decimal(12,2)"),
            "discount": F.col("l_discount").cast("decimal(5,2)"),
            "tax": F.col("l_tax").cast("decimal(5,2)"),
            "unit_price": F.col("p_retailprice").cast("decimal(12,2)"),
        }
    ).withColumns(
        {
            "shipping": F.round(F.col("price") * F.col("tax"), 2),
            "amount": F.round(F.col("price") * (1 - F.col("discount")), 2),
        }
    )


def tidy_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean sales, in the schema the star load takes."""
    rows = line_items(spark, sf_dir)
    segment = F.lit("Retail")
    for label, name in SEGMENTS.items():
        segment = F.when(F.col("c_mktsegment") == label, name).otherwise(segment)
    date = F.col("o_orderdate").cast("timestamp_ntz")
    return rows.select(
        date.alias("fecha"),
        *[c.alias(name) for name, c in calendar_columns(date).items()],
        F.col("p_name").alias("producto"),
        F.col("p_type").alias("tipo_producto"),
        F.col("l_quantity").alias("cantidad"),
        F.col("unit_price").cast("double").alias("precio_unitario"),
        F.col("discount").cast("double").alias("descuento"),
        F.col("shipping").cast("double").alias("costo_envio"),
        F.col("amount").cast("double").alias("total"),
        F.col("o_orderpriority").alias("tipo_venta"),
        F.col("c_mktsegment").alias("tipo_cliente"),
        segment.alias("segmento_cliente"),
        F.col("n_name").alias("ciudad"),
        F.col("r_name").alias("pais"),
    ).select(*CLEAN_COLUMNS)


_RAW_CELLS = {
    "fecha": """case when l_tax = 0.08 and l_linenumber = 1 then date_format(o_orderdate, 'dd/MM/yyyy')
                     when l_tax = 0.08 and l_linenumber = 2 then 'not a date'
                     else date_format(o_orderdate, 'yyyy-MM-dd') end""",
    "producto": """case when p_size = 50 then '###'
                        when p_size < 15 then concat('  ', upper(p_name), ' *')
                        when p_size < 25 then replace(p_name, ' ', concat(' ', chr(160)))
                        else p_name end""",
    "tipo_producto": "case when p_size <> 49 then concat(lower(p_type), '_line') end",
    "cantidad": """case when l_linenumber = 7 and l_tax = 0.0 then '1,000'
                        when l_linenumber = 6 and l_tax = 0.0 then ''
                        when l_linenumber = 5 then concat(cast(l_quantity as int), 'e0')
                        else concat(' ', cast(l_quantity as int), ' ') end""",
    "precio_unitario": "cast(unit_price as string)",
    "descuento": """case when l_discount = 0.1 then '1d'
                         when l_discount <> 0.05 then cast(discount as string) end""",
    "costo_envio": """case when l_tax = 0.0 then 'N/A' when l_tax = 0.01 then 'inf'
                           else cast(shipping as string) end""",
    "total": """case when l_returnflag = 'R' and l_linenumber = 1 then concat('-', amount)
                     when l_returnflag = 'R' and l_linenumber = 2 then 'nan'
                     when l_returnflag = 'R' and l_linenumber = 3 then '1e400'
                     else cast(amount as string) end""",
    "tipo_venta": """case when o_orderpriority = '4-NOT SPECIFIED' then null
                          when o_orderpriority = '5-LOW' and o_orderstatus = 'P' then 'none'
                          else concat('venta_', lower(substr(o_orderpriority, 3))) end""",
    "tipo_cliente": """case c_mktsegment when 'MACHINERY' then 'corporativo'
                            when 'AUTOMOBILE' then 'GOBIERNO' when 'BUILDING' then ' mayorista '
                            when 'HOUSEHOLD' then 'minorista' else 'NA' end""",
    "ciudad": """case when n_nationkey = 13 then '###'
                      when l_linestatus = 'O' then concat('são  ', upper(n_name), '@')
                      else concat('São ', n_name) end""",
    "pais": "case when n_nationkey <> 7 then lower(r_name) end",
}


def raw_sales(spark: SparkSession, sf_dir: str, part: tuple[int, int] = (0, 1)) -> DataFrame:
    """Untidy sales as text: every defect cleaning handles, undiscounted items twice."""
    rows = line_items(spark, sf_dir, part)
    copies = F.when(F.col("l_discount") == 0, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    return rows.withColumn("copy", F.explode(copies)).select(
        *[F.expr(cell).alias(RAW_HEADERS[name]) for name, cell in _RAW_CELLS.items()]
    )
