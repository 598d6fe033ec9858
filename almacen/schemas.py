"""Fixed schemas of the raw file, the clean dataset and the warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

from almacen.model import RAW_COLUMNS

RAW = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

CLEAN = T.StructType(
    [
        T.StructField("fecha", T.TimestampNTZType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("year_month", T.StringType()),
        T.StructField("producto", T.StringType()),
        T.StructField("tipo_producto", T.StringType()),
        T.StructField("cantidad", T.DoubleType()),
        T.StructField("precio_unitario", T.DoubleType()),
        T.StructField("descuento", T.DoubleType()),
        T.StructField("costo_envio", T.DoubleType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("tipo_venta", T.StringType()),
        T.StructField("tipo_cliente", T.StringType()),
        T.StructField("segmento_cliente", T.StringType()),
        T.StructField("ciudad", T.StringType()),
        T.StructField("pais", T.StringType()),
    ]
)

MEASURE_TYPES = {
    "cantidad": T.DecimalType(10, 2),
    "precio_unitario": T.DecimalType(12, 2),
    "descuento": T.DecimalType(5, 2),
    "costo_envio": T.DecimalType(12, 2),
    "total": T.DecimalType(14, 2),
}

WAREHOUSE = {
    "dim_fecha": T.StructType(
        [
            T.StructField("id_fecha", T.LongType(), False),
            T.StructField("fecha", T.DateType(), False),
            T.StructField("year", T.IntegerType(), False),
            T.StructField("month", T.IntegerType(), False),
            T.StructField("year_month", T.StringType(), False),
        ]
    ),
    "dim_region": T.StructType(
        [
            T.StructField("id_region", T.LongType(), False),
            T.StructField("ciudad", T.StringType(), False),
            T.StructField("pais", T.StringType(), False),
        ]
    ),
    "dim_cliente": T.StructType(
        [
            T.StructField("id_cliente", T.LongType(), False),
            T.StructField("tipo_cliente", T.StringType(), False),
            T.StructField("segmento_cliente", T.StringType(), False),
            T.StructField("tipo_venta", T.StringType(), False),
            T.StructField("id_region", T.LongType(), False),
        ]
    ),
    "dim_producto": T.StructType(
        [
            T.StructField("id_producto", T.LongType(), False),
            T.StructField("producto", T.StringType(), False),
            T.StructField("tipo_producto", T.StringType(), False),
        ]
    ),
    "fact_ventas": T.StructType(
        [
            T.StructField("id_venta", T.LongType(), False),
            T.StructField("id_fecha", T.LongType(), False),
            T.StructField("id_producto", T.LongType(), False),
            T.StructField("id_cliente", T.LongType(), False),
            *(
                # the two measures with a column default may hold nulls
                T.StructField(name, kind, name in ("descuento", "costo_envio"))
                for name, kind in MEASURE_TYPES.items()
            ),
        ]
    ),
}

# Longest text each column may hold.
TEXT_LENGTHS = {
    "dim_fecha": {"year_month": 7},
    "dim_region": {"ciudad": 100, "pais": 100},
    "dim_cliente": {"tipo_cliente": 50, "segmento_cliente": 50, "tipo_venta": 50},
    "dim_producto": {"producto": 100, "tipo_producto": 100},
    "fact_ventas": {},
}
