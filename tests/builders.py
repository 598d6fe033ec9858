"""Small hand-made inputs."""

from __future__ import annotations

import datetime

from almacen import schemas
from almacen.model import CLEAN_COLUMNS, RAW_COLUMNS
from almacen.plans.star_load import load_star
from almacen.sources.warehouse import Warehouse

BASE = {
    "fecha": "2024-01-15",
    "producto": " café* molido ",
    "tipo_producto": "bebidas_calientes",
    "cantidad": "2",
    "precio_unitario": "10.5",
    "descuento": "0.1",
    "costo_envio": "5",
    "total": "18.9",
    "tipo_venta": "en_linea",
    "tipo_cliente": "corporativo",
    "ciudad": "são  paulo",
    "pais": "brasil",
}


def raw(spark, *changes: dict):
    """Raw rows: the base row with each set of changes."""
    rows = [tuple({**BASE, **change}[c] for c in RAW_COLUMNS) for change in changes]
    return spark.createDataFrame(rows, schemas.RAW)


_SALE = {
    "fecha": "2024-01-15",
    "producto": "Café",
    "tipo_producto": "Bebidas",
    "cantidad": 1.0,
    "precio_unitario": 10.0,
    "descuento": 0.0,
    "costo_envio": 1.0,
    "total": 10.0,
    "tipo_venta": "Tienda",
    "tipo_cliente": "Gobierno",
    "segmento_cliente": "Enterprise",
    "ciudad": "Cali",
    "pais": "Colombia",
}


def sales(spark, *changes: dict):
    """Clean sales: a base sale with each set of changes; calendar parts follow the date."""
    rows = []
    for change in changes:
        sale = {**_SALE, **change}
        moment = datetime.datetime.fromisoformat(sale["fecha"])
        sale |= {
            "fecha": moment,
            "year": moment.year,
            "month": moment.month,
            "year_month": moment.strftime("%Y-%m"),
        }
        rows.append(tuple(sale[c] for c in CLEAN_COLUMNS))
    return spark.createDataFrame(rows, schemas.CLEAN)


def star(spark, folder, *changes: dict):
    """A star loaded from the sales."""
    warehouse = Warehouse(spark, str(folder))
    return warehouse.read(load_star(sales(spark, *changes), warehouse).version)
