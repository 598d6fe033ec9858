"""The retail data model: fixed values and the settings every stage takes.

Column names are Spanish because they are part of the data contract of the
files and tables this package reads and writes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. They decide results and must stay exactly as they are.
# ---------------------------------------------------------------------------

# Cell contents that a raw file uses for "no value"; compared exactly.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Characters removed from text columns.
REMOVED_CHARACTERS = "@#*$%^&(){}[]<>~`"

TEXT_COLUMNS = ("producto", "tipo_producto", "ciudad", "pais", "tipo_venta", "tipo_cliente")
UNDERSCORED_COLUMNS = ("tipo_producto", "tipo_venta")
MEASURE_COLUMNS = ("cantidad", "precio_unitario", "descuento", "costo_envio", "total")
CRITICAL_COLUMNS = ("fecha", "producto", "cantidad", "precio_unitario")

RAW_COLUMNS = (
    "fecha",
    "producto",
    "tipo_producto",
    "cantidad",
    "precio_unitario",
    "descuento",
    "costo_envio",
    "total",
    "tipo_venta",
    "tipo_cliente",
    "ciudad",
    "pais",
)

CLEAN_COLUMNS = (
    "fecha",
    "year",
    "month",
    "year_month",
    "producto",
    "tipo_producto",
    "cantidad",
    "precio_unitario",
    "descuento",
    "costo_envio",
    "total",
    "tipo_venta",
    "tipo_cliente",
    "segmento_cliente",
    "ciudad",
    "pais",
)

# Columns a sale must carry, and carry non-null, to enter the star schema.
REQUIRED_COLUMNS = (
    "fecha",
    "producto",
    "tipo_producto",
    "tipo_cliente",
    "segmento_cliente",
    "tipo_venta",
    "ciudad",
    "pais",
    "total",
)

NULL_DEFAULTS = {
    "descuento": 0.0,
    "costo_envio": 0.0,
    "tipo_venta": "Desconocido",
    "tipo_cliente": "Desconocido",
    "ciudad": "Desconocida",
}

SEGMENTS = {"Corporativo": "Enterprise", "Gobierno": "Enterprise", "Mayorista": "Wholesale"}
DEFAULT_SEGMENT = "Retail"

# Labels printed in the revenue rollup and in the discount report.
GRAND_TOTAL_LABEL = "*** GRAND TOTAL ***"
SUBTOTAL_LABEL = "--- Subtotal ---"
DISCOUNTED_LABEL = "Discounted"
FULL_PRICE_LABEL = "Full Price"


@dataclass(frozen=True)
class CleaningRules:
    """What the cleaning run does to which column; the defaults are the retail file's."""

    na_tokens: tuple[str, ...] = NA_TOKENS
    text: tuple[str, ...] = TEXT_COLUMNS
    underscored: tuple[str, ...] = UNDERSCORED_COLUMNS
    measures: tuple[str, ...] = MEASURE_COLUMNS
    critical: tuple[str, ...] = CRITICAL_COLUMNS
    date: str = "fecha"
    date_formats: tuple[str, ...] = ("yyyy-MM-dd",)
    amount: str = "total"
    customer_type: str = "tipo_cliente"
    segments: dict[str, str] = field(default_factory=lambda: dict(SEGMENTS))
    default_segment: str = DEFAULT_SEGMENT
    null_defaults: dict[str, object] = field(default_factory=lambda: dict(NULL_DEFAULTS))
    output: tuple[str, ...] = CLEAN_COLUMNS


@dataclass(frozen=True)
class Dimension:
    """A dimension table: its surrogate id, natural key and remaining attributes."""

    table: str
    id_column: str
    natural_key: tuple[str, ...]
    attributes: tuple[str, ...] = ()

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.id_column, *self.natural_key, *self.attributes)


DIM_REGION = Dimension("dim_region", "id_region", ("ciudad", "pais"))
DIM_CLIENTE = Dimension(
    "dim_cliente", "id_cliente", ("tipo_cliente", "segmento_cliente", "tipo_venta", "id_region")
)
DIM_PRODUCTO = Dimension("dim_producto", "id_producto", ("producto", "tipo_producto"))
DIM_FECHA = Dimension("dim_fecha", "id_fecha", ("fecha",), ("year", "month", "year_month"))
DIMENSIONS = (DIM_REGION, DIM_CLIENTE, DIM_PRODUCTO, DIM_FECHA)

FACT_TABLE = "fact_ventas"
FACT_KEYS = ("id_fecha", "id_producto", "id_cliente")
STAR_TABLES = (*(d.table for d in DIMENSIONS), FACT_TABLE)
