"""SQL pieces for the DuckDB side of the checks.

Written for the test tables directly, without surrogate keys where a report
does not show one, so that they share no step with the Spark side.
"""

from __future__ import annotations

# --- expressions ------------------------------------------------------------


def mean(total: str, count: str) -> str:
    """total / count to 2 decimals, half up, for a total that is not negative."""
    cents = f"cast(100 * {total} as hugeint)"
    return f"cast((2 * {cents} + {count}) // (2 * {count}) as double) / 100"


def percent(part: str, whole: str) -> str:
    """100 * part / whole to 2 decimals, half away from zero; null for a whole of 0."""
    top = f"abs(cast(100 * ({part}) as hugeint)) * 10000"
    low = f"nullif(abs(cast(100 * ({whole}) as hugeint)), 0)"
    sign = f"(case when (({part}) < 0) <> (({whole}) < 0) then -1 else 1 end)"
    return f"{sign} * cast((2 * {top} + {low}) // (2 * {low}) as double) / 100"


def number(expression: str, name: str) -> str:
    return f"cast({expression} as double) as {name}"


def whole(expression: str, name: str) -> str:
    return f"cast({expression} as bigint) as {name}"


_SPACE = (
    r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def clean_text(c: str) -> str:
    kept = rf"regexp_replace({c}, '[@#*$%^&(){{}}\[\]<>~`]', '', 'g')"
    return rf"trim(regexp_replace({kept}, '{_SPACE}', ' ', 'g'))"


def title(c: str) -> str:
    runs = rf"regexp_extract_all({c}, '[\p{{Lu}}\p{{Ll}}\p{{Lt}}]+|[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]+')"
    first = "if(w[1] = 'ß', 'Ss', upper(w[1]))"
    return f"array_to_string(list_transform({runs}, lambda w: {first} || lower(w[2:])), '')"


_NA = (
    "('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
    "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')"
)


def blank(c: str) -> str:
    return f"case when {c} not in {_NA} then {c} end"


def parsed_number(c: str) -> str:
    pattern = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    value = f"case when regexp_full_match(trim({c}), '{pattern}') then try_cast(trim({c}) as double) end"
    return f"case when isfinite({value}) then {value} end"


# --- common table expressions -----------------------------------------------

_JOINED = """
  from lineitem
  join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey
  join part on l_partkey = p_partkey"""

SALES = f"""
sales as (
  select cast(o_orderdate as date) as fecha,
         year(o_orderdate) as year, month(o_orderdate) as month,
         strftime(o_orderdate, '%Y-%m') as year_month,
         p_name as producto, p_type as tipo_producto,
         cast(l_quantity as decimal(10,2)) as cantidad,
         cast(p_retailprice as decimal(12,2)) as precio_unitario,
         cast(l_discount as decimal(5,2)) as descuento,
         cast(round(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(5,2)), 2)
              as decimal(12,2)) as costo_envio,
         cast(round(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(5,2))), 2)
              as decimal(14,2)) as total,
         o_orderpriority as tipo_venta, c_mktsegment as tipo_cliente,
         case c_mktsegment when 'MACHINERY' then 'Enterprise' when 'AUTOMOBILE' then 'Enterprise'
              when 'BUILDING' then 'Wholesale' else 'Retail' end as segmento_cliente,
         n_name as ciudad, r_name as pais, l_linenumber{_JOINED}
)"""


def numbered(name: str, id_column: str, keys: list[str], source: str, last: str = "0") -> str:
    """A dimension with its ids: members in order of the hash of their key, then the key."""
    text = " || chr(31) || ".join(f"cast({k} as varchar)" for k in keys)
    listed = ", ".join(keys)
    return f"""
{name} as (
  select {last} + row_number() over (order by md5({text}), {listed}) as {id_column}, {listed}
  from (select distinct {listed} from {source}) members
)"""


_REGION = numbered("dim_region", "id_region", ["ciudad", "pais"], "sales")
_PROFILES = "sales join dim_region using (ciudad, pais)"
_CLIENTE_KEYS = ["tipo_cliente", "segmento_cliente", "tipo_venta", "id_region"]
_CLIENTE = numbered("dim_cliente", "id_cliente", _CLIENTE_KEYS, _PROFILES)
_PRODUCTO = numbered("dim_producto", "id_producto", ["producto", "tipo_producto"], "sales")
_FECHA = numbered("dim_fecha", "id_fecha", ["fecha"], "sales")

DIMENSIONS = ",".join([SALES, _REGION, _CLIENTE, _PRODUCTO, _FECHA])


def _raw_cells() -> str:
    amount = (
        "cast(cast(round(cast(l_extendedprice as decimal(12,2)) "
        "* (1 - cast(l_discount as decimal(5,2))), 2) as decimal(14,2)) as varchar)"
    )
    shipping = (
        "cast(cast(round(cast(l_extendedprice as decimal(12,2)) "
        "* cast(l_tax as decimal(5,2)), 2) as decimal(14,2)) as varchar)"
    )
    units = "cast(cast(l_quantity as integer) as varchar)"
    return f"""
    case when l_tax = 0.08 and l_linenumber = 1 then strftime(o_orderdate, '%d/%m/%Y')
         when l_tax = 0.08 and l_linenumber = 2 then 'not a date'
         else strftime(o_orderdate, '%Y-%m-%d') end as fecha,
    case when p_size = 50 then '###'
         when p_size < 15 then '  ' || upper(p_name) || ' *'
         when p_size < 25 then replace(p_name, ' ', ' ' || chr(160))
         else p_name end as producto,
    case when p_size <> 49 then lower(p_type) || '_line' end as tipo_producto,
    case when l_linenumber = 7 and l_tax = 0.0 then '1,000'
         when l_linenumber = 6 and l_tax = 0.0 then null
         when l_linenumber = 5 then {units} || 'e0'
         else ' ' || {units} || ' ' end as cantidad,
    cast(cast(p_retailprice as decimal(12,2)) as varchar) as precio_unitario,
    case when l_discount = 0.1 then '1d'
         when l_discount <> 0.05 then cast(cast(l_discount as decimal(5,2)) as varchar)
         end as descuento,
    case when l_tax = 0.0 then null when l_tax = 0.01 then 'inf' else {shipping} end as costo_envio,
    case when l_returnflag = 'R' and l_linenumber = 1 then '-' || {amount}
         when l_returnflag = 'R' and l_linenumber = 2 then null
         when l_returnflag = 'R' and l_linenumber = 3 then '1e400'
         else {amount} end as total,
    case when o_orderpriority = '4-NOT SPECIFIED' then null
         when o_orderpriority = '5-LOW' and o_orderstatus = 'P' then 'none'
         else 'venta_' || lower(substr(o_orderpriority, 3)) end as tipo_venta,
    case c_mktsegment when 'MACHINERY' then 'corporativo' when 'AUTOMOBILE' then 'GOBIERNO'
         when 'BUILDING' then ' mayorista ' when 'HOUSEHOLD' then 'minorista' end as tipo_cliente,
    case when n_nationkey = 13 then '###'
         when l_linestatus = 'O' then 'são  ' || upper(n_name) || '@'
         else 'São ' || n_name end as ciudad,
    case when n_nationkey <> 7 then lower(r_name) end as pais"""


# the raw file as loaded: "no value" tokens are null already
RAW = f"""
raw as (
  select {_raw_cells()}{_JOINED}
  union all
  select {_raw_cells()}{_JOINED}
  where l_discount = 0
)"""

TEXT_COLUMNS = ["producto", "tipo_producto", "ciudad", "pais", "tipo_venta", "tipo_cliente"]
UNDERSCORED = ["tipo_producto", "tipo_venta"]
MEASURES = ["cantidad", "precio_unitario", "descuento", "costo_envio", "total"]


def _texts(transform) -> str:
    return ", ".join(f"{transform(c)} as {c}" for c in TEXT_COLUMNS)


def _spaced_title(c: str) -> str:
    return title(f"replace({c}, '_', ' ')" if c in UNDERSCORED else c)


CLEANED_TEXT = f"""
cleaned_text as (select * replace ({_texts(clean_text)}) from raw)"""

CASED = f"""
cased as (select * replace ({_texts(_spaced_title)}) from cleaned_text)"""

_PARSED = ", ".join(f"{parsed_number(c)} as {c}" for c in MEASURES)
TYPED = f"""
typed as (
  select * replace ({_PARSED}, try_strptime(fecha, '%Y-%m-%d') as fecha) from cased
)"""

KEPT = """
kept as (
  select * from typed
  where total > 0 and fecha is not null and producto is not null
    and cantidad is not null and precio_unitario is not null
)"""

UNIQUE = """
uniques as (select distinct * from kept)"""

CLEAN = """
clean as (
  select fecha, year(fecha) as year, month(fecha) as month, strftime(fecha, '%Y-%m') as year_month,
         producto, tipo_producto, cantidad, precio_unitario,
         coalesce(descuento, 0) as descuento, coalesce(costo_envio, 0) as costo_envio, total,
         coalesce(tipo_venta, 'Desconocido') as tipo_venta,
         coalesce(tipo_cliente, 'Desconocido') as tipo_cliente,
         case tipo_cliente when 'Corporativo' then 'Enterprise' when 'Gobierno' then 'Enterprise'
              when 'Mayorista' then 'Wholesale' else 'Retail' end as segmento_cliente,
         coalesce(ciudad, 'Desconocida') as ciudad, pais
  from uniques
)"""

_REQUIRED = ["producto", "tipo_producto", "tipo_cliente", "tipo_venta", "ciudad", "pais"]
_BLANKED = ", ".join(f"{blank(c)} as {c}" for c in _REQUIRED)
ARRIVED = f"""
arrived as (select * replace ({_BLANKED}) from clean)"""

REASON = (
    "coalesce("
    + ", ".join(
        f"case when {c} is null then 'null {c}' end"
        for c in (
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
    )
    + ")"
)

ACCEPTED = f"""
accepted as (select * from arrived where {REASON} is null)"""

UP_TO_TEXT = ",".join([RAW, CLEANED_TEXT])
UP_TO_CASE = ",".join([UP_TO_TEXT, CASED])
UP_TO_TYPES = ",".join([UP_TO_CASE, TYPED])
UP_TO_RULES = ",".join([UP_TO_TYPES, KEPT])
UP_TO_UNIQUE = ",".join([UP_TO_RULES, UNIQUE])
UP_TO_CLEAN = ",".join([UP_TO_UNIQUE, CLEAN])
UP_TO_ARRIVED = ",".join([UP_TO_CLEAN, ARRIVED])
UP_TO_ACCEPTED = ",".join([UP_TO_ARRIVED, ACCEPTED])

DAY = "strftime(fecha, '%Y-%m-%d')"
CLEAN_OUTPUT = f"""
  {DAY} as fecha, cast(year as bigint) as year, cast(month as bigint) as month, year_month,
  producto, tipo_producto, cantidad, precio_unitario, descuento, costo_envio, total,
  tipo_venta, tipo_cliente, segmento_cliente, ciudad, pais"""
