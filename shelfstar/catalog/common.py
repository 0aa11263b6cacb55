"""What the query modules share: output types and the SQL form of the table roles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType

from shelfstar.functions.labels import AGE_RANGES
from shelfstar.operators.calendar import FIXED_HOLIDAYS
from shelfstar.session import use_settings
from shelfstar.sources.commerce import (
    AS_OF,
    DAMAGE_TAX,
    DISCOUNT_START,
    MEMBERSHIP_START,
    Commerce,
)

Query = Callable[[SparkSession, str], DataFrame]


def query(build: Callable[[Commerce], DataFrame]) -> Query:
    """A registered query: decimals leave as doubles, as the SQL side returns them."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        use_settings(spark)
        return plain(build(Commerce(spark, folder)))

    return run


def plain(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, DecimalType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


# --- SQL text -------------------------------------------------------------


def ratio_sql(num: str, den: str, scale: int = 2, times: int = 1) -> str:
    """`times * num / den` of whole numbers, rounded half away from zero."""
    unit = 10**scale
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return (
        f"CASE WHEN {d} <> 0 THEN CAST(sign({n}) * "
        f"((abs({n}) * {2 * unit * times} + {d}) // (2 * {d})) AS DOUBLE) / {unit} END"
    )


def pct_sql(part: str, whole: str) -> str:
    return ratio_sql(part, whole, 2, 100)


def cents(expr: str) -> str:
    return f"({expr}) * 100"


def with_roles(*names: str) -> str:
    """`WITH a AS (...), b AS (...)` for the named roles and whatever they need."""
    needed: list[str] = []

    def add(name: str) -> None:
        for other in NEEDS.get(name, ()):
            add(other)
        if name not in needed:
            needed.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({ROLES[n]})" for n in needed)


def _holiday_rows() -> str:
    rows = []
    for month, day, name, _, since in FIXED_HOLIDAYS:
        quoted = name.replace("'", "''")
        rows.append(f"({month}, {day}, '{quoted}', {since})")
    return ", ".join(rows)


def age_sql(col: str) -> str:
    cases = [f"WHEN {col} IS NULL OR {col} = 100 THEN 'UNKNOWN'"]
    cases += [f"WHEN {col} <= {last} THEN '{n}'" for n, _, last in AGE_RANGES if last]
    return f"CASE {' '.join(cases)} ELSE '{AGE_RANGES[-1][0]}' END"


GENDER_SQL = (
    "CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'female' "
    "WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'male' END"
)
CODE_SQL = (
    "CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'F' "
    "WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'M' ELSE 'U' END"
)
STATUS_SQL = (
    "CASE WHEN l_returnflag = 'R' THEN 'Returned' WHEN l_returnflag = 'A' THEN 'Lost' "
    "WHEN l_linestatus = 'F' THEN 'Overdue' ELSE 'On loan' END"
)
ID_SQL = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"

NEEDS = {
    "hol": ("cal",),
    "dim_date": ("cal", "hol"),
    "members": ("places",),
    "sups": ("places",),
    "dim_member_keys": (),
    "po": ("lines",),
}

_ALL_DAYS = "(SELECT o_orderdate AS day FROM orders UNION ALL SELECT l_shipdate FROM lineitem)"
FIRST_DAY_SQL = f"(SELECT CAST(date_trunc('year', min(day)) AS DATE) FROM {_ALL_DAYS})"

ROLES = {
    "cal": (
        "SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), "
        "INTERVAL 1 DAY)) AS DATE) AS cal_date FROM (SELECT date_trunc('year', min(day)) AS lo, "
        f"date_trunc('year', max(day)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS hi FROM {_ALL_DAYS})"
    ),
    "hol": (
        "SELECT make_date(y, m, d) AS cal_date, e AS festive_event "
        f"FROM (VALUES {_holiday_rows()}) AS r(m, d, e, since), "
        "(SELECT DISTINCT year(cal_date) AS y FROM cal) WHERE y >= since"
    ),
    "dim_date": (
        f"SELECT 100001 + date_diff('day', {FIRST_DAY_SQL}, c.cal_date) AS date_key, "
        "c.cal_date, h.festive_event FROM cal c LEFT JOIN hol h ON h.cal_date = c.cal_date"
    ),
    "places": (
        "SELECT n_nationkey, n_name AS city, r_name AS state "
        "FROM nation JOIN region ON n_regionkey = r_regionkey"
    ),
    "members": (
        "SELECT c_custkey AS member_id, c_name AS member_name, "
        f"{GENDER_SQL} AS member_gender, {CODE_SQL} AS gender_code, "
        "CAST(floor((c_acctbal + 1000) / 100) AS INTEGER) AS member_age, city, state, "
        f"DATE '{MEMBERSHIP_START}' + c_nationkey * 40 AS registration_date, "
        f"CAST(DATE '{MEMBERSHIP_START}' + c_nationkey * 40 + INTERVAL 72 MONTH AS DATE) "
        "AS expire_date FROM customer JOIN places ON c_nationkey = n_nationkey"
    ),
    "sups": (
        "SELECT s_suppkey AS supplier_id, s_name AS supplier_name, city, state "
        "FROM supplier JOIN places ON s_nationkey = n_nationkey"
    ),
    "lend": (
        "SELECT CAST(l_shipdate AS DATE) AS d, upper(trim(p_type)) AS genre "
        "FROM lineitem JOIN part ON l_partkey = p_partkey"
    ),
    "loans": (
        f"SELECT {ID_SQL} AS borrow_id, o_custkey AS member_id, l_partkey AS book_id, "
        "CAST(l_shipdate AS DATE) AS borrow_date, CAST(l_shipdate AS DATE) + 10 AS due_date, "
        "CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) "
        f"END AS return_date, {STATUS_SQL} AS return_status, l_tax >= {DAMAGE_TAX} AS damaged "
        "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
    ),
    "sales": (
        f"SELECT {ID_SQL} AS sales_id, o_orderkey AS order_id, o_custkey AS member_id, "
        "l_partkey AS book_id, CAST(o_orderdate AS DATE) AS sales_date, o_orderpriority, "
        "CAST(l_quantity AS BIGINT) AS quantity, "
        "CAST(p_retailprice AS DECIMAL(18,2)) AS sales_price, upper(trim(p_type)) AS genre, "
        "CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)), 2) "
        "AS DECIMAL(18,2)) AS discount, "
        "CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(round(CAST(l_extendedprice AS "
        "DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS line_total "
        "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"
    ),
    "lines": (
        "SELECT l_orderkey AS po_id, l_partkey AS book_id, l_suppkey AS supplier_id, "
        "CAST(l_quantity AS BIGINT) AS quantity, "
        "CAST(l_extendedprice AS DECIMAL(18,2)) AS amount FROM lineitem"
    ),
    "po": (
        "SELECT po_id, min(supplier_id) AS supplier_id, sum(amount) AS total_amount, "
        "sum(quantity) AS qty, CASE WHEN max(amount) - min(amount) <= 0.005 THEN max(amount) "
        "ELSE sum(amount) END AS order_value, CAST(any_value(o_orderdate) AS DATE) AS po_date, "
        "CASE WHEN any_value(o_orderstatus) = 'F' THEN 'Y' ELSE 'N' END AS flag "
        "FROM lines JOIN orders ON po_id = o_orderkey GROUP BY po_id"
    ),
    "discounts": (
        "SELECT DISTINCT concat('D00', substring(o_orderpriority, 1, 1)) AS discount_id, "
        "o_orderpriority, substring(o_orderpriority, 3) AS discount_name, "
        "CAST(substring(o_orderpriority, 1, 1) AS INTEGER) * 5 AS discount_rate, "
        f"DATE '{DISCOUNT_START}' + CAST(substring(o_orderpriority, 1, 1) AS INTEGER) * 200 "
        f"AS discount_start, DATE '{DISCOUNT_START}' + CAST(substring(o_orderpriority, 1, 1) "
        "AS INTEGER) * 200 + 1600 AS discount_end "
        "FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'"
    ),
    "book_keys": (
        "SELECT p_partkey AS book_id, 100000 + row_number() OVER "
        "(ORDER BY md5(CAST(p_partkey AS VARCHAR)), p_partkey) AS book_key FROM part"
    ),
    "member_keys": (
        "SELECT c_custkey AS member_id, 100000 + row_number() OVER "
        "(ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey) AS member_key FROM customer"
    ),
    "supplier_keys": (
        "SELECT s_suppkey AS supplier_id, 100000 + row_number() OVER "
        "(ORDER BY md5(CAST(s_suppkey AS VARCHAR)), s_suppkey) AS supplier_key FROM supplier"
    ),
}

__all__ = ["AS_OF", "query", "plain", "ratio_sql", "pct_sql", "cents", "with_roles", "age_sql"]
