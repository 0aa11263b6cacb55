"""The stored warehouse: saved, added to twice, read by month, and reported on."""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from shelfstar.catalog.common import AS_OF, pct_sql, query, ratio_sql, with_roles
from shelfstar.catalog.changes import ORACLE as CHANGE_SQL
from shelfstar.catalog.changes import price_list
from shelfstar.catalog.reports import ORACLE as REPORT_SQL
from shelfstar.catalog.reports import REPORT2_SQL, REPORT_YEARS, line_activity
from shelfstar.catalog.star import CUT_DAY, CUT_YEAR, LAST_KNOWN_DAY, SINCE, sources
from shelfstar.operators.lookup import merged_if_large
from shelfstar.plans import preference, supplier_geo
from shelfstar.plans.load import initial_load
from shelfstar.session import shared_folder
from shelfstar.sources.commerce import ByOrder, Commerce
from shelfstar.sources.store import Store
from shelfstar.sources.tables import insert_new, read_table, refresh, write_report


@lru_cache(maxsize=8)
def _stored(spark: SparkSession, folder: str, app: str) -> tuple[Store, list]:
    """A store with the data up to the cut, to which all data were added as a batch, twice. Built once per session."""
    src = Commerce(spark, folder)
    laid_out = ByOrder(src)
    everything = sources(laid_out)
    early = replace(
        everything,
        titles=everything.titles.where(F.col("publication_year") < CUT_YEAR),
        loans=everything.loans.where(F.col("borrow_date") < CUT_DAY),
        book_orders=everything.book_orders.where(F.col("sales_date") < CUT_DAY),
        purchase_orders=everything.purchase_orders.where(F.col("purchase_date") < CUT_DAY),
    )
    days = src.days().where(F.col("cal_date") <= LAST_KNOWN_DAY)
    star = initial_load(early, days, src.holidays(), AS_OF, SINCE)
    schemas = {n: ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema) for n, df in star.tables().items()}
    store = Store(spark, f"{shared_folder(spark)}/star-{uuid.uuid4().hex}", schemas)
    counts = [("saved", n, None, k) for n, k in store.create(star).items()]
    for run in ("first", "again"):
        made = store.load(everything, *src.first_and_last, AS_OF, SINCE)
        counts += [(run, r.table_name, r.received, r.inserted) for r in made.collect()]
    laid_out.drop()
    return store, counts


def stored(src: Commerce) -> tuple[Store, list]:
    return _stored(src.spark, src.folder, src.spark.sparkContext.applicationId)


def load_counts(src: Commerce) -> DataFrame:
    rows = stored(src)[1]
    return src.spark.createDataFrame(rows, "run string, table_name string, received bigint, inserted bigint")


def _named(src: Commerce, fact: str, *dims: str) -> DataFrame:
    """Rows of a stored fact with the ids and the day that their keys stand for."""
    store = stored(src)[0]
    rows = store.fact(fact)
    days = store.dimension("dim_date").select("date_key", F.col("cal_date").alias("day"))
    rows = rows.join(F.broadcast(days), "date_key").drop("date_key")
    ids = {"dim_book": ("book_key", "book_id"), "dim_members": ("member_key", "member_id"), "dim_suppliers": ("supplier_key", "supplier_id")}
    for dim in dims:
        key, name = ids[dim]
        rows = rows.join(merged_if_large(store.dimension(dim).select(key, name)), key).drop(key)
    return rows


def rejected(src: Commerce) -> DataFrame:
    """What a load leaves out where the warehouse knows early books, members and Asian suppliers only and the batch brings no more."""
    from shelfstar.catalog.star import known_books, known_members, known_suppliers
    from shelfstar.plans.facts import rejected_rows

    return rejected_rows(
        src.loans(),
        src.copies(),
        src.book_orders(),
        src.sales_details(),
        src.titles(),
        src.purchase_orders(),
        src.purchase_details(),
        src.calendar().where(F.col("cal_date") <= LAST_KNOWN_DAY),
        known_members(src),
        known_books(src),
        known_suppliers(src),
    )


def _activity(src: Commerce, years: tuple[int, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Lending and sales by year, genre and member from the stored facts, and who the members are."""
    store = stored(src)[0]
    star = store.star(years)
    genders = star.dim_members.select("member_key", F.col("member_gender").alias("gender"))
    return preference.activity(star.fact_borrowing, star.fact_sales, star.dim_date, star.dim_book, years), genders


def _participants(src: Commerce) -> DataFrame:
    star = stored(src)[0].star()
    genders = star.dim_members.select("member_key", F.col("member_gender").alias("gender"))
    return preference.participants_by_period(star.fact_borrowing, star.fact_sales, star.dim_date, genders)


def _supplier_months(src: Commerce, years: tuple[int, int] | None = None) -> DataFrame:
    star = stored(src)[0].star(years)
    return supplier_geo.supplier_months(supplier_geo.po_values(star.fact_purchase), star.dim_date, star.dim_suppliers, years)


def report_file(src: Commerce) -> DataFrame:
    """Report 2 as an ordered file, read back with the number of each line."""
    path = f"{shared_folder(src.spark)}/report-{uuid.uuid4().hex}"
    report = preference.preference_report(line_activity(src, REPORT_YEARS), src.genders())
    write_report(report.select("year", "genre", "borrow_cnt", "sales_cnt", "sort_section"), path, ["year", "sort_section", "genre"], "parquet")
    lines = src.spark.read.parquet(path).select("*", "_metadata.file_name", "_metadata.row_index")
    number = F.row_number().over(W.orderBy("file_name", "row_index"))
    return lines.select(number.alias("line"), "year", "genre", "borrow_cnt", "sales_cnt")


def refreshed(src: Commerce) -> DataFrame:
    """A price list that is replaced as a whole, then given the parts that it lacks, twice."""
    path = f"{shared_folder(src.spark)}/prices-{uuid.uuid4().hex}"
    target, batch = price_list(src)
    refresh(batch, path)
    refresh(target, path)
    for _ in range(2):
        insert_new(batch, path, ["p_partkey"], batch.schema)
    return read_table(src.spark, path, batch.schema)


QUERIES = {
    "report_file": query(report_file),
    "sink_refresh_insert": query(refreshed),
    "stored_load_counts": query(load_counts),
    "stored_borrowing": query(lambda s: _named(s, "fact_borrowing", "dim_members", "dim_book")),
    "stored_sales": query(lambda s: _named(s, "fact_sales", "dim_members", "dim_book")),
    "stored_purchase": query(lambda s: _named(s, "fact_purchase", "dim_suppliers", "dim_book")),
    "load_rejects": query(rejected),
    "warehouse_preference": query(lambda s: preference.preference_report(*_activity(s, REPORT_YEARS))),
    "warehouse_preference_view": query(lambda s: preference.preference_view(*_activity(s))),
    "warehouse_participants": query(_participants),
    "warehouse_supplier_geo": query(lambda s: supplier_geo.supplier_geo_report(_supplier_months(s, REPORT_YEARS), "Q")),
    "warehouse_supplier_geo_view": query(lambda s: supplier_geo.supplier_geo_view(_supplier_months(s))),
}

# --- SQL ----------------------------------------------------------------------

_EARLY = f"p_size + 1960 < {CUT_YEAR}"
_AS_OF = f"DATE '{AS_OF}'"
_OVERDUE = (
    f"CASE WHEN return_date IS NULL AND due_date < {_AS_OF} THEN {_AS_OF} - due_date "
    "WHEN return_date > due_date THEN return_date - due_date ELSE 0 END"
)

_LENT = f"""lent AS (SELECT loans.*, borrow_date < DATE '{CUT_DAY}' AND {_EARLY} AS early
  FROM loans JOIN part ON p_partkey = book_id)"""
_BOUGHT = f"""bought AS (SELECT po.po_id, po_date, po.supplier_id, book_id, CAST(sum(lines.quantity) AS BIGINT) AS quantity,
    CAST(any_value(total_amount) AS DECIMAL(18,2)) AS total_amount, any_value(flag) AS flag_ind,
    any_value(po_date) < DATE '{CUT_DAY}' AND any_value({_EARLY}) AS early
  FROM po JOIN lines ON lines.po_id = po.po_id JOIN part ON p_partkey = book_id GROUP BY 1, 2, 3, 4)"""
_SOLD = f"sold AS (SELECT sales.*, sales_date < DATE '{CUT_DAY}' AND {_EARLY} AS early FROM sales JOIN part ON p_partkey = book_id)"


def _counts(table: str, rows: str) -> str:
    """Rows saved, received and inserted by the first run and by the second, of `rows` (column early)."""
    return f"""
SELECT 'saved' AS run, '{table}' AS table_name, NULL::BIGINT AS received, count(*) FILTER (WHERE early) AS inserted FROM {rows}
UNION ALL SELECT 'first', '{table}', count(*), count(*) FILTER (WHERE NOT early) FROM {rows}
UNION ALL SELECT 'again', '{table}', count(*), 0 FROM {rows}"""


def _dim_counts(table: str, rows: str) -> str:
    return f"""
SELECT 'saved' AS run, '{table}' AS table_name, NULL::BIGINT AS received, count(*) FILTER (WHERE early) AS inserted FROM {rows}
UNION ALL SELECT 'first', '{table}', count(*) FILTER (WHERE NOT early), count(*) FILTER (WHERE NOT early) FROM {rows}
UNION ALL SELECT 'again', '{table}', 0, 0"""


_COUNTS_SQL = f"""{with_roles("cal", "po", "loans", "sales")},
{_LENT}, {_BOUGHT}, {_SOLD}
""" + "\nUNION ALL ".join(
    [
        _dim_counts("dim_date", f"(SELECT cal_date <= DATE '{LAST_KNOWN_DAY}' AS early FROM cal) t"),
        _dim_counts("dim_book", f"(SELECT {_EARLY} AS early FROM part) t"),
        _dim_counts("dim_members", "(SELECT TRUE AS early FROM customer) t"),
        _dim_counts("dim_suppliers", "(SELECT TRUE AS early FROM supplier) t"),
        _counts("fact_purchase", "bought"),
        _counts("fact_borrowing", "(SELECT DISTINCT borrow_date, member_id, book_id, early FROM lent) t"),
        _counts("fact_sales", "sold"),
        "SELECT 'first', 'rejects', 0, 0 UNION ALL SELECT 'again', 'rejects', 0, 0",
    ]
)

_REJECT_SQL = f"""{with_roles("lines", "loans", "sales", "sups")},
early_books AS (SELECT p_partkey AS book_id FROM part WHERE {_EARLY}),
early_members AS (SELECT c_custkey AS member_id FROM customer WHERE DATE '1994-01-01' + c_nationkey * 40 < DATE '1996-03-01'),
asian AS (SELECT supplier_id FROM sups WHERE state = 'ASIA'),
heads AS (SELECT po_id, min(supplier_id) AS supplier_id, CAST(any_value(o_orderdate) AS DATE) AS po_date
  FROM lines JOIN orders ON po_id = o_orderkey GROUP BY 1),
r AS (
  SELECT 'fact_borrowing' AS table_name, borrow_id AS key, CASE WHEN borrow_date IS NULL OR borrow_date > DATE '{LAST_KNOWN_DAY}' THEN 'no day'
    WHEN member_id NOT IN (FROM early_members) THEN 'no member' WHEN book_id NOT IN (FROM early_books) THEN 'no book' END AS reason
  FROM loans
  UNION ALL
  SELECT 'fact_sales', sales_id, CASE WHEN sales_date IS NULL OR sales_date > DATE '{LAST_KNOWN_DAY}' THEN 'no day'
    WHEN member_id NOT IN (FROM early_members) THEN 'no member' WHEN book_id NOT IN (FROM early_books) THEN 'no book' END
  FROM sales
  UNION ALL
  SELECT 'fact_purchase', concat(lines.po_id, '|', book_id), CASE WHEN po_date IS NULL OR po_date > DATE '{LAST_KNOWN_DAY}' THEN 'no day'
    WHEN heads.supplier_id NOT IN (FROM asian) THEN 'no supplier' WHEN book_id NOT IN (FROM early_books) THEN 'no book' END
  FROM lines LEFT JOIN heads ON heads.po_id = lines.po_id)
SELECT * FROM r WHERE reason IS NOT NULL"""

# The stored lending fact has one row per member, book and day, the roles one per loan.
_ONCE = """loans AS (SELECT borrow_date, member_id, book_id, any_value(return_date) AS return_date
  FROM every_loan GROUP BY 1, 2, 3)"""


def _once(sql: str) -> str:
    """Report SQL in which loans of one member, book and day are one."""
    at = sql.index("\nloans AS (") + 1 if "\nloans AS (" in sql else sql.index("loans AS (")
    return sql[:at] + "every_" + sql[at:].replace("loans AS (", "loan AS (", 1).replace(",\n", f",\n{_ONCE},\n", 1)


_TOTAL = "CAST(total_amount AS DECIMAL(18,2)) AS v"

ORACLE = {
    "report_file": f"""{REPORT2_SQL}
SELECT CAST(row_number() OVER (ORDER BY year, sort_section, genre) AS INTEGER) AS line, CAST(year AS VARCHAR) AS year, genre,
  b AS borrow_cnt, s AS sales_cnt FROM u""",
    "sink_refresh_insert": CHANGE_SQL["merge_insert_absent"],
    "stored_load_counts": _COUNTS_SQL,
    "stored_borrowing": f"""{with_roles("loans")}, {_LENT},
rates AS (SELECT book_id, {pct_sql("count(*) FILTER (WHERE return_status = 'Returned')", "count(*)")} AS rate
  FROM loans WHERE borrow_date < DATE '{CUT_DAY}' GROUP BY 1),
x AS (SELECT lent.*, rate, CASE return_status WHEN 'Returned' THEN 100 WHEN 'Lost' THEN 0 ELSE 50 END AS score
  FROM lent LEFT JOIN rates USING (book_id))
SELECT borrow_date AS day, member_id, book_id, CAST(max({_OVERDUE}) AS BIGINT) AS overdue_days,
  CAST(max(coalesce(return_date, {_AS_OF}) - borrow_date) AS BIGINT) AS borrow_duration,
  CASE WHEN early THEN max(rate) ELSE {ratio_sql("sum(score)", "count(*)")} END AS return_rate
FROM x GROUP BY borrow_date, member_id, book_id, early""",
    "stored_sales": f"""{with_roles("sales", "discounts")}
SELECT sales_id, CAST(sales_price AS DOUBLE) AS sales_price, CAST(discount AS DOUBLE) AS discount,
  coalesce(discount_name, 'No Discount') AS discount_desc, CAST(line_total AS DOUBLE) AS line_total, quantity,
  sales_date AS day, member_id, book_id
FROM sales LEFT JOIN discounts ON discounts.o_orderpriority = sales.o_orderpriority""",
    "stored_purchase": f"""{with_roles("po")}, {_BOUGHT}
SELECT quantity, CAST(total_amount AS DOUBLE) AS total_amount, flag_ind, po_id AS purchase_order_id, po_date AS day, supplier_id, book_id
FROM bought""",
    "load_rejects": _REJECT_SQL,
    "warehouse_preference": _once(REPORT_SQL["preference_report"]),
    "warehouse_preference_view": _once(REPORT_SQL["preference_view"]),
    "warehouse_participants": f"""{with_roles("loans", "sales", "members")},
acts AS (SELECT borrow_date AS d, member_id FROM loans UNION ALL SELECT sales_date, member_id FROM sales),
who AS (SELECT CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter_num, CAST(month(d) AS INTEGER) AS month_num,
          member_id, gender_code AS g FROM acts JOIN members USING (member_id))
SELECT CASE WHEN grouping(month_num) = 0 THEN 'MONTH' WHEN grouping(quarter_num) = 0 THEN 'QUARTER' ELSE 'YEAR' END AS grain,
  year, quarter_num, month_num, count(DISTINCT member_id) AS participants_total,
  count(DISTINCT CASE WHEN g = 'M' THEN member_id END) AS male_cnt,
  count(DISTINCT CASE WHEN g = 'F' THEN member_id END) AS female_cnt
FROM who GROUP BY GROUPING SETS ((year, quarter_num, month_num), (year, quarter_num), (year))""",
    # The fact repeats an order's total on its lines.
    "warehouse_supplier_geo": REPORT_SQL["supplier_geo_report_q"].replace("order_value AS v", _TOTAL),
    "warehouse_supplier_geo_view": REPORT_SQL["supplier_geo_view"].replace("order_value AS v", _TOTAL),
}
