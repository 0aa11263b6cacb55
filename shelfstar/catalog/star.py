"""Calendar, dimensions, facts and loads."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from shelfstar.catalog.common import (
    AS_OF,
    FIRST_DAY_SQL,
    age_sql,
    pct_sql,
    query,
    ratio_sql,
    with_roles,
)
from shelfstar.functions.dates import expiry_after_renewals
from shelfstar.functions.labels import age_range
from shelfstar.functions.text import segment_from_right
from shelfstar.operators import calendar
from shelfstar.plans import dims, facts
from shelfstar.plans.load import Sources, incremental_load, initial_load, row_counts
from shelfstar.plans.trend import trend_month
from shelfstar.session import settle
from shelfstar.sources.commerce import Commerce

SINCE = "1995-01-01"
# The load tests split the data here: earlier rows are in the warehouse already.
CUT_DAY, CUT_YEAR = "2000-01-01", 2000
LAST_KNOWN_DAY = "2000-12-31"
KNOWN_BEFORE = "1996-03-01"


def sources(src: Commerce) -> Sources:
    return Sources(
        members=src.members(),
        titles=src.titles(),
        copies=src.copies(),
        suppliers=src.suppliers(),
        loans=src.loans(),
        book_orders=src.book_orders(),
        sales_details=src.sales_details(),
        discounts=src.discounts(),
        purchase_orders=src.purchase_orders(),
        purchase_details=src.purchase_details(),
    )


def dates_in_use(src: Commerce) -> DataFrame:
    """The calendar over the whole years in which anything was ordered or shipped."""
    return src.calendar()


def extended_dates(src: Commerce) -> DataFrame:
    """Days the calendar of the orders lacks up to the end of the shipping quarter."""
    ordered = calendar.days_covering(src.table("orders").select(F.to_date("o_orderdate")))
    early = calendar.dim_date(ordered.where(F.col("cal_date") < CUT_DAY), src.holidays())
    return calendar.extend_calendar(early, "1999-12-01", "2001-12-31")


def _books(src: Commerce) -> DataFrame:
    return dims.dim_book(src.titles(), SINCE)


def purchase_fact(src: Commerce) -> DataFrame:
    return facts.fact_purchase(
        src.purchase_orders(),
        src.purchase_details(),
        src.calendar(),
        settle(_books(src)),
        settle(dims.dim_suppliers(src.suppliers())),
    )


def _borrowing(build, src: Commerce, **extra) -> DataFrame:
    members, books = settle(dims.dim_members(src.members(), AS_OF)), settle(_books(src))
    return build(src.loans(), src.copies(), src.calendar(), members, books, AS_OF, **extra)


def borrowing_fact(src: Commerce) -> DataFrame:
    """The rates come from the lines alone, without looking up who borrowed."""
    rates = facts.return_rates(src.loan_lines(), src.copies())
    return _borrowing(facts.fact_borrowing, src, rates=rates)


def sales_fact(src: Commerce, load: str = "initial") -> DataFrame:
    return facts.fact_sales(
        src.sales_details(),
        src.book_orders(),
        src.titles(),
        src.discounts(),
        src.calendar(),
        settle(dims.dim_members(src.members(), AS_OF)),
        settle(_books(src)),
        load,
    )


def later_sales(src: Commerce) -> DataFrame:
    """Sold lines of which those without a discount come without an amount."""
    details = src.sales_details()
    priced = F.when(F.col("discount_amount") != 0, F.col("total_amount"))
    return facts.fact_sales(
        details.withColumn("total_amount", priced),
        src.book_orders(),
        src.titles(),
        src.discounts(),
        src.calendar(),
        settle(dims.dim_members(src.members(), AS_OF)),
        settle(_books(src)),
        "incremental",
    ).select("sales_id", "sales_price", "discount", "line_total", "quantity")


def day_discounts(src: Commerce) -> DataFrame:
    orders = src.book_orders().select("order_id", "member_id", "sales_date")
    return facts.discount_on_day(orders, src.discounts())


def all_discounts(src: Commerce) -> DataFrame:
    return facts.with_default_discount(src.discounts())


def membership_expiry(src: Commerce) -> DataFrame:
    """Expiry of every member after as many renewals as tens of years of age."""
    renewals = F.floor(F.col("member_age") / 10).cast("int")
    until = expiry_after_renewals(F.col("registration_date"), renewals)
    return src.members().select("member_id", until.alias("expiry"))


def known_books(src: Commerce) -> DataFrame:
    """The book dimension as it was before the titles published since the cut."""
    return dims.dim_book(src.titles().where(F.col("publication_year") < CUT_YEAR), SINCE)


def known_members(src: Commerce) -> DataFrame:
    early = src.members().where(F.col("registration_date") < KNOWN_BEFORE)
    return dims.dim_members(early, AS_OF)


def known_suppliers(src: Commerce) -> DataFrame:
    return dims.dim_suppliers(src.suppliers().where(F.col("supplier_address").contains("ASIA")))


def increment_counts(src: Commerce) -> DataFrame:
    """A warehouse up to the cut, then the whole data as one batch."""
    everything = sources(src)
    early = replace(
        everything,
        titles=everything.titles.where(F.col("publication_year") < CUT_YEAR),
        loans=everything.loans.where(F.col("borrow_date") < CUT_DAY),
        book_orders=everything.book_orders.where(F.col("sales_date") < CUT_DAY),
        purchase_orders=everything.purchase_orders.where(F.col("purchase_date") < CUT_DAY),
    )
    days = src.days().where(F.col("cal_date") <= LAST_KNOWN_DAY)
    star = initial_load(early, days, src.holidays(), AS_OF, SINCE)
    return row_counts(incremental_load(star, everything, *src.first_and_last, AS_OF, SINCE))


def orders_without_day(src: Commerce) -> DataFrame:
    """Sales that a calendar which ends at the last known day would leave out of the fact."""
    known = src.calendar().where(F.col("cal_date") <= LAST_KNOWN_DAY)
    orders = src.book_orders().select("order_id", F.col("sales_date").alias("day"))
    return facts.rows_without_day(orders, known, "day")


def warehouse_trend(src: Commerce) -> DataFrame:
    """The monthly trend from the loaded star, surrogate keys and all."""
    star = initial_load(sources(src), src.days(), src.holidays(), AS_OF, SINCE)
    return trend_month(
        star.fact_borrowing, star.dim_date, star.dim_book, src.loan_spans(), src.copies()
    ).select("year", "month_num", "borrows", "mom_pct", "top_genre")


def address_segments(src: Commerce) -> DataFrame:
    address = F.col("member_address")
    return src.members().select(
        "member_id",
        *[segment_from_right(address, n).alias(f"segment_{n}") for n in (1, 2, 3, 4)],
    )


def age_bucket(src: Commerce) -> DataFrame:
    return (
        src.members()
        .groupBy(age_range(F.col("member_age")).alias("age_range"))
        .agg(F.count(F.lit(1)).alias("members"))
    )


QUERIES = {
    "dim_date": query(dates_in_use),
    "orders_without_day": query(orders_without_day),
    "calendar_extension": query(extended_dates),
    "dim_book_clean": query(_books),
    "dim_members_clean": query(lambda s: dims.dim_members(s.members(), AS_OF)),
    "dim_suppliers_clean": query(lambda s: dims.dim_suppliers(s.suppliers())),
    "dim_book_new_keys": query(lambda s: dims.new_books(known_books(s), s.titles(), SINCE)),
    "dim_members_new_keys": query(
        lambda s: dims.new_members(known_members(s), s.members(), AS_OF)
    ),
    "dim_suppliers_new_keys": query(
        lambda s: dims.new_suppliers(known_suppliers(s), s.suppliers())
    ),
    "fact_purchase": query(purchase_fact),
    "fact_borrowing": query(borrowing_fact),
    "fact_borrowing_incremental": query(
        lambda s: _borrowing(facts.fact_borrowing_incremental, s)
    ),
    "fact_sales": query(sales_fact),
    "fact_sales_incremental": query(later_sales),
    "discount_on_date": query(day_discounts),
    "default_discount": query(all_discounts),
    "membership_expiry": query(membership_expiry),
    "incremental_load": query(increment_counts),
    "warehouse_trend": query(warehouse_trend),
    "address_segments": query(address_segments),
    "age_bucket": query(age_bucket),
}

# --- SQL ----------------------------------------------------------------------

_AS_OF = f"DATE '{AS_OF}'"


def _date_columns(key: str) -> str:
    return f"""CAST({key} AS BIGINT) AS date_key, cal_date,
  strftime(cal_date, '%Y %B %d') AS full_desc, CAST(dayofweek(cal_date) + 1 AS INTEGER) AS day_of_week,
  CAST(day(cal_date) AS INTEGER) AS day_num_month,
  CAST(dayofyear(cal_date) AS INTEGER) AS day_num_year, upper(strftime(cal_date, '%B')) AS month_name,
  CAST(month(cal_date) AS INTEGER) AS cal_month_year, strftime(cal_date, '%Y-%m') AS cal_year_month,
  concat('Q', quarter(cal_date)) AS cal_quarter,
  concat(year(cal_date), '-Q', quarter(cal_date)) AS cal_year_quarter,
  CAST(year(cal_date) AS INTEGER) AS cal_year,
  CASE WHEN festive_event IS NULL THEN 'N' ELSE 'Y' END AS holiday_indicator,
  CASE WHEN dayofweek(cal_date) BETWEEN 1 AND 5 THEN 'Y' ELSE 'N' END AS weekday_indicator,
  coalesce(festive_event, 'Regular Day') AS festive_event,
  CASE WHEN dayofweek(cal_date) BETWEEN 1 AND 5 AND festive_event IS NULL THEN 'Y' ELSE 'N' END
    AS business_day_ind"""


def _years(until: str, since: str, suffix: str = " years") -> str:
    months = f"((year({until}) - year({since})) * 12 + month({until}) - month({since}))"
    part = (
        f"CASE WHEN day({until}) = day({since}) OR ({until} = last_day({until}) AND "
        f"{since} = last_day({since})) THEN 0 ELSE day({until}) - day({since}) END"
    )
    num = f"({months} * 31 + ({part}))"
    return f"concat(printf('%.1f', {ratio_sql(num, '372', 1)}), '{suffix}')"


_SCD = (
    "CAST({since} AS DATE) AS effective_date, DATE '9999-12-31' AS expiration_date, 'Y' AS curr_ind"
)


def _member_sql(key: str, state: str, city: str, duration: str, source: str) -> str:
    return f"""SELECT {key} AS member_key, member_id, upper(trim(member_name)) AS member_name,
  {age_sql("member_age")} AS member_age_range, gender_code AS member_gender, {state} AS state,
  {city} AS city, {duration} AS member_duration, {_SCD.format(since="registration_date")}
FROM {source}"""


def _book_sql(key: str, status: str, popularity: str, source: str) -> str:
    return f"""SELECT {key} AS book_key, p_partkey AS book_id, '{status}' AS book_status,
  upper(trim(p_name)) AS title, upper(trim(p_brand)) AS author, upper(trim(p_type)) AS genre,
  CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS price, {popularity} AS popularity,
  {_SCD.format(since=f"DATE '{SINCE}'")} FROM {source}"""


def _new_key(count_sql: str, col: str) -> str:
    return (
        f"100000 + ({count_sql}) + row_number() OVER (ORDER BY md5(CAST({col} AS VARCHAR)), {col})"
    )


_OVERDUE = (
    f"CASE WHEN return_date IS NULL AND due_date < {_AS_OF} THEN {_AS_OF} - due_date "
    "WHEN return_date > due_date THEN return_date - due_date ELSE 0 END"
)
_DURATION = f"coalesce(return_date, {_AS_OF}) - borrow_date"
_DATE_KEY = "100001 + date_diff('day', %s, {0})" % FIRST_DAY_SQL

_BORROWING = f"""{with_roles("loans", "book_keys", "member_keys")},
rates AS (SELECT book_id, count(*) AS n,
            count(*) FILTER (WHERE return_status = 'Returned') AS r FROM loans GROUP BY 1),
x AS (SELECT {_DATE_KEY.format("borrow_date")} AS date_key, member_key, book_key,
        CAST({_OVERDUE} AS BIGINT) AS od, CAST({_DURATION} AS BIGINT) AS du,
        {pct_sql("r", "n")} AS rate,
        CASE return_status WHEN 'Returned' THEN 100 WHEN 'Lost' THEN 0 ELSE 50 END AS score
      FROM loans JOIN rates USING (book_id) JOIN book_keys USING (book_id)
      JOIN member_keys USING (member_id))"""

_EARLY = f"p_size + 1960 < {CUT_YEAR}"


def _inserted(name: str, body: str) -> str:
    return f"SELECT '{name}' AS table_name, count(*) AS inserted FROM ({body})"


_INCREMENT = "\nUNION ALL\n".join(
    [
        _inserted("dim_date", "SELECT 1 FROM cal WHERE cal_date > DATE '2000-12-31'"),
        _inserted("dim_book", f"SELECT 1 FROM part WHERE NOT ({_EARLY})"),
        _inserted("dim_members", "SELECT 1 FROM customer WHERE FALSE"),
        _inserted("dim_suppliers", "SELECT 1 FROM supplier WHERE FALSE"),
        _inserted(
            "fact_purchase",
            "SELECT DISTINCT po_id, book_id FROM lines JOIN orders ON po_id = o_orderkey "
            "JOIN part ON p_partkey = book_id "
            f"WHERE NOT (o_orderdate < DATE '{CUT_DAY}' AND {_EARLY})",
        ),
        _inserted(
            "fact_borrowing",
            "SELECT DISTINCT borrow_date, member_id, book_id FROM loans "
            f"JOIN part ON p_partkey = book_id WHERE NOT (borrow_date < DATE '{CUT_DAY}' "
            f"AND {_EARLY})",
        ),
        _inserted(
            "fact_sales",
            "SELECT DISTINCT sales_id FROM sales JOIN part ON p_partkey = book_id "
            f"WHERE NOT (sales_date < DATE '{CUT_DAY}' AND {_EARLY})",
        ),
    ]
)

_MEMBER_AGE = _years(_AS_OF, "registration_date")
_MEMBER_STATUS = (
    f"CASE WHEN expire_date > {_AS_OF} THEN {_MEMBER_AGE} "
    f"ELSE {_years('expire_date', 'registration_date', ' years (expired)')} END"
)
_POPULARITY = "CAST(CAST(p_size / 10 AS DECIMAL(3,1)) AS DOUBLE)"

ORACLE = {
    "dim_date": f"""{with_roles("hol")},
span AS (SELECT min(d) AS lo, max(d) AS hi FROM (SELECT o_orderdate AS d FROM orders
         UNION ALL SELECT l_shipdate FROM lineitem)),
days AS (SELECT CAST(unnest(generate_series(date_trunc('year', lo)::TIMESTAMP,
           (date_trunc('year', hi) + INTERVAL 1 YEAR - INTERVAL 1 DAY)::TIMESTAMP, INTERVAL 1 DAY))
           AS DATE) AS cal_date FROM span),
j AS (SELECT cal_date, festive_event, row_number() OVER (ORDER BY cal_date) AS rn
      FROM days LEFT JOIN hol USING (cal_date))
SELECT {_date_columns("100000 + rn")} FROM j""",
    "orders_without_day": f"""
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS day FROM orders
WHERE o_orderdate IS NULL OR CAST(o_orderdate AS DATE) > DATE '{LAST_KNOWN_DAY}'""",
    "calendar_extension": f"""
WITH span AS (SELECT date_trunc('year', min(o_orderdate)) AS lo FROM orders),
days AS (SELECT CAST(unnest(generate_series(TIMESTAMP '{CUT_DAY}', TIMESTAMP '2001-12-31',
           INTERVAL 1 DAY)) AS DATE) AS cal_date),
j AS (SELECT cal_date, NULL::VARCHAR AS festive_event,
        100001 + date_diff('day', lo, cal_date) AS k FROM days, span)
SELECT {_date_columns("k")} FROM j""",
    "dim_book_clean": _book_sql(
        "b.book_key",
        "AVAILABLE",
        _POPULARITY,
        "part JOIN (" + with_roles("book_keys") + " SELECT * FROM book_keys) b ON b.book_id = p_partkey",
    ),
    "dim_members_clean": with_roles("members", "member_keys")
    + "\n"
    + _member_sql(
        "member_key", "state", "city", _MEMBER_AGE, "members JOIN member_keys USING (member_id)"
    ),
    "dim_suppliers_clean": f"""{with_roles("sups", "supplier_keys")}
SELECT supplier_key, supplier_id, upper(trim(supplier_name)) AS supplier_name, state, city
FROM sups JOIN supplier_keys USING (supplier_id)""",
    "dim_book_new_keys": _book_sql(
        _new_key(f"SELECT count(*) FROM part WHERE {_EARLY}", "p_partkey"),
        "available",
        f"greatest(1.0, least(5.0, {_POPULARITY}))",
        f"part WHERE NOT ({_EARLY})",
    ),
    "dim_members_new_keys": with_roles("members")
    + "\n"
    + _member_sql(
        _new_key(
            f"SELECT count(*) FROM members WHERE registration_date < DATE '{KNOWN_BEFORE}'", "member_id"
        ),
        "'X'",
        "state",
        _MEMBER_STATUS,
        f"members WHERE registration_date >= DATE '{KNOWN_BEFORE}'",
    ),
    "dim_suppliers_new_keys": f"""{with_roles("sups")}
SELECT {_new_key("SELECT count(*) FROM sups WHERE state = 'ASIA'", "supplier_id")} AS supplier_key,
  supplier_id, upper(trim(supplier_name)) AS supplier_name, 'X' AS state, '00000' AS city
FROM sups WHERE state <> 'ASIA'""",
    "fact_purchase": f"""{with_roles("po", "book_keys", "supplier_keys")}
SELECT {_DATE_KEY.format("po_date")} AS date_key, book_key, supplier_key,
  CAST(sum(lines.quantity) AS BIGINT) AS quantity,
  CAST(CAST(any_value(total_amount) AS DECIMAL(18,2)) AS DOUBLE) AS total_amount,
  any_value(flag) AS flag_ind, po.po_id AS purchase_order_id
FROM po JOIN lines ON lines.po_id = po.po_id JOIN book_keys USING (book_id)
JOIN supplier_keys ON supplier_keys.supplier_id = po.supplier_id
GROUP BY po.po_id, po_date, book_key, supplier_key""",
    "fact_borrowing": f"""{_BORROWING}
SELECT date_key, member_key, book_key, max(od) AS overdue_days, max(du) AS borrow_duration,
  max(rate) AS return_rate FROM x GROUP BY 1, 2, 3""",
    "fact_borrowing_incremental": f"""{_BORROWING}
SELECT date_key, member_key, book_key, max(od) AS overdue_days, max(du) AS borrow_duration,
  {ratio_sql("sum(score)", "count(*)")} AS return_rate FROM x GROUP BY 1, 2, 3""",
    "fact_sales": f"""{with_roles("sales", "discounts", "book_keys", "member_keys")}
SELECT member_key, book_key, {_DATE_KEY.format("sales_date")} AS date_key, sales_id,
  CAST(sales_price AS DOUBLE) AS sales_price, CAST(discount AS DOUBLE) AS discount,
  coalesce(discount_name, 'No Discount') AS discount_desc,
  CAST(line_total AS DOUBLE) AS line_total, quantity
FROM sales JOIN book_keys USING (book_id) JOIN member_keys USING (member_id)
LEFT JOIN discounts ON discounts.o_orderpriority = sales.o_orderpriority""",
    "fact_sales_incremental": f"""{with_roles("sales")}
SELECT sales_id, CAST(sales_price AS DOUBLE) AS sales_price, CAST(discount AS DOUBLE) AS discount,
  CAST(CASE WHEN discount <> 0 THEN line_total ELSE sales_price * quantity END AS DOUBLE)
    AS line_total, quantity FROM sales""",
    "discount_on_date": f"""{with_roles("discounts")}
SELECT o_orderkey AS order_id, o_custkey AS member_id, CAST(o_orderdate AS DATE) AS sales_date,
  coalesce(min(discount_id), 'D000') AS discount_id,
  CAST(coalesce(arg_min(discount_rate, discount_id), 0) AS DOUBLE) AS discount_rate
FROM orders LEFT JOIN discounts ON CAST(o_orderdate AS DATE) BETWEEN discount_start AND discount_end
GROUP BY 1, 2, 3""",
    "default_discount": f"""{with_roles("discounts")}
SELECT discount_id, discount_name, CAST(discount_rate AS DOUBLE) AS discount_rate, discount_start,
  discount_end FROM discounts
UNION ALL SELECT 'D000', 'No Discount', 0, DATE '2004-07-01', DATE '2024-06-30'""",
    "membership_expiry": f"""{with_roles("members")}
SELECT member_id, CAST(registration_date + to_months(CAST(12 * (1 + member_age // 10) AS INTEGER))
  AS DATE) - 1 AS expiry FROM members""",
    "incremental_load": f"""{with_roles("cal", "lines", "loans", "sales")}
{_INCREMENT}""",
    "warehouse_trend": f"""{with_roles("loans")},
f AS (SELECT DISTINCT borrow_date, member_id, upper(trim(p_type)) AS genre, book_id
      FROM loans JOIN part ON p_partkey = book_id),
g AS (SELECT CAST(date_trunc('month', borrow_date) AS DATE) AS ms, genre, count(*) AS c
      FROM f GROUP BY 1, 2),
m AS (SELECT ms, CAST(sum(c) AS BIGINT) AS n, string_agg(genre, '/' ORDER BY genre)
        FILTER (WHERE r = 1) AS top_genre FROM (
        SELECT *, rank() OVER (PARTITION BY ms ORDER BY c DESC) AS r FROM g) GROUP BY 1),
l AS (SELECT *, lag(n) OVER (PARTITION BY year(ms) ORDER BY ms) AS pm FROM m)
SELECT CAST(year(ms) AS INTEGER) AS year, CAST(month(ms) AS INTEGER) AS month_num, n AS borrows,
  {pct_sql("n - pm", "pm")} AS mom_pct, top_genre FROM l""",
    "address_segments": f"""{with_roles("members")}
SELECT member_id, 'X' AS segment_1, upper(state) AS segment_2, upper(city) AS segment_3,
  'UNKNOWN' AS segment_4 FROM members""",
    "age_bucket": f"""{with_roles("members")}
SELECT {age_sql("member_age")} AS age_range, count(*) AS members FROM members GROUP BY 1""",
}
