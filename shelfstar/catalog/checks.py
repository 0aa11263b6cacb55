"""Row and table rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfstar.catalog.changes import BOOK_HISTORY_SQL, FINES_SQL, all_fines, book_history
from shelfstar.catalog.common import AS_OF, ID_SQL, cents, pct_sql, query, ratio_sql, with_roles
from shelfstar.operators.profile import range_profile, value_profile
from shelfstar.plans import constraints, rules
from shelfstar.sources.commerce import SHIFT_HOURS, WORK_SECONDS, Commerce


def expired_members(src: Commerce) -> DataFrame:
    """Every member as active first, so that the rule decides."""
    signed_up = src.members().withColumn("member_status", F.lit("active"))
    return rules.expire_memberships(signed_up, AS_OF).select("member_id", "member_status")


def stale_status(src: Commerce) -> DataFrame:
    signed_up = src.members().withColumn("member_status", F.lit("active"))
    return rules.status_mismatches(signed_up, AS_OF)


def total_guard(src: Commerce) -> DataFrame:
    """Only received orders were recomputed; the others still state their own total."""
    orders, details, titles = src.purchase_orders(), src.purchase_details(), src.titles()
    received = src.order_dates().where(F.col("order_status") == "Received")
    current = rules.recompute_totals(orders, details, titles, received)
    return rules.total_violations(current, details, titles)


def orders_without_lines(src: Commerce) -> DataFrame:
    return rules.check_foreign_key(
        src.table("orders"),
        "o_orderkey",
        "o_orderkey",
        src.table("lineitem"),
        "l_orderkey",
        "order has lines",
    )


def duplicate_lines(src: Commerce) -> DataFrame:
    return rules.check_unique(src.table("lineitem"), ["l_orderkey", "l_linenumber"], "line number")


def open_returns(src: Commerce) -> DataFrame:
    return rules.check_not_null(src.loan_lines(), "borrow_id", ["borrow_date", "return_date"])


def fine_rules(src: Commerce) -> DataFrame:
    """Fines against the rules; 1000 is taken off damage fines, so those of cheaper books fail."""
    cheaper = all_fines(src).withColumn(
        "fine_amount",
        F.when(F.col("fine_type") == "Damage", F.col("fine_amount") - 1000).otherwise(
            F.col("fine_amount")
        ),
    )
    return rules.fine_violations(cheaper)


def payment_rules(src: Commerce) -> DataFrame:
    """Payments against the rules; one of the three methods is made one that is not allowed."""
    made = src.payments().withColumn(
        "pay_amount", F.when(F.col("payment_type") == "Fines", F.lit(0)).otherwise(50)
    )
    renamed = F.col("payment_method") == "Duitnow"
    return rules.payment_violations(
        made.withColumn(
            "payment_method", F.when(renamed, "Cheque").otherwise(F.col("payment_method"))
        )
    )


def operational(src: Commerce) -> dict[str, DataFrame]:
    """The commerce tables as operational tables. Balances in whole hundreds stand for telephone numbers, so some are shared."""
    tel = src.table("customer").select(
        F.col("c_custkey").alias("member_id"),
        F.floor("c_acctbal").cast("string").alias("member_tel"),
        F.col("c_name").alias("member_email"),
    )
    line = F.concat_ws("-", "purchase_order_id", "book_id", "supplier_id", "quantity")
    return {
        "members": src.members().join(tel, "member_id"),
        "suppliers": src.suppliers(),
        "book_titles": src.titles(),
        "book_copies": src.copies(),
        "borrowed_books": src.loans(),
        "payments": src.payments(),
        "discounts": src.discounts(),
        "book_orders": src.book_orders(),
        "sales_details": src.sales_details(),
        "purchase_orders": src.purchase_orders().where(F.col("purchase_order_id") % 5 != 0),
        "purchase_details": src.purchase_details().withColumn("detail_id", line),
    }


def declared(src: Commerce) -> DataFrame:
    """All declared constraints over all rows; every fifth purchase order is missing."""
    return constraints.declared_violations(operational(src)).select("rule", "key")


def dated_orders(src: Commerce) -> DataFrame:
    """Orders of which those without a discount came without a date: they get the day of the load."""
    undated = src.book_orders().withColumn("sales_date", F.when(F.col("discount_id").isNotNull(), F.col("sales_date")))
    return rules.default_sales_dates(undated, AS_OF).select("order_id", "sales_date")


QUERIES = {
    "rule_declared": query(declared),
    "default_sales_dates": query(dated_orders),
    "rule_expire_membership": query(expired_members),
    "rule_member_status": query(stale_status),
    "rule_titles": query(lambda s: rules.title_violations(s.titles(), AS_OF)),
    "copy_status": query(lambda s: rules.copy_status(s.copies(), s.loan_lines())),
    "rule_unavailable_copies": query(
        lambda s: rules.unavailable_copies(s.copies(), book_history(s))
    ),
    "attendance_status": query(
        lambda s: rules.attendance_status(s.attendance(), s.shifts()).select(
            "attendance_id", "staff_id", "attendance_status"
        )
    ),
    "weekly_hours": query(lambda s: rules.weekly_hours(s.attendance())),
    "rule_weekly_limit": query(lambda s: rules.weekly_limit_violations(s.attendance())),
    "rule_membership_window": query(
        lambda s: rules.membership_violations(s.loans(), s.members())
    ),
    "rule_fines": query(fine_rules),
    "rule_payments": query(payment_rules),
    "rule_total_guard": query(total_guard),
    "rule_discount_window": query(
        lambda s: rules.discount_violations(s.book_orders(), s.discounts())
    ),
    "sales_amounts": query(
        lambda s: rules.sales_amounts(
            s.sales_details(), s.book_orders(), s.titles(), s.discounts()
        ).select("sales_id", "quantity_sold", "discount_amount", "total_amount")
    ),
    "rule_orphans": query(orders_without_lines),
    "rule_unique": query(duplicate_lines),
    "rule_not_null": query(open_returns),
    "status_profile": query(lambda s: value_profile(s.loan_lines(), "return_status")),
    "range_profile": query(lambda s: range_profile(s.members(), "member_age")),
}

# --- SQL ----------------------------------------------------------------------

_SHIFT_ROWS = ", ".join(f"('{name}', {hour * 3600})" for name, hour in SHIFT_HOURS)
_WEEKS = f"""
w AS (SELECT user_id AS staff_id, CAST(date_trunc('week', ts) AS DATE) AS week_start,
  CAST(sum(CAST(trunc(value * {WORK_SECONDS}) AS BIGINT) // 3600) AS BIGINT) AS hours
  FROM events GROUP BY 1, 2)"""


def _violation(rule: str, key: str, message: str, source: str) -> str:
    return (
        f"SELECT '{rule}' AS rule, CAST({key} AS VARCHAR) AS key, {message} AS message FROM {source}"
    )


def _declared_sql() -> str:
    """One SELECT per constraint that the commerce tables have the columns for."""
    tables = {
        "members": ("m", "member_id", "member_name member_tel member_email member_gender member_age member_address member_status "
                    "registration_date expire_date"),
        "suppliers": ("s", "supplier_id", "supplier_name supplier_address"),
        "book_titles": ("t", "book_id", "title author genre publication_year purchase_price sales_price"),
        "book_copies": ("c", "copy_id", "book_id book_status"),
        "borrowed_books": ("lent", "borrow_id", "member_id copy_id borrow_date due_date return_status"),
        "payments": ("p", "payment_id", "member_id payment_date payment_method payment_type"),
        "discounts": ("discounts", "discount_id", "discount_name"),
        "book_orders": ("b", "order_id", "discount_id member_id"),
        "sales_details": ("d", "sales_id", "order_id book_id"),
        "purchase_orders": ("o", "purchase_order_id", "supplier_id purchase_date total_amount order_status"),
        "purchase_details": ("l", "detail_id", "purchase_order_id book_id"),
    }
    broken = {
        "members member_gender": "member_gender NOT IN ('female', 'male')",
        "members member_status": "member_status NOT IN ('active', 'expire')",
        "members member_age range": "member_age NOT BETWEEN 12 AND 74",
        "book_titles purchase_price range": "purchase_price < 0",
        "book_titles sales_price range": "sales_price < 0",
        "book_titles popularity range": "popularity NOT BETWEEN 1 AND 5",
        "book_copies book_status": "book_status NOT IN ('available', 'reserved', 'borrowed', 'unavailable')",
        "borrowed_books return_status": "return_status NOT IN ('On loan', 'Returned', 'Overdue', 'Lost')",
        "payments payment_method": "payment_method NOT IN ('Tng', 'Cash', 'Duitnow')",
        "payments payment_type": "payment_type NOT IN ('Fines', 'Membership Registration', 'Book Sale')",
        "discounts discount_rate range": "discount_rate NOT BETWEEN 0 AND 100",
        "discounts discount_start before discount_end": "discount_start >= discount_end",
        "purchase_orders order_status": "order_status NOT IN ('Received', 'Pending', 'Cancelled')",
        "purchase_details quantity range": "quantity < 0",
    }
    parents = {
        "book_copies book_id": "book_titles", "borrowed_books member_id": "members", "borrowed_books copy_id": "book_copies",
        "payments member_id": "members", "book_orders discount_id": "discounts", "book_orders member_id": "members",
        "sales_details order_id": "book_orders", "sales_details book_id": "book_titles", "purchase_orders supplier_id": "suppliers",
        "purchase_details purchase_order_id": "purchase_orders", "purchase_details book_id": "book_titles",
    }
    out = []
    for name, (sql, key, required) in tables.items():
        for c in (key, *required.split()):
            out.append(f"SELECT '{name} {c} required' AS rule, CAST({key} AS VARCHAR) AS key FROM {sql} WHERE {c} IS NULL")
        out.append(f"SELECT '{name} primary key', CAST({key} AS VARCHAR) FROM {sql} GROUP BY {key} HAVING count(*) > 1 AND {key} IS NOT NULL")
    for c in ("member_tel", "member_email"):
        out.append(f"SELECT 'members {c} unique', {c} FROM m GROUP BY {c} HAVING count(*) > 1 AND {c} IS NOT NULL")
    for rule, test in broken.items():
        sql, key, _ = tables[rule.split()[0]]
        out.append(f"SELECT '{rule}', CAST({key} AS VARCHAR) FROM {sql} WHERE {test}")
    for rule, parent in parents.items():
        child, c = rule.split()
        sql, key, _ = tables[child]
        above, parent_key, _ = tables[parent]
        out.append(f"SELECT '{rule} reference', CAST({key} AS VARCHAR) FROM {sql} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {parent_key} FROM {above})")
    return f"""{with_roles("members", "sups", "loans", "discounts", "sales", "lines", "po")},
m AS (SELECT members.*, CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS member_tel, c_name AS member_email, c_name AS member_address,
    CASE WHEN expire_date > DATE '{AS_OF}' THEN 'active' ELSE 'expire' END AS member_status
  FROM members JOIN customer ON c_custkey = member_id),
s AS (SELECT *, supplier_name AS supplier_address FROM sups),
lent AS (SELECT *, book_id AS copy_id FROM loans),
t AS (SELECT p_partkey AS book_id, p_name AS title, p_brand AS author, p_type AS genre, p_size + 1960 AS publication_year,
    CAST(p_retailprice AS DECIMAL(18,2)) - 100 AS purchase_price, CAST(p_retailprice AS DECIMAL(18,2)) AS sales_price,
    CAST(p_size / 10 AS DECIMAL(3,1)) AS popularity FROM part),
c AS (SELECT p_partkey AS copy_id, p_partkey AS book_id, CASE p_brand WHEN 'Brand#25' THEN 'unavailable' WHEN 'Brand#24' THEN 'reserved'
    ELSE 'available' END AS book_status FROM part),
p AS (SELECT o_orderkey AS payment_id, o_custkey AS member_id, o_orderdate AS payment_date, 'Cash' AS payment_method,
    'Fines' AS payment_type FROM orders),
b AS (SELECT o_orderkey AS order_id, o_custkey AS member_id, CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
    THEN concat('D00', substring(o_orderpriority, 1, 1)) END AS discount_id FROM orders),
d AS (SELECT {ID_SQL} AS sales_id, l_orderkey AS order_id, l_partkey AS book_id FROM lineitem),
o AS (SELECT po_id AS purchase_order_id, supplier_id, po_date AS purchase_date, total_amount, 'Received' AS order_status FROM po
  WHERE po_id % 5 <> 0),
l AS (SELECT concat_ws('-', po_id, book_id, supplier_id, quantity) AS detail_id, po_id AS purchase_order_id, book_id, quantity FROM lines)
""" + "\nUNION ALL ".join(f"({x})" for x in out)


ORACLE = {
    "rule_declared": _declared_sql(),
    "default_sales_dates": f"""
SELECT o_orderkey AS order_id, CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(o_orderdate AS DATE)
  ELSE DATE '{AS_OF}' END AS sales_date FROM orders""",
    "rule_expire_membership": f"""{with_roles("members")}
SELECT member_id, CASE WHEN expire_date <= DATE '{AS_OF}' THEN 'expire' ELSE 'active' END
  AS member_status FROM members""",
    "rule_member_status": with_roles("members")
    + "\n"
    + _violation(
        "member status",
        "member_id",
        "'status contradicts expiry'",
        f"members WHERE expire_date < DATE '{AS_OF}'",
    ),
    "rule_titles": _violation(
        "title year",
        "p_partkey",
        "'publication year is in the future'",
        "part WHERE 1960 + p_size > 2001",
    )
    + "\nUNION ALL\n"
    + _violation(
        "title popularity",
        "p_partkey",
        "'popularity must be between 1.0 and 5.0'",
        "part WHERE p_size < 10 OR p_size > 50",
    )
    + "\nUNION ALL\n"
    + _violation(
        "title purchase price",
        "p_partkey",
        "'price must be zero or more'",
        "part WHERE p_retailprice < 100",
    ),
    "copy_status": """
SELECT p_partkey AS copy_id, p_partkey AS book_id, CASE
  WHEN p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus <> 'F')
    THEN 'borrowed' WHEN p_brand = 'Brand#25' THEN 'unavailable'
  WHEN p_brand = 'Brand#24' THEN 'reserved' ELSE 'available' END AS book_status FROM part""",
    "rule_unavailable_copies": f"""WITH {BOOK_HISTORY_SQL}
SELECT p_partkey AS copy_id, p_partkey AS book_id, CASE
  WHEN EXISTS (SELECT 1 FROM history h WHERE h.book_id = p_partkey AND curr_ind = 'Y'
       AND book_status = 'UNAVAILABLE') OR p_brand = 'Brand#25' THEN 'unavailable'
  WHEN p_brand = 'Brand#24' THEN 'reserved' ELSE 'available' END AS book_status FROM part""",
    "attendance_status": f"""
SELECT event_id AS attendance_id, user_id AS staff_id,
  CASE WHEN hour(ts) * 3600 + minute(ts) * 60 + floor(second(ts)) > start_second THEN 'Late'
       ELSE 'Present' END AS attendance_status
FROM events JOIN (VALUES {_SHIFT_ROWS}) AS s(shift_id, start_second) ON shift_id = event_type""",
    "weekly_hours": f"WITH {_WEEKS} SELECT staff_id, week_start, hours FROM w",
    "rule_weekly_limit": f"WITH {_WEEKS} "
    + _violation(
        "weekly hours",
        "concat(staff_id, '|', week_start)",
        "concat(hours, ' hours exceed 40')",
        "w WHERE hours > 40",
    ),
    "rule_membership_window": f"""{with_roles("loans", "members")}
{_violation("membership window", "borrow_id", "'loan date is outside the membership'",
            "loans JOIN members USING (member_id) "
            "WHERE borrow_date < registration_date OR borrow_date > expire_date")}""",
    "rule_fines": FINES_SQL
    + "\n"
    + _violation(
        "fine amount",
        "fine_id",
        "'fine amount must be positive'",
        "fines WHERE fine_type = 'Damage' AND fine_amount <= 1000",
    ),
    "rule_payments": _violation(
        "payment method",
        "o_orderkey",
        "'invalid payment method'",
        "orders WHERE o_orderstatus NOT IN ('F', 'O')",
    )
    + "\nUNION ALL\n"
    + _violation(
        "payment amount",
        "o_orderkey",
        "'payment amount must be positive'",
        "orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
    ),
    "rule_total_guard": f"""{with_roles("po")},
t AS (SELECT po_id, CAST(sum(lines.quantity * (CAST(p_retailprice AS DECIMAL(18,2)) - 100))
        AS DECIMAL(18,2)) AS total FROM lines JOIN part ON p_partkey = book_id GROUP BY 1)
{_violation("purchase total", "po.po_id", "concat('total must equal ', total)",
            "po JOIN t ON t.po_id = po.po_id WHERE flag = 'N' AND total <> total_amount")}""",
    "rule_discount_window": f"""{with_roles("discounts")}
{_violation("discount window", "o_orderkey",
            "concat('discount ', discount_id, ' not active on ', CAST(o_orderdate AS DATE))",
            "orders JOIN discounts USING (o_orderpriority) "
            "WHERE CAST(o_orderdate AS DATE) < discount_start "
            "OR CAST(o_orderdate AS DATE) > discount_end")}""",
    "sales_amounts": f"""{with_roles("sales", "discounts")},
p AS (SELECT sales_id, quantity, {cents("sales_price * quantity")} AS gross,
    coalesce(discount_rate, 0) AS rate, coalesce(sales_date < discount_start
      OR sales_date > discount_end, FALSE) AS void
  FROM sales LEFT JOIN discounts ON discounts.o_orderpriority = sales.o_orderpriority),
a AS (SELECT *, {ratio_sql("gross * rate", "10000")} AS cut FROM p)
SELECT sales_id, quantity AS quantity_sold, CASE WHEN NOT void THEN cut END AS discount_amount,
  CASE WHEN NOT void THEN CAST(gross - round(cut * 100) AS DOUBLE) / 100 END AS total_amount FROM a""",
    "rule_orphans": _violation(
        "order has lines",
        "o_orderkey",
        "concat('no parent for o_orderkey ', o_orderkey)",
        "orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
    ),
    "rule_unique": _violation(
        "line number",
        "concat(l_orderkey, '|', l_linenumber)",
        "concat(n, ' rows')",
        "(SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)",
    ),
    "rule_not_null": f"{with_roles('loans')} "
    + _violation(
        "return_date not null",
        "borrow_id",
        "'return_date is required'",
        "loans WHERE return_date IS NULL",
    ),
    "status_profile": f"""{with_roles("loans")},
c AS (SELECT return_status, count(*) AS n FROM loans GROUP BY 1)
SELECT return_status, n AS cnt, {pct_sql("n", "sum(n) OVER ()")} AS pct FROM c""",
    "range_profile": f"""{with_roles("members")}
SELECT count(*) AS rows, min(member_age) AS min_value, max(member_age) AS max_value,
  {ratio_sql("sum(member_age)", "count(member_age)")} AS avg_value FROM members""",
}
