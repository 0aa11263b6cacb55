"""Lending roles over commerce tables (customer, part, supplier, orders, lineitem, events).

Every function returns one operational table in the library's column names, so
that the loaders and reports run on generic order data. A line item plays a
loan (its ship date is the loan day) as well as a sale and a purchase line.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfstar.functions.labels import gender_code
from shelfstar.functions.numbers import money
from shelfstar.operators import calendar
from shelfstar.session import discard, shared_folder

AS_OF = "2001-12-31"
MEMBERSHIP_START = "1994-01-01"
DISCOUNT_START = "1995-01-01"

# Which market segment stands for which gender.
FEMALE_SEGMENTS = ("BUILDING", "HOUSEHOLD")
MALE_SEGMENTS = ("AUTOMOBILE", "MACHINERY")
# The tax from which on a line stands for a book that came back damaged.
DAMAGE_TAX = 0.08
# Seconds of work per unit of an event value.
WORK_SECONDS = 240
# Shift start hour per event type.
SHIFT_HOURS = (("click", 9), ("error", 12), ("purchase", 15), ("signup", 20), ("view", 9))


# Column types as stored; dates are timestamps without a zone.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


# Which column of a table holds its days, and the range of days of tables seen before.
DAY_COLUMNS = {"orders": "o_orderdate", "lineitem": "l_shipdate"}
_RANGES: dict[tuple[str, str], tuple] = {}
# Which column of a table holds its order, and lines in a bucket of orders, about.
ORDER_COLUMNS = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
BUCKET_LINES = 200_000


class Commerce:
    """The commerce tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    # --- places -----------------------------------------------------------

    def places(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            "n_nationkey", F.col("n_name").alias("city"), F.col("r_name").alias("state")
        )

    # --- operational tables -------------------------------------------------

    def members(self) -> DataFrame:
        c = self.table("customer")
        registered = F.date_add(F.lit(MEMBERSHIP_START).cast("date"), F.col("c_nationkey") * 40)
        expires = F.add_months(registered, 72)
        return c.join(self.places(), F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("member_id"),
            F.col("c_name").alias("member_name"),
            segment_gender(F.col("c_mktsegment")).alias("member_gender"),
            F.floor((F.col("c_acctbal") + 1000) / 100).cast("int").alias("member_age"),
            F.concat_ws(", ", "c_name", "city", "state", F.lit("X")).alias("member_address"),
            F.when(expires > F.lit(AS_OF).cast("date"), "active")
            .otherwise("expire")
            .alias("member_status"),
            registered.alias("registration_date"),
            expires.alias("expire_date"),
        )

    def suppliers(self) -> DataFrame:
        s = self.table("supplier")
        return s.join(self.places(), F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("supplier_id"),
            F.col("s_name").alias("supplier_name"),
            F.concat_ws(", ", "s_name", "city", "state", F.lit("00000"), F.lit("X")).alias(
                "supplier_address"
            ),
        )

    def titles(self) -> DataFrame:
        price = money(F.col("p_retailprice"))
        return self.table("part").select(
            F.col("p_partkey").alias("book_id"),
            F.col("p_name").alias("title"),
            F.col("p_brand").alias("author"),
            F.col("p_type").alias("genre"),
            (F.lit(1960) + F.col("p_size")).alias("publication_year"),
            (price - F.lit(100).cast("decimal(3,0)")).cast("decimal(18,2)").alias("purchase_price"),
            price.alias("sales_price"),
            (F.col("p_size") / 10).cast("decimal(3,1)").alias("popularity"),
        )

    def copies(self) -> DataFrame:
        brand = F.col("p_brand")
        return self.table("part").select(
            F.col("p_partkey").alias("copy_id"),
            F.col("p_partkey").alias("book_id"),
            F.when(brand == "Brand#25", "unavailable")
            .when(brand == "Brand#24", "reserved")
            .otherwise("available")
            .alias("book_status"),
        )

    def loan_lines(self) -> DataFrame:
        """Loans without the member: one scan, no join."""
        borrow = F.to_date("l_shipdate")
        days = F.col("l_quantity").cast("int")
        returned = F.when(F.col("l_linestatus") == "F", F.date_add(borrow, days))
        status = (
            F.when(F.col("l_returnflag") == "R", "Returned")
            .when(F.col("l_returnflag") == "A", "Lost")
            .when(F.col("l_linestatus") == "F", "Overdue")
            .otherwise("On loan")
        )
        return self.table("lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias(
                "borrow_id"
            ),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("copy_id"),
            borrow.alias("borrow_date"),
            F.date_add(borrow, 10).alias("due_date"),
            returned.alias("return_date"),
            status.alias("return_status"),
            (F.col("l_tax") >= DAMAGE_TAX).alias("damaged"),
        )

    def loans(self) -> DataFrame:
        who = self.table("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("member_id")
        )
        return self.loan_lines().join(who, "order_id").drop("order_id")

    def discounts(self) -> DataFrame:
        """One discount per order priority that is specified (a handful of values)."""
        level = F.substring("o_orderpriority", 1, 1).cast("int")
        start = F.date_add(F.lit(DISCOUNT_START).cast("date"), level * 200)
        return (
            self.table("orders")
            .select("o_orderpriority")
            .distinct()
            .where(F.col("o_orderpriority") != "4-NOT SPECIFIED")
            .select(
                F.concat(F.lit("D00"), level.cast("string")).alias("discount_id"),
                F.substring("o_orderpriority", 3, 20).alias("discount_name"),
                (level * 5).cast("decimal(8,2)").alias("discount_rate"),
                start.alias("discount_start"),
                F.date_add(start, 1600).alias("discount_end"),
            )
        )

    def book_orders(self) -> DataFrame:
        priority = F.col("o_orderpriority")
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("member_id"),
            F.when(
                priority != "4-NOT SPECIFIED", F.concat(F.lit("D00"), F.substring(priority, 1, 1))
            ).alias("discount_id"),
            F.to_date("o_orderdate").alias("sales_date"),
        )

    def sales_details(self) -> DataFrame:
        gross = money(F.col("l_extendedprice"))
        discount = F.round(gross * F.col("l_discount").cast("decimal(4,2)"), 2).cast("decimal(18,2)")
        return self.table("lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias(
                "sales_id"
            ),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("book_id"),
            F.col("l_quantity").cast("bigint").alias("quantity_sold"),
            discount.alias("discount_amount"),
            (gross - discount).cast("decimal(18,2)").alias("total_amount"),
        )

    def purchase_details(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("purchase_order_id"),
            F.col("l_partkey").alias("book_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            money(F.col("l_extendedprice")).alias("line_amount"),
        )

    def purchase_orders(self) -> DataFrame:
        """Headers: one supplier per order and the sum of its lines as total."""
        header = (
            self.purchase_details()
            .groupBy("purchase_order_id")
            .agg(
                F.min("supplier_id").alias("supplier_id"),
                F.sum("line_amount").cast("decimal(18,2)").alias("total_amount"),
            )
        )
        return self.order_dates().join(header, "purchase_order_id")

    def order_dates(self, years: tuple[int, int] | None = None) -> DataFrame:
        status = F.col("o_orderstatus")
        return within(self.table("orders"), "o_orderdate", years).select(
            F.col("o_orderkey").alias("purchase_order_id"),
            F.to_date("o_orderdate").alias("purchase_date"),
            F.when(status == "F", "Received")
            .when(status == "O", "Pending")
            .otherwise("Cancelled")
            .alias("order_status"),
        )

    def payments(self) -> DataFrame:
        """Orders as payments whose amount is still to be derived."""
        status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
        return self.table("orders").select(
            F.col("o_orderkey").alias("payment_id"),
            F.col("o_custkey").alias("member_id"),
            F.to_date("o_orderdate").alias("payment_date"),
            F.lit(None).cast("decimal(18,2)").alias("pay_amount"),
            F.when(status == "F", "Tng")
            .when(status == "O", "Cash")
            .otherwise("Duitnow")
            .alias("payment_method"),
            F.when(priority.isin("1-URGENT", "2-HIGH"), "Fines")
            .when(priority == "3-MEDIUM", "Membership Registration")
            .otherwise("Book Sale")
            .alias("payment_type"),
        )

    def shifts(self) -> DataFrame:
        rows = ", ".join(f"('{name}', {hour * 3600})" for name, hour in SHIFT_HOURS)
        return self.spark.sql(f"SELECT * FROM VALUES {rows} AS s(shift_id, start_second)")

    def attendance(self) -> DataFrame:
        """Events as staff attendance; `value` gives the length of the work."""
        seconds = (F.col("value") * WORK_SECONDS).cast("bigint")
        return self.table("events").select(
            F.col("event_id").alias("attendance_id"),
            F.col("user_id").alias("staff_id"),
            F.col("event_type").alias("shift_id"),
            F.to_date("ts").alias("shift_date"),
            F.col("ts").alias("actual_start"),
            F.timestamp_add("SECOND", seconds, F.col("ts")).alias("actual_end"),
        )

    # --- star tables on natural keys ----------------------------------------

    @property
    def first_and_last(self) -> tuple[date | None, date | None]:
        """First and last day of the whole years in which anything was ordered or shipped.

        As literals they reach the scans. None where no row has a date. The range is kept for as long as the
        tables consist of the same files, so it is scanned for once in a session and not before every query.
        """
        dated = {name: self.table(name).select(F.col(day).alias("day")) for name, day in DAY_COLUMNS.items()}
        files = tuple(sorted(f for df in dated.values() for f in df.inputFiles()))
        key = (self.spark.sparkContext.applicationId, self.folder)
        known = _RANGES.get(key)
        if not known or known[0] != files:
            days = dated["orders"].unionByName(dated["lineitem"])
            low, high = days.agg(F.min("day"), F.max("day")).first()
            _RANGES[key] = known = (files, (date(low.year, 1, 1), date(high.year, 12, 31)) if low else (None, None))
        return known[1]

    def days(self) -> DataFrame:
        return calendar.days_between(self.spark, *self.first_and_last)

    def holidays(self) -> DataFrame:
        first, last = self.first_and_last
        return calendar.fixed_holidays(self.spark, first.year if first else 0, last.year if last else 0)

    def calendar(self) -> DataFrame:
        return calendar.dim_date(self.days(), self.holidays())

    def book_genres(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("book_key"), F.upper(F.trim("p_type")).alias("genre")
        )

    def genders(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("member_key"),
            gender_code(segment_gender(F.col("c_mktsegment"))).alias("gender"),
        )

    def supplier_places(self) -> DataFrame:
        s = self.table("supplier")
        return s.join(self.places(), F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("supplier_key"),
            F.upper(F.trim("s_name")).alias("supplier_name"),
            F.upper(F.trim("city")).alias("city"),
        )

    def lending_fact(self, years: tuple[int, int] | None = None) -> DataFrame:
        """Loans with date and book key; a range of years is filtered at the scan."""
        day = F.to_date("l_shipdate")
        return within(self.table("lineitem"), "l_shipdate", years).select(
            calendar.date_key(day, self.first_and_last[0]).alias("date_key"),
            F.col("l_partkey").alias("book_key"),
        )

    def loan_spans(self) -> DataFrame:
        return self.loan_lines().select(
            F.col("borrow_date").alias("start"), F.col("return_date").alias("end")
        )


class ByOrder(Commerce):
    """The same tables, with orders and lines written once as tables bucketed by order.

    A load joins and groups lines by their order for every fact and again for its rejects; here it does so bucket by bucket, without a
    shuffle. As many buckets as the lines need, so that a bucket stays the same size however many lines there are.
    """

    def __init__(self, src: Commerce):
        super().__init__(src.spark, src.folder)
        buckets = src.table("lineitem").count() // BUCKET_LINES + 1
        at = uuid.uuid4().hex
        self.names = {name: f"{name}_by_order_{at}" for name in ORDER_COLUMNS}
        for name, column in ORDER_COLUMNS.items():
            rows = src.table(name).repartition(buckets, column)
            path = f"{shared_folder(src.spark)}/{self.names[name]}"
            rows.write.bucketBy(buckets, column).option("path", path).saveAsTable(self.names[name])

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self.names[name]) if name in self.names else super().table(name)

    def drop(self) -> None:
        """Give the bucketed tables up, for when nothing made from them will be computed again."""
        for name in self.names.values():
            self.spark.sql(f"DROP TABLE {name}")
            discard(self.spark, f"{shared_folder(self.spark)}/{name}")


def within(df: DataFrame, column: str, years: tuple[int, int] | None) -> DataFrame:
    """Rows of a closed range of years, as a range of the stored timestamp."""
    if years is None:
        return df
    first = F.lit(f"{years[0]}-01-01").cast("timestamp_ntz")
    after = F.lit(f"{years[1] + 1}-01-01").cast("timestamp_ntz")
    return df.where((F.col(column) >= first) & (F.col(column) < after))


def segment_gender(segment: Column) -> Column:
    return F.when(segment.isin(*FEMALE_SEGMENTS), "female").when(
        segment.isin(*MALE_SEGMENTS), "male"
    )
