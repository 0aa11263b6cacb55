"""Wall seconds of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from shelfstar.catalog import all_queries
from shelfstar.session import build_session

HEADLINES = (
    "trend_month",
    "trend_report",
    "preference_view",
    "preference_report",
    "supplier_geo_view",
    "supplier_geo_report_q",
    "fact_borrowing",
    "fact_sales",
    "fact_purchase",
    "scd2_apply",
    "asof_join_scd2",
    "allocate_payments",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    # The first query of a JVM pays for class loading; that is not a property of the query.
    queries["monthly_trend"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "wall seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
