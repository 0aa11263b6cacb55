"""Compare registered queries with their SQL in DuckDB: `python tests/oracle_check.py FOLDER [name ...]`."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _types(schema) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in schema}


def _sortable(row):
    return tuple((v is not None, str(type(v)), v) if v is not None else (False, "", 0) for v in row)


def difference(spark_table, sql_table) -> str | None:
    """None when both Arrow tables hold the same columns, types and rows."""
    left, right = _types(spark_table.schema), _types(sql_table.schema)
    if left != right:
        return "schema " + str({k: (left.get(k), right.get(k)) for k in left.keys() | right.keys() if left.get(k) != right.get(k)})
    names = sorted(left)
    if spark_table.num_rows != sql_table.num_rows:
        return f"rows {spark_table.num_rows} != {sql_table.num_rows}"
    a = sorted(zip(*[spark_table.column(n).to_pylist() for n in names]), key=_sortable)
    b = sorted(zip(*[sql_table.column(n).to_pylist() for n in names]), key=_sortable)
    for x, y in zip(a, b):
        for n, u, v in zip(names, x, y):
            same = u == v or (isinstance(u, float) and isinstance(v, float) and math.isclose(u, v, rel_tol=1e-12))
            if not same:
                return f"column {n}: {u!r} != {v!r} in {dict(zip(names, x))} / {dict(zip(names, y))}"
    return None


def main(folder: str, names: list[str]) -> int:
    from shelfstar.catalog import all_oracles, all_queries
    from shelfstar.session import build_session

    spark = build_session("oracle-check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracles, bad = all_oracles(), 0
    for name, run in all_queries().items():
        if names and name not in names:
            continue
        start = time.time()
        table = run(spark, folder).toArrow()
        took = time.time() - start
        if name not in oracles:
            print(f"{name:32} {took:6.2f}s rows={table.num_rows} (no SQL)")
            continue
        problem = difference(table, con.execute(oracles[name]).to_arrow_table())
        bad += problem is not None
        print(f"{name:32} {took:6.2f}s rows={table.num_rows} {problem or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
