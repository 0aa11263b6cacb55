"""The declared constraints of the operational tables, compiled from data.

`sources.schemas` says which columns are required, unique, coded, bounded, ordered and referring. Per table, all rules that a row
can break on its own become one projection and one scan, and all unique keys one grouped pass over (rule, key); each
reference is an anti-join with the distinct keys it may hold. Messages are made from the rule: column, value and bound.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfstar.plans.rules import check_foreign_key
from shelfstar.sources.schemas import ALLOWED, BEFORE, FOREIGN_KEYS, OPTIONAL, PRIMARY_KEYS, RANGES, UNIQUE


def _said(column: str) -> Column:
    return F.concat(F.lit(f"{column} is "), F.coalesce(F.col(column).cast("string"), F.lit("NULL")))


def row_rules(name: str, columns: Sequence[str]) -> Iterator[tuple[str, Column, Column]]:
    """Rule, violation and message of every rule on single rows of a table, as far as it has the columns. An unknown comparison
    breaks no rule."""
    has = set(columns)
    required = [c for c in columns if c in _declared(name) and c not in OPTIONAL.get(name, ())]
    for c in required:
        yield f"{name} {c} required", F.col(c).isNull(), _said(c)
    for c, codes in ALLOWED.get(name, {}).items():
        if c in has:
            yield f"{name} {c}", ~F.col(c).isin(*codes), F.concat(_said(c), F.lit(f", not one of {', '.join(codes)}"))
    for c, (low, high) in RANGES.get(name, {}).items():
        if c in has:
            under = F.col(c) < low if low is not None else F.lit(False)
            over = F.col(c) > high if high is not None else F.lit(False)
            bounds = f"{'' if low is None else low}..{'' if high is None else high}"
            yield f"{name} {c} range", under | over, F.concat(_said(c), F.lit(f", outside {bounds}"))
    for first, second in BEFORE.get(name, ()):
        if {first, second} <= has:
            yield f"{name} {first} before {second}", F.col(first) >= F.col(second), F.concat_ws(", ", _said(first), _said(second))


def _declared(name: str) -> set[str]:
    from shelfstar.sources.schemas import OPERATIONAL

    return {field.strip().split(" ")[0] for field in OPERATIONAL[name].split(", ")}


def row_violations(name: str, df: DataFrame) -> DataFrame:
    """rule, key, message of all rows that break a rule on their own, in one scan."""
    hits = [
        F.when(broken, F.struct(F.lit(rule).alias("rule"), message.alias("message")))
        for rule, broken, message in row_rules(name, df.columns)
    ]
    found = df.select(F.col(PRIMARY_KEYS[name]).cast("string").alias("key"), F.explode(F.array_compact(F.array(*hits))).alias("h"))
    return found.select("h.rule", "key", "h.message")


def unique_keys(name: str, columns: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """Rule and columns of every unique key of a table, as far as it has the columns."""
    keys = {f"{name} primary key": (PRIMARY_KEYS[name],)}
    keys |= {f"{name} {', '.join(k)} unique": k for k in UNIQUE.get(name, ())}
    return {rule: k for rule, k in keys.items() if set(k) <= set(columns)}


def unique_violations(name: str, df: DataFrame) -> DataFrame:
    """rule, key, message of every key value that occurs more than once, all unique keys of the table in one pass. A key with a
    NULL is equal to none; rows are counted before the shuffle, so a value of very many rows is one row per task there."""
    found = []
    for rule, columns in unique_keys(name, df.columns).items():
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
        # Values are told apart by more than their text, which may hold the mark between them.
        parts = F.to_json(F.array(*[F.col(c).cast("string") for c in columns])) if len(columns) > 1 else F.col(columns[0]).cast("string")
        said = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
        found.append(F.when(whole, F.struct(F.lit(rule).alias("rule"), parts.alias("value"), said.alias("key"))))
    every = df.select(F.explode(F.array_compact(F.array(*found))).alias("u")).select("u.*")
    many = every.groupBy("rule", "value", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return many.select("rule", "key", F.concat(F.col("n").cast("string"), F.lit(" rows")).alias("message"))


def reference_violations(tables: dict[str, DataFrame]) -> list[DataFrame]:
    """rule, key, message per reference between the given tables: rows whose value is not NULL and has no parent."""
    found = []
    for child, column, parent in FOREIGN_KEYS:
        if child in tables and parent in tables and column in tables[child].columns:
            args = (tables[child], PRIMARY_KEYS[child], column, tables[parent], PRIMARY_KEYS[parent])
            found.append(check_foreign_key(*args, f"{child} {column} reference"))
    return found


def declared_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """rule, key, message of everything in the given operational tables that breaks a declared constraint.

    Rules on columns that a table lacks are left out.
    """
    found = [part for name, df in tables.items() for part in (row_violations(name, df), unique_violations(name, df))]
    return reduce(DataFrame.unionByName, [*found, *reference_violations(tables)])
