"""Many-to-one lookups whose strategy follows the checked size of the lookup side."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# A lookup of at most this many rows (a key and a few attributes) is broadcast.
BROADCAST_ROWS = 1_000_000


# Tables counted before, so that a lookup that several queries of a session use is counted once: by application, plan and key column.
_KNOWN: OrderedDict[tuple[str, int, str | None], tuple[DataFrame, int]] = OrderedDict()
REMEMBERED = 256


def _known(df: DataFrame, by: str | None) -> int | None:
    """What was counted for a plan over the same files in this session. It decides on a strategy, not on results."""
    known = _KNOWN.get((df.sparkSession.sparkContext.applicationId, df.semanticHash(), by))
    return known[1] if known and known[0].sameSemantics(df) else None


def _remember(df: DataFrame, by: str | None, n: int) -> int:
    _KNOWN[(df.sparkSession.sparkContext.applicationId, df.semanticHash(), by)] = (df, n)
    if len(_KNOWN) > REMEMBERED:
        _KNOWN.popitem(last=False)
    return n


def row_count(df: DataFrame) -> int:
    n = _known(df, None)
    return _remember(df, None, df.count()) if n is None else n


def most_per_key(df: DataFrame, key: str) -> int:
    """Rows of the key that has most; 0 for an empty table. Keys are counted map side first, and the same job counts the rows."""
    n = _known(df, key)
    if n is None:
        total, n = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n")).first()
        _remember(df, None, total or 0)
        _remember(df, key, n or 0)
    return n or 0


def within_rows(df: DataFrame, bound: int = BROADCAST_ROWS) -> bool:
    return row_count(df) <= bound


def merged_if_large(side: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """A side of a join that Spark may not broadcast beyond the bound. By itself Spark goes by the bytes of compressed files and of the columns
    read, by which the ids of millions of rows look small, and the driver would hold the table of each such join."""
    return side if within_rows(side, bound) else side.hint("merge")


def attach(
    fact: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str] | Column,
    how: str = "inner",
    bound: int = BROADCAST_ROWS,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Join a lookup that has one row per key.

    Counted small, the lookup is broadcast and the fact stays in place; beyond
    the bound both sides shuffle, whatever size Spark takes the lookup for, and adaptive execution splits hot keys. Where
    counting the lookup would mean computing it, `sized_by` is a table that has
    at least as many rows.
    """
    small = within_rows(lookup if sized_by is None else sized_by, bound)
    side = F.broadcast(lookup) if small else lookup.hint("merge")
    return fact.join(side, on, how)


def attach_folded(
    fact: DataFrame,
    lookup: DataFrame,
    on: str,
    by: Sequence[str],
    measures: Sequence[str],
    how: str = "inner",
    bound: int = BROADCAST_ROWS,
) -> DataFrame:
    """Attach a lookup to rows that are going to be summed by `by` and its attributes.

    A small lookup is broadcast and the rows stay as they are. Before a large
    one the fact is reduced to (by, key), which folds hot keys ahead of the
    shuffled join.
    """
    if within_rows(lookup, bound):
        return fact.join(F.broadcast(lookup), on, how)
    return _sums(fact, [*by, on], measures).join(lookup.hint("merge"), on, how)


def sum_by_attribute(
    fact: DataFrame,
    lookup: DataFrame,
    on: str,
    by: Sequence[str],
    measures: Sequence[str],
    how: str = "inner",
    bound: int = BROADCAST_ROWS,
) -> DataFrame:
    """Sum `measures` by `by` plus every attribute of `lookup`."""
    attributes = [c for c in lookup.columns if c != on]
    joined = attach_folded(fact, lookup, on, by, measures, how, bound)
    return _sums(joined, [*by, *attributes], measures)


def _sums(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
