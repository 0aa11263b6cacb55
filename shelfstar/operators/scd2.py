"""Slowly changing dimensions of Type 2, all changes of a batch in one plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfstar.functions.dates import as_date, open_end
from shelfstar.operators.lookup import attach
from shelfstar.operators.split import SLICE, SLICE_ROWS, neighbour, with_slices
from shelfstar.operators.surrogate import assign_keys
from shelfstar.session import settle

NEW_KEY, NEW_VERSION, CLOSE = "new key", "new version", "close"


def scd2_apply(
    dim: DataFrame,
    changes: DataFrame,
    *,
    id_col: str,
    key_col: str,
    tracked: Sequence[str],
    inherit: Sequence[str] = (),
    source: DataFrame | None = None,
    close_floor: str = "before",
    as_of=None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The dimension after a batch of changes.

    A change without an effective_date holds from `as_of` on, which must be given if there is any. An id of more than
    `slice_rows` changes is cut along its order.

    `changes` carries id_col, every attribute that is not inherited,
    effective_date, and optionally: seq (order within a day), active (False
    closes the version and opens none) and first_effective (start of the first
    version of a new id). `inherit` attributes of a new version come from the
    version before; for new ids they come from `source`, and ids absent there
    are not inserted.

    A change whose tracked attributes equal those in force, ignoring case, does
    nothing. A replaced version ends the day before the change: never later
    than it would have ended anyway (`close_floor="before"`), or never earlier
    than it began (`close_floor="effective"`). The effective changes are settled
    once; they both end old versions and open new ones.
    """
    since = F.raise_error(F.lit("a change has no effective_date: give as_of")) if as_of is None else as_date(as_of)
    changes = changes.withColumn("effective_date", F.coalesce("effective_date", since.cast("date")))
    events = settle(scd2_events(dim, changes, id_col, tracked, inherit, source, slice_rows))
    fresh = _opened(events, id_col, dim, key_col, close_floor)
    return _closed(dim, changes, events, id_col, close_floor).unionByName(fresh)


def scd2_events(
    dim: DataFrame,
    changes: DataFrame,
    id_col: str,
    tracked: Sequence[str],
    inherit: Sequence[str] = (),
    source: DataFrame | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The changes that do something, each with its `action` and attributes filled in."""
    rows = changes
    for name, value in (("seq", F.lit(0)), ("active", F.lit(True))):
        if name not in rows.columns:
            rows = rows.withColumn(name, value)
    if "first_effective" not in rows.columns:
        rows = rows.withColumn("first_effective", F.col("effective_date"))
    rows = rows.withColumns({c: F.col(c).cast(dim.schema[c].dataType) for c in tracked})
    current = dim.where(F.col("curr_ind") == "Y").select(
        id_col,
        F.struct(*tracked).alias("_in_force"),
        *[F.col(c).alias(f"_old_{c}") for c in inherit],
    )
    order = ["effective_date", "seq"]
    rows, bucket = with_slices(rows, [id_col], order, slice_rows)
    chained = attach(
        neighbour(rows, [id_col], bucket, order, [*tracked, "active"], "_prev"),
        current,
        id_col,
        "left",
        sized_by=dim,
    )
    first = F.col("_prev").isNull()
    had_current = F.when(first, F.col("_in_force").isNotNull()).otherwise(F.col("_prev.active"))
    differs = F.lit(False)
    for c in tracked:
        before = F.when(first, F.col(f"_in_force.{c}")).otherwise(F.col(f"_prev.{c}"))
        differs = differs | ~_comparable(before).eqNullSafe(_comparable(F.col(c)))
    action = (
        F.when(~had_current, NEW_KEY)
        .when(~F.col("active"), CLOSE)
        .when(differs, NEW_VERSION)
    )
    events = chained.withColumn("action", action).where(F.col("action").isNotNull())
    if inherit:
        if source is None:
            raise ValueError("inherited attributes of new ids need a source")
        found = source.select(
            id_col, F.lit(True).alias("_found"), *[F.col(c).alias(f"_src_{c}") for c in inherit]
        )
        events = attach(events, found, id_col, "left").where(
            F.col("_found") | F.col("_in_force").isNotNull()
        )
        for c in inherit:
            events = events.withColumn(c, F.coalesce(f"_old_{c}", f"_src_{c}"))
    return events


def _comparable(col: Column) -> Column:
    return F.upper(col.cast("string"))


def _ends(next_start: Column, own_start: Column, own_end: Column, close_floor: str) -> Column:
    day_before = F.date_sub(next_start, 1)
    if close_floor == "effective":
        return F.greatest(day_before, own_start)
    return F.least(day_before, own_end)


def _opened(
    events: DataFrame, id_col: str, dim: DataFrame, key_col: str, close_floor: str
) -> DataFrame:
    """Versions opened by the batch, with keys after the dimension's highest."""
    chained = neighbour(
        events.withColumn("_change", F.col("effective_date")),
        [id_col],
        SLICE if SLICE in events.columns else None,
        ["effective_date", "seq"],
        ["_change"],
        "_next",
        following=True,
    ).where(F.col("action") != CLOSE)
    start = F.when(F.col("action") == NEW_KEY, F.col("first_effective")).otherwise(
        F.col("effective_date")
    )
    replaced = F.col("active") & F.col("_next").isNotNull()
    end = F.when(
        replaced, _ends(F.col("_next._change"), F.col("_start"), open_end(), close_floor)
    ).otherwise(open_end())
    versions = chained.withColumn("_start", start).withColumns(
        {
            "expiration_date": end,
            "curr_ind": F.when(F.col("active") & ~replaced, "Y").otherwise("N"),
        }
    )
    shaped = versions.withColumn("effective_date", F.col("_start"))
    keyed = assign_keys(shaped, id_col, key_col, after=dim, tie_break=["_change", "seq"])
    return keyed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in dim.schema])


def _closed(
    dim: DataFrame, changes: DataFrame, events: DataFrame, id_col: str, close_floor: str
) -> DataFrame:
    """The old versions, those in force ended by the first event of their id."""
    firsts = (
        events.where(F.col("_in_force").isNotNull())
        .groupBy(id_col)
        .agg(F.min("effective_date").alias("_change"))
    )
    hit = F.col("_change").isNotNull() & (F.col("curr_ind") == "Y")
    end = _ends(
        F.col("_change"), F.col("effective_date"), F.col("expiration_date"), close_floor
    )
    return (
        attach(dim, firsts, id_col, "left", sized_by=changes)
        .withColumn("expiration_date", F.when(hit, end).otherwise(F.col("expiration_date")))
        .withColumn("curr_ind", F.when(hit, "N").otherwise(F.col("curr_ind")))
        .select(*dim.columns)
    )
