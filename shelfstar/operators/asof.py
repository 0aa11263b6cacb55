"""Point-in-time lookup in a versioned dimension.

A fact row meets the versions of its business id by an equality join, with the span as residual condition. Where an id has very many
versions (a daily price) that would be as many candidates per row, so its versions are dealt, in order, to stretches of time that
hold CHUNK of them each. A row finds its stretch by binary search in the starts of the stretches of its id, and meets the versions of
that stretch only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from shelfstar.functions.dates import open_end
from shelfstar.operators.lookup import BROADCAST_ROWS, attach, most_per_key
from shelfstar.operators.split import rank_among

#: Versions that a fact row meets at most, and versions in a stretch of time.
CHUNK = 64


def version_spans(versions: DataFrame, id_col: str, key_col: str, strict: bool) -> DataFrame:
    """Add valid_from and valid_to, non-overlapping per business id.

    Of versions that overlap, the later one wins. Strict spans end at the
    version's own expiration; otherwise each version reaches to the next one and
    the first reaches back to the start, so that every date finds a version.

    Versions of one day are reduced to the last one map side, so the window over
    an id sees at most one row per day of its life. `_place` numbers them from 0.
    """
    columns = versions.columns
    versions = (
        versions.groupBy(id_col, "effective_date")
        .agg(F.max_by(F.struct(*columns), key_col).alias("v"))
        .select("v.*")
    )
    chain = W.partitionBy(id_col).orderBy("effective_date")
    before_next = F.date_sub(F.lead("effective_date").over(chain), 1)
    place = F.row_number().over(chain) - 1
    if strict:
        start, end = F.col("effective_date"), F.least("expiration_date", before_next)
    else:
        start = F.when(place == 0, F.lit("0001-01-01").cast("date")).otherwise(
            F.col("effective_date")
        )
        end = F.coalesce(before_next, open_end())
    return versions.withColumn("valid_from", start).withColumn("valid_to", end).withColumn("_place", place)


def deal(fact: DataFrame, spans: DataFrame, id_col: str, at: str, versions: DataFrame, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Both sides with `_at_chunk` and `_chunk`, the number of their stretch of time within the id.

    The starts of an id's stretches are one row, and there are at most a `chunk`-th as many starts as versions, which bounds
    the broadcast. Rows of ids without a second stretch, and rows before the first start, are in stretch 0.
    """
    number = F.floor(F.col("_place") / chunk).cast("int")
    first = (F.col("_place") % chunk == 0) & (F.col("_place") > 0)
    starts = spans.where(first).groupBy(F.col("_id").alias("_of")).agg(F.sort_array(F.collect_list("valid_from")).alias("_starts"))
    found = attach(fact, starts, F.col(id_col) == F.col("_of"), "left", BROADCAST_ROWS * chunk, sized_by=versions)
    # Starts on the day itself count, so what is looked for is the day after.
    stretch = F.coalesce(rank_among(F.col("_starts"), F.date_add(at, 1)), F.lit(0))
    return found.withColumn("_at_chunk", stretch).drop("_of", "_starts"), spans.withColumn("_chunk", number)


def asof_lookup(
    fact: DataFrame,
    versions: DataFrame,
    id_col: str,
    key_col: str,
    at: str,
    keep: tuple[str, ...] = (),
    strict: bool = False,
    how: str = "inner",
    chunk: int = CHUNK,
) -> DataFrame:
    """Attach the version of `id_col` that holds on date `at`: its key and `keep`.

    A fact row meets at most `chunk` versions, whatever their number and wherever in time they lie; hot fact keys are split by
    adaptive execution, and by their stretches of time where an id has several.
    """
    used = versions.select(id_col, key_col, *keep, "effective_date", "expiration_date")
    spans = version_spans(used, id_col, key_col, strict).select(
        F.col(id_col).alias("_id"), key_col, *keep, "valid_from", "valid_to", "_place"
    )
    match = F.col(id_col) == F.col("_id")
    if most_per_key(versions, id_col) > chunk:
        fact, spans = deal(fact, spans, id_col, at, versions, chunk)
        match = match & (F.col("_at_chunk") == F.col("_chunk"))
    match = match & F.col(at).between(F.col("valid_from"), F.col("valid_to"))
    found = attach(fact, spans, match, how, sized_by=versions)
    return found.drop("_id", "valid_from", "valid_to", "_place", "_at_chunk", "_chunk")
