"""Adding streamed rows to a table, each key once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from shelfstar.sources.tables import insert_new


def append_new_rows(
    stream: DataFrame,
    path: str,
    keys: Sequence[str],
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> StreamingQuery:
    """Load every micro-batch as an incremental batch: prepare it, then insert absent keys.

    A batch that is replayed after a failure finds its keys present and adds
    nothing. The table at `path` must exist. Of rows with the same key
    inside one batch the first in the order of the other columns is added.
    """

    def load(batch: DataFrame, _: int) -> None:
        rows = prepare(batch)
        insert_new(rows, path, keys, rows.schema)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
