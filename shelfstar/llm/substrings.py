"""Substring deduplication by content-defined chunks.

A gear hash of the last 16 bytes decides where a chunk ends, so equal passages are cut alike wherever they stand, and
an insertion moves only the cuts next to it. A chunk whose digest occurs in a document with a smaller id, or
earlier in its own, is a repeat; runs of repeats of at least `min_run` bytes are removed.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfstar.llm.common import table

#: Bytes of the shortest and longest chunk, and mean distance of places where one may end.
SHORTEST, LONGEST, SPACING = 20, 160, 20
MIN_RUN = 64
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 7) & 0xFFFF for b in range(256)], np.uint16)
#: Documents without an id order after all others.
LAST = (1 << 63) - 1


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash of the 16 bytes up to each place: each byte's value, doubled with each byte after it."""
    h = GEAR[data]
    for step in (1, 2, 4, 8):
        moved = h.copy()
        moved[step:] += h[:-step] << np.uint16(step)
        h = moved
    return h


def chunk_ends(text: bytes, shortest: int = SHORTEST, longest: int = LONGEST, spacing: int = SPACING) -> list[int]:
    """Ends of the chunks of a text. No chunk is shorter than `shortest` but the last."""
    places = np.flatnonzero(gear(np.frombuffer(text, np.uint8)) < 65536 // spacing) + 1
    return _cut(places.tolist(), len(text), shortest, longest)


def _cut(places: list[int], size: int, shortest: int, longest: int) -> list[int]:
    ends, at, i = [], 0, 0
    while at < size:
        i = bisect_left(places, at + shortest, i)
        end = min(places[i] if i < len(places) else size, at + longest, size)
        ends.append(end)
        at = end
    return ends


def chunks(docs: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST, spacing: int = SPACING) -> DataFrame:
    """doc, text_hash, start, size, d1, d2 (digest), again (seen earlier in the text) from doc, text_hash, text."""
    names = ["doc", "text_hash", "start", "size", "d1", "d2", "again"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column("doc").to_numpy(False), batch.column("text_hash").to_numpy(False)
            counts, starts, sizes, digests, again = [], [], [], [], []
            rows = 0
            for k, text in enumerate(batch.column("text")):
                raw = text.as_buffer() if text.is_valid else b""
                raw = bytes(raw) if raw is not None else b""
                ends = chunk_ends(raw, shortest, longest, spacing) if raw else []
                begin, seen = 0, set()
                for end in ends:
                    d = xxhash.xxh3_128_digest(raw[begin:end])
                    digests.append(d)
                    again.append(d in seen)
                    seen.add(d)
                    starts.append(begin)
                    sizes.append(end - begin)
                    begin = end
                counts.append((k, len(ends)))
                rows += len(ends)
                if rows > 200_000:
                    yield flush(ids, hashes, counts, starts, sizes, digests, again)
                    counts, starts, sizes, digests, again, rows = [], [], [], [], [], 0
            yield flush(ids, hashes, counts, starts, sizes, digests, again)

    def flush(ids, hashes, counts, starts, sizes, digests, again) -> pa.RecordBatch:
        at = np.repeat([k for k, _ in counts], [n for _, n in counts]).astype(np.int64)
        words = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids[at], pa.int64()),
                pa.array(hashes[at], pa.int64()),
                pa.array(starts, pa.int64()),
                pa.array(sizes, pa.int32()),
                pa.array(words[:, 0]),
                pa.array(words[:, 1]),
                pa.array(again, pa.bool_()),
            ],
            names,
        )

    return docs.select("doc", "text_hash", "text").mapInArrow(
        cut, "doc long, text_hash long, start long, size int, d1 long, d2 long, again boolean"
    )


def repeated_spans(docs: DataFrame, min_run: int = MIN_RUN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, n_bytes, n_removed, n_spans, spans (array of begin, end in bytes), first_docs (ids that hold the
    passages first): one row per distinct (id, text).

    Rows repeated in id and text are one document. A null text counts as empty and has no spans. Documents without an
    id order last and are not compared with each other. An empty table gives no rows. Other columns are not
    looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    )
    cut = chunks(rows)
    owners = cut.groupBy("d1", "d2").agg(F.min("doc").alias("owner"), F.max("doc").alias("latest"))
    owned = cut.join(owners.filter("owner < latest").drop("latest"), ["d1", "d2"]).filter("doc > owner")
    columns = ["doc", "text_hash", "start", "size"]
    repeats = owned.select(*columns, "owner").union(cut.filter("again").select(*columns, F.lit(None).cast("long")))
    repeats = repeats.groupBy(*columns).agg(F.min("owner").alias("owner"))
    order = Window.partitionBy("doc", "text_hash").orderBy("start")
    end = F.col("start") + F.col("size")
    broken = F.coalesce(F.lag(end).over(order) < F.col("start"), F.lit(True)).cast("int")
    runs = (
        repeats.withColumn("end", end)
        .withColumn("run", broken)
        .withColumn("run", F.sum("run").over(order))
        .groupBy("doc", "text_hash", "run")
        .agg(F.min("start").alias("begin"), F.max("end").alias("end"), F.collect_set("owner").alias("owners"))
        .filter(F.col("end") - F.col("begin") >= min_run)
    )
    per_doc = runs.groupBy(F.col("doc").alias("doc_"), F.col("text_hash").alias("hash_")).agg(
        F.sum(F.col("end") - F.col("begin")).alias("n_removed"),
        F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("owners")))).alias("first_docs"),
    )
    whole = rows.groupBy("doc", "text_hash").agg(F.max(F.octet_length("text")).cast("long").alias("n_bytes"))
    joined = whole.join(per_doc, (F.col("doc") == F.col("doc_")) & (F.col("text_hash") == F.col("hash_")), "left")
    return joined.select(
        F.when(F.col("doc") != LAST, F.col("doc")).alias("doc_id"),
        "text_hash",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("spans", F.array().cast("array<struct<begin:bigint,end:bigint>>")).alias("spans"),
        F.coalesce("first_docs", F.array().cast("array<bigint>")).alias("first_docs"),
    )


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """A text without the bytes of its spans."""
    out, at = [], 0
    for begin, end in spans:
        out.append(text[at:begin])
        at = end
    return b"".join([*out, text[at:]])


def op4_substring_dedup(spark, folder: str) -> DataFrame:
    return repeated_spans(table(spark, folder, "documents")).drop("text_hash")


QUERIES = {"op4_substring_dedup": op4_substring_dedup}
ORACLE: dict[str, str] = {}
