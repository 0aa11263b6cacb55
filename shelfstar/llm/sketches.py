"""Document fingerprints: threshold-scaled sketches of word shingles.

A text's sketch is every distinct shingle hash below a fixed fraction of the hash range, so sketches of texts of any two lengths sample
the same shingles: shared hashes over those of one text estimate how much of it the other holds, and the sketch of a union is the
union of sketches. A text with words but no hash below the fraction keeps its least hash alone, so that only
texts without words have an empty sketch.

Documents are compared with what follows them in descending order of ids. Texts are dealt once, to slices of that order; the first document
of each slice goes to the slice before too, so neighbours meet in one pass over sorted rows and no task sees more than its slice.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from hashlib import md5, sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfstar.llm.common import LOWER, UPPER, table, written

SHINGLE = 5
#: One hash in this many is kept.
ONE_IN = 8
#: Bytes of text in a slice of few or of very many, and how many count as few.
SLICE, LARGE_SLICE, FEW = 4 << 20, 256 << 20, 4096
#: Keys a task remembers to send repeated rows once.
REMEMBERED = 1 << 20
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def sketch(text: str | None, shingle: int = SHINGLE, one_in: int = ONE_IN) -> list[bytes]:
    """Ascending hashes (big-endian, 8 bytes) of the text's shingles that lie in the lowest part of the range; the least
    one where none does. Fewer words than a shingle are one shingle; null and texts without words have none."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return []
    joined = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    begins = [0, *(e + 1 for e in ends)]
    limit = ((1 << 64) // one_in).to_bytes(9, "big")[1:]
    found, least = set(), b"\xff" * 8
    for a, b in zip(begins, ends[min(shingle, len(words)) - 1 :]):
        h = md5(joined[a:b]).digest()[:7:-1]
        if h < limit or one_in == 1:
            found.add(h)
        elif h < least:
            least = h
    return sorted(found) or [least]


def hexed(hashes: list[bytes]) -> str:
    return b"".join(hashes).hex()


def likeness(a: list[bytes], b: list[bytes]) -> float:
    """Estimated share of shingles in common of all shingles of either text; 1 for two texts without words."""
    common = len(set(a) & set(b))
    every = len(a) + len(b) - common
    return common / every if every else 1.0


def sketch_texts(docs: DataFrame, shingle: int = SHINGLE, one_in: int = ONE_IN, text_col: str = "text") -> DataFrame:
    """`docs` with its text column replaced by `sketch`, an array of hashes of 16 hex digits, ascending; a row per input
    row. Texts that are null or without words have an empty one."""
    keep = [c for c in docs.columns if c != text_col]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[h.hex() for h in sketch(t.as_py(), shingle, one_in)] for t in batch.column(text_col)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(found, pa.list_(pa.string()))], [*keep, "sketch"])

    schema = docs.drop(text_col).schema.add("sketch", T.ArrayType(T.StringType()))
    return docs.mapInArrow(made, schema)


def merge_sketches(sketched: DataFrame, *keys: str, sketch_col: str = "sketch", one_in: int = ONE_IN) -> DataFrame:
    """The sketch of all texts of a group together, as rows (keys, hash). A least hash kept for want of others counts only where the
    group has no hash below the fraction, and there the least of them. No group is gathered in one place."""
    limit = f"{(1 << 64) // one_in:016x}"[-16:]
    rows = sketched.select(*keys, F.explode(sketch_col).alias("hash")).distinct()
    low = F.lit(one_in == 1) | (F.col("hash") < limit)
    least = rows.groupBy(*[F.col(k).alias(f"{k}_") for k in keys]).agg(F.min("hash").alias("least_"))
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"{k}_"))
    return rows.join(least, same).filter(low | (F.col("hash") == F.col("least_"))).select(*keys, "hash")


def containment(inner: Column, outer: Column) -> Column:
    """Estimated share of the shingles of `inner` that `outer` holds; null where `inner` is empty."""
    return F.try_divide(F.size(F.array_intersect(inner, outer)), F.size(F.array_distinct(inner)))


def compare_with_edited(
    docs: DataFrame, shingle: int = SHINGLE, one_in: int = ONE_IN, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, held_by_edited: a row per distinct (id, text).

    A document's edited text has its last third replaced by the beginning of the document that follows in descending order of ids
    (nulls last, texts of one id in order of their hashes; the first follows the last). Likenesses are estimated from the
    fingerprints, which are sketches in hex; held_by_edited is the share of the fingerprint that the edited one holds (null for an empty
    one). A null text counts as empty. Texts of any length are read whole. An empty table gives no rows. Other columns
    are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    doc = F.col(id_col).cast("long")
    # ~id reverses the order of ids without overflow.
    rows = docs.select(
        doc.isNull().cast("int").alias("none"), F.bitwise_not(F.coalesce(doc, F.lit(0).cast("long"))).alias("place"), F.xxhash64(text).alias("hash"), text.alias("text")
    )
    keys = ("none", "place", "hash")
    light = written(rows.groupBy(*keys).agg(F.max(F.octet_length("text")).cast("long").alias("size")), "sketch-order")
    total = light.agg(F.sum(F.col("size") + 64)).first()[0]
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, held_by_edited double"
    )
    if total is None:
        return docs.sparkSession.createDataFrame([], schema)
    slices = max(-(-total // LARGE_SLICE), min(FEW, -(-total // SLICE)))
    # As many keys as slices, like the bounds that Spark's own range partitioning keeps.
    cut = light.repartitionByRange(slices, *keys).groupBy(F.spark_partition_id()).agg(F.min(F.struct(*keys)).alias("first"))
    firsts = sorted(tuple(r["first"]) for r in cut.collect())

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in batches:
            take, at, tail = [], [], []
            for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in keys), strict=True)):
                if key in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(key)
                k = bisect_right(firsts, key) - 1
                take.append(i)
                at.append(k)
                tail.append(False)
                if firsts[k] == key:
                    take.append(i)
                    at.append((k or len(firsts)) - 1)
                    tail.append(True)
            columns = [c.take(pa.array(take, pa.int64())) for c in batch.columns]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(tail, pa.bool_()), *columns], ["slice", "tail", *keys, "text"])

    dealt = rows.mapInArrow(deal, "slice int, tail boolean, none int, place long, hash long, text string")
    dealt = dealt.repartition(len(firsts), "slice").sortWithinPartitions("slice", "tail", *keys)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row with the next one of its slice."""
        before = None
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("slice", "tail", *keys))
            for *key, text in zip(*columns, batch.column("text"), strict=True):
                if before and before[0] == key:
                    continue
                now = (key, text.as_py())
                now += (sketch(now[1], shingle, one_in),)
                if before and before[0][0] == key[0] and not before[0][1]:
                    out.append(compared(before, now))
                before = now
            yield pa.RecordBatch.from_pylist(out, arrow)

    def compared(now: tuple, following: tuple) -> dict:
        (_, _, none, place, _), text, own = now
        third = len(text) // 3
        edited = text[: len(text) - third] + following[1][:third]
        changed = sketch(edited, shingle, one_in)
        return {
            "doc_id": None if none else ~place,
            "n_chars": len(text),
            "edited_sha256": sha256(edited.encode()).hexdigest(),
            "fingerprint": hexed(own),
            "edited_fingerprint": hexed(changed),
            "near_edited": likeness(own, changed),
            "near_next": likeness(own, following[2]),
            "held_by_edited": len(set(own) & set(changed)) / len(own) if own else None,
        }

    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    arrow = pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in schema.split(", "))])
    return dealt.mapInArrow(follow, schema)


def op12_document_fingerprints(spark, folder: str) -> DataFrame:
    return compare_with_edited(table(spark, folder, "documents"))


def _sketch_sql(text: str) -> str:
    """A list of hex hashes from an SQL text, by the rule of `sketch`."""
    words = rf"list_filter(string_split_regex(translate({text}, '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
    shingles = (
        f"list_transform([{words}], lambda w: CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')] "
        f"ELSE list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' ')) END)[1]"
    )
    hashes = f"list_sort(list_distinct(list_transform({shingles}, lambda s: format('{{:016x}}', md5_number_lower(s)))))"
    low = f"list_filter(h, lambda x: x < '{(1 << 64) // ONE_IN:016x}')"
    return f"list_transform([{hashes}], lambda h: CASE WHEN len({low}) > 0 THEN {low} ELSE h[1:1] END)[1]"


def _likeness_sql(a: str, b: str) -> str:
    common = f"len(list_intersect({a}, {b}))"
    return f"CASE WHEN len({a}) + len({b}) = 0 THEN 1.0::DOUBLE ELSE {common} / (len({a}) + len({b}) - {common})::DOUBLE END"


_SQL = f"""
WITH docs AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
followed AS (
  SELECT doc_id, text, coalesce(lead(text) OVER w, first_value(text) OVER w) AS following FROM docs WINDOW w AS (ORDER BY doc_id DESC)
),
edits AS (
  SELECT doc_id, text, left(text, length(text) - length(text) // 3) || left(following, length(text) // 3) AS edited FROM followed
),
owned AS (SELECT doc_id, text, edited, {_sketch_sql("text")} AS own, {_sketch_sql("edited")} AS changed FROM edits),
sketched AS (
  SELECT *, coalesce(lead(own) OVER w, first_value(own) OVER w) AS next FROM owned WINDOW w AS (ORDER BY doc_id DESC)
)
SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256,
  array_to_string(own, '') AS fingerprint, array_to_string(changed, '') AS edited_fingerprint,
  {_likeness_sql("own", "changed")} AS near_edited, {_likeness_sql("own", "next")} AS near_next,
  CASE WHEN len(own) > 0 THEN len(list_intersect(own, changed)) / len(own)::DOUBLE END AS held_by_edited
FROM sketched
"""

QUERIES = {"op12_document_fingerprints": op12_document_fingerprints}
ORACLE = {"op12_document_fingerprints": _SQL}
