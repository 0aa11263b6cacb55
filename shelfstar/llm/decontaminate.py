"""Benchmark decontamination with SimHash windows of the size of the benchmark items.

A window of the item's size whose similarity reaches the threshold has at least a certain number of places whose shingle is one of
the item's. Every window with as many such places, counted over all items of that size, gets a SimHash, and no other needs one. Item fingerprints are indexed by Hamming blocks: fingerprints at most
`RADIUS` bits apart agree in one of `RADIUS` + 1 blocks at least. Candidates are verified by exact similarity of
shingle multisets, the sum of the smaller counts over the sum of the larger ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfstar.llm.common import table, written

SHINGLE, SIMILARITY = 5, 0.8
#: Two windows of similarity 0.8 differ in about ten of 64 bits.
RADIUS = 20
#: Shingles of the benchmark are broadcast up to this many bytes, else joined by shuffle.
BROADCAST_BYTES = 32 << 20


def _words(text: Column) -> Column:
    """Runs of letters and digits, lower-cased."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def _hash(words: Column, at: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(words, at + j) for j in range(k)])


def _shingles(words: Column, k: int) -> Column:
    """Hashes of all k-word shingles; `words` has at least k."""
    return F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: _hash(words, i, k))


def simhash(shingles: Column) -> Column:
    """64 bits, each set where it is set in over half the shingles."""
    bit = lambda b: F.call_function("shiftleft", F.lit(1).cast("long"), b)
    return F.aggregate(
        F.transform(
            F.sequence(F.lit(0), F.lit(63)),
            lambda b: F.when(
                2 * F.size(F.filter(shingles, lambda h: h.bitwiseAND(bit(b)) != 0)) > F.size(shingles), bit(b)
            ).otherwise(F.lit(0).cast("long")),
        ),
        F.lit(0).cast("long"),
        lambda a, x: a.bitwiseOR(x),
    )


def _block(fingerprint: Column, k: Column, radius: int) -> Column:
    """Block k of radius + 1 near equal blocks, which cover the 64 bits once."""
    low, high = ((F.call_function("div", (k + i) * 64, F.lit(radius + 1))).cast("int") for i in (0, 1))
    mask = F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), F.lit(64) - (high - low))
    return F.call_function("shiftright", fingerprint, low).bitwiseAND(mask)


def similarity(a: Column, b: Column) -> Column:
    """Sum of the smaller over sum of the larger counts of the shingles of both."""
    count = lambda s, x: F.size(F.filter(s, lambda y: y == x))
    plain = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    shared = F.array_intersect(a, b)
    common = F.when(plain, F.size(shared)).otherwise(F.aggregate(shared, F.lit(0), lambda s, x: s + F.least(count(a, x), count(b, x))))
    return common / (F.size(a) + F.size(b) - common)


def _small(rows: DataFrame, size: int) -> DataFrame:
    """`rows`, broadcast where they are few at `size` bytes each."""
    return F.broadcast(rows) if rows.count() * size <= BROADCAST_BYTES else rows


def _starts(at: Column, n: Column, m: Column, k: Column, threshold: float) -> Column:
    """Starts of all windows of `m` words that may reach the threshold, in order. `at`: the places, in order, of the shingles of a text
    of `n` words that an item has.

    Of windows with N shingles, items with M and C in common, C / (N + M - C) reaches t only if C reaches t (N + M) / (1 + t).
    A window holds as many places if C of them that follow each other fit in; those whose first place is at[i] start after at[i - 1].
    """
    size = F.least(n, m) - k + 1
    least = F.greatest(F.lit(1), F.ceil((size + m - k + 1) * (threshold / (1 + threshold)) - 1e-9).cast("int"))

    def of(i: Column) -> Column:
        low = F.greatest(F.get(at, i + least - 1) - size + 1, F.coalesce(F.get(at, i - 1) + 1, F.lit(0)), F.lit(0))
        high = F.least(F.get(at, i), F.greatest(F.lit(0), n - m))
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    firsts = F.when(F.size(at) >= least, F.sequence(F.lit(0), F.size(at) - least)).otherwise(F.array().cast("array<int>"))
    return F.flatten(F.transform(firsts, of))


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = SIMILARITY,
    radius: int = RADIUS,
) -> DataFrame:
    """doc_id, text_hash, item_id, start, similarity: per text and item the most similar window, where it reaches the threshold; `start` is its first word.

    Words are runs of letters and digits, lower-cased. An item of fewer than five words is one shingle; one without words
    matches nothing. A text shorter than the item is one window. Of windows equally similar the first counts.
    Texts are told apart by (id, hash of the text): repeated rows are one text, null ids are kept apart by
    their texts. Null and empty texts match nothing. Other columns are not looked at.
    """
    bench = items.select(F.col(item_col).alias("item_id"), _words(F.col(item_text_col)).alias("w"))
    bench = bench.withColumn("m", F.size("w")).filter("m > 0").withColumn("k", F.least(F.lit(SHINGLE), "m"))
    sizes = [r["k"] for r in bench.select("k").distinct().orderBy("k").collect()]  # of 1 to 5
    if not sizes:
        sizes = [SHINGLE]
    shingled = F.coalesce(*[F.when(F.col("k") == k, _shingles(F.col("w"), k)) for k in sizes])
    bench = bench.withColumn("s", shingled).withColumn("f", simhash(F.col("s")))
    bench = written(bench.select("item_id", "m", "k", "s", "f"), "benchmark")

    places = bench.select("m", "k", F.explode("s").alias("h")).distinct()
    places = _small(written(places, "benchmark-shingles"), 32)

    keyed = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"), F.col(text_col).alias("text")
    )
    text = keyed.withColumn("w", _words(F.col("text"))).withColumn("n", F.size("w"))
    shared = None
    for k in sizes:
        at = text.filter(F.col("n") >= k).withColumn("p", F.explode(F.sequence(F.lit(0), F.col("n") - k)))
        at = at.withColumn("h", _hash(F.col("w"), F.col("p"), k)).select("doc_id", "text_hash", "n", "p", "h", F.lit(k).alias("k"))
        shared = at if shared is None else shared.unionByName(at)
    found = (
        shared.join(places, ["k", "h"])
        .groupBy("doc_id", "text_hash", "n", "m", "k")
        .agg(F.array_sort(F.collect_set("p")).alias("at"))
        .withColumn("starts", _starts(F.col("at"), F.col("n"), F.col("m"), F.col("k"), threshold))
        .filter(F.size("starts") > 0)
        .select(F.col("doc_id").alias("id_"), F.col("text_hash").alias("hash_"), "m", "k", "starts")
    )
    found = _small(written(found, "windows"), 64)
    held = keyed.join(found, keyed["doc_id"].eqNullSafe(found["id_"]) & (keyed["text_hash"] == found["hash_"]))
    begin = F.element_at("starts", 1)
    part = F.slice(_words(F.col("text")), begin + 1, F.element_at("starts", -1) - begin + F.col("m"))
    windows = (
        held.groupBy("doc_id", "text_hash", "m", "k", "starts")
        .agg(F.any_value(part).alias("part"))
        .withColumn("at", F.explode(F.transform("starts", lambda s: F.struct(s.alias("start"), F.slice("part", s - begin + 1, F.col("m")).alias("w")))))
        .select("doc_id", "text_hash", "m", "k", "at.start", "at.w")
    )
    own = F.coalesce(*[F.when(F.col("k") == k, _shingles(F.col("w"), k)) for k in sizes])
    windows = windows.withColumn("s", own).withColumn("f", simhash(F.col("s")))

    blocks = F.explode(F.sequence(F.lit(0), F.lit(radius)))
    left = windows.withColumn("b", blocks).withColumn("v", _block(F.col("f"), F.col("b"), radius))
    right = bench.select("item_id", "m", F.col("s").alias("s_"), F.col("f").alias("f_"), blocks.alias("b"))
    right = right.withColumn("v", _block(F.col("f_"), F.col("b"), radius))
    # A pair that agrees in several blocks is taken from the first of them.
    first = F.aggregate(
        F.sequence(F.lit(0), F.lit(radius)),
        F.lit(-1),
        lambda a, b: F.when((a < 0) & (_block(F.col("f"), b, radius) == _block(F.col("f_"), b, radius)), b).otherwise(a),
    )
    near = (
        left.join(right, ["m", "b", "v"])
        .filter(F.bit_count(F.col("f").bitwiseXOR(F.col("f_"))) <= radius)
        .filter(first == F.col("b"))
        .withColumn("similarity", similarity(F.col("s"), F.col("s_")))
        .filter(F.col("similarity") >= threshold)
    )
    best = F.max_by(F.struct("similarity", "start"), F.struct("similarity", -F.col("start"))).alias("best")
    return near.groupBy("doc_id", "text_hash", "item_id").agg(best).select(
        "doc_id", "text_hash", "item_id", "best.start", "best.similarity"
    )


def remove_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that hold no passage of an item, with all their columns."""
    hits = contaminated(docs, items, id_col, text_col).select(F.col("doc_id").alias("id_"), "text_hash").distinct()
    key = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    return docs.join(hits, docs[id_col].eqNullSafe(hits["id_"]) & (key == hits["text_hash"]), "left_anti")


def op7_decontamination(spark, folder: str) -> DataFrame:
    hits = contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return hits.select("doc_id", "item_id", "start", "similarity")


QUERIES = {"op7_decontamination": op7_decontamination}
ORACLE: dict[str, str] = {}
