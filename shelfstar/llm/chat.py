"""Chat formatting of logged conversations, with cumulative snapshots collapsed.

A chat log often holds the same conversation several times, each snapshot with more turns. The hash of the first k
turns is the exclusive-or of hashes of (position, role, text); it rolls along the turns and, being associative, is
put together from blocks of turns, so that a very long conversation is spread over tasks. A conversation whose
hash equals the hash of a longer one's beginning is dropped by an anti-join; of equal conversations the one with
the smallest id stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfstar.llm.common import table, written

#: Turns of a conversation that one task holds together, and that one rendered row holds.
BLOCK = 1024


def turns_with_prefix(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv, turn, role, text, pos (from 1), h1 and h2 (hashes of the turns up to here). Rows repeated in all four
    columns count once."""
    t = turns.select(
        F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), F.col("role"), F.col("text")
    ).withColumn("block", F.floor(F.coalesce(F.col("turn"), F.lit(2**62)) / block))
    within = Window.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    same = F.lit(True)
    for c in ("turn", "role", "text"):
        same = same & F.lag(c).over(within).eqNullSafe(F.col(c))
    t = t.withColumn("fresh", (F.row_number().over(within) == 1) | ~same).filter("fresh")
    t = t.withColumn("own", F.row_number().over(within))
    counts = t.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    t = _same_block(t, base).withColumn("pos", (F.col("base") + F.col("own")).cast("long"))
    for name, salt in (("h1", 1), ("h2", 2)):
        one = F.xxhash64(F.lit(salt), "pos", F.coalesce("role", F.lit("")), F.col("role").isNull(), F.coalesce("text", F.lit("")), F.col("text").isNull())
        t = t.withColumn(name, F.bit_xor(one).over(within.rowsBetween(Window.unboundedPreceding, 0)))
    whole = t.groupBy("conv", "block").agg(*[F.max_by(h, "own").alias(f"{h}_all") for h in ("h1", "h2")])
    carried = whole.select(
        "conv", "block", *[F.coalesce(F.bit_xor(f"{h}_all").over(before), F.lit(0)).alias(f"{h}_before") for h in ("h1", "h2")]
    )
    t = _same_block(t, carried)
    for h in ("h1", "h2"):
        t = t.withColumn(h, F.col(h).bitwiseXOR(F.col(f"{h}_before")))
    return t.select("conv", "turn", "role", "text", "pos", "h1", "h2")


def _same_block(t: DataFrame, other: DataFrame) -> DataFrame:
    other = other.withColumnsRenamed({"conv": "conv_", "block": "block_"})
    on = t["conv"].eqNullSafe(other["conv_"]) & (t["block"] == other["block_"])
    return t.join(other, on).drop("conv_", "block_")


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """conv, n (turns), copies (ids with the same turns): conversations that no longer one begins with."""
    finals = prefixes.groupBy("conv").agg(
        F.max("pos").alias("n"), F.max_by("h1", "pos").alias("h1"), F.max_by("h2", "pos").alias("h2")
    )
    distinct = finals.groupBy("n", "h1", "h2").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("copies"))
    ends = finals.select(F.col("conv").alias("conv_"), F.col("n").alias("last"))
    begun = (
        prefixes.join(ends, prefixes["conv"].eqNullSafe(ends["conv_"]))
        .filter(F.col("pos") < F.col("last"))
        .select(F.col("pos").alias("n"), "h1", "h2")
        .distinct()
    )
    return distinct.join(begun, ["n", "h1", "h2"], "left_anti").select("conv", "n", "copies")


def rendered(role: Column, text: Column) -> Column:
    """One turn in the template; a null role is `user`, a null text is empty."""
    return F.concat(
        F.lit("<|"), F.coalesce(role, F.lit("user")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("<|end|>\n")
    )


def format_chats(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, part, n_turns, copies, text: each maximal conversation rendered, in parts of at most `block` turns.

    Turns order by number (null last), role and text. Rows repeated in all columns are one turn. Rows without a
    conv_id are one conversation with a null id. Null roles and texts differ from empty ones when conversations
    are compared. An empty table gives no rows. Other columns are not looked at.
    """
    prefixes = written(turns_with_prefix(turns, block), "chat-prefixes")
    kept = maximal_conversations(prefixes).withColumnRenamed("conv", "conv_")
    rows = prefixes.join(kept, prefixes["conv"].eqNullSafe(kept["conv_"]))
    part = F.floor((F.col("pos") - 1) / block).cast("int")
    piece = F.struct("pos", rendered(F.col("role"), F.col("text")).alias("said"))
    return (
        rows.groupBy(F.col("conv").alias("conv_id"), part.alias("part"), F.col("n").alias("n_turns"), "copies")
        .agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
        .select("conv_id", "part", "n_turns", "copies", F.array_join(F.transform("pieces", lambda p: p["said"]), "").alias("text"))
    )


def op3_chat_formatting(spark, folder: str) -> DataFrame:
    return format_chats(table(spark, folder, "conversations"))


ORACLE_OP3 = f"""
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS pos,
         '<|' || coalesce(role, 'user') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS said
  FROM turns),
prefixes AS (
  SELECT *, string_agg(coalesce(role, '?') || chr(1) || coalesce(text, '?') || chr(2), '')
              OVER (PARTITION BY conv_id ORDER BY pos) AS upto FROM numbered),
finals AS (SELECT conv_id, max(pos) AS n, arg_max(upto, pos) AS whole FROM prefixes GROUP BY conv_id),
single AS (SELECT min(conv_id) AS conv_id, n, whole, count(*) AS copies FROM finals GROUP BY n, whole),
begun AS (SELECT DISTINCT p.pos AS n, p.upto AS whole FROM prefixes p JOIN finals f USING (conv_id) WHERE p.pos < f.n),
kept AS (SELECT s.* FROM single s ANTI JOIN begun b ON s.n = b.n AND s.whole = b.whole)
SELECT k.conv_id, CAST((p.pos - 1) // {BLOCK} AS INTEGER) AS part, k.n AS n_turns, k.copies,
       string_agg(p.said, '' ORDER BY p.pos) AS text
FROM kept k JOIN numbered p USING (conv_id) GROUP BY ALL
"""

QUERIES = {"op3_chat_formatting": op3_chat_formatting}
ORACLE = {"op3_chat_formatting": ORACLE_OP3}
