"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation estimates how far each can be
trusted, and the posterior probability of good quality replaces all-must-pass filtering.

Measures are column expressions, so texts never leave the JVM. The model needs only the counts of the vote patterns,
a table of at most 3 ** (number of rules) rows whatever the corpus; its weights go back into a column expression.
"""

from __future__ import annotations

from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfstar.llm.common import table, words_of, written

WINDOW = 5
BAD, GOOD, ABSTAIN = 0, 1, 2
#: Characters counted as symbols.
SYMBOLS = r"[#*$%&|<>]"
#: Rule: (measure, bad when, good when); a measure of null abstains, as does what lies between.
RULES = {
    "length": ("n_words", lambda m: m < 20, lambda m: m >= 50),
    "word_length": ("mean_word", lambda m: (m < 2.0) | (m > 14.0), lambda m: (m >= 3.0) & (m <= 10.0)),
    "symbols": ("symbol_share", lambda m: m > 0.25, lambda m: m <= 0.10),
    "letters": ("letter_share", lambda m: m < 0.80, lambda m: m >= 0.95),
    "shouting": ("upper_share", lambda m: m > 0.30, lambda m: m <= 0.12),
    "exclaiming": ("mark_share", lambda m: m > 0.15, lambda m: m <= 0.03),
    "short_words": ("short_share", lambda m: m < 0.05, lambda m: m >= 0.12),
    "sentences": ("stop_share", lambda m: m < 0.003, lambda m: m >= 0.03),
    "dup_lines": ("dup_line_share", lambda m: m > 0.40, lambda m: m <= 0.10),
    "repeats": ("repeat_share", lambda m: m > 0.20, lambda m: m <= 0.05),
}
#: Start of the estimate: the probability of good quality falls by this factor with each vote against it.
PER_BAD_VOTE = 0.3
#: Share of good documents, and of votes for and against, assumed where there are no rows.
PRIOR, NO_ROWS = 0.8, ([0.4, 0.3, 0.3], [0.05, 0.65, 0.3])
ROUNDS, SMOOTH = 60, 0.5


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with one struct column `q_`: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the shares
    the rules look at. Whole texts; null counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.withColumn("w_", words_of(text)).withColumn("n_", F.size("w_"))
    hashes = F.transform(
        F.sequence(F.lit(0), F.col("n_") - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col("w_"), i + k) for k in range(WINDOW)]),
    )
    d = d.withColumn("h_", F.when(F.col("n_") >= WINDOW, hashes))
    d = d.withColumn("again_", F.size(F.array_distinct("h_")) < F.size("h_"))
    # Windows that share a hash stand side by side once sorted; only texts with repeats get here.
    tagged = F.sort_array(F.transform("h_", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("s_", F.when(F.col("again_"), tagged))
    twice = F.filter(
        "s_",
        lambda x, j: F.coalesce(F.get(F.col("s_"), j - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(F.col("s_"), j + 1)["h"] == x["h"], F.lit(False)),
    )
    d = d.withColumn("at_", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("at_", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("at_"), k + 1) - p, F.lit(WINDOW)))),
        F.lit(0),
        lambda a, x: a + x,
    )
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    d = d.withColumn("l_", lines)
    n, chars = F.col("n_"), F.char_length(F.array_join("w_", ""))
    d = d.withColumn("c_", chars)
    symbols = F.regexp_count(text, F.lit(SYMBOLS))
    d = d.withColumn("y_", symbols).withColumn("r_", F.when(F.col("again_"), covered).otherwise(0))
    d = d.withColumn("u_", F.size("l_") - F.size(F.array_distinct("l_")))
    share = lambda x: F.when(n > 0, x / n)
    return d.withColumn(
        "q_",
        F.struct(
            n.cast("long").alias("n_words"),
            F.col("c_").cast("long").alias("word_chars"),
            F.col("y_").cast("long").alias("n_symbols"),
            F.col("u_").cast("long").alias("n_dup_lines"),
            F.col("r_").cast("long").alias("n_repeat_words"),
            share(F.col("c_")).alias("mean_word"),
            share(F.col("y_")).alias("symbol_share"),
            F.when(F.col("c_") > 0, F.regexp_count(text, F.lit(r"\p{Lu}")) / F.col("c_")).alias("upper_share"),
            share(F.regexp_count(text, F.lit("!"))).alias("mark_share"),
            F.when(n >= 20, F.size(F.filter("w_", lambda w: F.char_length(w) <= 3)) / n).alias("short_share"),
            share(F.size(F.filter("w_", lambda w: w.rlike(r"[.!?]$")))).alias("stop_share"),
            share(F.size(F.filter("w_", lambda w: w.rlike(r"\p{L}")))).alias("letter_share"),
            F.when(F.size("l_") > 0, F.col("u_") / F.size("l_")).alias("dup_line_share"),
            share(F.col("r_")).alias("repeat_share"),
        ),
    ).select(*docs.columns, "q_")


def base_failed(q: Column) -> Column:
    return (q["n_words"] < 10) | (100 * q["n_repeat_words"] > 20 * q["n_words"])


def vote(q: Column, rule: str) -> Column:
    measure, bad, good = RULES[rule]
    m = q[measure]
    return F.when(m.isNull(), ABSTAIN).when(bad(m), BAD).when(good(m), GOOD).otherwise(ABSTAIN)


def fit(votes: DataFrame, rules: tuple[str, ...] = tuple(RULES)) -> tuple[float, dict[str, list[list[float]]]]:
    """(share of good documents, rule -> [P(vote | bad), P(vote | good)]) from a table with a column per rule.

    Rows are counted per pattern of votes first; there are at most 3 ** (number of rules) patterns. Without rows
    the assumed values come back.
    """
    counts = votes.groupBy(*rules).agg(F.count(F.lit(1)).alias("n_"))
    patterns = sorted(tuple(r) for r in counts.collect())
    total = sum(p[-1] for p in patterns)
    share, model = PRIOR, {r: NO_ROWS for r in rules}
    good = [PER_BAD_VOTE ** p[:-1].count(BAD) for p in patterns]
    for _ in range(ROUNDS if total else 0):
        sums = {r: [[SMOOTH] * 3, [SMOOTH] * 3] for r in rules}
        for p, (*pattern, n) in zip(good, patterns, strict=True):
            for r, v in zip(rules, pattern, strict=True):
                sums[r][GOOD][v] += p * n
                sums[r][BAD][v] += (1 - p) * n
        share = min(0.99, max(0.01, sum(p * row[-1] for p, row in zip(good, patterns, strict=True)) / total))
        model = {r: [[x / sum(row) for x in row] for row in sums[r]] for r in rules}
        good = [posterior(share, model, list(row[:-1]), rules) for row in patterns]
    return share, model


def weight(model: dict, rule: str, v: int) -> float:
    """What a vote adds to the log-odds of good quality. Abstaining says nothing, and a vote never counts for the
    other side: a rule found to be no better than chance has no weight."""
    if v == ABSTAIN:
        return 0.0
    bad, good = model[rule]
    odds = log(good[v] / (good[0] + good[1])) - log(bad[v] / (bad[0] + bad[1]))
    return max(0.0, odds) if v == GOOD else min(0.0, odds)


def posterior(share: float, model: dict, pattern: list[int], rules: tuple[str, ...]) -> float:
    odds = log(share / (1 - share)) + sum(weight(model, r, v) for r, v in zip(rules, pattern, strict=True))
    return 1 / (1 + exp(-max(-500.0, min(500.0, odds))))


def log_odds(share: float, model: dict, votes: dict[str, Column]) -> Column:
    total = F.lit(log(share / (1 - share)))
    for rule, v in votes.items():
        total = total + F.when(v == BAD, weight(model, rule, BAD)).when(v == GOOD, weight(model, rule, GOOD)).otherwise(0.0)
    return total


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    p_good, kept.

    Null texts count as empty, have no words and fail. Rows with a null id and repeated rows are judged like any
    other. An empty table gives no rows. Other columns are not looked at.
    """
    base = measures(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    # The measures are a few numbers a text; both the fit and the verdict read them from the shared folder.
    q = written(base.select("doc_id", "q_", *[vote(F.col("q_"), r).alias(r) for r in RULES]), "quality")
    share, model = fit(q)
    p = 1 / (1 + F.exp(-log_odds(share, model, {r: F.col(r) for r in RULES})))
    failed = base_failed(F.col("q_"))
    return q.select(
        "doc_id",
        *[f"q_.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"),
        p.alias("p_good"),
        (~failed & (p >= threshold)).alias("kept"),
    )


def keep_good(docs: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` that pass, with all their columns. Texts are measured once and written with their votes; the model is
    fitted on the votes and the verdict read from them, row by row: null ids and repeated rows need no key, and columns of
    any name stay apart from the measures."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text_col].alias("text"))
    judged = measures(rows).select("row", base_failed(F.col("q_")).alias("failed"), *[vote(F.col("q_"), r).alias(r) for r in RULES])
    judged = written(judged, "judged")
    odds = log_odds(*fit(judged.select(*RULES)), {r: F.col(r) for r in RULES})
    return judged.filter(~F.col("failed") & (odds >= log(threshold / (1 - threshold)))).select("row.*")


def op9_quality_rules(spark, folder: str) -> DataFrame:
    return judge_quality(table(spark, folder, "documents"))


QUERIES = {"op9_quality_rules": op9_quality_rules}
ORACLE: dict[str, str] = {}
