"""Operators against plain versions over a table, and with long texts and columns named like their own."""

from __future__ import annotations

import xxhash
from pyspark.sql import functions as F

from shelfstar.llm import chat, pii, quality, substrings, urls

FOLDER = "/root/testdata/sf0.001"


def plain_chunks(raw, shortest=20, longest=160, spacing=20):
    """(begin, end) of the chunks, with the gear hash rolled byte by byte."""
    value = [xxhash.xxh32_intdigest(bytes([b]), 7) & 0xFFFF for b in range(256)]
    out, at, h = [], 0, 0
    for k, b in enumerate(raw):
        h = (h << 1) + value[b] & 0xFFFF
        size = k + 1 - at
        if size >= shortest and h < 65536 // spacing or size == longest:
            out.append((at, k + 1))
            at = k + 1
    return [*out, (at, len(raw))] if at < len(raw) else out


def plain_spans(rows):
    """Per id the runs of 64 bytes or more of chunks that a smaller id has, or the text itself before, and the ids that have them first."""
    cut = {i: [(a, b, raw[a:b]) for a, b in plain_chunks(raw)] for i, raw in rows}
    owner = {}
    for i in sorted(cut):
        for _, _, part in cut[i]:
            owner.setdefault(part, i)
    out = {}
    for i, parts in cut.items():
        seen, runs = set(), []
        for a, b, part in parts:
            if owner[part] < i or part in seen:
                if not runs or runs[-1][1] < a:
                    runs.append([a, a, set()])
                runs[-1][1] = b
                runs[-1][2] |= {owner[part]} - {i}
            seen.add(part)
        runs = [r for r in runs if r[1] - r[0] >= 64]
        out[i] = ([(a, b) for a, b, _ in runs], sorted(set().union(*(r[2] for r in runs))))
    return out


def test_substrings_of_the_table(spark):
    got = substrings.op4_substring_dedup(spark, FOLDER).collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want = plain_spans([(r.doc_id, (r.text or "").encode()) for r in docs])
    assert {r.doc_id: ([tuple(s) for s in r.spans], r.first_docs) for r in got} == want
    assert all(r.n_removed == sum(b - a for a, b in want[r.doc_id][0]) and r.n_spans == len(r.spans) for r in got)
    assert sum(map(len, (spans for spans, _ in want.values()))) > 0


def test_substrings_of_long_texts(docs_of):
    """A text of 2 MB without line ends, and one that holds its second half."""
    words = [f"{k * 2654435761 % 2**32:x}" for k in range(220_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[110_000:]))]
    got = {r.doc_id: r for r in substrings.repeated_spans(docs_of(rows)).collect()}
    want = plain_spans([(i, t.encode()) for i, t in rows])
    assert {i: [tuple(s) for s in r.spans] for i, r in got.items()} == {i: spans for i, (spans, _) in want.items()}
    assert got[2].n_removed > 0.99 * got[2].n_bytes


def test_chats_with_long_turns_and_clashing_columns(spark):
    own = {c: F.lit(3) for c in ("conv", "pos", "h1", "h2", "block", "own", "n", "copies", "part", "conv_", "block_", "base", "last")}
    long = "word " * 400_000
    rows = [(1, 0, "user", long), (2, 0, "user", long), (2, 1, "assistant", ""), (3, 0, "user", long + "more"), (3, 0, "user", long + "more")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(map(tuple, chat.format_chats(turns.withColumns(own)).collect()))
    assert got == sorted(map(tuple, chat.format_chats(turns).collect()))
    assert {r[0] for r in got} == {2, 3} and any(long in str(r) for r in got)


def test_urls_with_long_paths_and_clashing_columns(spark):
    own = {c: F.lit("x") for c in ("host", "path", "rule", "verdict", "canonical", "blocked_by")}
    long = "a/" * 500_000
    rows = [(1, f"http://example.org/en/1{long}"), (1, f"http://example.org/en/1{long}"), (2, f"http://www.example.org/{long}?{long}"), (3, ""), (None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = sorted(map(tuple, urls.judge_urls(pages.withColumns(own)).collect()), key=str)
    assert got == sorted(map(tuple, urls.judge_urls(pages).collect()), key=str)
    said = {(r[0], r[3], r[4]) for r in got}
    assert {(1, "example.org/en/1", "block"), (2, "org/", "allow")} <= said
    assert {len(r[2]) for r in got if r[0] == 2} == {len(long) + 1}


def test_quality_stage_keeps_what_the_query_keeps(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = corpus_pipeline.quality_rules(spark, docs, FOLDER).collect()
    want = {r.doc_id for r in quality.judge_quality(docs).filter("kept").collect()}
    assert {r.doc_id for r in kept} == want
    assert sorted(map(str, kept)) == sorted(str(r) for r in docs.collect() if r.doc_id in want)


def test_masking_stage_replaces_the_spans_of_the_query(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    spans = {r.doc_id: r.spans for r in pii.op6_pii(spark, FOLDER).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    hidden = 0
    for r in corpus_pipeline.personal_data(spark, docs, FOLDER).collect():
        text = texts[r.doc_id]
        left, at = "", 0
        parts = [s.split(":") for s in (spans[r.doc_id] or "").split(",") if s]
        for a, b, kind in sorted((int(a), int(b), k) for k, a, b in parts):
            if a >= at:
                left += text[at:a] + f"<{kind.upper()}>"
                hidden += 1
            at = max(at, b)
        assert r.text == (None if text is None else left + text[at:])
        assert r.n_chars == (None if text is None else len(r.text))
    assert hidden > 0
