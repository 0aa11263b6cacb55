"""Operators on rows of documents, pages and turns against brute-force versions, and on odd input."""

from __future__ import annotations

import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shelfstar.llm import chat, pieces, pii, quality, sharding, urls
from shelfstar.llm.catalog import all_oracles, all_queries
from tests.oracle_check import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query_equals_sql(spark, name):
    got = all_queries()[name](spark, FOLDER).toArrow()
    assert got.num_rows > 0
    assert difference(got, connect(FOLDER).execute(all_oracles()[name]).to_arrow_table()) is None


def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def test_shards(spark, docs_of, odd):
    got = sharding.op2_sharding(spark, FOLDER).collect()
    by_id = texts(spark)
    assert len(got) == len(by_id)
    assert all(r.size == len(by_id[r.doc_id].encode()) + 1 for r in got)
    assert all(r.text_crc32 == zlib.crc32(by_id[r.doc_id].encode()) for r in got)
    for s in range(16):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    shard_of = {}
    for r in got:
        assert shard_of.setdefault(by_id[r.doc_id], r.shard) == r.shard
    rows = sharding.shard_documents(docs_of(odd), 3).collect()
    assert len(rows) == len(odd) and {r.shard for r in rows} <= {0, 1, 2}
    assert sharding.shard_documents(docs_of([]), 3).count() == 0


def least_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, used, fill = (low + high) // 2, 1, 0
        for s in sizes:
            used, fill = (used + 1, s) if fill + s > mid else (used, fill + s)
        low, high = (low, mid) if used <= shards else (mid + 1, high)
    return low


@pytest.mark.parametrize("seed", range(4))
def test_smallest_capacity(seed):
    rng = random.Random(seed)
    sizes = [rng.choice((1, 5, 50, 5000)) * rng.randint(1, 9) for _ in range(400)]
    ends = [sum(sizes[: k + 1]) for k in range(len(sizes))]

    def fetch(bits, within):
        cells = {}
        for e in ends:
            if within is None or (e - 1) >> within[0] in within[1]:
                cells.setdefault((e - 1) >> bits, []).append(e)
        return sorted((min(c), max(c)) for c in cells.values())

    old = sharding.CELLS
    sharding.CELLS = 64
    try:
        for shards in (2, 7, 16):
            assert sharding.smallest_capacity(fetch, ends[-1], shards) == least_capacity(sizes, shards)
    finally:
        sharding.CELLS = old


def test_snapshots_collapse(spark):
    a = [("user", "hi"), ("assistant", "yes"), ("user", None)]
    rows = [(1, k, r, t) for k, (r, t) in enumerate(a[:2])] + [(2, k, r, t) for k, (r, t) in enumerate(a)]
    rows += [(3, k, r, t) for k, (r, t) in enumerate(a)] + [(4, 0, "user", "ho"), (None, None, None, None), (2, 0, "user", "hi")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for block in (1024, 2):
        got = chat.format_chats(df, block).collect()
        whole = {}
        for r in sorted(got, key=lambda r: (str(r.conv_id), r.part)):
            whole[r.conv_id] = whole.get(r.conv_id, "") + r.text
            assert r.copies == (2 if r.conv_id == 2 else 1)
        assert set(whole) == {None, 2, 4}
        assert whole[2] == "<|user|>\nhi<|end|>\n<|assistant|>\nyes<|end|>\n<|user|>\n<|end|>\n"
    assert chat.format_chats(df.limit(0)).count() == 0


@pytest.mark.parametrize("copies", [1, 12])
def test_automaton_matches_like_patterns(copies):
    globs = ["*.a.org/**", "a.org/**", "**.exe", "x?z", "*spam**", ""] * copies
    seen = ["a.org/", "b.a.org/x", "b.com/.a.org/x", "q.exe", "xyz", "x/z", "myspam.net/q", "", "é.a.org/é", "a" * 500 + "spam"]

    def regex(g):
        return re.compile(re.sub(r"\*\*|\*|\?|.", lambda m: {"**": "(?s:.*)", "*": "[^/]*", "?": "[^/]"}.get(m[0], re.escape(m[0])), g))

    found = urls.Automaton(globs).matches(pa.array([*seen, None]))
    assert found.tolist() == [[bool(regex(g).fullmatch(u)) for g in globs] for u in [*seen, ""]]


def test_urls_without_host(spark):
    df = spark.createDataFrame([(1, None), (2, "no"), (None, "HTTP://Example.ORG/en/1?x"), (3, "a://b"), (3, "a://b")], "page_id long, url string")
    got = sorted(urls.judge_urls(df).collect(), key=str)
    assert Counter((r.host, r.path, r.rule, r.verdict) for r in got) == Counter(
        {("", "", None, "allow"): 2, ("example.org", "/en/1", "example.org/en/1", "block"): 1, ("b", "", None, "allow"): 2}
    )
    assert urls.judge_urls(df.limit(0)).count() == 0


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    seen, held = Counter(windows), set()
    for k, w in enumerate(windows):
        if seen[w] > 1:
            held |= set(range(k, k + 5))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(held))


def test_quality(spark, docs_of, odd):
    got = {r.doc_id: r for r in quality.op9_quality_rules(spark, FOLDER).collect()}
    for i, t in texts(spark).items():
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_counts(t)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    good = [got[i].kept for i, q in labels.items() if q == 1]
    bad = [got[i].kept for i, q in labels.items() if q == 0]
    assert sum(good) >= 0.9 * len(good) and sum(bad) <= 0.2 * len(bad)
    docs = docs_of(odd)
    assert not any(r.kept for r in quality.judge_quality(docs).collect())
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.keep_good(docs_of([])).count() == 0 and quality.judge_quality(docs_of([])).count() == 0


def base_spans(text):
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    out = [(m.start(), 0, m.end()) for m in email.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in pii.IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in pii.CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in pii.PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [(a, pii.KINDS[k], b) for a, k, b in sorted(out)]


def test_base_spans_on_random_texts():
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice("a1.@-+ 4)(") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == base_spans(text)


def test_field_adds_and_keeps(spark, docs_of, odd):
    got = {r.doc_id: r for r in pii.op6_pii(spark, FOLDER).collect()}
    for i, t in texts(spark).items():
        assert set(pii.said(base_spans(t)).split(",")) <= set(got[i].spans.split(","))
    rng = random.Random(2)
    sample = [f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}" for _ in range(60)]
    sample += [f"{rng.choice('abc')}{k}@x{k}.org" for k in range(60)] + [str(rng.randint(1, 10**6)) for _ in range(60)]
    field = pii.fit(sample)
    held_out = [f"+1 ({rng.randint(200, 999)}) 556-{rng.randint(1000, 9999)}" for _ in range(40)]
    assert sum(field.decode(x) == [(0, "phone", len(x))] for x in held_out) >= 36
    assert field.decode("1999") == []
    assert [r.spans for r in pii.detect(docs_of(odd), field).collect()] == [""] * len(odd)
    masked = pii.mask(docs_of([(1, "mail joe@x.org now"), (2, None)]))
    assert [r.text for r in masked.collect()] == ["mail <EMAIL> now", None]
    assert pii.mask(docs_of([])).count() == 0


@pytest.fixture(scope="module")
def own_field(spark):
    """Fitted as the query fits it, on the larger table."""
    return pii.fit(pii.sample_of(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")))


def test_added_spans_are_numbers_of_their_kind(spark, own_field):
    added = []
    for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").collect():
        t = r.text or ""
        base, every = pii.find_spans(t, own_field)
        assert set(base) <= set(every)
        added += [(k, t[a:b], t[max(0, a - 9) : a]) for a, k, b in every if (a, k, b) not in base]
    digits = [len(re.sub("[^0-9]", "", s)) for _, s, _ in added]
    assert all(n >= 10 or "@" in s or k == "ip" for n, (k, s, _) in zip(digits, added, strict=True))
    assert not any("version" in before for _, _, before in added)


def test_tables_and_dates_are_no_personal_data(own_field):
    rng = random.Random(4)
    for text in (
        "due 2024 12 31 and 1999 2000",
        "version 3.0 of 2.0. and 4.",
        " ".join(str(rng.randint(0, 10**6)) for _ in range(4000)),
        "\n".join(" ".join(f"{rng.random():.3f}" for _ in range(6)) for _ in range(300)),
    ):
        assert [s for s in pii.find_spans(text, own_field)[1] if s not in pii.base_spans(text)] == []


def test_cards_side_by_side_are_found(own_field):
    text = "pay 4111 1111 1111 1111 4012 8888 8888 1881 now"
    assert pii.base_spans(text) == []
    found = pii.find_spans(text, own_field)[1]
    assert found in ([], [(4, "card", 23), (24, "card", 43)])


def test_long_runs_and_words_are_read_whole():
    """Cards in a run of more digits than four have, and words of more than a hundred characters beside an `@`."""
    numbers = " ".join(["4111 1111 1111 1111"] * 80)
    assert pii.base_spans(numbers) == [] and pii.islands(numbers) == [(0, len(numbers), True)]
    weights, follow = np.zeros((pii.N_FEATURES, pii.OTHER + 1)), np.zeros((pii.OTHER + 1, pii.OTHER + 1))
    weights[0, : pii.OTHER], weights[13, pii.KINDS.index("card")] = -4.0, 9.0
    cards = pii.Field(weights, follow)
    assert pii.find_spans(numbers, cards)[1] == [(20 * k, "card", 20 * k + 19) for k in range(80)]
    assert pii.find_spans(f"{numbers} 77", cards)[1] == pii.find_spans(f"77 {numbers}", cards)[1] == []
    for text in ("x" * 150 + "@" + "y" * 150 + ".org", "x" * 150 + " @ " + "y" * 150 + ".org"):
        assert pii.islands(text) == [(0, len(text), False)]
    assert pii.islands("a." * 80 + "@b.org") == [(60, 166, False)]


def test_lists_of_phones_are_found_whatever_their_length():
    """Phones of digits only side by side, seven and seventy; numbers that are not written alike are none in a long run."""
    weights, follow = np.zeros((pii.N_FEATURES, pii.OTHER + 1)), np.zeros((pii.OTHER + 1, pii.OTHER + 1))
    weights[0, : pii.OTHER], weights[11, pii.KINDS.index("phone")] = -4.0, 9.0
    phones = pii.Field(weights, follow)
    for n in (7, 8, 70, 700):
        text = " ".join(f"{2000000000 + 7919 * k}" for k in range(n))
        assert pii.base_spans(text) == []
        assert pii.find_spans(text, phones)[1] == [(11 * k, "phone", 11 * k + 10) for k in range(n)]
        assert pii.find_spans(f"{text} 77", phones)[1] == []
    mixed = " ".join(f"{2000000000 + k}" if k % 2 else f"{20000 + k} {30000 + k}" for k in range(40))
    assert pii.find_spans(mixed, phones)[1] == []


def test_tables_of_numbers_of_one_length_hold_no_phones(own_field):
    for text in (" ".join(str(1990 + k % 30) for k in range(900)), " ".join(str(349523 + 7919 * k % 600000) for k in range(900))):
        assert pii.find_spans(text, own_field)[1] == pii.base_spans(text)


def test_very_long_texts_are_read_in_time(own_field):
    rng = random.Random(8)
    numbers = " ".join(str(rng.randint(0, 10**6)) for _ in range(500_000))
    mails = " ".join(f"a{k}@b" for k in range(200_000))
    hexes = " ".join(f"{rng.getrandbits(64):x}" for _ in range(150_000))
    for text in (numbers, mails, hexes, "@" * 200_000):
        start = time.perf_counter()
        pii.find_spans(text, own_field)
        assert time.perf_counter() - start < 60


def every_segmentation(island, field):
    """The greatest score over all segmentations, by trying them all."""
    at, spans = pii.candidates(island)
    best = (-1e300, None)

    def walk(i, y, score, out):
        nonlocal best
        if i == len(at) - 1:
            best = max(best, (score, tuple(out)), key=lambda s: s[0])
            return
        for (a, b), (held, kinds) in spans.items():
            if a == i:
                for z in range(pii.OTHER + 1):
                    if (z == pii.OTHER and b - a == 1) or (z < pii.OTHER and kinds[z]):
                        step = field.follow[y, z] + sum(field.weights[f][z] for f in held)
                        walk(b, z, score + step, out if z == pii.OTHER else [*out, (at[a], pii.KINDS[z], at[b])])

    walk(0, pii.OTHER, 0.0, [])
    return list(best[1])


def test_decoder_finds_the_best_segmentation(own_field):
    for island in ("+1 555 123 4567", "a@b.org", "1.2.3.4", "4111-1111-1111-1111", "x@y 12", "1234567890", "(555) 123-4567"):
        assert own_field.decode(island) == every_segmentation(island, own_field)


def test_windows_find_what_one_pass_finds(own_field, monkeypatch):
    text = " ".join(f"joe{k}@host{k}.org {k}@ 4111 1111 1111 1111" for k in range(12)).replace(" 4", "@4")
    whole = own_field.decode(text)
    monkeypatch.setattr(pii, "WINDOW", 64)
    assert own_field.decode(text) == whole


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.read(pieces.MODEL)


def every_way(word, vocabulary):
    arcs = pieces.lattice(word, vocabulary)

    def ways(end):
        if not end:
            return [(0.0, ())]
        return [(s + score, i + ids) for begin, score, ids in arcs[end] for s, i in ways(begin)]

    return sorted(ways(len(word)), reverse=True)


@pytest.mark.parametrize("word", [" the", " worthless", "é▁x", "\t\t", " 日本x", "aaaaaaaa", " "])
def test_n_best_is_exact(vocabulary, word):
    want = every_way(word, vocabulary)[:4]
    got = pieces.n_best(word, vocabulary, 4)
    assert [round(s, 9) for s, _ in got] == [round(s, 9) for s, _ in want]
    assert len({ids for _, ids in got}) == len(got)
    encoder = pieces.Encoder(vocabulary)
    encoder.learn({word})
    assert abs(encoder.known[word][1] - want[0][0]) < 1e-9


def test_n_best_of_a_text(vocabulary):
    encoder = pieces.Encoder(vocabulary, 3)
    for text in ("the cat sat", "a ▁ b  c\n\n\td é 日本", "x" * 5000):
        raw, scores, changes = encoder.encode(text)
        ids = memoryview(raw).cast("i").tolist()
        assert pieces.decode(ids, vocabulary) == text
        assert scores == sorted(scores, reverse=True)
        assert all(pieces.decode(pieces.changed(ids, c), vocabulary) == text for c in changes)
    want = [s for s, _ in every_way(" the cat", vocabulary)[:3]]
    assert [round(s, 9) for s in encoder.encode("the cat")[1]] == [round(s, 9) for s in want]


def test_pieces_of_odd_rows(docs_of, odd):
    got = pieces.encode_texts(docs_of(odd)).collect()
    assert len(got) == len(odd) and all(r.round_trip for r in got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].ids is None and by_id[2].ids == [] and by_id[2].scores == [0.0]
    assert pieces.encode_texts(docs_of([])).count() == 0


def test_words_of_all_lengths_are_learnt_side_by_side(vocabulary, monkeypatch):
    """A round of array steps for each length cost more than the steps themselves, as few words are long."""
    rounds, together = [], pieces.Encoder._together
    monkeypatch.setattr(pieces.Encoder, "_together", lambda self, words, *size: rounds.append(len(words)) or together(self, words, *size))
    text = "worthlessness understanding x\t日本 é▁x a\0b "
    words = {" " + (text * 3)[k : k + size].replace(" ", "").replace("\n", "") for size in range(1, 40) for k in range(0, 60, 7)}
    encoder = pieces.Encoder(vocabulary)
    encoder.learn(words)
    assert len(rounds) == 1 and rounds[0] > 100
    for word in words:
        (score, ids), second = pieces.n_best(word, vocabulary, 2)
        raw, learnt, loss = encoder.known[word]
        assert memoryview(raw).cast("i").tolist() == list(ids)
        assert abs(learnt - score) < 1e-9 and abs(loss - (score - second[0])) < 1e-9


def test_texts_split_together_encode_as_each_alone(vocabulary):
    texts = ["the cat sat on the mat", "", "a ▁ b  c\n\n\td é 日本", "x" * 500, "the cat", " "]
    encoder = pieces.Encoder(vocabulary, 3, kept=4)  # the table starts anew with each text
    assert list(encoder.encode_split([encoder.split(t) for t in texts])) == [encoder.encode(t) for t in texts]
