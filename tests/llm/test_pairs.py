"""Operators that compare documents, against brute-force versions, and on odd input."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfstar.llm import components, decontaminate, simhash, substrings, suffixes

FOLDER = "/root/testdata/sf0.001"


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1040)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent if root(x) != x}


def brute_components(fps, ids):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    a = np.array(fps, np.int64).view(np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 4):
            x, y = sorted((root(i), root(int(j))))
            parent[y] = x
    out = []
    for i in range(len(a)):
        known = [ids[j] for j in range(len(a)) if root(j) == root(i) and ids[j] is not None]
        out.append(min(known) if known else None)
    return out


def test_fingerprint_by_definition():
    text = "Ab cD\tef gh \n ij KL " * 3 + "É end"
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 4]).encode(), 42) for k in range(len(words) - 3)]
    want = sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))
    assert simhash.fingerprint(text, 4) & (1 << 64) - 1 == want
    assert simhash.fingerprint(None, 4) == simhash.fingerprint(" \n", 4) == 0
    assert simhash.fingerprint("a b", 4) & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"a b", 42)


@pytest.mark.parametrize("unit", [simhash.UNIT, 16])
def test_near_duplicates(spark, monkeypatch, unit):
    monkeypatch.setattr(simhash, "UNIT", unit)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = sorted(simhash.near_duplicates(docs, shingle=4).collect())
    fps = [int(np.uint64(int(r.fingerprint, 16)).view(np.int64)) for r in got]
    texts = dict(docs.select("doc_id", "text").collect())
    assert fps == [simhash.fingerprint(texts[r.doc_id], 4) for r in got]
    assert [r.component_id for r in got] == brute_components(fps, [r.doc_id for r in got])


def test_links_of_planted_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(simhash, "UNIT", 8)
    rng = random.Random(3)
    fps = set()
    for _ in range(12):
        f = rng.getrandbits(64)
        for flips in (0, 2, 4, 5, 7):
            fps.add(f ^ sum(1 << b for b in rng.sample(range(64), flips)))
    fps = [int(np.uint64(f).view(np.int64)) for f in sorted(fps)]
    roots = dict(simhash.rooted(spark.createDataFrame([(f,) for f in fps], "fp long"), 4).collect())
    want = brute_components(fps, fps)
    assert [roots[f] for f in fps] == want


def test_pack_round_trip():
    rng = np.random.default_rng(1)
    for kind, top in ((np.uint16, 1 << 40), (np.uint32, 1 << 50), (np.uint16, 3000)):
        values = np.unique(rng.integers(0, top, 1000).astype(np.uint64))
        assert (simhash.unpack(simhash.pack(values, kind), kind) == values).all()


def test_one_of_each_group_stays(docs_of, odd):
    docs = docs_of(odd)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5]
    assert simhash.drop_near_duplicates(docs_of([])).count() == 0
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(odd) and {r.component_id for r in got} == {1, 4, 5}


PASSAGE = " ".join(f"w{k}x{k * k}" for k in range(60))


def test_chunks_survive_insertions(docs_of):
    rng = random.Random(4)
    filler = lambda n: " ".join(f"{rng.getrandbits(40):x}" for _ in range(n))
    rows = [(k, f"{filler(40)} {PASSAGE} {filler(30)}") for k in range(1, 8)] + [(9, filler(90)), (10, None), (10, None), (None, PASSAGE)]
    got = {r.doc_id: r for r in substrings.repeated_spans(docs_of(rows)).collect()}
    texts = dict(rows)
    assert got[1].n_removed == got[9].n_removed == got[10].n_bytes == 0
    for k in [*range(2, 8), None]:
        raw = (texts[k] or "").encode()
        left = substrings.without_spans(raw, [(s.begin, s.end) for s in got[k].spans]).decode()
        assert got[k].n_removed >= len(PASSAGE) // 2 and 1 in got[k].first_docs
        assert len(raw) - len(left) == got[k].n_removed
        assert k is None or left.startswith(texts[k][:200])
    assert substrings.repeated_spans(docs_of([])).count() == 0


def test_gear_looks_at_sixteen_bytes():
    data = np.frombuffer(random.Random(1).randbytes(500), np.uint8)
    assert (substrings.gear(data)[100:] == substrings.gear(data[50:])[50:]).all()
    ends = substrings.chunk_ends(data.tobytes())
    assert ends[-1] == 500 and all(20 <= b - a <= 160 for a, b in zip([0, *ends[:-2]], ends[:-1], strict=True))


def brute_removed(rows):
    seen, out = {}, {}
    for i, raw in sorted(rows):
        gone = bytearray(len(raw))
        for j in range(len(raw) - 49):
            if seen.get(raw[j : j + 50], i) < i:
                gone[j : j + 50] = b"\1" * 50
        for j in range(len(raw) - 49):
            seen.setdefault(raw[j : j + 50], i)
        spans = sum(1 for j in range(len(gone)) if gone[j] and (j == 0 or not gone[j - 1]))
        kept = bytes(b for b, x in zip(raw, gone, strict=True) if not x)
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("wide", [suffixes.WIDE, 2])
def test_repeated_strings(spark, monkeypatch, wide):
    monkeypatch.setattr(suffixes, "UNIT", 1 << 16)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    cut = suffixes.remove_repeats(docs, wide=wide)
    got = {r[0]: tuple(r[1:]) for r in cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()}
    assert got == brute_removed([(r.doc_id, (r.text or "").encode()) for r in docs.collect()])


def test_repeated_strings_of_odd_rows(docs_of):
    rows = [(1, "a" * 49), (2, "a" * 49), (3, "b" * 50), (4, "x" + "b" * 50), (5, "ab" * 100), (6, "ba" * 60), (7, None), (8, ""), (8, ""), (None, "b" * 60)]
    got = {r.doc_id: r for r in suffixes.remove_repeats(docs_of(rows)).collect()}
    want = brute_removed([(1 << 62 if i is None else i, (t or "").encode()) for i, t in rows])
    for i, w in want.items():
        r = got[None if i == 1 << 62 else i]
        assert (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) == w
    assert suffixes.remove_repeats(docs_of([])).count() == 0


@pytest.mark.parametrize("wide", [suffixes.WIDE, 2])
@pytest.mark.parametrize("unit", [700, 1 << 20])
def test_repeated_strings_that_very_many_documents_share(docs_of, monkeypatch, wide, unit):
    """A passage and a line in most documents, within documents too, among unlike bytes; documents without an id and with one id."""
    monkeypatch.setattr(suffixes, "UNIT", unit)
    rng = random.Random(8)

    def noise(n):
        return "".join(rng.choice("abcdef é") for _ in range(n))

    passage, line = noise(120), noise(61)
    rows = []
    for i in range(90):
        parts = [noise(rng.randrange(40)) for _ in range(4)]
        text = rng.choice([passage, passage[:70], line]).join(parts) if i % 3 else noise(30) + line + noise(5) + line
        rows.append((rng.choice([i, i, i, 7, None]), text))
    rows += [(200, passage), (201, passage), (None, line * 3)]
    last = 1 << 62
    got = sorted((last if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.remove_repeats(docs_of(rows), wide=wide).collect())
    want, seen = [], {}
    every = sorted({(last if i is None else i, t.encode()) for i, t in rows})
    for i, raw in every:
        for j in range(len(raw) - 49):
            seen.setdefault(raw[j : j + 50], i)
    for i, raw in every:
        gone = bytearray(len(raw))
        for j in range(len(raw) - 49):
            if seen[raw[j : j + 50]] < i:
                gone[j : j + 50] = b"\1" * 50
        spans = sum(1 for j in range(len(gone)) if gone[j] and (j == 0 or not gone[j - 1]))
        want.append((i, len(raw), sum(gone), spans, bytes(b for b, x in zip(raw, gone, strict=True) if not x)))
    assert got == sorted(want)


def words_of(text):
    import re

    return re.findall(r"[^\W_]+", text.lower())


def brute_hits(docs, items):
    from collections import Counter

    def grams(w, k):
        return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]

    out = set()
    for d, text in docs:
        w = words_of(text or "")
        for i, item in items:
            v = words_of(item or "")
            if not v:
                continue
            k, m = min(5, len(v)), len(v)
            b = Counter(grams(v, k))
            for s in range(max(1, len(w) - m + 1)):
                a = Counter(grams(w[s : s + m], k))
                low = sum((a & b).values())
                if low and low / sum((a | b).values()) >= 0.8:
                    out.add((d, i))
    return out


def test_decontamination(spark, docs_of):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in decontaminate.op7_decontamination(spark, FOLDER).collect()}
    want = brute_hits([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert want and got == want
    item = PASSAGE
    words = item.split()
    near = " ".join(["start", *words[:58], "changed"])
    rows = [(1, f"before {item} after"), (2, near), (3, " ".join(words[:20])), (4, None), (None, item.upper()), (5, "one two"), (5, "one two")]
    bench = spark.createDataFrame([(1, item), (2, "One, two!"), (3, None), (4, "")], "item_id long, text string")
    hits = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs_of(rows), bench).collect()}
    assert hits == {(1, 1), (2, 1), (None, 1), (5, 2)} == brute_hits(rows, bench.collect())
    left = decontaminate.remove_contaminated(docs_of(rows), bench)
    assert left.columns == docs_of(rows).columns and {r.doc_id for r in left.collect()} == {3, 4}
    assert decontaminate.remove_contaminated(docs_of(rows), bench.limit(0)).count() == len(rows)
    assert decontaminate.contaminated(docs_of([]), bench).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, FOLDER)
        now = docs.count()
        assert 0 < now <= before
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        before = now
    assert all(r.round_trip for r in docs.select("round_trip").collect())


def shingle_set(text, k=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def test_near_copies_by_similarity(spark, docs_of):
    """A text and its copies with every 25th or so word changed: copies are nearer to the text than to each other."""
    rng = random.Random(6)
    rows, k = [], 0
    for size in (60, 150, 400):
        for copies in (0, 1, 6):
            base = [f"v{rng.getrandbits(24)}" for _ in range(size)]
            rows.append((k := k + 1, " ".join(base)))
            for _ in range(copies):
                changed = list(base)
                for at in rng.sample(range(size), max(1, size // rng.choice((45, 60, 90)))):
                    changed[at] = f"c{rng.getrandbits(24)}"
                rows.append((k := k + 1, " ".join(changed)))
    sets = {i: shingle_set(t) for i, t in rows}
    fps = {i: simhash.fingerprint(t, 5) for i, t in rows}
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            near = len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) or bin((fps[a] ^ fps[b]) & (1 << 64) - 1).count("1") <= 4
            if a < b and near:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    kept = simhash.drop_near_duplicates(docs_of(rows)).select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == sorted(i for i in root if find(i) == i)


def test_similar_goes_on_after_the_hub(spark):
    """Under one key, two pairs of texts that have nothing in common: the pair without the hub is found in a later round."""
    texts = {1: "a b c d e f g", 2: "a b c d e f g h", 3: "p q r s t u v", 4: "p q r s t u v w", 5: ""}
    holders = spark.createDataFrame([(7, i) for i in texts], "key long, fp long")
    said = spark.createDataFrame(list(texts.items()), "fp long, text string")
    got = simhash.similar(holders, said, 5, 0.7)[0].collect()
    assert sorted(tuple(sorted(r)) for r in got) == [(1, 2), (3, 4)]


def test_blocks_of_a_key_meet(spark, monkeypatch):
    """Forty pairs of copies under one key, in blocks of eight: each text meets its copy whatever their blocks."""
    monkeypatch.setattr(simhash, "BLOCK", 8)
    monkeypatch.setattr(simhash, "HUBS", (1,))
    rng = random.Random(9)
    texts = {}
    for k in range(1, 81, 2):
        base = [f"u{rng.getrandbits(30)}" for _ in range(90)]
        texts[k], texts[k + 1] = " ".join(base), " ".join([*base, "more"])
    texts[81] = None
    holders = spark.createDataFrame([(key, i) for i in texts for key in (7, 8)], "key long, fp long")
    said = spark.createDataFrame(list(texts.items()), "fp long, text string")
    links, roots = simhash.similar(holders, said, 5, 0.8)
    got = links.collect()
    assert sorted(tuple(r) for r in roots.collect()) == [(k + 1, k) for k in range(1, 81, 2)]
    assert sorted(tuple(sorted(r)) for r in got) == [(k, k + 1) for k in range(1, 81, 2)]


def filled(rng, size, word, times):
    """Random words, and a text of them with one word repeated after them, which decides the whole fingerprint."""
    words = " ".join(f"r{rng.getrandbits(40)}" for _ in range(size))
    return words, f"{words} {' '.join([word] * times)}"


def test_copies_of_a_text_behind_a_shared_fingerprint(spark, docs_of):
    """Unlike texts A and B share a filler and so a fingerprint; C, which is B without it, is a near copy of B all the same."""
    rng = random.Random(12)
    rows = []
    for k in range(0, 80, 10):
        _, a = filled(rng, 800, f"filler{k}", 198)
        c, b = filled(rng, 800, f"filler{k}", 198)
        assert simhash.fingerprint(a, 5) == simhash.fingerprint(b, 5) != simhash.fingerprint(c, 5)
        rows += [(k + 1, a), (k + 2, b), (k + 3, c), (k + 4, c.replace(" ", "\n ").upper())]
    kept = {r.doc_id for r in simhash.drop_near_duplicates(docs_of(rows)).select("doc_id").collect()}
    assert not {i for i in kept if i % 10 > 2}


def test_unlike_texts_of_one_fingerprint_stay(spark, docs_of):
    """Thirty unlike texts whose fingerprint a repeated word decides, and one copy among them that only the ball could bring together."""
    rng = random.Random(13)
    rows = [(k, filled(rng, 800, "filler", 198)[1]) for k in range(1, 31)]
    assert len({simhash.fingerprint(t, 5) for _, t in rows}) == 1
    rows.append((31, rows[6][1] + " more"))
    kept = simhash.drop_near_duplicates(docs_of(rows)).select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == list(range(1, 31))


def test_fingerprints_link_what_no_band_does(spark, docs_of, monkeypatch):
    """Two near copies without a band in common: the ball around their fingerprints alone decides that one of them goes."""
    rng = random.Random(5)
    fresh = lambda n: [f"w{rng.getrandbits(40):x}" for _ in range(n)]
    for _ in range(2000):
        own = fresh(60)
        rows = [(k, " ".join(["filler"] * 400 + words)) for k, words in enumerate((own, own[:54] + fresh(6)), 1)]
        (fp, bands), (other, others) = (simhash.sketch(t, 5, True) for _, t in rows)
        if not set(bands.tolist()) & set(others.tolist()) and ((fp ^ other) % (1 << 64)).bit_count() <= 4:
            break
    assert [r.doc_id for r in simhash.drop_near_duplicates(docs_of(rows)).collect()] == [1]
    monkeypatch.setattr(simhash, "rooted", lambda classes, radius: classes.limit(0).selectExpr("fp", "fp AS root"))
    assert simhash.drop_near_duplicates(docs_of(rows)).count() == 2


def test_copies_that_meet_in_a_ball_only(spark, docs_of, monkeypatch):
    """No bands: unlike texts and copies of some share a fingerprint, and each copy is found whichever text stands first in the ball."""
    rng = random.Random(14)
    sketch = simhash.sketch
    monkeypatch.setattr(simhash, "sketch", lambda *a: (lambda fp, bands: (fp, None if bands is None else bands[:0]))(*sketch(*a)))
    rows = [(k, filled(rng, 300, "filler", 90)[1]) for k in range(1, 25)]
    rows += [(100 + k, f"{t} more") for k, t in rows[::2]]
    kept = simhash.drop_near_duplicates(docs_of(rows)).select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == list(range(1, 25))


def test_windows_between_and_beside_the_matches(spark, docs_of):
    """An item with k words lost at each end and 2k put in at the middle, its halves swapped, and one with both ends changed."""
    rng = random.Random(15)
    fresh = lambda n: [f"z{rng.getrandbits(40):x}" for _ in range(n)]
    rows, bench = [], []
    for i, (m, k) in enumerate(((60, 1), (80, 2), (150, 6), (200, 8)), 1):
        v = fresh(m)
        bench.append((i, " ".join(v)))
        edited = v[k : m // 2] + fresh(2 * k) + v[m // 2 : m - k]
        for d, inner in enumerate((edited, v[m // 2 :] + v[: m // 2], [*fresh(1), *v[1:-1], *fresh(1)])):
            rows.append((10 * i + d, " ".join(fresh(30) + inner + fresh(20))))
        rows.append((10 * i + 3, " ".join(v[: m * 17 // 20])))
    v = ("a b c d e f g h " * 8).split()
    bench.append((5, " ".join(v)))
    rows += [(51, " ".join(fresh(9) + v + v[:5])), (52, " ".join(v[:40])), (53, " ".join(fresh(3) + v[3:] + v[:40]))]
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs_of(rows), items).collect()}
    want = brute_hits(rows, bench)
    assert {(10 * i, i) for i in (1, 2, 3, 4)} <= want
    assert set(got) == want
    # Of windows equally similar the first: one word before the item loses no shingle of it where both its ends are changed.
    assert [got[10 * i + 2, i].start for i in (1, 2, 3, 4)] == [29] * 4


def test_blocks_cover_the_fingerprint_once(spark):
    """Fingerprints 16 to 20 bits apart, the bits spread over all sixteen nibbles, agree in one of 21 blocks."""
    rng = random.Random(16)
    signed = lambda x: int(np.uint64(x).view(np.int64))
    rows = []
    for flips in (16, 17, 18, 19, 20):
        for _ in range(40):
            f, bits = rng.getrandbits(64), {4 * n + rng.randrange(4) for n in range(16)}
            bits |= set(rng.sample(sorted(set(range(64)) - bits), flips - 16))
            rows.append((signed(f), signed(f ^ sum(1 << b for b in bits))))
    df = spark.createDataFrame(rows, "f long, g long").withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(20))))
    same = F.col("x") == F.col("y")
    both = df.withColumn("x", decontaminate._block(F.col("f"), F.col("b"), 20)).withColumn("y", decontaminate._block(F.col("g"), F.col("b"), 20))
    got = both.groupBy("f", "g").agg(F.sum(same.cast("int")).alias("n"))
    assert got.filter("n >= 1").count() == len(rows)
    ones = spark.createDataFrame([(r, k) for r in (0, 3, 20, 63) for k in range(r + 1)], "r int, k int")
    for r in (0, 3, 20, 63):
        at = ones.filter(F.col("r") == r).select(F.sum(F.bit_count(decontaminate._block(F.lit(-1).cast("long"), F.col("k"), r))))
        assert at.first()[0] == 64


def least_linked(n, linked):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in linked:
        a, b = sorted((find(i), find(j)))
        root[b] = a
    return [find(i) for i in range(n)]


def test_fingerprints_of_a_table_equal_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in simhash.op10_simhash_near_dedup(spark, folder).collect()}
    ids = sorted(got)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    fps = np.array([simhash.fingerprint(texts[i], 4) for i in ids], np.int64).view(np.uint64)
    assert [got[i].fingerprint for i in ids] == [f"{f:016x}" for f in fps]
    near = np.argwhere(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4)
    roots = least_linked(len(ids), near)
    assert [got[i].component_id for i in ids] == [ids[r] for r in roots]


def test_near_copies_of_a_table_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = sorted(r.doc_id for r in simhash.drop_near_duplicates(docs).select("doc_id").collect())
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    sets = [set(h for part in simhash.shingle_hashes(t, 5) for h in part.tolist()) for _, t in rows]
    by_hash = {}
    for k, s in enumerate(sets):
        for h in s or {"none"}:
            by_hash.setdefault(h, []).append(k)
    common = Counter()
    for holders in by_hash.values():
        for x in range(len(holders)):
            for y in range(x):
                common[holders[y], holders[x]] += 1
    linked = [(a, b) for (a, b), n in common.items() if n >= 0.8 * (len(sets[a] | sets[b]) or 1)]
    roots = least_linked(len(rows), linked)
    assert kept == sorted(rows[r][0] for r in set(roots))


def test_sorted_values_and_lookups():
    rng = np.random.default_rng(3)
    for size in (0, 1, 5, 4000):
        values = rng.integers(0, 3000, size, dtype=np.uint64) << np.uint64(30)
        counted = Counter(values.tolist())
        once, twice = simhash.ascending(values)
        assert once.tolist() == sorted(counted) and twice.tolist() == sorted(v for v, n in counted.items() if n > 1)
        wanted = once[::3]
        assert simhash.among(values, wanted, 42).tolist() == [k for k, v in enumerate(values) if v in set(wanted)]


def test_bins_rule_out_no_similar_pair():
    """Sets about the threshold: bins let every pair pass that reaches it, and few small sets that share half."""
    rng = np.random.default_rng(8)
    far = passed = 0

    def row(found):
        return np.frombuffer(simhash.bins(found), np.uint8)[None], np.array([len(found)])

    for _ in range(600):
        common = int(rng.integers(1, 300))
        extra = int(rng.integers(0, common + 1))
        cut = int(rng.integers(0, extra + 1))
        both, alone = (rng.integers(1 << 63, size=n, dtype=np.uint64) * np.uint64(2) for n in (common, extra))
        a, b = (np.unique(np.concatenate((both, part))) for part in (alone[:cut], alone[cut:]))
        (bins_a, size_a), (bins_b, size_b) = row(a), row(b)
        good = simhash.likely(bins_a, bins_b, size_a, size_b, 0.8)[0, 0]
        shared = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert good or shared < 0.8
        far, passed = far + (shared < 0.6), passed + (shared < 0.6 and good)
    assert passed < far / 20


def test_components_joined_in_rounds(spark):
    """Links that come in two rounds give the components of all of them."""
    first, second = [(1, 2), (2, 5), (7, 8), (11, 12)], [(8, 5), (20, 21), (12, 11), (30, 20)]
    roots = spark.createDataFrame([], "fp long, root long")
    for part in (first, second, []):
        roots = simhash.joined(roots, spark.createDataFrame(part, "a long, b long"))
    assert sorted(map(tuple, roots.collect())) == [(2, 1), (5, 1), (7, 1), (8, 1), (12, 11), (21, 20), (30, 20)]
