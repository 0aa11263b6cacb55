"""Alignment, sketches and whitening against brute-force versions, and on odd input."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shelfstar.llm import alignment, sketches, whitening

FOLDER = "/root/testdata/sf0.001"


# --- alignment


class Plain:
    """Both tokenizers by their own libraries, and alignment by comparing all ranges."""

    def __init__(self):
        self.a = Tokenizer.from_file(alignment.A_MODEL)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=alignment.B_MODEL)
        symbol = {i: p for p, i in self.a.get_vocab(with_added_tokens=False).items()}
        byte = alignment.byte_of_symbol()
        self.a_bytes = lambda i: bytes(byte[c] for c in symbol[i])

    def b_bytes(self, i):
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()

    def aligned(self, text):
        """Ids, links (positions) and groups."""
        if not text:
            return [], [], [], []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        ranges = []
        for ids, spell in ((a, self.a_bytes), (b, self.b_bytes)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(spell(i))))
                at = out[-1][1]
            if b"".join(map(spell, ids)) != (" " + text).encode():
                return [], [], [], []
            ranges.append(out)
        links, low = [], 0
        for i, (x, y) in enumerate(ranges[0]):
            while ranges[1][low][1] <= x:
                low += 1
            j = low
            while j < len(b) and ranges[1][j][0] < y:
                links.append((i, j))
                j += 1
        cuts = sorted({y for _, y in ranges[0]} & {y for _, y in ranges[1]})
        groups, i, j = [], 0, 0
        for c in cuts:
            own = ([], [])
            while i < len(a) and ranges[0][i][1] <= c:
                own[0].append(a[i])
                i += 1
            while j < len(b) and ranges[1][j][1] <= c:
                own[1].append(b[j])
                j += 1
            groups.append(own)
        return a, b, links, groups


def brute_alignment(rows):
    """Rows of (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)."""
    plain, count, kept = Plain(), Counter(), []
    for doc, text in rows:
        a, b, links, groups = plain.aligned(text)
        pairs = [(a[i], b[j]) for i, j in links]
        count.update(set(pairs))
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        kept.append((doc, len(a), len(b), len(groups), pairs, hashlib.sha256(said.encode()).hexdigest() if a else ""))
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    return [
        (doc, n_a, n_b, n_groups, len(pairs), sum(count[p] == top[p[0]] for p in pairs), sum(count[p] for p in pairs), said)
        for doc, n_a, n_b, n_groups, pairs, said in kept
    ]


TRICKY = [
    (1, None),
    (2, ""),
    (3, " "),
    (4, "   \n\t  x"),
    (5, "<|endoftext|> </s><s><unk> <0x41>"),
    (6, "naïve 漢字 🙂🙂 é ▁ x▁y \x00 z"),
    (None, "a" * 5000),
    (8, "the cat " * 4000),
    (8, "the cat " * 4000),
    (9, "x1y22z333 " * 30 + "\r\n" * 20),
    (-5, "   tail ﻿"),
]


def test_alignment_of_the_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = [tuple(r) for r in alignment.op11_tokenizer_alignment(spark, FOLDER).collect()]
    assert sorted(got) == sorted(brute_alignment(docs))


@pytest.mark.parametrize("unit", [1 << 23, 64])
def test_alignment_of_odd_texts(spark, docs_of, monkeypatch, unit):
    monkeypatch.setattr(alignment, "UNIT", unit)
    monkeypatch.setattr(alignment, "TOGETHER", min(unit, alignment.TOGETHER))
    got = [tuple(r) for r in alignment.summed_alignment(docs_of(TRICKY)).collect()]
    assert sorted(got, key=str) == sorted(brute_alignment(TRICKY), key=str)
    assert alignment.summed_alignment(docs_of([])).count() == 0


@pytest.mark.parametrize("lane", [1, 3, 256])
def test_links_and_cuts_with_any_number_of_walkers(lane):
    aligner, plain = alignment.Aligner(), Plain()
    texts = [t for _, t in TRICKY]
    tokens = aligner.tokens(texts)
    link_a, link_b, cut_a, cut_b = alignment.lockstep(tokens, lane)
    want = []
    for k, text in enumerate(texts):
        want += [(i + tokens.a_from[k], j + tokens.b_from[k]) for i, j in plain.aligned(text)[2]]
    assert list(zip(link_a, link_b, strict=True)) == want
    assert (tokens.a_end[cut_a] == tokens.b_end[cut_b]).all()
    assert len(cut_a) == len(set(tokens.a_end.tolist()) & set(tokens.b_end.tolist()))


def test_aligned_texts_hold_places(spark, docs_of):
    plain = Plain()
    got = alignment.align_texts(docs_of(TRICKY)).collect()
    want = {str((doc, text)): plain.aligned(text) for doc, text in TRICKY}
    assert len(got) == len(TRICKY)
    found = Counter((tuple(r.a), tuple(r.b), tuple((x.a, x.b) for x in r.links), len(r.cuts)) for r in got)
    assert set(found) == {(tuple(a), tuple(b), tuple(links), len(groups)) for a, b, links, groups in want.values()}
    assert alignment.align_texts(docs_of([])).count() == 0


def test_both_libraries_encode_alike(tmp_path):
    """The fast way and the file's own library, which is taken where a file is of another shape."""
    own = alignment.ByteLevel(alignment.A_MODEL)
    shaped = tmp_path / "shaped.json"
    text = open(alignment.A_MODEL, encoding="utf-8").read()
    shaped.write_text(text.replace('"ignore_merges":false', '"ignore_merges":true').replace('"ignore_merges": false', '"ignore_merges": true'))
    other = alignment.ByteLevel(str(shaped))
    for _, t in TRICKY:
        if t:
            assert own.encode(" " + t) == other.encode(" " + t)


# --- sketches


def plain_sketch(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))] if words else []
    hashes = sorted({int.from_bytes(hashlib.md5(s.encode()).digest()[8:], "little") for s in shingles})
    return [h for h in hashes if h < 2**61] or hashes[:1]


def plain_fingerprints(rows):
    """{(id, text): (n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)} for distinct ids."""
    rows = sorted({(d, t or "") for d, t in rows}, reverse=True)

    def near(a, b):
        a, b = set(plain_sketch(a)), set(plain_sketch(b))
        return len(a & b) / len(a | b) if a | b else 1.0

    out = {}
    for k, (doc, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        said = ["".join(f"{h:016x}" for h in plain_sketch(t)) for t in (text, edited)]
        out[doc] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), *said, near(text, edited), near(text, following))
    return out


COLUMNS = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def test_fingerprints_of_the_table(spark, monkeypatch):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    want = plain_fingerprints(rows)
    for size in (4 << 20, 20_000):
        monkeypatch.setattr(sketches, "SLICE", size)
        got = sketches.op12_document_fingerprints(spark, FOLDER).collect()
        assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("size", [4 << 20, 1000, 1])
def test_fingerprints_of_odd_texts(spark, docs_of, monkeypatch, size):
    monkeypatch.setattr(sketches, "SLICE", size)
    rng = random.Random(3)
    rows = [(i, t) for i, t in enumerate(["", None, "  \n", "One", "é\U0001f642" * 700, "to be or not " * 9000, "a b c d e", "A B C D E"])]
    rows += [(100 + i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 60)))) for i in range(60)]
    rows += [((1 << 63) - 1, "last"), (-(1 << 63), "first"), (3, "One"), (3, "One")]
    got = sketches.compare_with_edited(docs_of(rows).repartition(5)).collect()
    want = plain_fingerprints(rows)
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in got} == want and len(got) == len(want)
    assert all(r.held_by_edited is None if not r.fingerprint else 0 <= r.held_by_edited <= 1 for r in got)


def test_fingerprints_with_null_and_repeated_ids(spark, docs_of):
    rows = [(None, "x y"), (None, "x y"), (None, None), (7, "p q"), (7, "r s"), (8, "t" * 9)]
    got = sketches.compare_with_edited(docs_of(rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter({None: 2, 7: 2, 8: 1})
    eight = next(r for r in got if r.doc_id == 8)
    assert eight.edited_sha256 in {hashlib.sha256(("t" * 6 + x).encode()).hexdigest() for x in ("p q", "r s")}
    assert sketches.compare_with_edited(docs_of([])).count() == 0
    one = sketches.compare_with_edited(docs_of([(1, "abcdef")])).collect()
    assert [(r.near_next, r.edited_sha256) for r in one] == [(1.0, hashlib.sha256(b"abcdab").hexdigest())]


def test_sketches_merge_and_estimate_containment(spark, docs_of):
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**6)}" for _ in range(12000)]
    whole, part = " ".join(words), " ".join(words[3000:4200])
    docs = docs_of([(1, whole), (2, part), (3, part[:40]), (4, None)])
    made = sketches.sketch_texts(docs)
    assert made.columns == [c for c in docs.columns if c != "text"] + ["sketch"]
    held = {r.doc_id: r.sketch for r in made.collect()}
    assert held[4] == [] and len(held[3]) >= 1
    pair = spark.createDataFrame([(held[2], held[1], held[4])], "a array<string>, b array<string>, none array<string>")
    r = pair.select(sketches.containment("a", "b").alias("ab"), sketches.containment("b", "a").alias("ba"), sketches.containment("none", "a").alias("no")).first()
    assert r.ab == 1.0 and abs(r.ba - 1196 / 11996) < 0.02 and r.no is None
    split = docs_of([(1, " ".join(words[:7000])), (2, " ".join(words[6996:])), (3, "only this")])
    merged = {x.hash for x in sketches.merge_sketches(sketches.sketch_texts(split), "lang").collect()}
    assert merged == set(held[1]) | set(h for h in map(bytes.hex, sketches.sketch("only this")) if h < "2" + "0" * 15)
    assert sketches.merge_sketches(sketches.sketch_texts(docs_of([(1, "only this")])), "lang").count() == 1
    assert sketches.merge_sketches(sketches.sketch_texts(docs_of([])), "lang").count() == 0


# --- whitening


def exact_whitening(vectors):
    x = np.array([[math.floor(64 * float(c)) + 1000000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    moved = n * x - sums
    v = np.array([[int(a) / n**3 for a in row] for row in moved.T @ moved], float)
    values, vecs = np.linalg.eigh(v)
    order = np.argsort(-values)
    return n, [int((m * m).sum()) for m in moved], values[order], vecs[:, order], np.array(moved, float) / n


def test_whitening_of_the_table(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    n, deviation, values, vecs, moved = exact_whitening([r.embedding for r in rows])
    got = whitening.op13_embedding_whitening(spark, FOLDER).collect()
    assert len(got) == 32 * len(rows) and {r.n for r in got} == {n}
    table = defaultdict(dict)
    for r in got:
        table[r.vec_id][r.component] = r
    white = np.array([[table[r.vec_id][k + 1].whitened for k in range(32)] for r in rows])
    assert [table[r.vec_id][1].deviation for r in rows] == deviation
    want = moved @ vecs[:, :32] / np.sqrt(values[:32])
    sign = np.sign((white * want).sum(axis=0))
    assert np.allclose(white * sign, want, atol=1e-8)
    assert np.allclose([table[rows[0].vec_id][k + 1].explained for k in range(32)], values[:32] / values.sum(), rtol=1e-9)
    cov = white.T @ white / n - np.outer(white.mean(axis=0), white.mean(axis=0))
    error = {r.identity_error for r in got}
    assert len(error) == 1 and abs(error.pop() - np.abs(cov - np.eye(32)).max()) < 1e-9


@pytest.mark.parametrize("top", [1, 900, 1 << 22, 1 << 40])
def test_bit_sliced_products(top):
    y = np.random.default_rng(top).integers(0, top, (133, 5))
    y[:, 3] = 0
    want = y.astype(object).T @ y.astype(object)
    got = whitening.bit_sliced(y)
    assert all(int(got[i, j]) == want[i, j] for i in range(5) for j in range(i, 5))


def vectors(spark, rows):
    full = [(i, v, 0, 1, 2) for i, v in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<double>, n int, vector int, component int")


def test_whitening_drops_what_it_must(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.normal(size=3).tolist()) for i in range(40)] + [(None, [1.0, 2.0, 3.0]), (5, [0.1, 0.2, 0.3]), (5, [0.1, 0.2, 0.3])]
    bad = [(900, None), (901, []), (902, [1.0, None, 2.0]), (903, [math.nan, 0.0, 0.0]), (904, [math.inf, 0.0, 0.0]), (905, [1.0]), (906, [1e300, 0.0, 0.0])]
    got = whitening.whiten(vectors(spark, good + bad).repartition(3)).collect()
    n, deviation, values, _, _ = exact_whitening([v for _, v in good])
    assert len(got) == 3 * len(good) and {r.n for r in got} == {n}
    assert sorted(r.deviation for r in got if r.component == 1) == sorted(deviation)
    assert max(r.identity_error for r in got) < 1e-9
    assert not {r.vec_id for r in got} & {i for i, _ in bad}


def test_whitening_without_variance(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    flat = whitening.whiten(vectors(spark, [(i, [float(i), 5.0, 2.0 * i]) for i in range(9)])).collect()
    assert {r.component for r in flat} == {1} and abs(flat[0].explained - 1) < 1e-9


def test_whitening_of_wide_values(spark):
    rows = [(i, [float(k << 38), 0.5 * i]) for i, k in enumerate((1, 2, 3, 100, 7))]
    got = whitening.whiten(vectors(spark, rows)).collect()
    _, deviation, _, _, _ = exact_whitening([v for _, v in rows])
    assert sorted(r.deviation or 0 for r in got if r.component == 1) == sorted(d if d < 1 << 63 else 0 for d in deviation)
