"""Alignment of two tokenizers over the same bytes.

The tokens of A and B of a text cover the same bytes. Pointers walk both lists: each step links the two tokens pointed at, which overlap,
and moves the one that ends first, or both where they end together, which is a cut. All texts of a batch walk in lockstep, as one
NumPy vector of pointers: a step emits a link for each walker and drops those that are done. A text of very many tokens is walked
by several walkers, each from its own A token on, so that the number of steps is bounded and each link belongs to one walker.

How many documents hold a pair of ids linked is counted over all documents. A unit of a few megabytes of text writes its texts' pairs as
places in a dictionary of its distinct pairs; counts are summed over the dictionaries and sent back to each unit, so that
what is shuffled is one row per unit and pair and no text is read twice.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfstar.llm.common import table, written

A_MODEL, B_MODEL = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: How byte-level pieces are split before merging, a fixed value of that kind of tokenizer.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A tokens of a walker, bytes of text encoded together, and bytes of text of a unit.
LANE, TOGETHER, UNIT = 256, 1 << 20, 8 << 20


def byte_of_symbol() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for: visible Latin-1 characters are themselves, the other
    bytes in order are the characters from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteLevel:
    """A byte-level BPE tokenizer from its JSON file; special tokens' strings are plain text.

    The file's merges are carried out by the faster of two libraries where its ids are in the order of its merges and it splits words the
    usual way, so that both give the same ids; otherwise by the library whose format the file is.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        model, before = stored["model"], stored["pre_tokenizer"] or {}
        symbols, special = byte_of_symbol(), {t["content"] for t in stored["added_tokens"]}
        vocab = {piece: i for piece, i in model["vocab"].items() if piece not in special}
        size = 1 + max([*vocab.values(), *(t["id"] for t in stored["added_tokens"])])
        self.bytes = [b""] * size
        for piece, i in vocab.items():
            self.bytes[i] = bytes(symbols[c] for c in piece)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ordered = all(vocab.get("".join(m)) == 256 + k for k, m in enumerate(merges)) and len(vocab) == 256 + len(merges)
        plain = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        if ordered and plain and not stored["normalizer"] and not model.get("ignore_merges"):
            import tiktoken

            ranks = {self.bytes[i]: i for i in vocab.values()}
            self.encode = tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer

            whole = Tokenizer.from_file(path)
            whole.encode_special_tokens = True
            self.encode = lambda text: whole.encode(text, add_special_tokens=False).ids


class Pieces:
    """A SentencePiece model; it puts a space before a text itself."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.bytes = [
            bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids, map(model.id_to_piece, ids), strict=True)
        ]
        self.encode = lambda text: model.encode(text, num_threads=1)


class Tokens:
    """Tokens of both tokenizers of several texts, one after the other, and the places where each text's begin."""

    def __init__(self, a: list[list[int]], b: list[list[int]], a_sizes: np.ndarray, b_sizes: np.ndarray) -> None:
        self.a, self.b = _joined(a), _joined(b)
        self.a_from = np.concatenate(([0], np.cumsum([len(x) for x in a], dtype=np.int64)))
        self.b_from = np.concatenate(([0], np.cumsum([len(x) for x in b], dtype=np.int64)))
        # Texts follow each other and take the same bytes in both, so that ends count on over all of them.
        self.a_end, self.b_end = np.cumsum(a_sizes[self.a]), np.cumsum(b_sizes[self.b])


def _joined(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter((i for x in lists for i in x), np.int32, sum(map(len, lists)))


def lockstep(tokens: Tokens, lane: int = LANE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (places of an A and a B token) and cuts (places of the A and the B token that end together), each in order."""
    empty = np.zeros(0, np.int64)
    if not len(tokens.a):
        return empty, empty, empty, empty
    a = np.arange(0, len(tokens.a), lane)
    stop = np.minimum(a + lane, len(tokens.a))
    b = np.searchsorted(tokens.b_end, tokens.a_end[a] - _size_at(tokens.a_end, a), side="right")
    links, cuts = [], []
    while len(a):
        links.append((a, b))
        a_end, b_end = tokens.a_end[a], tokens.b_end[b]
        met = a_end == b_end
        cuts.append((a[met], b[met]))
        a, b = a + (a_end <= b_end), b + (b_end <= a_end)
        going = a < stop
        if not going.all():
            a, b, stop = a[going], b[going], stop[going]
    link_a, link_b = (np.concatenate(x) for x in zip(*links, strict=True))
    order = np.lexsort((link_b, link_a))
    cut_a, cut_b = (np.sort(np.concatenate(x)) for x in zip(*cuts, strict=True))
    return link_a[order], link_b[order], cut_a, cut_b


def _size_at(ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ends[at] - np.where(at > 0, ends[at - 1], 0)


class Speller:
    """Groups of ids as `a1,a2|b1;a3|b2,b3`."""

    def __init__(self, n_a: int, n_b: int) -> None:
        self.after_a = 2 * n_a
        self.parts = [f"{i}{mark}" for n, marks in ((n_a, ",|"), (n_b, ",;")) for i in range(n) for mark in marks]

    def spell(self, a: np.ndarray, b: np.ndarray, a_last: np.ndarray, b_last: np.ndarray) -> str:
        """`a_last` and `b_last` say which tokens end a group."""
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        a_before, b_upto = np.searchsorted(b_group, a_group), np.searchsorted(a_group, b_group, side="right")
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + a_before] = 2 * a + a_last
        codes[np.arange(len(b)) + b_upto] = self.after_a + 2 * b + b_last
        return "".join(map(self.parts.__getitem__, codes.tolist()))[:-1]


class Aligner:
    """Both tokenizers, as a task holds them."""

    def __init__(self, a_model: str = A_MODEL, b_model: str = B_MODEL) -> None:
        self.a, self.b = ByteLevel(a_model), Pieces(b_model)
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b))

    def tokens(self, texts: list[str | None]) -> Tokens:
        """Tokens of texts; none for those whose joined tokens are not a space and the text in both tokenizers."""
        a, b = [], []
        for text in texts:
            found = ([], [])
            if text:
                ids = self.a.encode(" " + text), self.b.encode(text)
                raw = (" " + text).encode()
                if all(b"".join(map(t.bytes.__getitem__, i)) == raw for t, i in zip((self.a, self.b), ids, strict=True)):
                    found = ids
            a.append(found[0])
            b.append(found[1])
        return Tokens(a, b, self.a_sizes, self.b_sizes)


def parts(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """The texts of a column in parts of bounded size, with the bytes of each; a longer text is a part of its own."""
    held, size = [], 0
    for x in column:
        text = x.as_py()
        n = len(text) if text else 0
        if held and size + n > TOGETHER:
            yield size, held
            held, size = [], 0
        held.append(text)
        size += n
    if held:
        yield size, held


def align_texts(
    docs: DataFrame, a_model: str = A_MODEL, b_model: str = B_MODEL, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, a, b (arrays of ids), links (array of the places of an A and a B token, overlapping), cuts (array of the places of tokens that
    end together): a row per input row.

    Null and empty texts, and those that either tokenizer does not give back byte by byte, have no tokens. Repeated rows
    and null ids are read like any other; texts of any length are read whole. Other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    place = pa.struct([("a", pa.int32()), ("b", pa.int32())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_model, b_model)
        for batch in batches:
            at = 0
            for _, texts in parts(batch.column("text")):
                t = aligner.tokens(texts)
                link_a, link_b, cut_a, cut_b = lockstep(t)
                out = {"doc_id": batch.column("doc_id").slice(at, len(texts)), "a": _lists(t.a_from, pa.array(t.a)), "b": _lists(t.b_from, pa.array(t.b))}
                for name, x, y in (("links", link_a, link_b), ("cuts", cut_a, cut_b)):
                    begins = np.searchsorted(x, t.a_from)
                    own = np.repeat(np.arange(len(texts)), np.diff(begins))
                    pair = [pa.array((v - f[own]).astype(np.int32)) for v, f in ((x, t.a_from), (y, t.b_from))]
                    out[name] = _lists(begins, pa.StructArray.from_arrays(pair, fields=list(place)))
                yield pa.RecordBatch.from_pydict(out)
                at += len(texts)

    kind = rows.schema["doc_id"].dataType.simpleString()
    pair = "array<struct<a:int,b:int>>"
    return rows.mapInArrow(made, f"doc_id {kind}, a array<int>, b array<int>, links {pair}, cuts {pair}")


def _lists(begins: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), values)


def summed_alignment(
    docs: DataFrame, a_model: str = A_MODEL, b_model: str = B_MODEL, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups: a row per input row.

    A pair of ids counts once for each document that holds it linked. n_best is the number of a document's links whose count is the
    highest that their A id has anywhere, count_sum the sum of counts over its links, groups the lower-case hex SHA-256 of the
    groups as `a1,a2|b1;a3|b2,b3` ('' for a text without tokens). Rows that repeat are documents of their own, null ids are read
    like any other. Texts as in `align_texts`. An empty table gives no rows. Other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = ("n_a", "n_b", "n_groups", "n_links")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_model, b_model)
        speller = Speller(len(aligner.a.bytes), len(aligner.b.bytes))
        task = TaskContext.get().partitionId() << 32
        unit, size, held = 0, 0, []
        for batch in batches:
            at = 0
            for n, texts in parts(batch.column("text")):
                held.append((batch.column("doc_id").slice(at, len(texts)), *measured(aligner, speller, texts)))
                at, size = at + len(texts), size + n
                if size >= UNIT:
                    yield from unit_rows(task + unit, held)
                    unit, size, held = unit + 1, 0, []
        if held:
            yield from unit_rows(task + unit, held)

    def measured(aligner: Aligner, speller: Speller, texts: list) -> tuple:
        """Counts per text, hashes of groups, and per text its distinct pairs (ascending) and how often each is linked."""
        t = aligner.tokens(texts)
        link_a, link_b, cut_a, cut_b = lockstep(t)
        a_last, b_last = np.zeros(len(t.a), np.int64), np.zeros(len(t.b), np.int64)
        a_last[cut_a] = b_last[cut_b] = 1
        hashes = []
        for k in range(len(texts)):
            i, j = (slice(f[k], f[k + 1]) for f in (t.a_from, t.b_from))
            said = speller.spell(t.a[i], t.b[j], a_last[i], b_last[j])
            hashes.append(sha256(said.encode()).hexdigest() if said else "")
        begins = np.searchsorted(link_a, t.a_from)
        numbers = np.column_stack((np.diff(t.a_from), np.diff(t.b_from), np.diff(np.searchsorted(cut_a, t.a_from)), np.diff(begins)))
        pair = t.a[link_a].astype(np.int64) << 32 | t.b[link_b]
        own = np.repeat(np.arange(len(texts)), np.diff(begins))
        order = np.lexsort((pair, own))
        pair, own = pair[order], own[order]
        first = np.flatnonzero(np.concatenate(([True], (pair[1:] != pair[:-1]) | (own[1:] != own[:-1])))[: len(pair)])
        times = np.diff(np.append(first, len(pair)))
        return numbers, hashes, np.bincount(own[first], minlength=len(texts)), pair[first], times.astype(np.int32)

    def unit_rows(unit: int, held: list) -> Iterator[pa.RecordBatch]:
        """The unit's dictionary of pairs, with the number of its documents that hold each, and a row per document."""
        ids, numbers, hashes, sizes, pairs, times = zip(*held, strict=True)
        pair, where, n = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
        ids, numbers = pa.concat_arrays(ids), np.concatenate(numbers)
        begins = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
        count = len(ids)
        columns = {
            "unit": pa.array(np.full(count, unit)),
            "doc_id": ids,
            **{c: pa.array(numbers[:, k]) for k, c in enumerate(counts)},
            "groups": pa.array([h for x in hashes for h in x]),
            "at": _lists(begins, pa.array(where.astype(np.int32))),
            "times": _lists(begins, pa.array(np.concatenate(times))),
            "pairs": pa.nulls(count, pa.list_(pa.int64())),
            "held": pa.nulls(count, pa.list_(pa.int32())),
        }
        documents = pa.RecordBatch.from_pydict(columns)
        yield documents
        dictionary = {
            "unit": pa.array([unit]),
            "pairs": _lists(np.array([0, len(pair)]), pa.array(pair)),
            "held": _lists(np.array([0, len(pair)]), pa.array(n.astype(np.int32))),
        }
        yield pa.RecordBatch.from_arrays([dictionary.get(f.name, pa.nulls(1, f.type)) for f in documents.schema], documents.schema.names)

    numbers = ", ".join(f"{c} long" for c in counts)
    schema = f"unit long, doc_id {kind}, {numbers}, groups string, at array<int>, times array<int>, pairs array<long>, held array<int>"
    aligned = written(rows.mapInArrow(made, schema), "aligned")
    entries = aligned.filter("pairs IS NOT NULL").select("unit", F.posexplode(F.arrays_zip("pairs", "held")).alias("at", "entry"))
    entries = entries.select("unit", "at", F.col("entry.pairs").alias("pair"), F.col("entry.held").alias("held"))
    count = entries.groupBy("pair").agg(F.sum("held").alias("n")).withColumn("a", F.shiftright("pair", 32))
    count = written(count, "pair-counts")
    top = count.groupBy("a").agg(F.max("n").alias("top"))
    ranked = count.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    told = entries.join(ranked, "pair").select(F.col("unit").alias("to"), F.col("at").alias("place"), "n", "best")

    def summed(documents: pa.Table, told: pa.Table) -> pa.Table:
        """Per document the sums over its links, from the counts of the unit's pairs."""
        place = told.column("place").to_numpy()
        n, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        n[place], best[place] = told.column("n").to_numpy(), told.column("best").to_numpy()
        documents = documents.combine_chunks()
        lists = documents.column("at").combine_chunks()
        at, times = lists.flatten().to_numpy(), documents.column("times").combine_chunks().flatten().to_numpy().astype(np.int64)
        begins = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
        out = {c: documents.column(c) for c in ("doc_id", *counts)}
        for name, per_pair in (("n_best", best), ("count_sum", n)):
            running = np.concatenate(([0], np.cumsum(per_pair[at] * times)))
            out[name] = pa.array(running[begins[1:]] - running[begins[:-1]])
        return pa.table(out | {"groups": documents.column("groups")})

    documents = aligned.filter("pairs IS NULL").drop("pairs", "held")
    return documents.groupBy("unit").cogroup(told.groupBy("to")).applyInArrow(
        summed, f"doc_id {kind}, {numbers}, n_best long, count_sum long, groups string"
    )


def op11_tokenizer_alignment(spark, folder: str) -> DataFrame:
    return summed_alignment(table(spark, folder, "documents")).withColumnRenamed("groups", "groups_sha256")


QUERIES = {"op11_tokenizer_alignment": op11_tokenizer_alignment}
ORACLE: dict[str, str] = {}
