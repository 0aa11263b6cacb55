"""SentencePiece encoding and decoding with the N best segmentations.

A segmentation is a path through the lattice of vocabulary pieces; its score is the sum of the pieces' log-probabilities. A
forward Viterbi pass scores the best way to each place. These scores are exact estimates of what remains for a search
backwards from the end, so A-star reaches the start with the best segmentation first, then the second best, and so on.

No piece of the vocabulary holds a space after another character, and none a line feed, so the lattice of a text falls apart into
those of its words, which recur: their best segmentations are kept by each task in a table of bounded size. The best
segmentations of a text differ from the very best only in words where the second choice costs least.

The vocabulary is that of a given model file. Its pieces are ranked by frequency; a piece's log-probability follows from
its rank by Zipf's law. Nothing is trained. Characters that no piece holds are spelled in byte pieces, so that every text
comes back as it was.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Collection, Iterator
from itertools import chain, product
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfstar.llm.common import table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BEST = 3
#: Words a task keeps, the table starts anew beyond it; characters of the longest word kept; words learnt together, and side by side.
KEPT, LONG, TOGETHER, ASIDE = 700_000, 32, 150_000, 20_000
FACTOR, MASK, PREFIX = 0x9E3779B97F4A7C15, (1 << 64) - 1, 20
#: Offset of the rank in Zipf's law, and log-probability of a byte piece.
ZIPF, BYTE = 2.7, -18.0
#: Pieces scored below this (runs of spaces) have no rank and count as the rarest.
UNRANKED = -1e8
#: Ids sent on at a time.
FLUSH = 1 << 20


class Vocabulary:
    """Pieces as texts with plain spaces, their ids and log-probabilities; ids of the 256 bytes; what each id decodes to."""

    def __init__(self, pieces: list[tuple[str, float, str]]) -> None:
        self.pieces: dict[str, tuple[int, float]] = {}
        self.bytes: list[int] = [-1] * 256
        self.spelled: list[bytes] = []
        ranks = [-s for _, s, kind in pieces if kind == "piece" and s > UNRANKED]
        mass = log(sum(1 / (r + ZIPF) for r in ranks)) if ranks else 0.0
        for i, (text, score, kind) in enumerate(pieces):
            spelled = b""
            if kind == "byte":
                value = int(text[3:5], 16)
                self.bytes[value], spelled = i, bytes([value])
            elif kind == "piece":
                plain = text.replace("▁", " ")
                spelled = plain.encode()
                self.pieces[plain] = (i, -log(ZIPF + (-score if score > UNRANKED else len(pieces))) - mass)
            self.spelled.append(spelled)
        self.longest = max(map(len, self.pieces), default=1)
        apart = not any(" " in p.lstrip(" ") or "\n" in p for p in self.pieces)
        self.word = re.compile(r"\n| *[^ \n]+| +" if apart else r"(?s).+")

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        kind = lambda i: "byte" if model.is_byte(i) else "other" if model.is_control(i) or model.is_unknown(i) else "piece"
        return cls([(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.get_piece_size())])


def lattice(word: str, vocabulary: Vocabulary) -> list[list[tuple[int, float, tuple[int, ...]]]]:
    """For each place the arcs that end there: (begin, log-probability, ids)."""
    arcs: list[list] = [[] for _ in range(len(word) + 1)]
    for end in range(1, len(word) + 1):
        for begin in range(max(0, end - vocabulary.longest), end):
            piece = vocabulary.pieces.get(word[begin:end])
            if piece:
                arcs[end].append((begin, piece[1], (piece[0],)))
        if word[end - 1] not in vocabulary.pieces:
            raw = word[end - 1].encode()
            arcs[end].append((end - 1, BYTE * len(raw), tuple(vocabulary.bytes[b] for b in raw)))
    return arcs


def n_best(word: str, vocabulary: Vocabulary, n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n best segmentations (score, ids), best first; of equal scores in the order of the search, which is the same each time."""
    arcs = lattice(word, vocabulary)
    ahead = [0.0] * (len(word) + 1)
    for end in range(1, len(word) + 1):
        ahead[end] = max(ahead[begin] + score for begin, score, _ in arcs[end])
    # (minus the best total through this state, place, order, score behind it, ids behind it as linked pairs). Of equal
    # totals the one nearest the start goes first; a place is left at most n times, as no more of its ways can matter.
    queue: list = [(-ahead[-1], len(word), 0, 0.0, None)]
    out, count, left = [], 0, [0] * (len(word) + 1)
    while queue and len(out) < n:
        _, at, _, behind, path = heapq.heappop(queue)
        left[at] += 1
        if left[at] > n:
            continue
        if at == 0:
            ids: list[int] = []
            while path:
                ids += path[0]
                path = path[1]
            out.append((behind, tuple(ids)))
            continue
        for begin, score, ids in arcs[at]:
            count += 1
            heapq.heappush(queue, (-round(ahead[begin] + score + behind, 9), begin, count, score + behind, (ids, path)))
    return out


class Encoder:
    """Encodes texts and remembers words. New words are segmented many at a time, side by side from the longest on: the forward pass
    takes the best and the second best score to each place. Only words whose second choice is among a text's cheapest are
    searched for their n best."""

    def __init__(self, vocabulary: Vocabulary, n: int = BEST, kept: int = KEPT) -> None:
        self.vocabulary, self.n, self.kept = vocabulary, n, kept
        self.known: dict[str, tuple[bytes, float, float]] = {}
        self.searched: dict[str, list] = {}
        texts = list(vocabulary.pieces)
        hashes = np.array([self._hash(t) for t in texts], np.uint64) * np.uint64(FACTOR)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.ids = np.array([vocabulary.pieces[t][0] for t in texts], np.int32)[order]
        self.scores = np.array([vocabulary.pieces[t][1] for t in texts])[order]
        # Pieces by the first bits of their hashes: where those with these bits begin, whether there are any, and the most that share them.
        begins = np.arange(1 << PREFIX, dtype=np.uint64) << np.uint64(64 - PREFIX)
        starts = np.append(np.searchsorted(self.hashes, begins), len(texts))
        self.starts, self.any, self.shared = starts[:-1].astype(np.int32), np.diff(starts) > 0, int(np.diff(starts).max(initial=1))

    @staticmethod
    def _hash(text: str) -> int:
        h = 0
        for c in text:
            h = (h * FACTOR + ord(c) + 1) & MASK
        return h

    def best(self, word: str) -> list:
        got = self.searched.get(word)
        if got is None:
            if len(self.searched) >= self.kept // 8:
                self.searched.clear()
            got = n_best(word, self.vocabulary, self.n)
            if len(word) <= LONG:
                self.searched[word] = got
        return got

    def learn(self, words: Collection[str]) -> None:
        """Puts ids, score and loss of the second best of new words into `known`."""
        if len(self.known) + len(words) > self.kept:
            self.known.clear()
        aside, alone = [], []
        for word in words:
            if word not in self.known:
                (aside if len(word) <= LONG and "\0" not in word else alone).append(word)
        aside.sort(key=len, reverse=True)
        for k in range(0, len(aside), ASIDE):
            alone += self._together(aside[k : k + ASIDE])
        for word in alone:
            best = self.best(word)
            loss = best[0][0] - best[1][0] if len(best) > 1 else float("inf")
            self.known[word] = (np.array(best[0][1], np.int32).tobytes(), best[0][0], loss)

    def _together(self, words: list[str]) -> list[str]:
        """Words by falling length; returns those with characters that no piece holds."""
        size, rows = len(words[0]), len(words)
        sizes, every = np.array(list(map(len, words))), np.arange(rows)
        reach = np.searchsorted(-sizes, -np.arange(size + 1), "right").tolist()  # the first so many words have this length or more
        codes = np.array(words, f"U{size}").view(np.uint32).reshape(-1, size).T.astype(np.uint64, order="C") + np.uint64(1)
        first, second = np.full((size + 1, rows), -np.inf), np.full((size + 1, rows), -np.inf)
        came, by = np.zeros((size + 1, rows), np.int8), np.full((size + 1, rows), -1, np.int32)
        first[0] = 0.0
        spelled = np.zeros(rows, bool)  # words with a character that bytes spell are left to the search
        for begin in range(size):
            h = np.zeros(rows, np.uint64)
            for end in range(begin + 1, min(size, begin + self.vocabulary.longest) + 1):
                h = h[: reach[end]] * np.uint64(FACTOR) + codes[end - 1, : reach[end]]
                mixed = h * np.uint64(FACTOR)
                bits = (mixed >> np.uint64(64 - PREFIX)).astype(np.int64)
                hit = np.flatnonzero(self.any[bits])
                mixed, at = mixed[hit], self.starts[bits[hit]]
                found = self.hashes[at] == mixed
                for _ in range(1, self.shared):
                    at = np.where(found, at, np.minimum(at + 1, len(self.hashes) - 1))
                    found = self.hashes[at] == mixed
                hit, at = hit[found], at[found]
                if end == begin + 1:
                    lacks = np.ones(reach[end], bool)
                    lacks[hit] = False
                    spelled[: reach[end]] |= lacks
                if not len(hit):
                    continue
                one, two = first[begin, hit] + self.scores[at], second[begin, hit] + self.scores[at]
                old = first[end, hit]
                better = one > old
                second[end, hit] = np.maximum(np.maximum(np.minimum(one, old), second[end, hit]), two)
                first[end, hit] = np.where(better, one, old)
                came[end, hit[better]] = begin
                by[end, hit[better]] = self.ids[at[better]]
        whole, runner_up = first[sizes, every], second[sizes, every]
        reached = np.isfinite(whole) & ~spelled
        out = np.zeros((rows, size), np.int32)
        place, taken = np.where(reached, sizes, 0), np.zeros(rows, np.int64)
        while (going := every[place > 0]).size:
            taken[going] += 1
            out[going, size - taken[going]] = by[place[going], going]
            place[going] = came[place[going], going]
        raw, score = out.tobytes(), whole.tolist()
        loss = (np.where(reached, whole, 0.0) - runner_up).tolist()
        alone = []
        for k, (word, ok, n) in enumerate(zip(words, reached.tolist(), taken.tolist(), strict=True)):
            if ok:
                self.known[word] = (raw[4 * ((k + 1) * size - n) : 4 * (k + 1) * size], score[k], loss[k])
            else:
                alone.append(word)
        return alone

    def split(self, text: str) -> list[str]:
        return self.vocabulary.word.findall(" " + text) if text else []

    def encode(self, text: str) -> tuple[bytes, list[float], list[list[tuple[int, int, tuple[int, ...]]]]]:
        """Ids of the best segmentation (32-bit), scores of the n best, and for each of the n the places where it differs
        from the best: (index of the first id, number of ids replaced, ids instead). A text gets a space in front."""
        return next(self.encode_split([self.split(text)]))

    def encode_split(self, texts: list[list[str]]) -> Iterator[tuple[bytes, list[float], list[list[tuple[int, int, tuple[int, ...]]]]]]:
        """`encode` of texts split into words. Each word is looked up once for all of them, and its figures lie side by side."""
        words = list(chain.from_iterable(texts))
        apart = list(dict.fromkeys(words))
        self.learn(apart)
        known = [self.known[w] for w in apart]
        ids, scores, losses = [k[0] for k in known], np.array([k[1] for k in known]).tolist(), np.array([k[2] for k in known]).tolist()
        number = dict(zip(apart, range(len(apart)), strict=True))
        places, begin = list(map(number.__getitem__, words)), 0
        for parts in texts:
            mine = places[begin : begin + len(parts)]
            begin += len(parts)
            yield self._joined(parts, *[list(map(figure.__getitem__, mine)) for figure in (ids, scores, losses)])

    def _joined(self, parts: list[str], raw: list[bytes], score: list[float], losses: list[float]):
        if not parts:
            return b"", [0.0], [[]]
        ids, score = b"".join(raw), sum(score)
        # Only the n - 1 words that lose least can differ in one of the n best.
        open_words = []
        while len(open_words) < self.n - 1 and (least := min(losses)) < float("inf"):
            open_words.append(losses.index(least))
            losses[open_words[-1]] = float("inf")
        best = {k: self.best(parts[k]) for k in open_words}
        choices = []
        for picks in product(*[range(len(best[k])) for k in open_words]):
            lost = sum(best[k][0][0] - best[k][p][0] for k, p in zip(open_words, picks, strict=True))
            choices.append((lost, picks))
        choices = heapq.nsmallest(self.n, choices)
        at = {k: sum(map(len, raw[:k])) // 4 for k in open_words}
        scores, changes = [], []
        for lost, picks in choices:
            scores.append(score - lost)
            change = []
            for k, p in sorted(zip(open_words, picks, strict=True)):
                if p:
                    change.append((at[k], len(raw[k]) // 4, best[k][p][1]))
            changes.append(change)
        return ids, scores, changes


def decode(ids: list[int], vocabulary: Vocabulary) -> str:
    """The text of a segmentation: its pieces put together, less the space in front."""
    raw = b"".join(map(vocabulary.spelled.__getitem__, ids))
    return raw[1:].decode() if raw else ""


def changed(ids: list[int], change: list[tuple[int, int, tuple[int, ...]]]) -> list[int]:
    """The ids of a segmentation that differs from the best as said."""
    out, at = [], 0
    for begin, size, instead in change:
        out += [*ids[at:begin], *instead]
        at = begin + size
    return out + ids[at:]


def encode_texts(docs: DataFrame, model: str = MODEL, n: int = BEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_pieces, ids (best segmentation), scores (of the n best, best first), changes (where each of the others differs from
    the best: at, size, ids), round_trip (the ids decode to the text): a row per input row.

    A null text has null ids, scores and changes, no pieces and a true round trip; an empty one has no pieces and the score 0. A
    text with fewer segmentations than n has fewer scores. Repeated rows and null ids are encoded like any other, an
    empty table gives no rows, and other columns are not looked at.
    """
    vocabulary = Vocabulary.read(model)  # bounded: tens of thousands of pieces
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    change = pa.struct([("at", pa.int32()), ("size", pa.int32()), ("ids", pa.list_(pa.int32()))])
    names = ["doc_id", "n_pieces", "ids", "scores", "changes", "round_trip"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, spelled = Encoder(vocabulary, n), vocabulary.spelled
        for batch in batches:
            texts = batch.column("text")
            first, held, out = 0, 0, ([], [], [], [])
            left = 0
            for k in range(len(texts)):
                text = texts[k].as_py()
                if not left:  # words of the texts to come are learnt and looked up together
                    ahead, size = [], 0
                    for j in range(k, len(texts)):
                        ahead.append(encoder.split(texts[j].as_py() or ""))
                        size += len(ahead[-1])
                        if size > TOGETHER:
                            break
                    encoded, left = encoder.encode_split(ahead), len(ahead)
                ids, scores, changes = next(encoded)
                left -= 1
                ints = np.frombuffer(ids, np.int32)
                whole = b"".join(map(spelled.__getitem__, ints.tolist())) == (b" " + text.encode() if text else b"")
                out[0].append(ints)
                out[1].append(None if text is None else scores)
                out[2].append(None if text is None else [[{"at": a, "size": s, "ids": i} for a, s, i in c] for c in changes[1:]])
                out[3].append(whole)
                held += len(ints)
                if held > FLUSH or k == len(texts) - 1:
                    yield flush(batch.slice(first, k + 1 - first), out)
                    first, held, out = k + 1, 0, ([], [], [], [])

    def flush(rows: pa.RecordBatch, out: tuple) -> pa.RecordBatch:
        sizes = np.array([len(i) for i in out[0]], np.int32)
        null = np.array([s is None for s in out[1]])
        offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32), mask=np.append(null, False))
        ids = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(out[0])))
        return pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(sizes), ids, pa.array(out[1], pa.list_(pa.float64())), pa.array(out[2], pa.list_(pa.list_(change))), pa.array(out[3])],
            names,
        )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        encode,
        f"doc_id {kind}, n_pieces int, ids array<int>, scores array<double>, changes array<array<struct<at:int,size:int,ids:array<int>>>>, round_trip boolean",
    )


def op1_sentencepiece(spark, folder: str) -> DataFrame:
    return encode_texts(table(spark, folder, "documents"))


QUERIES = {"op1_sentencepiece": op1_sentencepiece}
ORACLE: dict[str, str] = {}
