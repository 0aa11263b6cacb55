"""Personal data by a semi-Markov conditional random field over whole spans.

Base patterns find e-mail addresses, IP addresses, card and phone numbers. The field adds what they miss (a number written
in an unusual way, say): features look at a whole candidate span, and dynamic programming over spans of bounded length
chooses boundaries and types together. The field is fitted on a bounded sample of places that the base patterns
have labelled, half of them places without any.

Texts are decoded whole at the cost of their islands, the only places that can hold a span: runs of digits with no more than three
marks or spaces between two, and what stands around an `@`. A span is of a number kind only with the digits that kind has (a card
passes Luhn). A run of digits holds number spans only where they and the base spans take all of its digits: a piece of a longer
number, of a date or of a table is none. Long islands are decoded in windows, and a run of digits, which may be a long table, no
further than to the first digit that no span takes, since nothing behind it could make its spans hold. Any table of whole numbers can be cut into tens to
fifteens of digits, so in a run of more digits than four cards have the phones without `+` or `(` are all written alike, as in a list of phones, and not as
groups of one length, as in a table of years; cards and addresses show what they are by themselves. What stands around an `@` is an island as far as a span can reach: no text is left out for its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfstar.llm.common import table

#: Kinds in the order of ties. Fixed patterns.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

RUN = re.compile(r"[+(]{0,2}[0-9](?:[\x20()./+-]{0,3}[0-9])*")
TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]")
WORD = re.compile(r"[^\x20\t-\r]*")
#: Tokens of the longest span; islands and tokens of an island that the field is fitted on, rounds and step of the fit.
LONGEST, SAMPLE, SAMPLE_TOKENS, ROUNDS, STEP = 20, 600, 48, 60, 0.5
DIGIT, RUN_OF_DIGITS = re.compile(r"[0-9]"), re.compile(r"[0-9]+")
#: Digits of the least run that can be a number, without the dots of an IP address and with them, and of the longest run in which phones of digits
#: only may be written in several ways, on which the field is fitted too; characters on either side of an `@` that an island takes at least (LONGEST tokens where those reach farther), and tokens of a window.
LEAST_DIGITS, MOST_DIGITS, AROUND, WINDOW = (10, 4), 76, 100, 400
OTHER = len(KINDS)
#: As much of a word as the longest span holds.
WORD_TOKENS = re.compile(rf"(?:[A-Za-z]+|[0-9]+|[^A-Za-z0-9\x20\t-\r]){{0,{LONGEST}}}")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(begin, kind, end) of the base patterns, leftmost and without overlap within a kind."""
    found = []
    at, done = text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        m = DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            found.append((begin, "email", m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            found.append((m.start(), "ip", m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), "card", m.end()))
    for m in PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), "phone", m.end()))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def _back(text: str, begin: int, at: int, done: int) -> int:
    """Where the word that ends at `begin` starts, or the part of it that a span with the mark `at` can hold; no farther back than to
    `done`, where the island before ends."""
    tokens, last = 0, ""
    while begin > done and text[begin - 1] not in " \t\n\v\f\r":
        c = text[begin - 1]
        kind = "a" if c.isascii() and c.isalpha() else "1" if "0" <= c <= "9" else ""
        if not kind or kind != last:
            tokens, last = tokens + 1, kind
        if tokens > LONGEST and at - begin >= AROUND:
            break
        begin -= 1
    return begin


def islands(text: str) -> list[tuple[int, int, bool]]:
    """(begin, end, whether it is a run of digits) of the places where a span can be, in order. A run that touches what stands around an
    `@` is part of that."""
    mails: list[list[int]] = []
    at = text.find("@")
    while at >= 0:
        begin, end, done = at, at + 1, mails[-1][1] if mails else 0
        for _ in range(2):  # the word, or the one before and after where the mark stands alone
            begin = _back(text, begin, at, done)
            if at - begin or not text[max(0, begin - 1) : begin] == " ":
                break
            begin -= 1
        for _ in range(2):
            end = max(WORD_TOKENS.match(text, end).end(), WORD.match(text, end, max(end, at + AROUND)).end())
            if end - at > 1 or not text[end : end + 1] == " ":
                break
            end += 1
        if mails and begin <= mails[-1][1]:
            mails[-1][1] = max(mails[-1][1], end)
        else:
            mails.append([begin, end])
        at = text.find("@", at + 1)
    runs, k = [], 0
    for m in RUN.finditer(text):
        while k < len(mails) and mails[k][1] < m.start():
            k += 1
        if k < len(mails) and mails[k][0] < m.end() and m.start() < mails[k][1]:
            continue
        run = m[0]
        least = LEAST_DIGITS[run.count(".") >= 3]
        if len(run) >= least <= sum(map(str.isdigit, run)):
            runs.append((m.start(), m.end(), True))
    # Without a dot it holds no address, and without digits no number.
    kept = [(a, b, False) for a, b in mails if text.find(".", a, b) >= 0 or sum(map(str.isdigit, text[a:b])) >= LEAST_DIGITS[0]]
    return sorted([*kept, *runs])


def features(span: str, left: str, right: str) -> list[int]:
    """Which of the whole-span features hold; `left` and `right` are the characters beside it."""
    digits = "".join(c for c in span if "0" <= c <= "9")
    n, letters = len(digits), any("a" <= c.lower() <= "z" for c in span)
    dots, ats = span.count("."), span.count("@")
    parts = span.split(".")
    number = all(c in "0123456789 ()+-." for c in span)
    tests = (
        True,
        ats == 1,
        ats == 1 and "." in span[span.find("@") :] and span[-1].isalnum() and span[0] != "@",
        ats == 1 and any(c in LOCAL for c in left) and span[0] in LOCAL,
        ats == 1 and any(c in LOCAL for c in right) and right not in (".", ""),
        ats > 1 or (ats == 0 and letters),
        number and len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts),
        number and dots == 3 and n <= 12,
        number and span[:1] == "+",
        number and span[:1] == "+" and 10 <= n <= 15,
        number and "(" in span and ")" in span,
        number and 10 <= n <= 11,
        number and 14 <= n <= 19,
        number and 14 <= n <= 19 and luhn(digits),
        number and n < 7,
        number and n > 19,
        number and not span[-1:].isdigit(),
        number and not (span[:1].isdigit() or span[:1] == "+"),
        left.isalnum() and left.isascii(),
        right.isalnum() and right.isascii(),
        left == "+",
        number and " " in span,
        number and "-" in span,
        not number,
    )
    return [k for k, holds in enumerate(tests) if holds]


#: Number of features.
N_FEATURES = 24


def allowed(span: str) -> tuple[bool, ...]:
    """Whether a span can be of each kind at all."""
    at = span.find("@")
    mail = at > 0 and "@" not in span[at + 1 :] and "." in span[at:] and span[0] in LOCAL and span[-1].isalnum()
    if at >= 0 or not (span[-1].isdigit() and (span[0].isdigit() or span[0] in "+(")):
        return mail, False, False, False
    if any(c not in "0123456789 ()+-./" for c in span):
        return False, False, False, False
    digits = "".join(c for c in span if c.isdigit())
    parts = span.split(".")
    ip = len(parts) == 4 and all(x.isdigit() and len(x) <= 3 and int(x) <= 255 for x in parts)
    return False, ip, 14 <= len(digits) <= 19 and span[0] not in "+(" and luhn(digits), 10 <= len(digits) <= 15 and "." not in span[:2]


def candidates(island: str, before: str = "", after: str = "") -> tuple[list[int], dict[tuple[int, int], tuple[list[int], tuple[bool, ...]]]]:
    """Token boundaries; and of every single token and every span (first token, token after the last) that can be of some kind, its
    features and the kinds it can be. `before` and `after` are the characters beside the island."""
    ends = [m.end() for m in TOKEN.finditer(island)]
    at = [0, *ends]
    spans = {}
    for i in range(len(ends)):
        for j in range(i + 1, min(len(ends), i + LONGEST) + 1):
            span = island[at[i] : at[j]]
            kinds = allowed(span)
            if j - i == 1 or any(kinds):
                left, right = island[at[i] - 1 : at[i]] if at[i] else before, island[at[j] : at[j] + 1] or after
                spans[i, j] = features(span, left, right), kinds
            if j - i == 1 and not (span[0].isalnum() or span in "+(" or span[0] in LOCAL):
                break  # no kind begins so
    return at, spans


class Field:
    """Weights of (feature, type) and of a type after another; the type OTHER is a single token outside of spans."""

    def __init__(self, weights: np.ndarray, follow: np.ndarray) -> None:
        self.weights, self.follow = weights, follow

    def decode(self, island: str, before: str = "", after: str = "") -> list[tuple[int, str, int]]:
        """The best segmentation's spans."""
        return [span for _, _, found in self.windows(island, before, after) for span in found]

    def windows(self, island: str, before: str = "", after: str = "") -> Iterator[tuple[int, int, list[tuple[int, str, int]]]]:
        """Begin, end and spans of the island. Of one of more tokens than a window, those of each window up to a boundary LONGEST
        tokens before its end; the next window begins there."""
        cut = [m.end() for m in TOKEN.finditer(island)]
        if len(cut) <= WINDOW:
            yield 0, len(island), self._decode(island, before, after)[0]
            return
        begin, first = 0, 0
        while begin < len(island):
            last = min(first + WINDOW, len(cut))
            end = cut[last - 1]
            left, right = island[begin - 1 : begin] if begin else before, island[end : end + 1] or after
            found, places = self._decode(island[begin:end], left, right)
            stop = end if last == len(cut) else begin + max(p for p in places if p <= cut[last - LONGEST - 1] - begin)
            yield begin, stop, [(a + begin, kind, b + begin) for a, kind, b in found if b + begin <= stop]
            begin, first = stop, int(np.searchsorted(cut, stop, side="right"))

    def _decode(self, island: str, before: str, after: str) -> tuple[list[tuple[int, str, int]], list[int]]:
        """Spans, and the boundaries of all segments."""
        at, spans = candidates(island, before, after)
        n = len(at) - 1
        best = np.full((n + 1, OTHER + 1), -np.inf)
        back: dict[tuple[int, int], tuple[int, int]] = {}
        best[0, OTHER] = 0.0
        into: list[list[tuple[int, list[int], tuple[bool, ...]]]] = [[] for _ in range(n + 1)]
        for (i, j), (held, kinds) in spans.items():
            into[j].append((i, held, kinds))
        for j in range(1, n + 1):
            for i, held, kinds in into[j]:
                score = self.weights[held].sum(axis=0)
                score[[*(not k for k in kinds), j - i > 1]] = -np.inf
                came = best[i][:, None] + self.follow
                last = came.argmax(axis=0)
                total = came[last, np.arange(OTHER + 1)] + score
                for y in np.flatnonzero(total > best[j]):
                    best[j, y] = total[y]
                    back[j, int(y)] = (i, int(last[y]))
        out, places, j, y = [], [n and at[n]], n, int(best[n].argmax())
        while j > 0:
            i, last = back[j, y]
            if y != OTHER:
                out.append((at[i], KINDS[y], at[j]))
            places.append(at[i])
            j, y = i, last
        return out[::-1], places


def _labels(island: str, at: list[int]) -> list[tuple[int, int, int]] | None:
    """The island cut into (first token, token after the last, type) by the base patterns; None where they overlap or do not fit."""
    place = {p: k for k, p in enumerate(at)}
    out, done = [], 0
    for begin, kind, end in base_spans(island):
        if begin not in place or end not in place or place[begin] < done or place[end] - place[begin] > LONGEST:
            return None
        out += [(k, k + 1, OTHER) for k in range(done, place[begin])]
        done = place[end]
        out.append((place[begin], done, KINDS.index(kind)))
    return out + [(k, k + 1, OTHER) for k in range(done, len(at) - 1)]


def fit(sample: list[str]) -> Field:
    """The weights of greatest conditional likelihood, by gradient steps over all islands of the sample at once. An empty sample
    gives a field that finds nothing."""
    types = OTHER + 1
    cases = []
    for island in sample:
        at, spans = candidates(island)
        gold = _labels(island, at)
        if gold is not None and len(at) - 1 <= SAMPLE_TOKENS and all((i, j) in spans for i, j, _ in gold):
            cases.append((len(at) - 1, spans, gold))
    weights, follow = np.zeros((N_FEATURES, types)), np.zeros((types, types))
    weights[0, :OTHER] = -4.0
    if not cases:
        return Field(weights, follow)
    size, rows = max(c[0] for c in cases), len(cases)
    lengths = np.array([c[0] for c in cases])
    keys = [(r, i, j) for r, (_, spans, _) in enumerate(cases) for i, j in spans]
    held, barred = np.zeros((len(keys), N_FEATURES)), np.zeros((len(keys), types), bool)
    for k, (r, i, j) in enumerate(keys):
        found, kinds = cases[r][1][i, j]
        held[k, found] = 1.0
        barred[k] = [*(not x for x in kinds), j - i > 1]
    r_, i_, j_ = np.array(keys).T
    where = {key: k for k, key in enumerate(keys)}
    want, want_follow = np.zeros((len(keys), types)), np.zeros((types, types))
    for r, (_, _, gold) in enumerate(cases):
        before = OTHER
        for i, j, y in gold:
            want[where[r, i, j], y] += 1
            want_follow[before, y] += 1
            before = y
    by_end = [np.flatnonzero(j_ == j) for j in range(size + 1)]
    by_begin = [np.flatnonzero(i_ == i) for i in range(size + 1)]
    for step in range(ROUNDS):
        score = held @ weights
        score[barred] = -1e9
        ahead = np.full((rows, size + 1, types), -1e9)
        ahead[:, 0, OTHER] = 0.0
        for j in range(1, size + 1):
            k = by_end[j]
            into = _log_sum(ahead[r_[k], i_[k]][:, :, None] + follow[None], 1) + score[k]
            np.logaddexp.at(ahead[:, j], r_[k], into)
        behind = np.full((rows, size + 1, types), -1e9)
        behind[np.arange(rows), lengths] = 0.0
        for i in range(size - 1, -1, -1):
            k = by_begin[i]
            out = _log_sum(follow[None] + (score[k] + behind[r_[k], j_[k]])[:, None, :], 2)
            np.logaddexp.at(behind[:, i], r_[k], out)
        whole = behind[:, 0, OTHER]
        arc = ahead[r_, i_][:, :, None] + follow[None] + (score + behind[r_, j_])[:, None, :] - whole[r_][:, None, None]
        chance = np.exp(np.minimum(arc, 0.0))
        rate = STEP / (1 + step / 20)
        weights += rate * (held.T @ (want - chance.sum(axis=1)) / rows * 4 - 1e-3 * weights)
        follow += rate * ((want_follow - chance.sum(axis=0)) / rows - 1e-3 * follow)
    return Field(weights, follow)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def find_spans(text: str, field: Field) -> tuple[list, list]:
    """Base spans, and all spans: the base ones with those of the field that overlap none of them."""
    base = base_spans(text)
    every, taken, k = list(base), _merged(base), 0
    for begin, end, number in islands(text):
        while k < len(taken) and taken[k][1] <= begin:
            k += 1
        near = _from(taken, k, end)
        # An island that base spans cover but for punctuation has no room for another span.
        if not _rest(text, begin, end, near):
            continue
        island = text[begin:end]
        found, n, ways = [], 0, set()
        long = number and sum(map(str.isdigit, island)) > MOST_DIGITS
        for first, last, spans in field.windows(island, text[begin - 1 : begin] if begin else "", text[end : end + 1]):
            while n < len(near) and near[n][1] <= begin + first:
                n += 1
            here = _from(near, n, begin + last)
            new = [(a + begin, kind, b + begin) for a, kind, b in spans]
            new = [f for f in new if all(f[2] <= x or f[0] >= y for x, y in here)]
            if long:
                ways |= {DIGIT.sub("0", text[a:b]) for a, kind, b in new if kind == "phone" and text[a] not in "+("}
            if len(ways) > 1 or any(map(_even, ways)) or number and _rest(text, begin + first, begin + last, _merged([*((a, "", b) for a, b in here), *new])):
                break
            found += new
        else:
            every += found
    return base, sorted(every, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def _even(way: str) -> bool:
    """Whether a number is written in several groups, all of one length."""
    groups = RUN_OF_DIGITS.findall(way)
    return len(groups) > 1 and len({len(g) for g in groups}) == 1


def _from(ranges: list[tuple[int, int]], first: int, end: int) -> list[tuple[int, int]]:
    """The ranges from the `first` on that begin before `end`."""
    last = first
    while last < len(ranges) and ranges[last][0] < end:
        last += 1
    return ranges[first:last]


def _merged(spans: list) -> list[tuple[int, int]]:
    """What spans cover, as ranges apart from each other."""
    out: list[tuple[int, int]] = []
    for a, _, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _rest(text: str, begin: int, end: int, covered: list[tuple[int, int]]) -> bool:
    """Whether a digit or `@` of an island is outside of what is covered."""
    at = begin
    for a, b in [*covered, (end, end)]:
        if any(c.isdigit() or c == "@" for c in text[at : max(at, a)]):
            return True
        at = max(at, b)
    return False


def said(spans: list) -> str:
    return ",".join(f"{kind}:{begin}:{end}" for begin, kind, end in spans)


def sample_of(docs: DataFrame, text_col: str = "text", bound: int = SAMPLE) -> list[str]:
    """At most `bound` islands, those of smallest hash among all islands of all texts, each text of an island once: up to half
    of them with base spans and up to half without."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = {t[a:b] for t in batch.column(0).to_pylist() if t for a, b, _ in islands(t) if b - a <= 2 * AROUND}
            seen = {x for x in every if "@" in x or sum(map(str.isdigit, x)) <= MOST_DIGITS}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(seen), pa.string())], ["island"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(found, "island string").distinct()

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base = [bool(base_spans(x)) for x in batch.column("island").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("island"), pa.array(base, pa.bool_())], ["island", "base"])

    rows = rows.mapInArrow(marked, "island string, base boolean")
    least = F.min(F.struct(F.xxhash64("island").alias("hash"), "island"))
    # The least of each of many parts, then the least of those, so that no sort holds all islands.
    parts = bound // 2
    kept = rows.groupBy("base", F.pmod(F.hash("island"), F.lit(parts)).alias("part")).agg(least.alias("least"))
    return [r["island"] for r in kept.select("least.*").orderBy("hash", "island").collect()]


def detect(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base, spans (texts kind:begin:end, in code points): a row per input
    row. Null texts count as empty. Repeated rows and null ids are read like any other. Other columns are not looked at."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, texts = [], ([], [])
            for text in batch.column("text").to_pylist():
                base, every = find_spans(text or "", field)
                counts.append([sum(kind == k for _, kind, _ in base) for k in KINDS])
                texts[0].append(said(base))
                texts[1].append(said(every))
            table_ = np.array(counts, np.int64).reshape(-1, len(KINDS))
            columns = [pa.array(table_[:, k]) for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, pa.array(texts[0], pa.string()), pa.array(texts[1], pa.string())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(read, f"doc_id {kind}, {counts}, base string, spans string")


def masked(text: str, spans: list) -> str:
    """A text with each span replaced by its kind; overlapping spans become one, of the first's kind."""
    out, at = [], 0
    for begin, kind, end in spans:
        if begin >= at:
            out += [text[at:begin], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with the spans in its texts replaced, all columns and rows kept; null texts stay null."""
    field = fit(sample_of(docs, text_col))
    at = docs.columns.index(text_col)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t and masked(t, find_spans(t, field)[1]) for t in batch.column(at).to_pylist()]
            columns = [*batch.columns]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(replace, docs.schema)


def op6_pii(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = detect(docs, fit(sample_of(docs)))
    return found.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2("base", 256).alias("base_sha256"), "spans")


QUERIES = {"op6_pii": op6_pii}
ORACLE: dict[str, str] = {}
