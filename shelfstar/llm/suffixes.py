"""Exact removal of repeated 50-byte strings by column-wise construction over aligned fragments.

Every 50-byte window has a minimizer, its 24-byte piece of smallest hash (the first of equal ones). Equal windows have equal
minimizers at the same place, so windows need comparing only where minimizers meet, aligned at them. A run of
windows with one minimizer is a fragment of at most 76 bytes.

1. Texts are dealt to units. A unit sends the hashes of its minimizers, packed, to buckets of the hash space; a bucket
   answers with those that several units sent, and with those that very many sent. Fragments of minimizers that no second document
   has go no further.
2. A unit folds its equal fragments: those of its smallest document stand for all, the others are removed whole. So a passage that any
   number of documents share is one row per unit from here on. A minimizer that very many units have is met under its context too:
   every window holds the 13 bytes before it or the 13 after it, and goes with those.
3. The fragments that are left meet in buckets. There the collection's order is built column by column from the
   right: one symbol of every fragment is inserted per round by a stable sort on the symbol, which takes the order of the suffixes
   and the lengths of their common prefixes from one column to the next. Neighbours with a common prefix of 50 or
   more hold the same window, and the smallest document among them owns it.
4. Each unit cuts the bytes that its texts do not own.

Buckets are bounded and the shuffle files between the steps are read and written in sequence, so a round keeps its column in
memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfstar.llm.common import table, written
from shelfstar.llm.simhash import ascending, pack, unpack

LENGTH, PIECE = 50, 24
#: Bytes of text in a unit, hashes in a bucket of the first pass, fragments in a bucket of the second, on average.
UNIT, BUCKET, FRAGMENTS = 4 << 20, 1 << 20, 40_000
#: A minimizer that so many units have is met together with the bytes beside it.
WIDE = 64
SPARE_BITS = 6
#: Windows worked on at a time within a unit.
SLICE = 1 << 19
LAST = (1 << 63) - 1


def minimizers(data: np.ndarray, breaks: np.ndarray, length: int = LENGTH, piece: int = PIECE) -> tuple[np.ndarray, ...]:
    """Runs of windows with one minimizer: (first window, last window, place of the minimizer, its hash), places in `data`.
    No window reaches over a place in `breaks`, the ends of the texts in order."""
    out = []
    for at in range(0, max(0, len(data) - length + 1), SLICE):
        part = data[at : at + SLICE + length - 1]
        hashes = _piece_hashes(part, piece)
        value, place = _sliding_least(hashes, length - piece + 1)
        first = np.arange(len(value))
        text = np.searchsorted(breaks, at + first, side="right")
        whole = at + first + length <= breaks[np.minimum(text, len(breaks) - 1)]
        new = np.ones(len(value), bool)
        new[1:] = (place[1:] != place[:-1]) | (whole[1:] != whole[:-1]) | (text[1:] != text[:-1])
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(value)) - 1
        good = whole[begin]
        begin, end = begin[good], end[good]
        out.append((at + begin, at + end, at + place[begin], value[begin]))
    if not out:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _piece_hashes(data: np.ndarray, piece: int) -> np.ndarray:
    """A hash of the `piece` (a multiple of 8) bytes from each place on."""
    word = data.astype(np.uint64)
    for step in (1, 2, 4):
        word = word[:-step] | (word[step:] << np.uint64(8 * step))
    n = len(data) - piece + 1
    out = np.zeros(n, np.uint64)
    for k in range(0, piece, 8):
        out = (out ^ word[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out * np.uint64(0xD6E8FEB86659FD93)


def _sliding_least(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least of each `width` values and its first place."""
    value, place, span = values, np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        right = value[step:]
        left = value[: len(right)]
        less = right < left
        value, place = np.where(less, right, left), np.where(less, place[step:], place[: len(right)])
        span += step
    return value, place


def halves(
    data: np.ndarray, first: np.ndarray, last: np.ndarray, place: np.ndarray, value: np.ndarray, length: int = LENGTH, piece: int = PIECE
) -> tuple[np.ndarray, ...]:
    """Fragments in two: the windows that hold `half` bytes before the minimizer, under its hash and these bytes, and the others, which hold
    as many after it. (row, first, last, hash); a half without windows is left out. Equal windows come to equal hashes."""
    half = (length - piece) // 2
    out = []
    for side, begin, end, at in (
        (1, first, np.minimum(last, place - half), place - half),
        (2, np.maximum(first, place - half + 1), last, place + piece),
    ):
        row = np.flatnonzero(begin <= end)
        hashes = value[row] + np.uint64(side)
        for k in range(half):
            hashes = (hashes ^ data[at[row] + k]) * np.uint64(0x9E3779B97F4A7C15)
            hashes ^= hashes >> np.uint64(31)
        out.append((row, begin[row], end[row], hashes))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def owned_elsewhere(fragments: list[bytes], left: np.ndarray, docs: np.ndarray, length: int = LENGTH, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Per fragment the smallest and largest number of bytes left of the minimizer at which a window begins that a smaller document holds too; -1 for
    none. `left`: bytes of the fragment before its minimizer."""
    n, reach = len(fragments), length - piece
    sizes = np.fromiter(map(len, fragments), np.int64, n)
    symbols = np.full((reach + length, n), 256, np.int16)
    row = np.repeat(np.arange(n), sizes)
    column = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(reach - left, sizes)
    symbols[column, row] = np.frombuffer(b"".join(fragments), np.uint8)
    order, common = np.arange(n), np.zeros(n + 1, np.int16)
    least, most = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    for j in range(reach + length - 1, -1, -1):
        symbol = symbols[j][order]
        moved = np.argsort(symbol, kind="stable")
        after = symbol[moved]
        same = np.flatnonzero(after[1:] == after[:-1])
        grown = np.zeros(n + 1, np.int16)
        if len(same):
            ranges = np.stack((moved[same] + 1, moved[same + 1] + 1), axis=1).ravel()
            grown[same + 1] = np.minimum(np.minimum.reduceat(common, ranges)[::2] + 1, length)
        order, common = order[moved], grown
        back = reach - j
        if back >= 0:
            starts = np.flatnonzero(common[:n] < length)
            owner = np.minimum.reduceat(docs[order], starts)
            smaller = np.repeat(owner, np.diff(np.append(starts, n))) < docs[order]
            hit = order[smaller]
            hit = hit[(left[hit] >= back) & (sizes[hit] - left[hit] >= length - back)]
            least[hit] = np.where(least[hit] < 0, back, least[hit])
            most[hit] = back
    return least, most


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed, since they are shuffled twice."""
    pack_ = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        raw = pa.array([pack_(x) for x in batch.column("raw").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], raw], batch.schema.names)


def _unpacked(rows: pa.Table) -> list[bytes]:
    unpack_ = zstandard.ZstdDecompressor().decompress
    return [unpack_(x) for x in rows.column("raw").to_pylist()]


def _read(rows: pa.Table) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts of a unit, joined, and their ends."""
    texts = _unpacked(rows)
    return texts, np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts], dtype=np.int64)


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", wide: int = WIDE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary: the bytes left), spans (array of begin, end): one row per
    distinct (id, text).

    A null text counts as empty. Documents without an id order last and are not compared with each other; texts of one id
    are not either. Rows repeated in id and text give one row. An empty table gives no rows. Other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("hash"), F.encode(text, "utf-8").alias("raw")
    )
    light = written(
        rows.select("doc", "hash", F.octet_length("raw").cast("long").alias("size"), F.unhex(F.sha2("raw", 256)).alias("digest")), "suffix-sizes"
    )
    total = light.agg(F.sum("size")).first()[0] or 0
    units = max(1, -(-total // UNIT))
    around = 2 * total // (length - PIECE) + 1
    bits = min(60, max(16, int(around).bit_length() + SPARE_BITS))
    bucket_bits = max(0, int(around // BUCKET).bit_length())
    low = np.uint64(bits - bucket_bits)
    kind = np.uint32 if (1 << bits) > (1 << 14) * max(1, 2 * UNIT // (length - PIECE)) else np.uint16
    # Documents without an id are dealt by their texts, so that they are not all in one unit.
    unit = F.pmod(F.when(F.col("doc") == LAST, F.col("hash")).otherwise(F.xxhash64("doc")), F.lit(units)).alias("unit")

    # A text that a smaller document has whole is removed whole, and stands aside from the rest.
    owners = light.filter(F.col("size") >= length).groupBy("digest").agg(F.min("doc").alias("owner"), F.max("doc").alias("latest"))
    copies = written(
        light.join(owners.filter("owner < latest"), "digest").filter("doc > owner").select("doc", "hash", "size").distinct(), "suffix-copies"
    )
    dealt = rows.select(unit, "doc", "hash", "raw").mapInArrow(_packed, "unit long, doc long, hash long, raw binary")
    none = F.lit(None).cast("binary")
    aside = copies.select(unit, F.col("doc").alias("copy"), F.col("hash").alias("copy_hash"), none.alias("shared"), none.alias("wide"))

    def own(rows: pa.Table, told: pa.Table) -> pa.Table:
        """The texts of the unit that no smaller document has whole, each once."""
        gone = {x for x in zip(told.column("copy").to_pylist(), told.column("copy_hash").to_pylist(), strict=True) if x[1] is not None}
        seen, keep = set(gone), []
        for i, x in enumerate(zip(rows.column("doc").to_pylist(), rows.column("hash").to_pylist(), strict=True)):
            if x not in seen:
                seen.add(x)
                keep.append(i)
        return rows.take(pa.array(keep, pa.int64()))

    def send(rows: pa.Table, told: pa.Table) -> pa.Table:
        rows = own(rows, told)
        _, data, ends = _read(rows)
        keys = ascending(minimizers(data, ends, length)[3] >> np.uint64(64 - bits))[0]
        cuts = np.searchsorted(keys, np.arange((1 << bucket_bits) + 1, dtype=np.uint64) << low)
        mask = np.uint64((1 << int(low)) - 1)
        full = [i for i in range(1 << bucket_bits) if cuts[i] < cuts[i + 1]]
        packed = [pack(keys[cuts[i] : cuts[i + 1]] & mask, kind) for i in full]
        unit = rows.column("unit")[0].as_py() if full else 0
        return pa.table({"bucket": pa.array(full, pa.int64()), "unit": pa.array([unit] * len(full), pa.int64()), "keys": pa.array(packed, pa.binary())})

    def meet(rows: pa.Table) -> pa.Table:
        sent = [unpack(x.as_py(), kind) for x in rows.column("keys")]
        met = np.sort(np.concatenate(sent))
        shared = ascending(met)[1]
        far = max(0, len(met) - wide + 1)
        common = ascending(met[:far][met[:far] == met[wide - 1 :]])[0]
        high = np.uint64(rows.column("bucket")[0].as_py()) << low
        found = []
        for unit, keys in zip(rows.column("unit").to_pylist(), sent, strict=True):
            hits = np.intersect1d(keys, shared, assume_unique=True)
            if len(hits):
                found.append((unit, (hits | high).tobytes(), (np.intersect1d(hits, common, assume_unique=True) | high).tobytes()))
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        return pa.table({c: pa.array(v, t) for (c, t), v in zip((("unit", pa.int64()), ("shared", pa.binary()), ("wide", pa.binary())), columns, strict=True)})

    def answer(rows: pa.Table, told: pa.Table) -> pa.Table:
        rows = own(rows, told)
        _, data, ends = _read(rows)
        first, last, place, value = minimizers(data, ends, length)
        keys = value >> np.uint64(64 - bits)
        text = np.searchsorted(ends, first, side="right")
        order = np.lexsort((text, keys))
        k, t = keys[order], text[order]
        # Shared within the unit: the same key in two texts.
        begins = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.zeros(0, np.int64)
        size = np.diff(np.append(begins, len(k)))
        differ = t[begins] != t[begins + size - 1] if len(k) else np.zeros(0, bool)
        wanted = np.zeros(len(k), bool)
        wanted[order] = np.repeat(differ, size)
        sent = [np.frombuffer(x.as_py(), np.uint64) for x in told.column("shared") if x.is_valid]
        if sent:
            shared = np.sort(np.concatenate(sent))
            wanted |= shared[np.minimum(np.searchsorted(shared, keys), len(shared) - 1)] == keys
        sent = [np.frombuffer(x.as_py(), np.uint64) for x in told.column("wide") if x.is_valid]
        split = wanted & np.isin(keys, np.concatenate(sent)) if sent else np.zeros(len(keys), bool)
        whole = wanted & ~split
        row, begin, end, hashes = halves(data, *(x[split] for x in (first, last, place, value)), length)
        text = np.concatenate((text[whole], text[split][row]))
        place = np.concatenate((place[whole], place[split][row]))
        first, last, value = (np.concatenate((x[whole], y)) for x, y in ((first, begin), (last, end), (value, hashes)))
        base = (ends - np.diff(ends, prepend=0))[text]
        docs, hashes = rows.column("doc").to_numpy()[text], rows.column("hash").to_numpy()[text]
        left, raw = place - first, data.tobytes()
        parts = [raw[a:b] for a, b in zip(first.tolist(), (last + length).tolist(), strict=True)]

        # Equal fragments are folded: those of the smallest document stand for all.
        classes: dict[tuple, int] = {}
        each = np.array([classes.setdefault(x, len(classes)) for x in zip(value.tolist(), left.tolist(), parts, strict=True)], np.int64)
        least = np.full(len(classes), LAST, np.int64)
        np.minimum.at(least, each, docs)
        stands = docs == least[each]
        member = np.flatnonzero(stands)
        member = member[np.argsort(each[member], kind="stable")]
        heads = np.flatnonzero(np.diff(each[member], prepend=-1))
        sizes = np.diff(np.append(heads, len(member)))
        one = member[heads]
        pairs = np.stack((hashes[member], (place - base)[member]), axis=1)
        more = [pairs[h + 1 : h + n].tobytes() if n > 1 else None for h, n in zip(heads.tolist(), sizes.tolist(), strict=True)]
        # The others are removed whole; overlapping ones are one span. Texts do not overlap.
        gone = np.flatnonzero(~stands)
        gone = gone[np.argsort(first[gone], kind="stable")]
        reach = np.maximum.accumulate(last[gone] + length)
        new = np.flatnonzero(np.concatenate(([True], first[gone][1:] >= reach[:-1]))[: len(gone)])
        span = gone[new]
        until = reach[np.append(new[1:], len(gone)) - 1] if len(gone) else reach
        open_, decided = len(one), len(span)
        rest = pa.nulls(decided, pa.binary())
        return pa.table(
            {
                "key": pa.array(np.concatenate((value[one].view(np.int64), np.zeros(decided, np.int64)))),
                "doc": pa.array(np.concatenate((docs[one], docs[span]))),
                "hash": pa.array(np.concatenate((hashes[one], hashes[span]))),
                "place": pa.array(np.concatenate(((place - base)[one], (first - base)[span]))),
                "end": pa.array(np.concatenate((np.zeros(open_, np.int64), until - base[span]))),
                "left": pa.array(np.concatenate((left[one], np.zeros(decided, np.int64))).astype(np.int32)),
                "bytes": pa.chunked_array([pa.array([parts[i] for i in one.tolist()], pa.binary()), rest]),
                "members": pa.chunked_array([pa.array(more, pa.binary()), rest]),
            }
        )

    def compare(rows: pa.Table) -> pa.Table:
        left = rows.column("left").to_numpy().astype(np.int64)
        docs = rows.column("doc").to_numpy()
        least, most = owned_elsewhere(rows.column("bytes").to_pylist(), left, docs, length)
        hit = np.flatnonzero(most >= 0)
        members = rows.column("members").take(pa.array(hit)).to_pylist()
        pairs = np.stack((rows.column("hash").to_numpy()[hit], rows.column("place").to_numpy()[hit].astype(np.int64)), axis=1)
        pairs = [pairs, *[np.frombuffer(x, np.int64).reshape(-1, 2) for x in members if x]]
        row = np.concatenate((hit, np.repeat(hit, [len(x) // 16 if x else 0 for x in members]).astype(np.int64)))
        hashes, place = np.concatenate(pairs).T
        return pa.table(
            {
                "doc": pa.array(docs[row]),
                "hash": pa.array(hashes),
                "begin": pa.array(place - most[row]),
                "end": pa.array(place - least[row] + length),
            }
        )

    def cut(rows: pa.Table, spans: pa.Table) -> pa.Table:
        begin, end = spans.column("begin").to_numpy(), spans.column("end").to_numpy()
        by: dict[tuple, list] = {}
        for i, x in enumerate(zip(spans.column("doc").to_pylist(), spans.column("hash").to_pylist(), strict=True)):
            by.setdefault(x, []).append(i)
        out: dict[str, list] = {c: [] for c in ("doc", "n_bytes", "n_removed", "n_spans", "kept", "spans")}
        seen = set()
        for doc, text_hash, raw in zip(*(rows.column(c).to_pylist() for c in ("doc", "hash")), _unpacked(rows), strict=True):
            if (doc, text_hash) in seen:
                continue
            seen.add((doc, text_hash))
            runs, kept, at = [], [], 0
            for a, b in sorted((int(begin[i]), int(end[i])) for i in by.get((doc, text_hash), ())):
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], b)
                else:
                    runs.append([a, b])
            for a, b in runs:
                kept.append(raw[at:a])
                at = b
            kept.append(raw[at:])
            out["doc"].append(None if doc == LAST else doc)
            out["n_bytes"].append(len(raw))
            out["n_removed"].append(sum(b - a for a, b in runs))
            out["n_spans"].append(len(runs))
            out["kept"].append(b"".join(kept))
            out["spans"].append([{"begin": a, "end": b} for a, b in runs])
        span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        kinds = {"kept": pa.binary(), "spans": span}
        return pa.table({c if c != "doc" else "doc_id": pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()})

    by_unit = dealt.groupBy("unit")
    sent = by_unit.cogroup(aside.groupBy("unit")).applyInArrow(send, "bucket long, unit long, keys binary")
    met = sent.groupBy("bucket").applyInArrow(meet, "unit long, shared binary, wide binary")
    told = aside.union(met.select("unit", F.lit(None).cast("long"), F.lit(None).cast("long"), "shared", "wide"))
    fragments = written(
        dealt.groupBy("unit").cogroup(told.groupBy("unit")).applyInArrow(
            answer, "key long, doc long, hash long, place long, end long, left int, bytes binary, members binary"
        ),
        "suffix-fragments",
    )
    met_again = F.col("bytes").isNotNull()
    buckets = max(1, -(-fragments.where(met_again).count() // FRAGMENTS))
    spans = (
        fragments.where(met_again)
        .select(F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"), "doc", "hash", F.col("place").cast("int"), "left", "bytes", "members")
        .groupBy("bucket")
        .applyInArrow(compare, "doc long, hash long, begin long, end long")
    )
    spans = spans.union(fragments.where(~met_again).select("doc", "hash", F.col("place").alias("begin"), "end"))
    spans = spans.union(copies.select("doc", "hash", F.lit(0).cast("long"), "size"))
    placed = spans.select(unit, "doc", "hash", "begin", "end")
    return dealt.groupBy("unit").cogroup(placed.groupBy("unit")).applyInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<struct<begin:bigint,end:bigint>>"
    )


def op8_suffix_array_dedup(spark, folder: str) -> DataFrame:
    cut = remove_repeats(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op8_suffix_array_dedup": op8_suffix_array_dedup}
ORACLE: dict[str, str] = {}
