"""Near-duplicate detection by SimHash, with meet-in-the-middle ball hashing.

Fingerprints at most 2r bits apart have a fingerprint between them that is at most r bits from either. So every distinct
fingerprint emits all variants within half the radius, and fingerprints that emit a common variant are linked.
For r = 2 that is 2,081 variants each; they meet in two passes, so that the shuffle stays small:

1. Fingerprints are dealt to units. A unit sorts short keys of all its variants and sends each bucket of the key
   space one packed list, about two bytes a variant. A bucket finds the keys that several units sent.
2. Each unit gets back the keys it shares with others, and sends whole variants for these only. Units and keys are
   bounded in size, whatever the corpus.

All holders of a variant are within the radius of each other, so linking each to the smallest of them
loses no link between components and makes no pairs within a group.

Texts of a shingle similarity of 0.8 differ in about ten bits, and no ball of half that radius can be sent. Where near copies
are asked for by similarity, texts meet on bands of least shingle hashes as well as by their fingerprints, and those that meet are
verified by their exact similarity, since a repeated shingle can give unlike texts one fingerprint: each with the hubs of the bucket, then, where it still holds several components, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfstar.llm.common import SPACES, ascii_lower, table, written
from shelfstar.llm.components import components

SEED = 42
#: Fingerprints a unit holds on average, and variant keys a bucket holds on average.
UNIT, BUCKET = 2048, 1 << 22
#: Bits of a key beyond those that number the variants; a false meeting costs a row in the second pass.
SPARE_BITS = 6
SLICE = 1 << 16
#: Hubs of a key in each round; after that, holders of a key in a block, and rows of a task that compares blocks.
HUBS, BLOCK, CELL_ROWS = (1, 8), 512, 8192
#: Bands of least hashes, and hashes in a band: of pairs at a similarity of 0.8 one in 80 shares none, and at 0.5 one in eleven
#: shares any.
BANDS, BAND = 24, 8
_ODD = np.random.default_rng(7).integers(1 << 63, size=BANDS * BAND, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of the `shingle`-word shingles in order, a slice at a time; one of the whole sequence where there are fewer words."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, SLICE):
        pairs = zip(begins[at : at + SLICE], ends[at : at + SLICE], strict=True)
        yield np.array([digest(joined[a:b], SEED) for a, b in pairs], np.uint64)


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of the `shingle`-word shingles, repeats included: 64 bits, each 1 if set in over half the hashes."""
    return sketch(text, shingle, False)[0]


def sketch(text: str | None, shingle: int, banded: bool) -> tuple[int, np.ndarray | None]:
    """The fingerprint and, if `banded`, a hash of each band of least shingle hashes (none for a text without words)."""
    n, counts = 0, np.zeros(64, np.int64)
    least = np.full(BANDS * BAND, np.iinfo(np.uint64).max, np.uint64)
    for hashes in shingle_hashes(text, shingle):
        n += len(hashes)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        for at in range(0, len(hashes) if banded else 0, 1024):  # as many as the cache holds
            part = hashes[at : at + 1024]
            mixed = (part[None, :] ^ (part[None, :] >> np.uint64(32))) * _ODD[:, None]
            np.minimum(least, mixed.min(axis=1), out=least)
    fp = int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])
    if not banded:
        return fp, None
    rows = least.reshape(BANDS, BAND) if n else np.zeros((0, BAND), np.uint64)
    return fp, np.array([xxhash.xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(rows)], np.uint64).view(np.int64)


def fingerprints(rows: DataFrame, shingle: int, text_col: str = "text", banded: bool = False) -> DataFrame:
    """`rows` with its text column replaced by `fp` and, if `banded`, `bands`."""
    keep = [f for f in rows.schema.fields if f.name != text_col]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [sketch(t.as_py(), shingle, banded) for t in batch.column(text_col)]
            columns = [pa.array([fp for fp, _ in made], pa.int64())]
            if banded:
                columns.append(pa.array([bands for _, bands in made], pa.list_(pa.int64())))
            names = [*(f.name for f in keep), "fp", "bands"][: len(keep) + len(columns)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in keep), *columns], names)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keep)
    return rows.mapInArrow(hashed, f"{schema}, fp long" + (", bands array<long>" if banded else ""))


def digest(text: Column) -> Column:
    """A hash of the words of a text in order, which are all that its shingles depend on."""
    return F.xxhash64(F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), SPACES, " ")))


def ascending(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and those of them that occur more than once. Sorting is far faster here than NumPy's `unique`, which
    hashes first."""
    values = np.sort(values)
    same = values[1:] == values[:-1]
    again = values[1:][same]
    return values[np.concatenate(([True], ~same))[: len(values)]], again[np.concatenate(([True], again[1:] != again[:-1]))[: len(again)]]


def among(values: np.ndarray, wanted: np.ndarray, bits: int) -> np.ndarray:
    """Places of the values (of so many bits) that are among `wanted` (ascending). A bitmap of their leading bits leaves few to search for."""
    if not len(wanted):
        return np.zeros(0, np.int64)
    drop = np.uint64(max(0, bits - 22))
    marked = np.zeros(1 << min(bits, 22), bool)
    marked[(wanted >> drop).astype(np.int64)] = True
    likely = np.flatnonzero(marked[(values >> drop).astype(np.int64)])
    found = values[likely]
    return likely[wanted[np.minimum(np.searchsorted(wanted, found), len(wanted) - 1)] == found]


def masks(radius: int) -> np.ndarray:
    """All 64-bit words with at most `radius` bits set."""
    out = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(64), r)]
    return np.array(out, np.uint64)


def _keys(variants: np.ndarray, bits: int) -> np.ndarray:
    mixed = (variants ^ (variants >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - bits)


def pack(values: np.ndarray, kind: type) -> bytes:
    """Ascending unsigned values as steps of `kind`; its largest value means a step that goes on."""
    top = np.uint64(np.iinfo(kind).max)
    steps = np.diff(values, prepend=np.uint64(0))
    more = (steps // top).astype(np.int64)
    out = np.full(len(values) + int(more.sum()), top, kind)
    out[np.cumsum(more + 1) - 1] = (steps % top).astype(kind)
    return out.tobytes()


def unpack(packed: bytes, kind: type) -> np.ndarray:
    steps = np.frombuffer(packed, kind)
    return np.cumsum(steps, dtype=np.uint64)[steps != np.iinfo(kind).max]


def links(classes: DataFrame, radius: int = 4) -> DataFrame:
    """a, b: links between the distinct fingerprints of `classes` (column fp) such that those at most `radius` (even) bits
    apart are connected, and only fingerprints that apart are linked."""
    around = masks(radius // 2)
    n = classes.count()
    units = max(1, -(-n // UNIT))
    bits = min(60, max(16, int(n * len(around)).bit_length() + SPARE_BITS))
    bucket_bits = max(0, int(n * len(around) // BUCKET).bit_length())
    low = np.uint64(bits - bucket_bits)
    kind = np.uint16 if (1 << bits) < len(around) * UNIT << 15 else np.uint32
    # A unit is a few kilobytes of fingerprints and seconds of work, so units are not put together by size.
    dealt = classes.select(F.pmod(F.xxhash64("fp"), F.lit(units)).alias("unit"), "fp").repartition(units, "unit")

    def variants(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        fps = np.sort(rows.column("fp").to_numpy()).view(np.uint64)
        return fps, (fps[:, None] ^ around[None, :]).ravel()

    def send(rows: pa.Table) -> pa.Table:
        _, made = variants(rows)
        keys, twice = ascending(_keys(made, bits))
        cuts = np.searchsorted(keys, np.arange((1 << bucket_bits) + 1, dtype=np.uint64) << low)
        mask = np.uint64((1 << int(low)) - 1)
        full = [i for i in range(1 << bucket_bits) if cuts[i] < cuts[i + 1]]
        packed = [pack(keys[cuts[i] : cuts[i + 1]] & mask, kind) for i in full]
        twices = [pack(part & mask, kind) for part in np.split(twice, np.searchsorted(twice, np.arange(1, 1 << bucket_bits, dtype=np.uint64) << low))]
        unit = rows.column("unit")[0].as_py()
        return pa.table(
            {
                "bucket": pa.array(full, pa.int64()),
                "unit": pa.array([unit] * len(full), pa.int64()),
                "keys": pa.array(packed, pa.binary()),
                "twice": pa.array([twices[i] for i in full], pa.binary()),
            }
        )

    def meet(rows: pa.Table) -> pa.Table:
        """For each unit the keys that other units sent too, and those that it has twice itself."""
        sent, own = ([unpack(x.as_py(), kind) for x in rows.column(c)] for c in ("keys", "twice"))
        shared = ascending(np.concatenate(sent))[1]
        high = np.uint64(rows.column("bucket")[0].as_py()) << low
        out: dict[str, list] = {"unit": [], "shared": []}
        for unit, keys, twice in zip(rows.column("unit").to_pylist(), sent, own, strict=True):
            hit = ascending(np.concatenate((keys[among(keys, shared, int(low))], twice)))[0]
            if len(hit):
                out["unit"].append(unit)
                out["shared"].append((hit | high).tobytes())
        return pa.table({"unit": pa.array(out["unit"], pa.int64()), "shared": pa.array(out["shared"], pa.binary())})

    def answer(rows: pa.Table, told: pa.Table) -> pa.Table:
        """Links within the unit, and for each variant that met another its smallest holder in the unit."""
        fps, made = variants(rows)
        keys = _keys(made, bits)
        told_keys = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in told.column("shared")] or [keys[:0]])
        again = among(keys, ascending(told_keys)[0], bits)
        holder, value = again // len(around), made[again]
        del keys, made
        order = np.argsort(value, kind="stable")  # holders of a variant stay in order, the smallest first
        value, holder = value[order], holder[order]
        first = np.concatenate(([True], value[1:] != value[:-1])) if len(value) else np.zeros(0, bool)
        least = holder[np.maximum.accumulate(np.where(first, np.arange(len(value)), 0))] if len(value) else holder
        pairs = np.unique(holder[~first] * np.int64(len(fps)) + least[~first])
        signed = fps.view(np.int64)
        own_a, own_b = signed[pairs // len(fps)], signed[pairs % len(fps)]
        met, met_by = value[first], signed[holder[first]]
        return pa.table(
            {
                "variant": pa.array(np.concatenate([np.zeros(len(own_a), np.int64), met.view(np.int64)])),
                "a": pa.array(np.concatenate([own_a, met_by])),
                "b": pa.array(np.concatenate([own_b, np.zeros(len(met), np.int64)])),
                "whole": pa.array(np.concatenate([np.ones(len(own_a), bool), np.zeros(len(met), bool)])),
            }
        )

    sent = dealt.groupBy("unit").applyInArrow(send, "bucket long, unit long, keys binary, twice binary")
    told = sent.groupBy("bucket").applyInArrow(meet, "unit long, shared binary")
    found = written(
        dealt.groupBy("unit").cogroup(told.groupBy("unit")).applyInArrow(answer, "variant long, a long, b long, whole boolean"),
        "simhash-found",
    )
    least = F.min("a").over(Window.partitionBy("variant"))
    across = found.filter("not whole").withColumn("b", least).filter("a <> b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    return found.filter("whole").select("a", "b").union(across.select("a", "b")).filter(near).distinct()


def bins(found: np.ndarray) -> bytes:
    """One byte for the least of `found` (ascending, unsigned) in each of 256 ranges of hashes, 0 where there is none."""
    starts = np.searchsorted(found, np.arange(256, dtype=np.uint64) << np.uint64(56))
    ends = np.append(starts[1:], len(found))
    out = np.zeros(256, np.uint8)
    full = starts < ends
    out[full] = found[starts[full]] % np.uint64(255) + np.uint64(1)
    return out.tobytes()


def likely(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray, similarity: float) -> np.ndarray:
    """Whether each row of bins `a` and each of `b`, of sets of these sizes, agree as often as sets of this similarity do."""
    filled = 256 - (a == 0).astype(np.float32) @ (b == 0).astype(np.float32).T
    equal = np.stack([((b == row) & (row != 0)).sum(1, dtype=np.int32) for row in a])
    return agrees(equal, filled, sizes_a[:, None], sizes_b[None, :], similarity)


def agrees(equal: np.ndarray, filled: np.ndarray, a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Whether so many equal of so many filled bins are what sets of `a` and `b` members and this similarity have.

    Every filled bin that differs takes a member that only one of the sets has, and sets of this similarity have at most
    (1 - similarity) / (1 + similarity) of their members, counted over both, of that kind. That and their sizes rule out no similar pair. For
    large sets, whose bins hold many members, the share of equal bins is the similarity, less five standard deviations.
    """
    alone = (1 - similarity) / (1 + similarity) * (a + b) + 1e-6
    share = equal >= similarity * filled - 5 * np.sqrt(similarity * (1 - similarity) * filled)
    return (filled - equal <= alone) & (np.abs(a - b) <= alone) & share


def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each cell, from batches in which the rows of a cell follow each other."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        cell = batch.column("cell").to_numpy()
        cuts = [0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1).tolist(), len(cell)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            if i < j and held and held[0].column("cell")[0].as_py() != cell[i]:
                yield pa.Table.from_batches(held)
                held = []
            if i < j:
                held.append(batch.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


def alike(now: DataFrame, held: DataFrame, similarity: float) -> DataFrame:
    """a, b: pairs of `now` (key, fp, root, n) that share a key, not a root, and whose bins in `held` (fp, bins, members) agree well enough.

    The holders of a key are dealt to blocks of bounded size, and each two blocks are compared in a cell of their own, so a
    key of any size is spread over tasks and what a task sees is bounded.
    """
    blocks = F.ceil(F.col("n") / BLOCK)
    rows = now.agg(F.sum(blocks)).first()[0] or 0
    own = now.join(held.select("fp", "bins", "members"), "fp").withColumn("own", F.pmod(F.xxhash64("fp"), blocks))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
    dealt = dealt.withColumn("cell", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")))
    dealt = dealt.select("cell", "own", "fp", "root", "bins", "members").repartition(max(1, -(-rows // CELL_ROWS)), "cell")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in cells(batches):
            own, fp, root, size = (rows.column(c).to_numpy() for c in ("own", "fp", "root", "members"))
            sets = np.frombuffer(b"".join(rows.column("bins").to_pylist()), np.uint8).reshape(-1, 256)
            one = own == own.min()
            two = one if one.all() else ~one
            good = likely(sets[one], sets[two], size[one], size[two], similarity) & (root[one][:, None] != root[two][None, :])
            i, j = np.nonzero(good)
            a, b = fp[one][i], fp[two][j]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return dealt.sortWithinPartitions("cell").mapInArrow(compared, "a long, b long").distinct()


def around_hubs(now: DataFrame, hubs: DataFrame, held: DataFrame, similarity: float) -> DataFrame:
    """a, b: pairs of a hub of `hubs` (key, hub, hub_root; a few per key) and a row of `now` (key, fp, root) of that key, of different
    roots, whose bins in `held` agree well enough. A row meets its key's hubs as one list, so that no pairs are joined."""
    known = held.select(F.col("fp").alias("hub"), "bins", "members")
    hub = F.struct("hub", "hub_root", "bins", "members")
    lists = hubs.join(known, "hub").groupBy("key").agg(F.collect_list(hub).alias("hubs"))
    rows = now.select("key", "fp", "root").join(held.select("fp", "bins", "members"), "fp").join(lists, "key")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                own, listed = part.column("bins"), part.column("hubs")
                one = np.repeat(np.arange(part.num_rows), listed.value_lengths().to_numpy())
                flat = listed.flatten()
                fp, root, size = (part.column(c).to_numpy() for c in ("fp", "root", "members"))
                mine = np.frombuffer(b"".join(own.to_pylist()), np.uint8).reshape(-1, 256)[one]
                theirs = np.frombuffer(b"".join(flat.field("bins").to_pylist()), np.uint8).reshape(-1, 256)
                filled = 256 - ((mine == 0) & (theirs == 0)).sum(axis=1)
                equal = ((mine == theirs) & (mine != 0)).sum(axis=1)
                good = agrees(equal, filled, size[one], flat.field("members").to_numpy(), similarity) & (root[one] != flat.field("hub_root").to_numpy())
                a, b = flat.field("hub").to_numpy()[good], fp[one][good]
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return rows.select("fp", "root", "bins", "members", "hubs").mapInArrow(compared, "a long, b long").distinct()


def meeting(holders: DataFrame) -> DataFrame:
    """The rows of `holders` (key, fp) whose key another one has too."""
    shared = holders.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    return holders.join(shared, "key")


def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """`roots` (fp, root; a text that is its own root is left out) with further `links` (a, b). Only the links between components are
    worked on, each as one between their roots."""
    at = lambda end: F.coalesce(F.col(f"root_{end}"), F.col(end)).alias(end)
    ends = [roots.select(F.col("fp").alias(e), F.col("root").alias(f"root_{e}")) for e in "ab"]
    between = links.join(ends[0], "a", "left").join(ends[1], "b", "left").select(at("a"), at("b"))
    stars = components(between)
    moved = roots.join(stars, roots["root"] == stars["node"], "left").select("fp", F.coalesce(stars["root"], roots["root"]).alias("root"))
    return written(moved.union(stars.select("node", "root")), "components")


def similar(holders: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Links and components. Links: a, b, between texts that share a key in `holders` (key, fp) and that have at least this similarity, the
    shared over all distinct shingles; as many as hold each component together. Components: fp, root (the smallest), texts that are their
    own root left out. `fp` names a text in both `holders` and `texts` (fp, text); two texts of one name would be one.

    In two rounds the holders of a key that are in other components are compared with its hubs, which are then done: first
    with one, the holder of the component that is rarest there and that meets most others over all its keys, then with eight. So no
    pairs are made within a group of copies. What is then left under a key in several components is compared block by block. In rounds
    and blocks bins of hashes are compared first, and only the pairs that may be similar are verified by their whole sets.
    """
    spark = holders.sparkSession

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fp, text in zip(batch.column("fp"), batch.column("text"), strict=True):
                found = ascending(np.concatenate([*shingle_hashes(text.as_py(), shingle), np.zeros(0, np.uint64)]))[0]
                columns = [pa.array([fp.as_py()]), pa.array([found.view(np.int64)], pa.list_(pa.int64())), pa.array([bins(found)])]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([len(found)], pa.int64())], ["fp", "set", "bins", "members"])

    def apart(left: DataFrame, roots: DataFrame) -> DataFrame:
        """key, fp, root, n (holders of the key) where a key has holders of several components."""
        left = left.join(roots, "fp", "left").select("key", "fp", F.coalesce("root", "fp").alias("root"))
        crowd = left.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
        return left.join(crowd.filter("low < high").select("key", "n"), "key")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for a, b in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                a, b = a.values.to_numpy(), b.values.to_numpy()
                common = len(np.intersect1d(a, b, assume_unique=True))
                good.append(common >= similarity * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    def checked(pairs: DataFrame) -> DataFrame:
        pairs = pairs.join(held.select(F.col("fp").alias("b"), F.col("set").alias("set_b")), "b")
        pairs = pairs.join(held.select(F.col("fp").alias("a"), F.col("set").alias("set_a")), "a")
        return written(pairs.mapInArrow(verified, "a long, b long"), "similar")

    found, roots = spark.createDataFrame([], "a long, b long"), spark.createDataFrame([], "fp long, root long")
    now = written(apart(holders, roots), "meetings")
    if now.isEmpty():
        return found, roots
    wanted = now.select("fp").distinct()
    held = written(texts.join(wanted, "fp", "left_semi").mapInArrow(sets, "fp long, set array<long>, bins binary, members long"), "shingle-sets")
    for parts in HUBS:
        degree = now.groupBy("fp").agg(F.sum("n").alias("degree"))
        rare = now.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
        ranked = now.join(degree, "fp").join(rare, ["key", "root"])
        best = F.min(F.struct("c", (-F.col("degree")).alias("d"), "fp", "root")).alias("best")
        hubs = ranked.groupBy("key", F.pmod(F.xxhash64("fp"), F.lit(parts)).alias("part")).agg(best)
        hubs = written(hubs.select("key", F.col("best.fp").alias("hub"), F.col("best.root").alias("hub_root")), "hubs")
        more = checked(around_hubs(now, hubs, held, similarity))
        found, roots = found.union(more), joined(roots, more)
        left = now.join(hubs.select("key", F.col("hub").alias("fp")), ["key", "fp"], "left_anti")
        now = written(apart(left.select("key", "fp"), roots), "meetings")
        if now.isEmpty():
            return found.distinct(), roots
    more = checked(alike(now, held, similarity))
    return found.union(more).distinct(), joined(roots, more)


def rooted(classes: DataFrame, radius: int) -> DataFrame:
    """fp, root for every fingerprint of `classes`, over the links within the radius."""
    stars = components(links(classes, radius)).withColumnRenamed("node", "fp")
    return classes.join(stars, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 5, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits), component_id: one row per input row.

    Null and empty texts have fingerprint zero and are linked like any other. component_id is the smallest id among
    the texts reachable over links, null ids left aside (null if all are). Repeated rows are rows of one component. An
    empty table gives no rows. Other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = written(fingerprints(rows, shingle), "fingerprints")
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = written(rooted(classes.select("fp"), radius), "roots")
    ids = roots.join(classes, "fp").groupBy("root").agg(F.min("first").alias("component_id"))
    named = roots.join(ids, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(
    docs: DataFrame, shingle: int = 5, radius: int = 4, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`docs` with one row of each component, all columns kept: the row of the smallest id (nulls last), of equal ids
    the one of the smallest row hash. Links are texts of at least the similarity that meet on a band or whose fingerprints are
    linked within the radius. Of rows equal in every column one stays. Texts without words are one component. Columns of a map type do not enter the row hash."""
    plain = [c for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    row_hash = F.xxhash64(*[docs[c] for c in plain])
    rows = docs.select(docs[id_col].alias("id_"), row_hash.alias("hash_"), digest(docs[text_col]).alias("digest"), docs[text_col].alias("text_"))
    texts = rows.select("digest", "text_")
    rows = written(fingerprints(rows, shingle, "text_", banded=True), "fingerprints")
    # Unlike texts can have one fingerprint, so a ball is a key to meet under, like a band, and no link.
    own = written(rows.select("fp", "digest").distinct(), "digests")
    balls = rooted(written(own.select("fp").distinct(), "classes"), radius)
    balls = own.join(balls, "fp").select(F.xxhash64(F.lit("ball"), "root").alias("key"), F.col("digest").alias("fp"))
    bands = rows.select(F.explode("bands").alias("key"), F.col("digest").alias("fp")).distinct()
    met = written(meeting(bands.union(balls)), "met")
    said = texts.join(met.select(F.col("fp").alias("digest")).distinct(), "digest", "left_semi")
    said = said.groupBy(F.col("digest").alias("fp")).agg(F.any_value("text_").alias("text"))
    roots = similar(met, said, shingle, similarity)[1].withColumnRenamed("fp", "digest")
    order = [F.col("id_").isNull().alias("none_"), "id_", "hash_"]
    # One row per text first, so that a large group of copies is small before the roots are joined.
    best = rows.groupBy("digest").agg(F.min(F.struct(*order)).alias("best"))
    best = best.join(roots, "digest", "left").groupBy(F.coalesce("root", "digest").alias("root"))
    best = best.agg(F.min("best").alias("best")).select("best.id_", "best.hash_")
    counted = rows.groupBy("id_", "hash_").agg(F.count(F.lit(1)).alias("n_")).withColumnsRenamed({"id_": "i_", "hash_": "h_"})
    on = best["id_"].eqNullSafe(counted["i_"]) & (best["hash_"] == counted["h_"])
    kept = written(best.join(counted, on).select("id_", "hash_", "n_"), "kept")
    same = docs[id_col].eqNullSafe(kept["id_"]) & (row_hash == kept["hash_"])
    stay = docs.join(kept.filter("n_ = 1"), same, "left_semi")
    if kept.filter("n_ > 1").isEmpty():
        return stay
    return stay.unionByName(docs.join(kept.filter("n_ > 1"), same, "left_semi").dropDuplicates(plain))


def op10_simhash_near_dedup(spark, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), shingle=4, radius=4)


QUERIES = {"op10_simhash_near_dedup": op10_simhash_near_dedup}
ORACLE: dict[str, str] = {}
