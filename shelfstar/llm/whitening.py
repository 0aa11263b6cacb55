"""Whitening of embeddings by exact bit-sliced cross-products.

Entries become integers. A task shifts each dimension of a slab of rows to begin at zero and packs every bit plane across rows into
64-bit words; the product sums of two dimensions are then popcounts of plane AND plane, each weighted with its two powers of two. All of this
is exact, so the parts of all tasks are added as exact decimals and centred as integers before the only step that rounds, the
eigenvectors of one matrix of dimensions by dimensions, which is all that reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfstar.llm.common import table

#: An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Entries this large or larger count as not finite: their scaled value has no exact double, and products would pass 38 digits.
LARGEST = float(1 << 46)
#: Rows packed at a time, and entries of such a slab.
SLAB, ENTRIES = 1 << 14, 1 << 20
#: Whether whole-number results fit a long.
TOP = (1 << 63) - 1


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers; true for one without entries."""
    entry = lambda e: e.isNotNull() & (F.abs(e.cast("double")) < LARGEST)
    return F.coalesce(F.forall(vector, entry), F.lit(False))


def scaled(column: pa.Array, dims: int) -> np.ndarray:
    """Rows by dimensions of floor(SCALE * c). The offset changes no difference and is left out, so that products stay small."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(values * SCALE).astype(np.int64).reshape(-1, dims)


def slabs(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    rows = max(64, min(SLAB, ENTRIES // dims))
    held: list[np.ndarray] = []
    for batch in batches:
        held.append(scaled(batch.column(0), dims))
        if sum(map(len, held)) >= rows:
            z = np.concatenate(held)
            full = len(z) // rows * rows
            for at in range(0, full, rows):
                yield z[at : at + rows]
            held = [z[full:]]
    if held and sum(map(len, held)):
        yield np.concatenate(held)


def bit_sliced(y: np.ndarray) -> np.ndarray:
    """Sums of products of all two columns of `y` (rows by dimensions, not negative), upper triangle, exact."""
    rows, dims = y.shape
    widths = [int(top).bit_length() for top in y.max(axis=0)]
    starts = np.concatenate(([0], np.cumsum(widths)))
    words = np.zeros((starts[-1], -(-rows // 64)), np.uint64)
    packed = words.view(np.uint8)
    for d in range(dims):
        bits = (y[:, d][None, :] >> np.arange(widths[d])[:, None]) & 1
        packed[starts[d] : starts[d + 1], : -(-rows // 8)] = np.packbits(bits.astype(np.uint8), axis=1)
    exact = object if 2 * max(widths, default=0) + rows.bit_length() > 62 else np.int64
    weight = np.array([1 << b for w in widths for b in range(w)], exact)
    out = np.zeros((dims, dims), exact)
    full = [d for d in range(dims) if widths[d]]
    for k, d in enumerate(full):
        others = full[k:]
        begin = starts[d]
        cuts = starts[others] - begin
        for plane in range(starts[d], starts[d + 1]):
            common = np.bitwise_count(words[begin:] & words[plane]).sum(axis=1, dtype=np.int64)
            out[d, others] += weight[plane] * np.add.reduceat(common * weight[begin:], cuts)
    return out


def cross_products(vectors: DataFrame, dims: int) -> DataFrame:
    """i, j, total (decimal): for i <= j the sum of z_i * z_j over all rows, and for j = -1 the sum of z_i."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, cross = np.zeros(dims, object), np.zeros((dims, dims), object)
        for z in slabs(batches, dims):
            low = z.min(axis=0)
            y = z - low
            low = low.astype(object)
            own = np.array([int(s) for s in y.sum(axis=0)], object)
            cross += bit_sliced(y).astype(object) + np.outer(low, own) + np.outer(own, low) + len(z) * np.outer(low, low)
            sums += own + len(z) * low
        i, j = np.triu_indices(dims)
        totals = [str(v) for v in [*sums, *cross[i, j]]]
        columns = [np.concatenate((np.arange(dims), i)), np.concatenate((np.full(dims, -1), j))]
        columns = [pa.array(c.astype(np.int32)) for c in columns]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(totals).cast(pa.decimal128(38, 0))], ["i", "j", "total"])

    made = vectors.mapInArrow(parts, "i int, j int, total decimal(38,0)")
    return made.groupBy("i", "j").agg(F.sum("total").alias("total"))


class Whitening:
    """What is fitted: the number of rows, sums per dimension, components (columns) and their eigenvalues, and the trace."""

    def __init__(self, n: int, sums: np.ndarray, cross: np.ndarray, components: int = COMPONENTS) -> None:
        """`sums` and `cross` hold Python integers. Components without variance are left out."""
        centred = n * cross - np.outer(sums, sums)
        covariance = np.array([[v / (n * n) for v in row] for row in centred], np.float64)
        values, vectors = np.linalg.eigh(covariance)
        order = np.argsort(-values, kind="stable")[:components]
        order = order[values[order] > max(values.max(), 0.0) * len(sums) * np.finfo(np.float64).eps]
        self.n, self.sums, self.trace = n, sums, sum(int(v) for v in centred.diagonal()) / (n * n)
        self.values, self.vectors = values[order], vectors[:, order]

    def deviations(self, z: np.ndarray) -> np.ndarray:
        """n * z - sums, exact: longs where they fit, else Python integers."""
        wide = self.n * int(np.abs(z).max(initial=0)) + max(abs(s) for s in self.sums)
        kind = np.int64 if wide * wide * len(self.sums) <= TOP else object
        return self.n * z.astype(kind) - self.sums.astype(kind)

    def project(self, moved: np.ndarray) -> np.ndarray:
        return (moved / self.n).astype(np.float64) @ self.vectors / np.sqrt(self.values)


def fit(vectors: DataFrame, dims: int, n: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of all rows of `vectors` (one column). Only sums by dimensions reach the driver."""
    sums, cross = np.zeros(dims, object), np.zeros((dims, dims), object)
    for r in cross_products(vectors, dims).collect():
        if r.j < 0:
            sums[r.i] = int(r.total)
        else:
            cross[r.i, r.j] = cross[r.j, r.i] = int(r.total)
    return Whitening(n, sums, cross, components)


def identity_error(vectors: DataFrame, dims: int, fitted: Whitening) -> float:
    """Largest absolute entry of the covariance of all whitened rows less the identity, measured on the rows themselves."""
    size = len(fitted.values)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for z in slabs(batches, dims):
            w = fitted.project(fitted.deviations(z))
            total += np.column_stack((w.T @ w, w.sum(axis=0)))
        i, j = np.indices(total.shape, np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(x.ravel()) for x in (i, j, total)], ["i", "j", "total"])

    total = np.zeros((size, size + 1))
    for r in vectors.mapInArrow(parts, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        total[r.i, r.j] = r.total
    mean = total[:, size] / fitted.n
    return float(np.abs(total[:, :size] / fitted.n - np.outer(mean, mean) - np.eye(size)).max(initial=0.0))


def whiten(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, component (from 1, by falling variance), n, deviation, whitened, explained, identity_error: a row per
    remaining input row and component.

    Rows are dropped whose vector is null, has a null or non-finite entry (2**46 or more counts as such), or is not of the commonest
    length (of equally common ones the greatest). Repeated rows and null ids are rows like any other. `deviation` is null where
    it does not fit a long. Components without variance are left out: at most n - 1 remain, and none where all vectors are
    equal or the table is empty. Other columns are not looked at.
    """
    rows = rows.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("vector")).filter(usable(F.col("vector")))
    by_length = rows.groupBy(F.size("vector").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    most = by_length.agg(F.max(F.struct("n", "dims")).alias("most")).first()["most"]
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if most is None or not most.dims:
        return rows.sparkSession.createDataFrame([], schema)
    n, dims = most.n, most.dims
    rows = rows.filter(F.size("vector") == dims)
    fitted = fit(rows.select("vector"), dims, n, components)
    size = len(fitted.values)
    if not size:
        return rows.sparkSession.createDataFrame([], schema)
    error = identity_error(rows.select("vector"), dims, fitted)
    explained = fitted.values / fitted.trace

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                moved = fitted.deviations(scaled(part.column("vector"), dims))
                deviation = [int(v) if v <= TOP else None for v in (moved * moved).sum(axis=1)]
                count = len(deviation)
                again = pa.array(np.repeat(np.arange(count), size))
                columns = [
                    part.column("vec_id").take(again),
                    pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * size, n, np.int64)),
                    pa.array(deviation, pa.int64()).take(again),
                    pa.array(fitted.project(moved).ravel()),
                    pa.array(np.tile(explained, count)),
                    pa.array(np.full(count * size, error)),
                ]
                names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(out, schema)


def op13_embedding_whitening(spark, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))


QUERIES = {"op13_embedding_whitening": op13_embedding_whitening}
ORACLE: dict[str, str] = {}
