"""Whitening of embeddings with exact covariances.

Entries become integers. Tasks take the different vectors in blocks, subtract each dimension's
smallest value and pack every bit of what is left across rows, 64 rows to a word. The number of
rows with bit a of one dimension and bit b of another is a popcount of two words' AND, and these
counts, weighted by 2 ** (a + b), are the block's cross products. Blocks, tasks and the table are
added up as integers. The covariance is centred as integers too, so nothing cancels before
`eigh` sees it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept

SCALE = 64
"""Steps of an entry's whole numbers."""
COMPONENTS = 16
BLOCK = 1 << 14
"""Rows whose bit planes are held at once."""
SMALLEST = 1e-12
"""Share of the variance below which a component counts as one along which nothing varies."""
_LOW = 60
_PLANE_WORDS = 1 << 20
"""Words that one AND of a plane with others makes at once, at most."""


def planes(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bit planes of the columns of non-negative numbers: packed words, and of each plane
    its column and its bit."""
    widths = [int(top).bit_length() for top in shifted.max(axis=0, initial=0)]
    column = np.repeat(np.arange(len(widths)), widths)
    bit = np.concatenate([np.arange(w) for w in widths] or [np.empty(0, int)]).astype(np.int64)
    words = -(-len(shifted) // 64)
    packed = np.zeros((len(column), words * 8), np.uint8)
    for plane, (at, shift) in enumerate(zip(column.tolist(), bit.tolist())):
        row = np.packbits((shifted[:, at] >> np.uint64(shift)).astype(np.uint8) & 1, bitorder="little")
        packed[plane, : len(row)] = row
    return packed.view("<u8"), column, bit


def cross_products(shifted: np.ndarray) -> np.ndarray:
    """Exact sums over rows of the products of any two columns, as Python integers."""
    words, column, bit = planes(shifted)
    out = np.zeros((shifted.shape[1],) * 2, object)
    step = max(1, _PLANE_WORDS // max(1, words.shape[1]))
    # All weights of one sum are applied in 64 bits where they fit.
    fits = len(bit) == 0 or 2 * (int(bit.max()) + 1) + len(shifted).bit_length() < 63
    for plane, (at, shift) in enumerate(zip(column.tolist(), bit.tolist())):
        counts = np.concatenate(
            [np.bitwise_count(words[plane] & words[i : i + step]).sum(axis=1, dtype=np.int64) for i in range(0, len(words), step)]
        )
        weighted = counts << (bit + shift) if fits else counts.astype(object) * (1 << (bit.astype(object) + shift))
        sums = np.zeros(shifted.shape[1], np.int64 if fits else object)
        np.add.at(sums, column, weighted)
        out[at] += sums.astype(object)
    return out


def _numbers(batch: pa.RecordBatch, name: str, size: int) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _scatter(size: int):
    """Per task: the number of rows (i = j = -1), sums (j = -1) and cross products (i <= j) of
    whole numbers, each as an upper and a lower part, so that no sum of them overflows."""

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cross = 0, np.zeros(size, object), np.zeros((size, size), object)
        for batch in batches:
            rows = _numbers(batch, "steps", size)
            for at in range(0, len(rows), BLOCK):
                block = rows[at : at + BLOCK]
                least = block.min(axis=0)
                shifted = block.view(np.uint64) - least.view(np.uint64)
                base, count = least.astype(object), len(block)
                above = shifted.astype(object).sum(axis=0) if int(shifted.max(initial=0)) >> 48 else shifted.sum(axis=0).astype(object)
                cross += cross_products(shifted) + np.outer(base, above) + np.outer(above, base) + count * np.outer(base, base)
                sums += above + count * base
                n += count
        if n:
            upper = np.triu_indices(size)
            i = np.concatenate(([-1], np.arange(size), upper[0]))
            j = np.concatenate(([-1], np.full(size, -1), upper[1]))
            values = [n, *sums.tolist(), *cross[upper].tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(i, pa.int32()),
                    pa.array(j, pa.int32()),
                    pa.array([str(v >> _LOW) for v in values]),
                    pa.array([v & (1 << _LOW) - 1 for v in values], pa.int64()),
                ],
                ["i", "j", "high", "low"],
            )

    return scatter


@dataclass
class Whitening:
    """What the different vectors say: their number, the sums of their whole numbers, and the
    components by falling share of the variance."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """n x - S, exactly."""
        most = max((abs(s) for s in self.sums), default=0)
        top = max(abs(int(rows.min(initial=0))), abs(int(rows.max(initial=0))))
        if self.n * top + most < 1 << 63:
            return rows * np.int64(self.n) - np.array(self.sums, np.int64)
        return rows.astype(object) * self.n - np.array(self.sums, object)

    def deviations(self, centred: np.ndarray) -> list[int | None]:
        """Sums of squares, exactly; None where a long cannot hold it."""
        if centred.dtype != object:
            top = max(abs(int(centred.min(initial=0))), abs(int(centred.max(initial=0))))
            if top * top * max(1, centred.shape[1]) < 1 << 63:
                return (centred * centred).sum(axis=1).tolist()
        found = (centred.astype(object) ** 2).sum(axis=1).tolist()
        return [value if value < 1 << 63 else None for value in found]

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(np.float64) @ (self.vectors / np.sqrt(self.values))


def whole_steps(vectors: DataFrame, vec_col: str) -> tuple[DataFrame, int]:
    """The rows whose vector has only finite entries, with ``steps``, floor(64 c) of each entry c,
    and the vectors' size. Rows of another size than the most frequent one (of equally frequent
    ones the largest) are dropped as well."""
    entries = F.col(vec_col).cast("array<double>")

    def finite(c: Column) -> Column:
        return F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))

    usable = vectors.withColumn("__entries", entries).filter(F.col(vec_col).isNotNull()).filter(F.forall("__entries", finite))
    sizes = usable.groupBy(F.size("__entries").alias("size")).agg(F.count("*").alias("n"))
    size = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    size = size["size"] if size else 0
    steps = F.transform("__entries", lambda c: F.floor(c * SCALE)).alias("steps")
    return usable.filter(F.size("__entries") == size).select(*vectors.columns, steps), size


def fit(steps: DataFrame, size: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a table of different ``steps`` vectors. What meets in the driver is the
    matrix of cross products, which does not grow with the rows."""
    if not size:
        return None
    wide = "decimal(38,0)"
    parts = steps.mapInArrow(_scatter(size), "i int, j int, high string, low long").groupBy("i", "j")
    parts = parts.agg(F.sum(F.col("high").cast(wide)).alias("high"), F.sum(F.col("low").cast(wide)).alias("low"))
    found = {(r["i"], r["j"]): (int(r["high"]) << _LOW) + int(r["low"]) for r in parts.collect()}
    if not found:
        return None
    n = found[-1, -1]
    sums = [found[i, -1] for i in range(size)]
    covariance = np.empty((size, size))
    for i in range(size):
        for j in range(i, size):  # whole numbers are divided once, and rounded once
            covariance[i, j] = covariance[j, i] = (n * found[i, j] - sums[i] * sums[j]) / (n * n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    total = float(np.trace(covariance))
    varying = min(components, int((values > SMALLEST * total).sum()) if total else 0)
    values = values[:varying]
    return Whitening(n, sums, vectors[:, :varying], values, values / total if total else values)


def _moments(model: Whitening):
    """Per task: sums over rows of the products of any two whitened components."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(model.sums)
        total = np.zeros((len(model.values),) * 2)
        for batch in batches:
            rows = model.whitened(model.centred(_numbers(batch, "steps", size)))
            total += rows.T @ rows
        i, j = np.indices(total.shape)
        columns = [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "total"])

    return moments


def _project(model: Whitening, identity_error: float):
    count = len(model.values)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            centred = model.centred(_numbers(batch, "steps", len(model.sums)))
            order = pa.array(np.repeat(np.arange(rows), count))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(order),
                    pa.array(np.tile(np.arange(1, count + 1), rows), pa.int32()),
                    pa.array(np.full(rows * count, model.n), pa.int64()),
                    pa.array(model.deviations(centred), pa.int64()).take(order),
                    pa.array(model.whitened(centred).ravel()),
                    pa.array(np.tile(model.explained, rows)),
                    pa.array(np.full(rows * count, identity_error)),
                ],
                names,
            )

    return project


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """A row per usable vector and component: ``vec_id``, ``component`` (from 1, by falling
    variance), ``n`` different vectors, ``deviation`` (sum of (n x - S)^2, exact; NULL where a long
    cannot hold it), ``whitened``, ``explained`` (share of the variance), ``identity_error``
    (largest entry of the whitened vectors' covariance minus the identity, from the rows).

    Vectors that are NULL, hold NULL or non-finite entries, or have another size than most are
    dropped. Repeated rows and ids stay, and count once in the fit if their whole numbers are
    equal. Components along which nothing varies are left out, so equal vectors, one vector or an
    empty table give no rows. Entries beyond the range of a long count as its ends. Other columns
    are ignored.

    Copies meet in tasks before they are shuffled. A vector in a third of all rows is one row of
    the fit.
    """
    rows, size = whole_steps(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vector")), "vector")
    rows = rows.select("vec_id", "steps")
    different = kept(rows.select("steps").distinct(), "vectors")
    model = fit(different, size, components)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema)
    moments = different.mapInArrow(_moments(model), "i int, j int, total double")
    moments = moments.groupBy("i", "j").agg((F.sum("total") / model.n).alias("value"))
    error = moments.agg(F.max(F.abs(F.col("value") - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)))).first()[0]
    return rows.mapInArrow(_project(model, float(error)), schema)
