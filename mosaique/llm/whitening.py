"""Whitening of embeddings by hierarchical merging of singular value decompositions.

Entries become whole numbers, x = floor(SCALE * c) + SHIFT. A task reads its vectors in batches and keeps Moments: their number,
their exact sums, and all singular values and right vectors of the centred rows. Two of these merge without loss: the factors of
both are stacked with one row for the distance of the means, sqrt(n1 n2 / (n1 + n2)) (mean1 - mean2), and decomposed anew. Tasks'
moments are stored and merged FAN at a time in rounds; what remains is one row of dimension squared numbers, whatever the table's
size. Products of columns are never formed, and means are differences of whole numbers, so neither a common offset nor a small
eigenvalue loses digits. The covariance of the whitened rows, whose distance from the identity is reported, comes from a pass
over them.

Vectors that are null or hold null, non-finite or (exact sums end there) entries of 2^40 and more are dropped. The dimension is
the length that most of the others have, of equally many the largest; vectors of other lengths are dropped. Repeated rows count
as often as they occur, each gets its rows. Components without variance (their singular value is below TINY of the largest; all of
them, if all vectors are equal) have no whitened value: it is null, and identity_error leaves them out. explained is null where
there is no variance at all. deviation is null where it exceeds a long. Equal eigenvalues have any orthogonal vectors of their
space. An empty table, or one without such vectors, gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mosaique.llm.common import folded, stored

#: From entries to whole numbers, and the components that are reported.
SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
LARGEST, TINY = float(1 << 40), 1e-12
_WHOLE = pa.decimal128(38, 0)


@dataclass
class Moments:
    """Of n rows: exact sums by dimension, and singular values and right vectors (rows) of the centred rows."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        n, sums = len(x), x.sum(axis=0)
        return cls(n, sums.tolist(), *_decomposed((n * x - sums) / n))

    @classmethod
    def merged(cls, found: list[Moments]) -> Moments:
        """All of them in one decomposition: each adds its factor and the row of its mean's distance from those in front."""
        n, sums = found[0].n, found[0].sums
        rows = [found[0].values[:, None] * found[0].vectors]
        for m in found[1:]:
            apart = [(a * m.n - b * n) / (n * m.n) for a, b in zip(sums, m.sums, strict=True)]  # whole numbers: rounded once
            rows += [m.values[:, None] * m.vectors, np.sqrt(n * m.n / (n + m.n)) * np.array([apart])]
            n, sums = n + m.n, [a + b for a, b in zip(sums, m.sums, strict=True)]
        return found[0] if len(found) == 1 else cls(n, sums, *_decomposed(np.vstack(rows)))


def _decomposed(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, values, vectors = np.linalg.svd(rows, full_matrices=False)
    return values, vectors


@dataclass
class Whitening:
    """The merged moments with all dimensions, components by falling eigenvalue; of a component the largest entry is positive."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of(cls, m: Moments) -> Whitening:
        signs = np.sign(m.vectors[np.arange(len(m.vectors)), np.abs(m.vectors).argmax(axis=1)])
        return cls(m.n, m.sums, m.values, m.vectors * signs[:, None])

    @property
    def eigenvalues(self) -> np.ndarray:
        return self.values**2 / self.n

    @property
    def rank(self) -> int:
        return int((self.values > TINY * self.values[:1]).sum()) if len(self.values) else 0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact: as longs where they fit, else as Python's whole numbers."""
        fits = self.n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, self.sums), default=0) < 1 << 62
        return self.n * x - np.array(self.sums, np.int64) if fits else x.astype(object) * self.n - np.array(self.sums, object)

    def whiten(self, x: np.ndarray, components: int | None = None) -> np.ndarray:
        k = min(self.rank, components or self.rank)
        return (self.centred(x) / self.n).astype(float) @ (self.vectors[:k].T / np.sqrt(self.eigenvalues[:k]))

    def unwhiten(self, w: np.ndarray) -> np.ndarray:
        """The whole numbers that all components come from."""
        mean = np.array([s / self.n for s in self.sums])
        return np.rint(w * np.sqrt(self.eigenvalues[: w.shape[1]]) @ self.vectors[: w.shape[1]] + mean).astype(np.int64)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of the squares of n * x - sums, exact; None beyond a long."""
        d = self.centred(x)
        top = int(np.abs(d).max(initial=0))
        if d.dtype != object and top * top * max(1, d.shape[1]) >= 1 << 63:
            d = d.astype(object)
        return [v if v < 1 << 63 else None for v in (d * d).sum(axis=1).tolist()]


def vectors(rows: DataFrame, id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """id and vector of the rows that count, and the dimension."""
    fits = F.forall(vector, lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False)) & ~F.isnan(c))
    some = rows.select(id, F.col(vector).cast("array<double>").alias(vector)).where(F.coalesce(F.col(vector).isNotNull() & fits, F.lit(False)))
    size = some.groupBy(F.size(vector).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    dimension = size["size"] if size else 0
    return some.where(F.size(vector) == dimension), dimension


def whole(column: pa.Array, dimension: int) -> np.ndarray:
    flat = np.asarray(column.flatten(), dtype=np.float64).reshape(-1, max(1, dimension))
    return np.floor(SCALE * flat).astype(np.int64) + SHIFT


def _row(part: int, m: Moments) -> pa.RecordBatch:
    sums = pa.array([[Decimal(s) for s in m.sums]], pa.list_(_WHOLE))
    return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([m.n]), sums, pa.array([m.values]), pa.array([m.vectors.ravel()])], ["part", "n", "sums", "factors", "directions"])


def _moments(table: pa.Table | pa.RecordBatch) -> list[Moments]:
    rows = table.select(["n", "sums", "factors", "directions"]).to_pylist()
    return [Moments(r["n"], [int(s) for s in r["sums"]], np.array(r["factors"]), np.array(r["directions"]).reshape(len(r["factors"]), -1)) for r in rows]


def fit(rows: DataFrame, dimension: int, vector: str = "embedding") -> Whitening | None:
    """The whitening of all rows that `vectors` gives; None without rows or dimensions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for x in batches:
            if x.num_rows:
                own = Moments.of(whole(x.column(0), dimension))
                at = own if at is None else Moments.merged([at, own])
        if at is not None:
            yield _row(TaskContext.get().partitionId(), at)

    kind = "part long, n long, sums array<decimal(38,0)>, factors array<double>, directions array<double>"
    if not dimension:
        return None
    parts = stored(rows.select(vector).mapInArrow(run, kind), "moments")
    last = folded(parts, lambda t: pa.Table.from_batches([_row(0, Moments.merged(_moments(t)))])).toArrow()
    return Whitening.of(_moments(last)[0]) if last.num_rows else None


def identity_error(rows: DataFrame, dimension: int, model: Whitening, components: int, vector: str = "embedding") -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity."""
    k = min(components, model.rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(k), np.zeros((k, k))
        for x in batches:
            w = model.whiten(whole(x.column(0), dimension), k)
            sums, products = sums + w.sum(axis=0), products + w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([sums]), pa.array([products.ravel()])], ["part", "sums", "products"])

    def fold(table: pa.Table) -> pa.Table:
        added = [pa.array([np.array(table.column(c).to_pylist()).sum(axis=0)]) for c in ("sums", "products")]
        return pa.Table.from_arrays([table.column("part").slice(0, 1), *added], ["part", "sums", "products"])

    if not k:
        return 0.0
    last = folded(stored(rows.select(vector).mapInArrow(run, "part long, sums array<double>, products array<double>"), "products"), fold).first()
    mean = np.array(last["sums"]) / model.n  # a rounding error: the rows are centred
    covariance = np.array(last["products"]).reshape(k, k) / model.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(k)).max())


def whitened(rows: DataFrame, components: int = COMPONENTS, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, component (from 1), n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    some, dimension = vectors(rows, id, vector)
    model = fit(some, dimension, vector)
    kind = dict(rows.dtypes)[id]
    out = f"{id} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return some.sparkSession.createDataFrame([], out)
    error = identity_error(some, dimension, model, components, vector)
    most, rank = min(components, dimension), min(components, model.rank)
    trace = model.eigenvalues.sum()
    shares = np.zeros(most)
    shares[:rank] = model.eigenvalues[:rank] / trace if trace else 0
    share = pa.array(shares, mask=np.full(most, not rank))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            rows = whole(x.column(1), dimension)
            each, by = np.repeat(np.arange(len(rows)), most), np.tile(np.arange(most), len(rows))
            values = np.zeros((len(rows), most))
            values[:, :rank] = model.whiten(rows, rank) if rank else 0
            cols = [x.column(0).take(pa.array(each)), pa.array(by + 1, pa.int32()), pa.array(np.full(len(each), model.n)), pa.array(model.deviations(rows), pa.int64()).take(pa.array(each))]
            cols += [pa.array(values.ravel(), mask=by >= rank), share.take(pa.array(by)), pa.array(np.full(len(each), error))]
            yield pa.RecordBatch.from_arrays(cols, [id, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return some.mapInArrow(run, out)
