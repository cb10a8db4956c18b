"""Whitening of embeddings: moments by pairwise merging, eigenvectors on the driver, a second pass that verifies the result.

Entries are put on a grid (``floor(scale * c)``), so that equal vectors are equal in every digit and sums are exact. The model is fitted
on each distinct vector once. Every partition computes count, sums, local mean and the scatter about that mean, batch by batch; partial
moments are merged in pairs by Chan's formula in ``treeReduce``, so that nothing is squared before it is centred. ``eigh`` on the driver
takes a matrix of the vectors' dimension, whatever the number of vectors. A second pass over the fit list
computes the covariance of the whitened vectors in the same way and compares it with the identity.

Defined cases: rows whose vector is null or holds null or non-finite entries are left out; vectors of different lengths have a model for
each length; an empty vector has no components and gives no row; repeated rows each get their rows, and copies count once in the fit;
a component without variance (all vectors equal, say, or more dimensions than vectors) has a null ``whitened`` and an ``explained`` of 0,
and ``identity_error`` is over the other ones (null where there is none); other columns don't matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.llm import kernels as K
from dealspark.session import Scratch, table

#: Steps of the grid for an entry of 1; components that are returned.
SCALE, COMPONENTS = 256, 4
#: Vectors that are centred and multiplied at once.
BLOCK = 4096


@dataclass
class Moments:
    """Count, exact sums, mean and centred scatter of vectors of one length."""

    n: int
    sums: np.ndarray
    mean: np.ndarray
    scatter: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        mean = x.mean(0, dtype=np.float64)
        apart = x - mean
        return cls(len(x), x.sum(0), mean, apart.T @ apart)

    def merged(self, other: Moments) -> Moments:
        n = self.n + other.n
        apart = other.mean - self.mean
        return Moments(n, self.sums + other.sums, self.mean + apart * (other.n / n), self.scatter + other.scatter + np.outer(apart, apart) * (self.n * other.n / n))


def _merge(a: dict[int, Moments], b: dict[int, Moments]) -> dict[int, Moments]:
    return {d: a[d].merged(b[d]) if d in a and d in b else a.get(d) or b[d] for d in a.keys() | b.keys()}


def _by_length(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and matrix of the vectors of each length but 0; no vector or entry is null."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    ends = lists.offsets.to_numpy().astype(np.int64)
    values, lengths = lists.values.to_numpy(zero_copy_only=False), np.diff(ends)
    for d in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == d)
        for i in range(0, len(rows), BLOCK):
            part = rows[i : i + BLOCK]
            yield part, values[ends[part][:, None] + np.arange(d)]


def on_grid(vectors: DataFrame, column: str = "embedding", scale: int = SCALE, key: str = "vec_id") -> DataFrame:
    """Key and whole-number vector of each row whose entries are all finite."""
    v = vectors[column].cast("array<double>")
    known = vectors.where(v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))
    return known.select(known[key].cast("long").alias("vec_id"), F.transform(v, lambda c: F.floor(c * scale).cast("long")).alias("x"))


def moments(vectors: DataFrame, project: dict[int, tuple[np.ndarray, np.ndarray]] | None = None) -> dict[int, Moments]:
    """Moments of the vectors ``x`` by length; of their projections (after subtracting a centre) if ``project`` is given."""
    K.prepare(vectors.sparkSession)
    shared = vectors.sparkSession.sparkContext.broadcast(project) if project is not None else None  # matrices of the vectors' dimension

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        own: dict[int, Moments] = {}
        for b in batches:
            for _, x in _by_length(b.column(0)):
                d = x.shape[1]
                if shared is not None:
                    centre, axes = shared.value[d]
                    x = (x - centre) @ axes
                if x.shape[1]:
                    own = _merge(own, {d: Moments.of(x)})
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(own)], pa.binary())], names=["state"])

    def merge(a: dict[int, Moments], b: dict[int, Moments]) -> dict[int, Moments]:
        return _merge(a, b)

    def load(row) -> dict[int, Moments]:
        import pickle

        return pickle.loads(row["state"])

    states = vectors.select("x").mapInArrow(run, "state binary").rdd.map(load)
    return states.treeReduce(merge) if states.getNumPartitions() else {}


@dataclass
class Whitener:
    """What one length of vector needs: fit, eigenvectors as columns by falling eigenvalue, and the share of each in the variance."""

    n: int
    sums: np.ndarray
    axes: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float | None = None

    @classmethod
    def fitted(cls, m: Moments, components: int) -> Whitener:
        values, axes = np.linalg.eigh(m.scatter / m.n)
        values, axes = np.maximum(values[::-1], 0.0), axes[:, ::-1]
        # rounding leaves a little variance where there is none
        values[values <= values[:1] * len(values) * np.finfo(np.float64).eps] = 0.0
        total = values.sum()
        explained = values / total if total > 0 else np.zeros_like(values)
        k = min(components, len(values))
        return cls(m.n, m.sums, np.ascontiguousarray(axes[:, :k]), values[:k], explained[:k])

    @property
    def projection(self) -> tuple[np.ndarray, np.ndarray]:
        """Centre, and the axes that have variance over the root of it."""
        kept = self.values > 0
        return self.sums / self.n, self.axes[:, kept] / np.sqrt(self.values[kept])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        out = np.full((len(x), len(self.values)), np.nan)
        centre, axes = self.projection
        out[:, self.values > 0] = (x - centre) @ axes
        return out

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """Sum over dimensions of (n * x - sums) squared: exact whole numbers as far as the result fits 64 bits."""
        with np.errstate(over="ignore"):  # whole numbers wrap, so a result that fits is right
            apart = x * np.int64(self.n) - self.sums
            return (apart * apart).sum(1)


def fit(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Whitener]:
    """A model for each length of the distinct vectors ``x``, with the error of a second pass."""
    models = {d: Whitener.fitted(m, components) for d, m in moments(distinct).items()}
    seen = moments(distinct, {d: w.projection for d, w in models.items()})
    for d, m in seen.items():
        models[d].identity_error = float(np.abs(m.scatter / m.n - np.eye(len(m.mean))).max())
    return models


_RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, models: dict[int, Whitener]) -> DataFrame:
    """One row for each vector (vec_id, x) and component."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    K.prepare(vectors.sparkSession)
    shared = vectors.sparkSession.sparkContext.broadcast(models)  # matrices of the vectors' dimension
    schema = to_arrow_schema(StructType.fromDDL(_RESULT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, x in _by_length(b.column(1)):
                w = shared.value[x.shape[1]]
                k = len(w.values)
                many = len(rows) * k
                whitened = w.whitened(x).ravel()
                yield K.batch(schema, [b.column(0).take(pa.array(np.repeat(rows, k))), np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows)), np.full(many, w.n), np.repeat(w.deviation(x), k), pa.array(whitened, pa.float64(), mask=np.isnan(whitened)), np.tile(w.explained, len(rows)), pa.array([w.identity_error] * many, pa.float64())])

    return vectors.mapInArrow(run, _RESULT)


def whitened_vectors(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """Fit on each distinct vector once and whiten every row."""
    placed = on_grid(vectors, scale=scale)
    scratch = Scratch(vectors.sparkSession)
    models = fit(scratch.stored(placed.select("x").distinct()), components)
    scratch.drop()
    return whiten(placed, models)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_vectors(table(spark, sf_dir, "embeddings"))
