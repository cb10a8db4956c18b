"""Embedding near-dedup with randomised-rotation binary codes and stored correction factors.

Every vector is turned by random rotations; the signs of its coordinates are its code, and the inner product of
the vector with its own code is stored with it as a correction factor. Bands of code bits
put vectors into buckets of several tables. All tables draw on the same bits, so their number is taken from the chance of each
count of differing bits: a pair at the threshold shares a bucket with a probability of 1 - ``MISS``, a nearer one
with a higher. A pair that does is tested in three steps, each on
fewer pairs: the distance of the codes, the unbiased estimate of the inner product (one vector, the other's code and
factor) with its confidence bound, and the exact cosine in double precision, which alone makes a link.

Defined cases: vectors that are null, zero or hold null or non-finite components, and rows without a label,
link with nothing and are their own component; only vectors of one label and one length are compared; exact
copies are compared once and counted as often as they occur; vec_id is the key of a row (repeated rows are copies of each
other); other columns don't matter; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.llm import kernels as K
from dealspark.llm.components import connected_components
from dealspark.session import Scratch, table

#: Bits of a code at least; the chance to miss a pair at the threshold; standard errors that a bound allows.
BITS, MISS, SIGMAS = 384, 5e-4, 5.0
_CODED = "vec_id long, label string, dim int, k1 long, k2 long, vec binary, code array<long>, factor array<double>"


@functools.cache
def rotations(dim: int) -> np.ndarray:
    """Random orthogonal matrices, enough of them for BITS signs; columns are directions."""
    rng = np.random.default_rng(dim)
    return np.concatenate([np.linalg.qr(rng.normal(size=(dim, dim)))[0] for _ in range(-(-BITS // dim))], 1)


def _blocks(dim: int) -> int:
    return -(-BITS // dim)


def coded(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (packed into 64-bit numbers) and correction factors of unit vectors."""
    n, dim = vectors.shape
    turned = vectors @ rotations(dim)
    bits = np.zeros((n, -(-turned.shape[1] // 64) * 64), np.uint8)
    bits[:, : turned.shape[1]] = turned > 0
    return np.packbits(bits, axis=1).view(np.int64), np.abs(turned).reshape(n, _blocks(dim), dim).sum(2) / math.sqrt(dim)


def estimate(vectors: np.ndarray, codes: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased inner products of unit vectors with the coded ones of the same rows, and their bounds."""
    n, dim = vectors.shape
    blocks = _blocks(dim)
    signs = np.unpackbits(codes.view(np.uint8).reshape(n, -1), axis=1)[:, : blocks * dim].astype(np.float64) * 2 - 1
    products = ((vectors @ rotations(dim)) * signs).reshape(n, blocks, dim).sum(2) / math.sqrt(dim)
    spread = np.sqrt(np.maximum(1 - factors**2, 0) / factors**2 / max(1, dim - 1))
    return (products / factors).mean(1), SIGMAS * np.sqrt((spread**2).sum(1)) / blocks


def _coded_rows(vectors: DataFrame) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(_CODED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, labels, out = b.column(0).to_pylist(), b.column(2).to_pylist(), []
            by_size: dict[int, list[int]] = {}
            lists = b.column(1).to_pylist()
            for i, v in enumerate(lists):
                if v and labels[i] is not None and None not in v:
                    by_size.setdefault(len(v), []).append(i)
                else:
                    out.append((ids[i], labels[i], None, None, None, None, None, None))
            for dim, rows in by_size.items():
                x = np.array([lists[i] for i in rows], np.float64)
                with np.errstate(all="ignore"):
                    unit = x / np.abs(x).max(1, keepdims=True)
                    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                good = np.isfinite(unit).all(1) & np.isfinite(x).all(1)
                codes, factors = coded(np.where(good[:, None], unit, 0))
                with np.errstate(over="ignore"):
                    words = K.mix64((x + 0.0).view(np.uint64) + np.arange(1, dim + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                    k1, k2 = words.sum(1, dtype=np.uint64).view(np.int64), K.mix64(words).sum(1, dtype=np.uint64).view(np.int64)
                for j, i in enumerate(rows):
                    if good[j]:
                        out.append((ids[i], labels[i], dim, int(k1[j]), int(k2[j]), unit[j].tobytes(), codes[j].tolist(), factors[j].tolist()))
                    else:
                        out.append((ids[i], labels[i], None, None, None, None, None, None))
            yield K.batch(schema, [list(c) for c in zip(*out, strict=True)] or [[]] * 8)

    return vectors.select(vectors["vec_id"].cast("long"), vectors["embedding"].cast("array<double>"), vectors["label"].cast("string")).mapInArrow(run, _CODED)


def tables_needed(bits: int, same: float, width: int, farthest: int, miss: float) -> int:
    """Tables of ``width`` of the bits each, so that a pair shares a bucket with a probability of 1 - miss.

    ``same`` is the chance that a bit is equal; pairs that differ in more than ``farthest`` bits are lost anyway. The bits of a
    rotation vary less together than the independent ones that are assumed here.
    """
    fact = np.cumsum(np.log(np.maximum(np.arange(bits + 1), 1)))
    differ = np.arange(farthest + 1)
    chance = np.exp(fact[bits] - fact[differ] - fact[bits - differ] + differ * math.log(1 - same) + (bits - differ) * math.log(same))
    left = bits - differ
    alone = np.where(left >= width, np.exp(fact[left] - fact[np.maximum(left - width, 0)] - fact[bits] + fact[bits - width]), 0.0)
    lost = max(0.0, 1 - chance.sum())
    tables = 1
    while (chance * (1 - alone) ** tables).sum() + lost > miss:
        tables += 1 + tables // 50
    return tables


def _pairs(nodes: DataFrame, dim: int, count: int, threshold: float, stored: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Pairs that share a bucket of one of the tables and whose codes are near enough."""
    same = 1 - math.acos(threshold) / math.pi
    bits = _blocks(dim) * dim
    width = min(bits, max(8, math.ceil(math.log2(max(2, count))) - 2))
    farthest = int(bits * (1 - same) + SIGMAS * math.sqrt(bits * same * (1 - same)))
    tables = tables_needed(bits, same, width, farthest, MISS)
    rng = np.random.default_rng(11)
    picks = [sorted(rng.choice(bits, width, replace=False).tolist()) for _ in range(tables)]

    def bit(i: int):
        at = 8 * ((i % 64) // 8) + 7 - i % 8  # the place in a little-endian number of bit i of packed bytes
        return F.shiftrightunsigned(F.col("code")[i // 64], at).bitwiseAND(F.lit(1))

    keys = F.array(*[F.xxhash64("label", F.lit(t), *[bit(i) for i in pick]) for t, pick in enumerate(picks)])
    rows = nodes.where(F.col("dim") == dim).select("node", "label", "code", F.explode(keys).alias("key"))
    crowded = stored(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
    rows = stored(rows.join(crowded, "key"))
    a = rows.select("key", F.col("node").alias("a"), F.col("label").alias("la"), F.col("code").alias("ca"))
    b = rows.select("key", F.col("node").alias("b"), F.col("label").alias("lb"), F.col("code").alias("cb"))
    apart = sum((F.bit_count(F.col("ca")[i].bitwiseXOR(F.col("cb")[i])) for i in range(1, -(-bits // 64))), F.bit_count(F.col("ca")[0].bitwiseXOR(F.col("cb")[0])))
    return a.join(b, "key").where((F.col("a") < F.col("b")) & (F.col("la") == F.col("lb")) & (apart <= farthest)).select("a", "b").distinct()


def _matrix(column: pa.Array, dtype=np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def _links(nodes: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose exact cosine reaches the threshold; the estimate decides which need it."""
    vectors = nodes.select("node", "vec")
    codes = nodes.select(F.col("node").alias("b"), "code", "factor")

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(2))
                about, bound = estimate(x, np.array(b.column(3).to_pylist(), np.int64), np.array(b.column(4).to_pylist()))
                yield b.select([0, 1, 2]).filter(pa.array(about + bound >= threshold))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cosine = np.einsum("ij,ij->i", _matrix(b.column(2)), _matrix(b.column(3)))
                yield b.select([0, 1]).filter(pa.array(cosine >= threshold))

    near = pairs.join(vectors.withColumnRenamed("node", "a"), "a").join(codes, "b").select("a", "b", "vec", "code", "factor").mapInArrow(likely, "a long, b long, vec binary")
    return near.join(vectors.select(F.col("node").alias("b"), F.col("vec").alias("other")), "b").select("a", "b", "vec", "other").mapInArrow(exact, "a long, b long")


def near_duplicate_vectors(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding, label)."""
    K.prepare(vectors.sparkSession)
    scratch = Scratch(vectors.sparkSession)
    stored = scratch.stored
    rows = stored(_coded_rows(vectors))
    valid = rows.where("k1 is not null")
    groups = stored(valid.groupBy("label", "dim", "k1", "k2").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")))
    same = ["label", "dim", "k1", "k2"]
    nodes = stored(valid.join(groups, same).where("vec_id = node").dropDuplicates(["node"]).select("node", "label", "dim", "copies", "vec", "code", "factor"))
    sizes = nodes.groupBy("label", "dim").agg(F.count("*").alias("n")).groupBy("dim").agg(F.max("n").alias("n")).collect()  # a row for each length of vector
    links = None
    for r in sizes:
        own = nodes.where(F.col("dim") == r["dim"])
        found = stored(_links(own, stored(_pairs(nodes, r["dim"], r["n"], threshold, stored)), threshold))
        links = found if links is None else links.union(found)
    if links is None:
        links = vectors.sparkSession.createDataFrame([], "a long, b long")
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    partners = both.join(nodes.select(F.col("node").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("others"))
    components = connected_components(links)
    described = groups.join(partners.withColumnRenamed("a", "node"), "node", "left").join(components, "node", "left")
    described = stored(described.select(*same, (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id")))
    scratch.drop(rows, described)
    out = rows.select("vec_id", *same).join(described, same, "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))
