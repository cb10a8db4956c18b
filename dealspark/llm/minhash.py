"""MinHash near-dedup by an LSH forest, with links confirmed on full shingle sets.

Every tree of the forest sorts the texts by a sequence of minimum hashes of its own. Texts next to each other there have
the longest common prefixes. The depth adapts to the region: a
prefix that few texts share is used as it is, a crowded one is split by the next, longer prefix. Work goes in steps, each
on distinct shingle sets only:

1. each text is compared with its neighbours in every sorted order, which joins most groups of copies at once (a
   neighbour across the border of two tasks is left to the next steps, which read regions by key);
2. regions that still hold several components are compared pair by pair, across components, once they are
   small (descending to longer prefixes where they are not);
3. regions that stay crowded at full depth are dealt out in blocks, and every two blocks are compared in a task of their
   own, all pairs at once: the number of shingles that two texts share is an entry of a matrix product. A task hands on
   only links that join components it had not joined yet, so that no step ever holds the pairs of a large region.

In the first two steps a two-bit sketch of the signature drops pairs that are far below the threshold (by more than five
standard errors). Every link is confirmed on the two full sets.

Defined cases: null, empty and wordless texts have the empty set and link with nothing; texts
with fewer words than a shingle have their whole sequence as one shingle; rows without doc_id link with nothing and are kept; identical sets (copies) share a
component without being paired; doc_id is the key of a text: repeated rows come back as often as they came, and where
their texts differ the greatest text is the one compared; other columns don't matter; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.llm import kernels as K
from dealspark.llm.components import connected_components
from dealspark.session import Scratch

HASHES, TREES, DEPTHS = 128, 24, (4, 5, 6, 7, 8)
#: One of so many prefixes has pairs with its first text.
LED = 6
#: Largest region that is compared pair by pair.
REGION = 48
#: Texts of a block of a crowded region, bytes of their texts, and shingles that are counted at once.
BLOCK, BLOCK_BYTES, _COLUMNS = 1024, 16_000_000, 4096
#: Standard errors by which a sketch must miss the threshold before its pair is dropped.
MARGIN = 5.0
_SETS = "doc_id long, n_shingles long, k1 long, k2 long, sketch array<long>, keys array<array<long>>"


@functools.cache
def _family() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    multipliers = rng.integers(1, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    orders = np.stack([rng.permutation(HASHES)[: DEPTHS[-1]] for _ in range(TREES)])
    return multipliers, orders


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingles of every text, in order."""
    raw, at = K.text_bytes(texts)
    with np.errstate(over="ignore"):
        weights = K.mix64(np.arange(101, 101 + size, dtype=np.uint64)) | np.uint64(1)
        for _, _, part, offsets in K.slices(raw, at):
            low = K.lower_ascii(part)
            starts, ends, rows = K.word_spans(low, offsets)
            words = K.span_hashes(low, starts, ends)
            cut = K.grouped(words, rows, len(offsets) - 1)
            whole = max(0, len(words) - size + 1)
            total = np.zeros(whole, np.uint64)
            for j in range(size):
                total += words[j : j + whole] * weights[j]
            total = K.mix64(total)
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                if b - a >= size:
                    yield np.unique(total[a : b - size + 1])
                elif b > a:
                    yield K.mix64(np.array([(words[a:b] * weights[: b - a]).sum() + np.uint64(b - a)], np.uint64))
                else:
                    yield np.zeros(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum hashes of a set that is not empty."""
    multipliers, _ = _family()
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 512):
        np.minimum(low, (x[i : i + 512, None] * multipliers).min(0), out=low)
    return low


def _described(shingles: np.ndarray) -> tuple:
    """Set key (two 64-bit sums), two-bit sketch and tree prefixes."""
    if not len(shingles):
        return 0, None, None, None, None
    low = signature(shingles)
    _, orders = _family()
    bits = np.unpackbits((low & 3).astype(np.uint8)[:, None], axis=1, count=8)[:, 6:].ravel()
    sketch = np.packbits(bits).view(np.int64)
    running = K.mix64(np.arange(1, TREES + 1, dtype=np.uint64))
    keys = []
    for depth in range(DEPTHS[-1]):
        running = K.mix64(running * np.uint64(0x9E3779B97F4A7C15) + low[orders[:, depth]])
        if depth + 1 in DEPTHS:
            keys.append(running.view(np.int64).tolist())
    k1, k2 = K.mix64(shingles).sum(dtype=np.uint64), K.mix64(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return len(shingles), int(k1.view(np.int64)), int(k2.view(np.int64)), sketch.tolist(), keys


def described_sets(docs: DataFrame, size: int) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    K.prepare(docs.sparkSession)
    schema = to_arrow_schema(StructType.fromDDL(_SETS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for b in batches:
                rows = [_described(s) for s in shingle_sets(b.column(1), size)]
                yield K.batch(schema, [b.column(0), *([list(c) for c in zip(*rows, strict=True)] or [[]] * 5)])

    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(run, _SETS)


def _similar(sketches: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sketches don't rule the threshold out."""
    target = 0.25 + 0.75 * percent / 100
    least = HASHES * target - MARGIN * (HASHES * target * (1 - target)) ** 0.5

    def differ(i: int) -> Column:
        x = F.col("sa")[i].bitwiseXOR(F.col("sb")[i])
        return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))

    a = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    b = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))
    differing = sum((differ(i) for i in range(1, HASHES // 32)), differ(0))
    return pairs.join(a, "a").join(b, "b").where(F.lit(HASHES) - differing >= least).select("a", "b")


def _confirmed(texts: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(shingle_sets(batch.column(2), size), shingle_sets(batch.column(3), size), strict=True):
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row: links are pairs of texts of at least ``percent`` similarity, 80 to 100."""
    if not 80 <= percent <= 100:
        raise ValueError("the forest finds too few of the pairs below a similarity of 80 percent")
    scratch = Scratch(docs.sparkSession)
    stored = scratch.stored
    sets = stored(described_sets(docs, size))
    filled = sets.where("n_shingles > 0 and doc_id is not null")
    groups = stored(filled.groupBy("k1", "k2").agg(F.min("doc_id").alias("node")))
    chosen = filled.join(groups, ["k1", "k2"]).where("doc_id = node").dropDuplicates(["node", "k1", "k2"])
    rows = chosen.select("node", F.posexplode(F.arrays_zip(*[F.col("keys")[i].alias(f"p{d}") for i, d in enumerate(DEPTHS)])))
    rows = stored(rows.select("node", *[F.col("col")[f"p{d}"].alias(f"p{d}") for d in DEPTHS]))
    first = f"p{DEPTHS[0]}"
    near = stored(rows.join(stored(rows.groupBy(first).agg(F.count("*").alias("n")).where("n > 1").select(first)), first))
    nodes = stored(near.select("node").distinct())
    sketches = stored(chosen.select("node", "sketch").join(nodes, "node"))
    raw = docs.select(docs["doc_id"].cast("long").alias("node"), docs["text"]).join(nodes, "node")
    texts = stored(raw.groupBy("node").agg(F.max("text").alias("text")))
    scratch.drop(sets, groups, near, sketches, texts)
    links = stored(_confirmed(texts, _similar(sketches, _neighbours(near).distinct(), percent), size, percent))
    components = connected_components(links)

    deepest = f"p{DEPTHS[-1]}"
    crowded, more = near.select("node", *[f"p{d}" for d in DEPTHS]), None
    crowded = stored(crowded.join(components, "node", "left").withColumn("component", F.coalesce("component", "node")))
    for depth in DEPTHS:
        unsettled = _unsettled(crowded, f"p{depth}", stored)
        small = _across(unsettled.where(F.col("n") <= REGION), f"p{depth}")
        more = small if more is None else more.union(small)
        crowded = stored(unsettled.where(F.col("n") > REGION).drop("n"))
    found = stored(_confirmed(texts, _similar(sketches, more.distinct(), percent), size, percent))
    scratch.drop(sets, groups, texts, crowded, found)
    if not found.isEmpty():
        components = connected_components(found.union(components.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    crowded = crowded.select("node", deepest).join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    crowded = stored(_unsettled(stored(crowded), deepest, stored))
    if not crowded.isEmpty():
        found = stored(_block_links(crowded, texts, deepest, size, percent, stored))
        if not found.isEmpty():
            components = connected_components(found.union(components.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    named = stored(groups.join(components, "node", "left").select("k1", "k2", F.coalesce("component", "node").alias("component_id")))
    scratch.drop(sets, named)
    out = sets.select("doc_id", "n_shingles", "k1", "k2").join(named, ["k1", "k2"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    out = out.select("doc_id", "n_shingles", own.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _neighbours(rows: DataFrame) -> DataFrame:
    """Pairs of texts that are next to each other in a sorted order and have a common prefix there, and, for some prefixes, of each with the first text there.

    The latter keep the links of a group short, so that its components are found in few rounds. A group of near copies has a common
    prefix in most trees, so a part of the prefixes, chosen by their hash, does; all other pairs are left to the steps that follow.

    A key of depth d hashes the tree and its first d minimum hashes, so that one sort by the keys holds the sorted orders of
    all trees, and the longest common prefix of two rows is at least as deep as their last equal key.
    """
    keys = [f"p{d}" for d in DEPTHS]
    ordered = rows.select(*keys, "node").repartitionByRange(*keys, "node").sortWithinPartitions(*keys, "node").select(keys[0], "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, node, lead = (np.zeros(0, np.int64) for _ in range(3))  # the last row of the batch before, and the first one of its prefix
        for b in batches:
            key, node = np.append(key, b.column(0).to_numpy()), np.append(node, b.column(1).to_numpy())
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
            first = np.repeat(node[start], np.diff(np.append(start, len(key))))
            if len(lead):
                first[: start[1] if len(start) > 1 else len(key)] = lead[0]
            at = np.flatnonzero(key[1:] == key[:-1])
            star = key % LED == 0
            left, right = np.concatenate([node[at], first[star]]), np.concatenate([node[at + 1], node[star]])
            apart = left != right
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(left, right)[apart]), pa.array(np.maximum(left, right)[apart])], names=["a", "b"])
            key, node, lead = key[-1:], node[-1:], first[-1:]

    return ordered.mapInArrow(run, "a long, b long")


def _unsettled(rows: DataFrame, key: str, stored: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows of the regions that hold several components, with the region's size n."""
    sizes = rows.groupBy(key).agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    return rows.join(stored(sizes.select(key, "n")), key)


def _block_links(rows: DataFrame, texts: DataFrame, key: str, size: int, percent: int, stored: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Links between different components of crowded regions, enough of them to join all that any pair of texts joins."""
    members = _groups(rows, key, stored).join(texts, "node")
    sized = stored(members.withColumn("bytes", F.octet_length("text")))
    blocks = sized.groupBy("kind", "grp").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("bytes") / BLOCK_BYTES)).alias("blocks"))
    dealt = sized.join(blocks, ["kind", "grp"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    met = met.select("kind", "grp", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "component", "text")

    def compare(group: pa.Table) -> pa.Table:
        a, b = _joining_links(group.column("own").to_numpy(), group.column("node").to_numpy(), group.column("component").to_numpy(), list(shingle_sets(group.column("text"), size)), percent)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return met.groupBy("kind", "grp", "low", "high").applyInArrow(compare, "a long, b long").distinct()


def _groups(rows: DataFrame, key: str, stored: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(kind, grp, node, component): the crowded regions, or, where it takes fewer rows to compare them at once, all regions that overlap as one group.

    The trees find much the same crowd, so that most of its pairs share many regions. A group of n texts is read once for each of its
    blocks, in the one form and in the other.
    """
    reads = lambda n: n * F.ceil(n / BLOCK)
    regions = stored(rows.groupBy(key).agg(F.count("*").alias("n"), F.min("node").alias("lead")))
    edges = rows.join(regions, key).select(F.col("lead").alias("a"), F.col("node").alias("b"))
    spread = stored(connected_components(edges).withColumnRenamed("component", "grp"))
    apart = regions.join(spread.withColumnRenamed("node", "lead"), "lead").groupBy("grp").agg(F.sum(reads(F.col("n"))).alias("apart"))
    at_once = spread.groupBy("grp").agg(F.count("*").alias("n")).join(apart, "grp").select("grp", (reads(F.col("n")) <= F.col("apart")).alias("at_once"))
    tagged = stored(rows.join(spread, "node").join(at_once, "grp"))
    whole = tagged.where("at_once").select(F.lit(1).alias("kind"), "grp", "node", "component").dropDuplicates(["node"])
    return whole.union(tagged.where("not at_once").select(F.lit(0), F.col(key), "node", "component"))


def _joining_links(block: np.ndarray, node: np.ndarray, component: np.ndarray, sets: list[np.ndarray], percent: int) -> tuple[list[int], list[int]]:
    """Links between the texts of two blocks (or inside one) that join components, without those whose ends are joined by others."""
    order = np.argsort(block, kind="stable")
    first = int((block == block.min()).sum()) if block.min() != block.max() else 0  # rows of the first block; 0: there is but one
    sizes = np.array([len(sets[i]) for i in order])
    owner = np.repeat(np.arange(len(order)), sizes)
    values, column = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    shared = np.bincount(column, minlength=len(values)) > 1
    place = np.cumsum(shared) - 1
    owner, column = owner[shared[column]], place[column[shared[column]]]
    by_column = np.argsort(column, kind="stable")
    owner, column = owner[by_column], column[by_column]
    common = np.zeros((first or len(order), len(order) - first), np.float32)
    edges = np.searchsorted(column, np.arange(0, int(shared.sum()) + _COLUMNS, _COLUMNS))
    for k, (x, y) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        part = np.zeros((len(order), _COLUMNS), np.float32)
        part[owner[x:y], column[x:y] - k * _COLUMNS] = 1
        common += (part[:first] if first else part) @ part[first:].T
    common = common.astype(np.int64)
    left, right = np.arange(first or len(order)), np.arange(first, len(order))
    both = sizes[left][:, None].astype(np.int64) + sizes[right][None, :]
    own = component[order]
    linked = (100 * common >= percent * (both - common)) & (own[left][:, None] != own[right][None, :])
    root: dict[int, int] = {}

    def top(c: int) -> int:
        while (up := root.get(c, c)) != c:
            root[c] = c = root.get(up, up)
        return c

    out: tuple[list[int], list[int]] = ([], [])
    for i, j in zip(*np.nonzero(linked), strict=True):
        x, y = top(int(own[i])), top(int(own[first + j]))
        if x != y:
            root[max(x, y)] = min(x, y)
            pair = sorted((int(node[order[i]]), int(node[order[first + j]])))
            out[0].append(pair[0])
            out[1].append(pair[1])
    return out


def _across(rows: DataFrame, key: str) -> DataFrame:
    """Pairs of different components in regions of at most REGION rows."""
    members = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("node", "component"))).alias("m"))
    left = members.select(F.posexplode("m").alias("i", "x"), "m")
    right = left.select("x", F.explode(F.slice("m", F.col("i") + 2, REGION)).alias("y"))
    return right.where("x.component <> y.component").select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(K.documents(spark, sf_dir), size=3, percent=85)
