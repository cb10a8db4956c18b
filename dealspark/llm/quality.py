"""Quality scores by Bradley-Terry ranking of preference pairs.

A text is described by numbers that its bytes give (shares of character kinds, word shapes, repetition). Each
training pair holds a text that is labelled good and one that is not; logistic loss on the difference of their
descriptions learns a score under which the good text tends to be ahead. The score that parts the training rows best
becomes the threshold, and the score is scaled so that the threshold is 0.5.

Learning uses all labelled rows and every pair of a good and a bad one, by counts of scores in steps of an eighth.

Defined cases: null and empty texts have the description of a text without characters (all 0) and its
score; whole texts are read; repeated rows get equal scores; without labelled rows of
both classes every score is 0.5; other columns don't matter; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.llm import kernels as K
from dealspark.llm.scoring import labelled, score_column, scored
from dealspark.session import Scratch, table

FEATURES = 20
_KIND = np.zeros(256, np.uint8)  # 0 other letters and bytes, then as named below
_UPPER, _DIGIT, _STOP, _JUNK, _BAR, _BANG, _LINE, _BLANK = range(1, 9)
_KIND[65:91], _KIND[48:58] = _UPPER, _DIGIT
for _chars, _kind in ((".,;:?'\"()-", _STOP), ("#$%&*@^~<>{}[]=+_\\/`", _JUNK), ("|", _BAR), ("!", _BANG), ("\n\r", _LINE), (" \t\v\f", _BLANK)):
    _KIND[[ord(c) for c in _chars]] = _kind


def describe(texts: pa.Array) -> np.ndarray:
    """FEATURES numbers for each text."""
    raw, at = K.text_bytes(texts)
    out = np.zeros((len(at) - 1, FEATURES))
    for i, j, part, offsets in K.slices(raw, at):
        out[i:j] = _describe(part, offsets)
    return out


def _sums(values: np.ndarray, cut: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[cut[1:]] - total[cut[:-1]]


def _describe(part: np.ndarray, at: np.ndarray) -> np.ndarray:
    n = len(at) - 1
    size = np.diff(at).astype(np.float64)
    kind = _KIND[part]
    row = np.repeat(np.arange(n), np.diff(at))
    kinds = np.bincount(row * 9 + kind, minlength=9 * n).reshape(n, 9).astype(np.float64)
    starts, ends, rows = K.word_spans(part, at)
    cut = K.grouped(starts, rows, n)
    words = np.diff(cut).astype(np.float64)
    w, b = np.maximum(words, 1), np.maximum(size, 1)
    length = (ends - starts).astype(np.float64)
    hashes = K.span_hashes(part, starts, ends)

    def distinct(values: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of distinct values in each row and the count of the commonest."""
        if not len(values):
            return np.zeros(n), np.zeros(n)
        order = np.lexsort((values, of))
        v, r = values[order], of[order]
        new = np.flatnonzero(np.append(True, (v[1:] != v[:-1]) | (r[1:] != r[:-1])))
        times, most = np.diff(np.append(new, len(v))), np.zeros(n)
        np.maximum.at(most, r[new], times)
        return np.bincount(r[new], minlength=n).astype(np.float64), most

    different, commonest = distinct(hashes, rows)
    same_row = rows[1:] == rows[:-1] if len(rows) else np.zeros(0, bool)
    with np.errstate(over="ignore"):
        pairs = K.mix64(hashes[:-1] * np.uint64(3) + hashes[1:] * np.uint64(0x9E3779B97F4A7C15))[same_row] if len(rows) else hashes
    pair_rows = rows[1:][same_row] if len(rows) else rows
    pairs_different, pair_commonest = distinct(pairs, pair_rows)
    pair_count = np.maximum(np.bincount(pair_rows, minlength=n), 1)
    stutter = np.bincount(pair_rows, weights=(hashes[1:] == hashes[:-1])[same_row] if len(rows) else None, minlength=n)
    upper = np.concatenate([[0], np.cumsum(kind == _UPPER)])
    odd = np.concatenate([[0], np.cumsum((kind >= _JUNK) & (kind <= _BANG))])
    shouted = (upper[ends] - upper[starts] >= 2) if len(starts) else np.zeros(0, bool)
    soiled = (odd[ends] - odd[starts] > 0) if len(starts) else np.zeros(0, bool)
    log_words = np.log1p(words)
    return np.stack(
        [
            log_words,
            kinds[:, _UPPER] / b,
            kinds[:, _DIGIT] / b,
            kinds[:, _STOP] / w,
            kinds[:, _JUNK] / w,
            kinds[:, _BAR] / w,
            kinds[:, _BANG] / w,
            np.log1p(kinds[:, _LINE]),
            kinds[:, _LINE] / w,
            kinds[:, _BLANK] / w,
            _sums(length, cut) / w,
            np.sqrt(np.maximum(_sums(length**2, cut) / w - (_sums(length, cut) / w) ** 2, 0)),
            different / w,
            log_words * different / w,
            commonest / w,
            pairs_different / pair_count,
            pair_commonest / pair_count,
            stutter / pair_count,
            _sums(shouted, cut) / w,
            _sums(soiled, cut) / w,
        ],
        1,
    )


class Ranking:
    """Bradley-Terry weights over standardised descriptions and their squares, a threshold and a scale."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, weights: np.ndarray, threshold: float, scale: float):
        self.mean, self.spread, self.weights, self.threshold, self.scale = mean, spread, weights, threshold, scale

    def design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -4, 4)
        return np.concatenate([z, z * z], 1)

    def rank(self, x: np.ndarray) -> np.ndarray:
        return self.design(x) @ self.weights

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * (self.rank(describe(texts)) - self.threshold), -30, 30)))


#: Scores at which the rows of a class are counted (a row between two counts in parts at both), and at which their descriptions are summed.
_FINE, _COARSE = np.linspace(-64, 64, 1025), np.linspace(-64, 64, 257)
#: Bins of the scores that may become the threshold.
BINS = 8192
#: Weight of the ridge, most passes over the rows for steps, and by how much a step may raise the loss, which is interpolated.
RIDGE, STEPS, SLACK = 1e-3, 50, 1.001


def _parts(s: np.ndarray, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each score the grid's point before it and the share of the next one."""
    at = (np.clip(s, grid[0], grid[-1]) - grid[0]) / (grid[1] - grid[0])
    low = np.minimum(at.astype(np.int64), len(grid) - 2)
    return low, at - low


def _totals(rows: DataFrame, made) -> np.ndarray:
    """What ``made`` makes of the descriptions and labels of each batch, as an array of a fixed size, added up in every task; one row a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                x, y = b.column(1).flatten().to_numpy().reshape(-1, FEATURES), b.column(0).to_numpy()
                part = made(x, y)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["v"])

    got = [r["v"] for r in rows.select("y", "x").mapInArrow(run, "v array<double>").collect()]
    return np.sum(np.array(got), 0) if got else np.zeros(0)


def bradley_terry(rows: DataFrame) -> Ranking:
    """Learn from all rows (y: 0 or 1, x: a description), each good one paired with each bad one.

    The loss of all pairs needs no row for a pair: what a row adds follows from its score and from how many rows of the other class have which
    score. Each step of Newton's method counts these, then adds up the rows.
    """
    one = _totals(rows, lambda x, y: np.concatenate([[len(y), y.sum()], x.sum(0)]))
    n, good = (int(v) for v in one[:2]) if len(one) else (0, 0)
    model = Ranking(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(2 * FEATURES), 0.0, 1.0)
    if not 0 < good < n:
        return model
    mean, bad, width = one[2:] / n, n - good, 2 * FEATURES
    spread = np.sqrt(_totals(rows, lambda x, y: ((x - mean) ** 2).sum(0)) / n)
    model = Ranking(mean, np.maximum(spread, 1e-6), model.weights, 0.0, 1.0)
    expit = lambda v: 1 / (1 + np.exp(-np.clip(v, -30, 30)))
    apart = _FINE[None, :] - _FINE[:, None]  # a good text at the row's score, a bad one at the column's
    cost, behind = np.logaddexp(0, apart), expit(apart)  # the loss of the two, and the chance that the bad one wins
    chance = expit(_COARSE[None, :] - _COARSE[:, None])
    curve = chance * (1 - chance)
    taken, step, lowest = model.weights, np.full(width, math.inf), math.inf
    for _ in range(STEPS):  # Newton's method with a ridge; a step that raises the loss is halved

        def spread_out(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            z = model.design(x)
            s, counts, sums = z @ model.weights, [], []
            for k in (0, 1):
                low, share = _parts(s[y == k], _FINE)
                counts.append(np.bincount(low, 1 - share, len(_FINE)) + np.bincount(low + 1, share, len(_FINE)))
                low, share = _parts(s[y == k], _COARSE)
                own = np.append(z[y == k], np.ones((len(low), 1)), 1)
                total = np.zeros((len(_COARSE), width + 1))
                np.add.at(total, low, (1 - share)[:, None] * own)
                np.add.at(total, low + 1, share[:, None] * own)
                sums.append(total.ravel())
            return np.concatenate(counts + sums)

        found = _totals(rows, spread_out)
        counts, sums = found[: 2 * len(_FINE)].reshape(2, -1), found[2 * len(_FINE) :].reshape(2, len(_COARSE), width + 1)
        loss = counts[1] @ cost @ counts[0] / good / bad + RIDGE / 2 * model.weights @ model.weights
        if loss > SLACK * lowest:
            step = step / 2
            model = Ranking(model.mean, model.spread, taken + step, 0.0, 1.0)
            continue
        taken, lowest = model.weights, min(loss, lowest)
        if np.abs(step).max() < 1e-4:
            break
        pull = np.stack([behind.T @ counts[1], behind @ counts[0]]) / good / bad  # of a bad and of a good row
        bend = np.stack([curve.T @ sums[1][:, width], curve @ sums[0][:, width]]) / good / bad

        def added(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            z = model.design(x)
            s = z @ model.weights
            parts = ((pull, *_parts(s, _FINE)), (bend, *_parts(s, _COARSE)))
            p, q = ((1 - share) * v[y, low] + share * v[y, low + 1] for v, low, share in parts)
            return np.concatenate([z.T @ (p * (2 * y - 1)), ((z * q[:, None]).T @ z).ravel()])

        found = _totals(rows, added)
        # rows and pairs are taken from the same counts, so that the curvature is that of some set of pairs and never negative
        cross = sums[1][:, :width].T @ curve @ sums[0][:, :width] / good / bad
        hessian = found[width:].reshape(width, width) - cross - cross.T + RIDGE * np.eye(width)
        step = np.linalg.solve(hessian, found[:width] - RIDGE * model.weights)
        model = Ranking(model.mean, model.spread, taken + step, 0.0, 1.0)
    model.weights = taken

    def extent(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        s = model.rank(x)
        return np.array([s.sum(), (s**2).sum()])

    middle, square = _totals(rows, extent) / n
    deviation = max(math.sqrt(max(square - middle**2, 0)), 1e-6)
    edges = middle + deviation * np.linspace(-10, 10, BINS + 1)[:-1]  # what lies beyond counts at the ends

    def binned(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        at = np.searchsorted(edges, model.rank(x), side="right")
        return np.bincount(y * (BINS + 1) + at, minlength=2 * (BINS + 1)).astype(np.float64)

    # the score that parts the classes with the fewest errors, each class counting as a half, among those from the 0.5th to the 99.5th percentile
    below = np.cumsum(_totals(rows, binned).reshape(2, -1), 1)[:, :-1]
    wrong = (1 - below[0] / bad) + below[1] / good
    inside = (below.sum(0) >= 0.005 * n) & (below.sum(0) <= 0.995 * n)
    wrong = np.where(inside, wrong, np.inf) if inside.any() else wrong
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    model.threshold, model.scale = float(edges[best[len(best) // 2]]), 4.0 / deviation
    return model


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Ranking:
    """A ranking from all labelled rows (doc_id, label); the caller leaves out what must not be learned from."""
    K.prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(describe(b.column(1))), pa.list_(pa.float64()))], names=["doc_id", "x"])

    # described before the join: FEATURES numbers a text are joined, not the texts
    described = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null").mapInArrow(run, "doc_id long, x array<double>")
    scratch = Scratch(docs.sparkSession)
    model = bradley_terry(scratch.stored(described.join(labelled(labels, label), "doc_id").select(F.col("label").cast("long").alias("y"), "x")))
    scratch.drop()
    return model


def without_low_quality(docs: DataFrame, model: Ranking, threshold: float = 0.5) -> DataFrame:
    """The rows whose text reaches the threshold, with all their columns."""
    return docs.where(score_column(docs, model) >= threshold)


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows that may be learned from: crc32 of doc_id mod 3 is not 1."""
    return table(spark, sf_dir, "labels").where(K.remainder(F.col("doc_id"), 3) != 1)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = K.documents(spark, sf_dir)
    out = scored(docs, learn(docs, training_labels(spark, sf_dir)))
    return out.select("doc_id", (K.remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
