"""Toxicity scores of texts whose wording may be disguised.

A word may be spelled with digits and signs, spaced out or stretched. Such words become character
lattices: a sign may stand for several letters, for nothing, or repeat the letter before it. Viterbi decoding under a
character trigram model, which is learned from the same training rows, restores the likeliest spelling. Signs at the end
of a word may be letters or just signs, so the word is read with none, some and all of them. A run of spaced-out
characters may hold several words: it is read from each of its characters on, and after each further character, until the
likeliest reading is longer than every word that the model knows, or spends more than ``SPREAD`` characters on each letter
of the longest one. The restored words and all plain words are then scored by learned log-odds of words and word
beginnings; a text's score is the calibrated log-odds of its most telling word.

Learning uses all labelled rows. It
learns spaced-out words of at most ``SPACED`` letters; plain words have no such bound.

Defined cases: null, empty and letterless texts have the score of a text without any telling
word; whole texts are read, however long; repeated rows get equal scores; a doc_id
that has several labels counts with each; without labelled rows of both classes every score is 1 / (1 + e ** 30),
practically 0; other columns don't matter; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.llm import kernels as K
from dealspark.llm.scoring import labelled_texts, score_column, scored
from dealspark.session import Scratch, table

#: Most words and beginnings in a model.
FEATURES = 16_384
#: Texts of the toxic class that must hold a feature.
SUPPORT = 4
#: Letters of a spaced-out word that is learned; characters of a spaced-out run for each letter of a word.
SPACED, SPREAD = 24, 4
_BEGINNINGS = (4, 5)
#: Letters that a sign may stand for: fixed values.
STANDS_FOR = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "+": "t", "|": "il", "(": "c", "€": "e", "*": "aeiou"}
_SEPARATORS = ".-_*~'`^,:;/\\#%&="
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = True
_BEFORE = np.zeros(256, bool)
_BEFORE[[b for c in [*STANDS_FOR, *_SEPARATORS] for b in c.encode() if b < 0x80]] = True
_AFTER = np.zeros(256, bool)
_AFTER[[*range(0x30, 0x3A), 0x40]] = True
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in STANDS_FOR if c < "\x80"]] = True
_EURO = "€".encode()
_PLACE = 27 * 27


def _spelled(path: tuple | None, most: float = math.inf) -> str | None:
    """The letters of a reading, null if there are more than ``most``."""
    out = []
    while path is not None:
        if len(out) >= most:
            return None
        out.append(path[0])
        path = path[1]
    return "".join(reversed(out))


class Decoder:
    """Viterbi decoding of disguised words under a character trigram model."""

    def __init__(self, counts: np.ndarray):
        total = counts.reshape(27, 27, 27).astype(np.float64) + 0.1
        self.log = np.log(total / total.sum(2, keepdims=True)).tolist()
        self.cache: dict[str, str] = {}
        self.tails: dict[tuple[str, int], list[str]] = {}
        self.runs: dict[tuple[str, int], list[tuple[str, bool]]] = {}

    def restore(self, word: str) -> str:
        found = self.cache.get(word)
        if found is None:
            if len(self.cache) > 200_000:
                self.cache.clear()
            found = self.cache[word] = self._viterbi(word)
        return found

    def endings(self, word: str, longest: int) -> list[str]:
        """Readings of a word up to each sign at its end, where a sign may also double the letter before it, of at most ``longest`` letters.

        They count as whole words only, so longer ones match nothing. All signs are read, in one decoding for each cost.
        """
        found = self.tails.get((word, longest))
        if found is None:
            if len(self.tails) > 200_000:
                self.tails.clear()
            end = len(word)
            while end and not word[end - 1].isalpha():
                end -= 1
            read = {_spelled(path, longest) for cost in (-1.5, -99.0) for c, path, j in zip(word, self._steps(word, cost), range(len(word))) if j >= end and c in STANDS_FOR}
            found = self.tails[word, longest] = sorted(read - {None})
        return found

    def spaced(self, run: str, longest: int) -> list[tuple[str, bool]]:
        """(reading, whole) of the parts of a run of spaced-out characters that may be words of at most ``longest`` letters.

        A part that ends in a sign counts as a whole word only, and is read with the sign and without. The parts from one
        character on share a decoding: its best reading after each further one is that part's.
        """
        found = self.runs.get((run, longest))
        if found is None:
            if len(self.runs) > 20_000:
                self.runs.clear()
            read: set[tuple[str, bool]] = set()
            for i in range(len(run)):
                for cost in (-1.5,) if run.isalpha() else (-1.5, -99.0):
                    lettered = False
                    for j, path in enumerate(self._steps(run[i : i + SPREAD * longest], cost)):
                        part, sign = _spelled(path), not run[i + j].isalpha()
                        if len(part) > longest:
                            break
                        lettered |= not sign
                        if j >= 2 and lettered and (sign or cost == -1.5):
                            read.add((part, sign))
            found = self.runs[run, longest] = sorted(read)
        return found

    def _viterbi(self, word: str, stretch: float = -1.5) -> str:
        path = None
        for path in self._steps(word, stretch):
            pass
        return _spelled(path)

    def _steps(self, word: str, stretch: float) -> Iterator[tuple | None]:
        """The likeliest reading after each character, as its last letter and the reading before it."""
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(26, 26): (0.0, None)}
        for c in word:
            if c.isalpha():
                options, skip = ((c, -0.05),), None
            elif c in STANDS_FOR:
                options, skip = tuple((x, -1.0) for x in STANDS_FOR[c]), -3.0 if c == "*" else -8.0
            else:
                options, skip = (), -0.5
            following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (p, q), (score, path) in states.items():
                if skip is not None:
                    known = following.get((p, q))
                    if known is None or known[0] < score + skip:
                        following[p, q] = (score + skip, path)
                for letter, cost in options:
                    code = ord(letter) - 97 if "a" <= letter <= "z" else 26
                    if path is not None and path[0] == letter:  # the letter before it, stretched
                        known = following.get((p, q))
                        if known is None or known[0] < score + cost + stretch:
                            following[p, q] = (score + cost + stretch, path)
                    value = score + cost + self.log[p][q][code]
                    known = following.get((q, code))
                    if known is None or known[0] < value:
                        following[q, code] = (value, (letter, path))
            states = following or states
            yield max(states.values(), key=lambda x: x[0])[1]


def _spans(mask: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of a mask that don't cross texts."""
    n = len(mask)
    border = np.zeros(n + 1, bool)
    border[at] = True
    first, last = mask.copy(), mask.copy()
    first[1:] &= ~mask[:-1] | border[1:n]
    last[:-1] &= ~mask[1:] | border[1:n]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of separate spans in order."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    place = np.arange(len(raw)) - np.repeat(np.append(0, starts), np.diff(np.concatenate([[0], starts, [len(raw)]])))
    value = np.append(K._BYTE_CODE[raw] * K._powers(int(place.max()) + 1)[place], np.uint64(0))
    edges = np.stack([starts, ends], 1).ravel()
    return K.mix64(np.add.reduceat(value, edges)[::2] + (ends - starts).astype(np.uint64))


def _features(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, whole: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of words of three bytes or more and of their beginnings, unless they count as a whole only, with the word that each belongs to, and their bytes."""
    keep = np.flatnonzero(ends - starts >= 3)
    starts, ends = starts[keep], ends[keep]
    part = np.ones(len(keep), bool) if whole is None else ~whole[keep]
    hashes, owner, sizes = [_hashes(raw, starts, ends)], [keep], [ends - starts]
    for size in _BEGINNINGS:
        longer = np.flatnonzero((ends - starts > size) & part)
        hashes.append(_hashes(raw, starts[longer], starts[longer] + size) ^ np.uint64(size))
        owner.append(keep[longer])
        sizes.append(np.full(len(longer), size))
    return np.concatenate(hashes), np.concatenate(owner), np.concatenate(sizes)


def _disguised(low: np.ndarray, at: np.ndarray, letters: np.ndarray) -> Iterator[tuple[int, str, bool, bool]]:
    """(row, word, inside, ending) of words with signs inside them, or that end in signs, and of runs of single letters and signs, which are neither."""
    starts, ends, rows = K.word_spans(low, at)
    if not len(starts):
        return
    data = low.tobytes()
    mark = np.zeros(len(low) + 1, bool)
    mark[1:-1] = (letters[1:] & _BEFORE[low[:-1]]) | (letters[:-1] & _AFTER[low[1:]])
    mark[2:-1] |= letters[2:] & (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2])
    tail = np.zeros(len(low) + 1, bool)
    tail[1:-1] = letters[:-1] & _SIGN[low[1:]]
    euro, i = [], data.find(_EURO)
    while i >= 0:
        euro.append(i)
        i = data.find(_EURO, i + 3)
    mark[euro] = True
    own = np.add.reduceat(letters, starts) > 3 * np.bincount(np.searchsorted(starts, euro, side="right") - 1, minlength=len(starts)) if euro else np.add.reduceat(letters, starts) > 0
    inner = np.append(True, ~K._WHITE[low[:-1]])
    inside = (np.add.reduceat(mark[:-1] & inner, starts) > 0) & own
    last = low[ends - 1]
    ending = ((np.add.reduceat(tail[:-1] & inner, starts) > 0) | inside) & own & ~letters[ends - 1] & (ends - starts > 1)
    ending |= inside & (last == _EURO[2]) & np.isin(ends - 3, euro)
    for k in np.flatnonzero(inside | ending):
        yield int(rows[k]), data[starts[k] : ends[k]].decode("utf-8", "replace"), bool(inside[k]), bool(ending[k])
    single = (ends - starts == 1) & (letters | _SIGN[low])[starts]
    if euro:
        single |= (ends - starts == 3) & np.isin(starts, euro)
    runs = np.flatnonzero(np.diff(np.concatenate([[0], single.astype(np.int8), [0]])))
    for a, b in zip(runs[::2], runs[1::2], strict=True):
        if b - a >= 3 and letters[starts[a:b]].any():
            for row in np.unique(rows[a:b]):
                mine = np.arange(a, b)[rows[a:b] == row]
                yield int(row), _short(data[starts[mine[0]] : ends[mine[-1]]].translate(None, b" \t\r\n\v\f").decode()), False, False


def _short(run: str) -> str:
    """A run with at most three of the same character in a row: more say nothing more."""
    return re.sub(r"(.)\1{3,}", r"\1\1\1", run)


def _restored(low: np.ndarray, at: np.ndarray, letters: np.ndarray, decoder: Decoder, longest: int) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Rows, words, and whether a word counts as a whole only: what signs at the end make of a word says nothing of how it begins."""
    rows, words, whole = [], [], []
    for row, word, inside, ending in _disguised(low, at, letters):
        found = [(decoder.restore(word), False)] if inside else []
        found += [(x, True) for x in decoder.endings(word, longest)] if ending else []
        found += decoder.spaced(word, longest) if not (inside or ending) else []
        for x, only in found:
            rows.append(row)
            words.append(x)
            whole.append(only)
    return np.array(rows, np.int64), words, np.array(whole, bool)


class Model:
    """Features with their log-odds, and the calibration of a text's highest one."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, counts: np.ndarray, slope: float, offset: float, longest: int = SPACED):
        order, self.longest = np.argsort(hashes), longest
        self.hashes, self.weights = hashes[order], weights[order]
        self.counts, self.slope, self.offset = counts, slope, offset
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.hashes >> np.uint64(44)).astype(np.int64)] = True
        self.decoder: Decoder | None = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "decoder"} | {"decoder": None}

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are features, and their weights."""
        some = np.flatnonzero(self.sieve[(hashes >> np.uint64(44)).astype(np.int64)])
        if not len(some) or not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0)
        at = np.minimum(np.searchsorted(self.hashes, hashes[some]), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes[some]
        return some[hit], self.weights[at[hit]]

    def highest(self, texts: pa.Array) -> np.ndarray:
        """The highest weight of a word in each text, 0 without one."""
        self.decoder = self.decoder or Decoder(self.counts)
        raw, at = K.text_bytes(texts)
        out = np.zeros(len(at) - 1)
        for i, _, part, offsets in K.slices(raw, at):
            low = K.lower_ascii(part)
            letters = _LETTER[low]
            starts, ends = _spans(letters, offsets)
            hashes, owner, _ = _features(low, starts, ends)
            hit, weight = self.lookup(hashes)
            np.maximum.at(out, i + np.searchsorted(offsets, starts[owner[hit]], side="right") - 1, weight)
            rows, words, whole = _restored(low, offsets, letters, self.decoder, self.longest)
            if words:
                sizes = [len(w.encode()) for w in words]
                data = np.frombuffer("".join(words).encode("utf-8"), np.uint8)
                ends = np.cumsum(sizes)
                hashes, owner, _ = _features(data, ends - sizes, ends, whole) if len(data) else (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 2)
                hit, weight = self.lookup(hashes)
                np.maximum.at(out, i + rows[owner[hit]], weight)
        return out

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.highest(texts) + self.offset, -30, 30)))


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """A model from all labelled rows (doc_id, label); the caller leaves out what must not be learned from."""
    spark = docs.sparkSession
    K.prepare(spark)
    scratch = Scratch(spark)  # read three times
    rows = labelled_texts(docs, labels, label)
    rows = scratch.stored(rows.select("label", "text", F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("half")))

    def letters_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(27**3, np.int64)
        for b in batches:
            raw, at = K.text_bytes(b.column(1))
            for _, _, part, offsets in K.slices(raw, at):
                low = K.lower_ascii(part)
                code = np.where((low >= 97) & (low < 123), low.astype(np.int64) - 97, 26)
                total += np.bincount(code[:-2] * 729 + code[1:-1] * 27 + code[2:], minlength=27**3)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["c", "n"])

    counts = np.zeros(27**3, np.int64)
    for r in rows.select("label", "text").mapInArrow(letters_of, "c long, n long").groupBy("c").agg(F.sum("n").alias("n")).collect():  # 27 ** 3 at most
        counts[r["c"]] = r["n"]
    K.release(spark)  # the texts' shuffle, before that of the features

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(counts)
        for b in batches:
            classes, halves = b.column(0).to_numpy(), b.column(2).to_numpy()
            raw, at = K.text_bytes(b.column(1))
            for i, _, part, offsets in K.slices(raw, at):
                low = K.lower_ascii(part)
                letters = _LETTER[low]
                starts, ends = _spans(letters, offsets)
                hashes, owner, size = _features(low, starts, ends)
                row = np.searchsorted(offsets, starts[owner], side="right") - 1
                more, words, whole = _restored(low, offsets, letters, decoder, SPACED)
                if words and (data := np.frombuffer("".join(words).encode("utf-8"), np.uint8)).size:
                    sizes = np.array([len(w.encode()) for w in words])
                    extra, owner, more_size = _features(data, np.cumsum(sizes) - sizes, np.cumsum(sizes), whole)
                    hashes, row, size = np.concatenate([hashes, extra]), np.concatenate([row, more[owner]]), np.concatenate([size, more_size])
                order = np.lexsort((row, hashes))
                hashes, row, size = hashes[order], row[order], size[order]
                own = np.ones(len(row), bool)
                own[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
                hashes, row, size = hashes[own], i + row[own], size[own]
                first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)
                cells = [np.add.reduceat(((classes[row] == c) & (halves[row] == h)).astype(np.int64), first) if len(first) else np.zeros(0, np.int64) for h in (0, 1) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(hashes[first].view(np.int64)), pa.array(size[first].astype(np.int32)), *map(pa.array, cells)], names=["f", "size", "c0", "t0", "c1", "t1"])

    seen = rows.mapInArrow(presence, "f long, size int, c0 long, t0 long, c1 long, t1 long").groupBy("f").agg(F.max("size").alias("size"), *[F.sum(x).alias(x) for x in ("c0", "t0", "c1", "t1")])
    size = {(r["label"], r["half"]): r["n"] for r in rows.groupBy("label", "half").agg(F.count("*").alias("n")).collect()}
    n = {(c, h): max(1, size.get((c, h), 0)) for c in (0, 1) for h in (0, 1)}

    def odds(toxic, clean, n_toxic: int, n_clean: int):
        return F.log((toxic - 0.5) / n_toxic) - F.log((clean + 1) / n_clean)

    both = odds(F.col("t0") + F.col("t1"), F.col("c0") + F.col("c1"), n[1, 0] + n[1, 1], n[0, 0] + n[0, 1])
    top = seen.where(F.col("t0") + F.col("t1") >= SUPPORT).withColumn("w", both).where("w > 0").orderBy(F.desc("w"), "f").limit(FEATURES).collect()
    if not size or not {1, 0} <= {c for c, _ in size}:
        scratch.drop()
        return Model(np.zeros(0, np.uint64), np.zeros(0), counts, 0.0, -30.0)
    hashes = np.array([r["f"] for r in top], np.int64).view(np.uint64)
    longest = max([_BEGINNINGS[-1] + 1, *(r["size"] for r in top)])  # a beginning belongs to a longer word
    halves = []
    for h, g in ((0, 1), (1, 0)):  # weights of one half of the rows, for calibration on the other
        t, c = (np.array([r[f"{k}{h}"] for r in top], np.float64) for k in "tc")
        w = np.where(t >= SUPPORT / 2, np.log(np.maximum(t - 0.5, 0.1) / n[1, h]) - np.log((c + 1) / n[0, h]), 0)
        halves.append((g, Model(hashes, np.maximum(w, 0), counts, 1.0, 0.0, longest)))
    shared = spark.sparkContext.broadcast(dict(halves))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            halves = b.column(2).to_numpy()
            high = np.where(halves == 0, shared.value[0].highest(b.column(1)), shared.value[1].highest(b.column(1)))
            yield pa.RecordBatch.from_arrays([pa.array(high), b.column(0).cast(pa.int32())], names=["x", "y"])

    found = rows.mapInArrow(held, "x double, y int").groupBy("x", "y").count().toPandas().sort_values(["x", "y"])  # a row for each weight of the two models and class
    slope, offset = _calibrate(found["x"].to_numpy(), found["y"].to_numpy(np.float64), found["count"].to_numpy(np.float64))
    scratch.drop()
    return Model(hashes, np.array([r["w"] for r in top]), counts, slope, offset, longest)


def _calibrate(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one number, which n rows have, by Newton's method; clean rows count twice, as most texts are clean."""
    weight = n * np.where(y == 1, 1, 2) / max(1, n.sum())
    design, beta = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - 1e-4 * beta * [1, 0]
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag([1e-4, 1e-9])
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows whose text scores below the threshold, with all their columns."""
    return docs.where(score_column(docs, model) < threshold)


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows that may be learned from: crc32 of doc_id mod 5 is not 0."""
    return table(spark, sf_dir, "labels").where(K.remainder(F.col("doc_id"), 5) != 0)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = K.documents(spark, sf_dir)
    out = scored(docs, learn(docs, training_labels(spark, sf_dir)))
    return out.select("doc_id", (K.remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
