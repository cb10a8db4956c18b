"""Language-model scoring by subword lattices.

A word is a lattice of vocabulary pieces; the weights of all its segmentations are summed by a
forward recursion in log space. A document's marginal probability is the product over its words and its end. Two
sets of piece weights are used. ``vocabulary_score`` takes those of the existing vocabulary as they are: its model ranks
pieces by merges and has no probabilities, so a piece of rank r weighs 1 / (r + 30). ``score`` departs from them twice,
as they know nothing of the corpus: they are re-estimated by expectation and maximisation over the counts of all training
words, with the vocabulary's weights as a prior, and a word that training has seen also has one arc of its own, weighted by its
count. The word-count base with additive smoothing is returned beside both.

How it runs: words are counted per task and summed by word; each distinct word is scored once. The
``HEAD`` most frequent words at most are broadcast and cover most tokens where they are read; the rest of the
tokens travel as packed arrays to buckets of the word table, whose number grows with the corpus so that a bucket stays
small, and come back as sums.

Defined cases: null text is scored like an empty one, of which only the end counts; rows without doc_id are scored and keep
their null; words of any length are read, long ones in stretches, with 16 bytes of memory for each of theirs; repeated rows get equal scores and count as often as they occur; without training
rows all words are unknown; other columns don't matter; an empty table gives no rows. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import copy
import functools
import math
import uuid
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.llm import kernels as K
from dealspark.session import Scratch

HEAD, ROUNDS, PRIOR = 65_536, 3, 200.0
#: Distinct words that a task counts before it hands them on.
_COUNTED = 400_000
#: Documents, and tokens outside the head, that travel together at most; training tokens for each bucket of words.
_GROUP_DOCS, _GROUP_TOKENS, _BUCKET_TOKENS = 32_768, 1_000_000, 500_000
_NEVER = -1e30
#: Bytes from which a word is read in stretches of so many, by itself; bytes of such words that are counted or valued together.
_LONG, _STRETCH, _HELD = 4096, 65_536, 16_000_000


class Pieces:
    """Byte strings of a vocabulary (a leading space begins a word), their prior and their log weights."""

    def __init__(self, texts: list[bytes], prior: np.ndarray):
        self.texts = texts
        self.initial = np.array([t[:1] == b" " for t in texts])
        self.longest = max(map(len, texts))
        self.prior = prior
        keys = np.array([self._key(t) for t in texts], np.uint64)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.keys >> np.uint64(44)).astype(np.int64)] = True
        self.log, self.stop = np.zeros(len(texts)), 0.0
        self.weigh(np.zeros(len(texts)), 0.0)

    @staticmethod
    def _key(text: bytes) -> int:
        with np.errstate(over="ignore"):
            h = np.zeros(1, np.uint64)
            for b in text:
                h = h * _STEP + _CODE[b]
            return int(K.mix64(h + np.uint64(len(text)))[0])

    def weigh(self, expected: np.ndarray, stops: float) -> None:
        """Weights from expected counts and the prior: initial pieces on their own, the others with the word's end."""
        log = np.empty(len(self.texts))
        first = self.initial
        p = expected[first] + PRIOR * self.prior[first] / self.prior[first].sum()
        log[first] = np.log(p / p.sum())
        rest = expected[~first] + PRIOR * self.prior[~first] / self.prior[~first].sum()
        stop = stops + PRIOR * 0.4
        log[~first] = np.log(rest / (rest.sum() + stop))
        self.log, self.stop = log, float(np.log(stop / (rest.sum() + stop)))

    def arcs(self, words: np.ndarray) -> np.ndarray:
        """Piece of each arc of words (n, bytes) by [word, end, length], -1 without one."""
        n, size = words.shape
        found = np.full((n, size, min(size, self.longest)), -1, np.int32)
        h = np.zeros((n, size), np.uint64)
        for k in range(found.shape[2]):
            h = h[:, : size - k] * _STEP + _CODE[words[:, k:]]
            key = K.mix64(h + np.uint64(k + 1))
            some = np.flatnonzero(self.sieve[(key >> np.uint64(44)).astype(np.int64)])
            wanted = key.ravel()[some]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            hit = self.keys[at] == wanted
            row, start = np.divmod(some[hit], size - k)
            found[row, start + k, k] = self.order[at[hit]]
        return found


_CODE = K.mix64(np.arange(501, 757, dtype=np.uint64))
_STEP = np.uint64(0xD6E8FEB86659FD93)


@functools.cache
def vocabulary(path: str) -> Pieces:
    """Pieces of a sentencepiece model. Its scores rank the pieces; a rank r has prior weight 1 / (r + 30)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    weight: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if model.is_unknown(i) or model.is_control(i):
            continue
        rank = model.get_piece_size() if model.is_byte(i) else -model.get_score(i)
        text = bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
        if rank < 1e6:
            weight[text] = weight.get(text, 0) + 1 / (rank + 30)
    weight.setdefault(b" ", 1 / 32_000)
    return Pieces(list(weight), np.array(list(weight.values())))


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(1)
    return top + np.log(np.exp(x - top[:, None]).sum(1))


def _forward(weights: np.ndarray) -> np.ndarray:
    """Log sums of all paths to each position, by [word, position]; weights by [word, end, length]."""
    n, size, longest = weights.shape
    alpha = np.full((n, size + longest), _NEVER)
    alpha[:, longest - 1] = 0
    for j in range(size):
        alpha[:, longest + j] = _log_sum(alpha[:, j : j + longest][:, ::-1] + weights[:, j])
    return alpha[:, longest - 1 :]


def _stretches(pieces: Pieces, word: np.ndarray, backwards: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(start, end, piece) of the arcs of a word's bytes, sorted by end, those that end in one stretch at a time."""
    edges = range(0, len(word), _STRETCH)
    for first in reversed(edges) if backwards else edges:
        before = max(0, first - pieces.longest + 1)
        arcs = pieces.arcs(word[None, before : first + _STRETCH])[0]
        end, k = np.nonzero(arcs[first - before :] >= 0)
        yield end + first - k, end + first + 1, arcs[end + first - before, k]


def _pass(sums: array, arcs: Iterator[tuple[int, int, float]]) -> None:
    """Add, in log space, what each arc (from, to, weight) carries."""
    exp, log1p = math.exp, math.log1p
    for origin, goal, weight in arcs:
        low, high = sums[origin] + weight, sums[goal]
        if low > high:
            low, high = high, low
        sums[goal] = high + log1p(exp(low - high))


def _long_forward(pieces: Pieces, word: np.ndarray) -> array:
    """Log sums of all paths to each position of one long word."""
    alpha = array("d", [_NEVER]) * (len(word) + 1)
    alpha[0] = 0.0
    for start, end, piece in _stretches(pieces, word):
        _pass(alpha, zip(start.tolist(), end.tolist(), pieces.log[piece].tolist(), strict=True))
    return alpha


def _long_counts(pieces: Pieces, word: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in one long word."""
    alpha = _long_forward(pieces, word)
    beta = array("d", [_NEVER]) * (len(word) + 1)
    beta[-1] = 0.0
    ahead, behind = np.frombuffer(alpha), np.frombuffer(beta)
    total = np.zeros(len(pieces.texts))
    for start, end, piece in _stretches(pieces, word, backwards=True):
        _pass(beta, zip(end[::-1].tolist(), start[::-1].tolist(), pieces.log[piece[::-1]].tolist(), strict=True))
        total += np.bincount(piece, weights=np.exp(ahead[start] + pieces.log[piece] + behind[end] - ahead[-1]), minlength=len(total))
    return total


def _by_size(words: list[bytes], longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, bytes) of words with their leading space, of one size each, some at a time; a long word comes alone."""
    sizes = np.array([len(w) + 1 for w in words])
    order = np.argsort(sizes, kind="stable")
    for a, b in zip(*(lambda e: (e[:-1], e[1:]))(np.concatenate([[0], np.flatnonzero(np.diff(sizes[order])) + 1, [len(order)]])), strict=True):
        size = int(sizes[order[a]])
        step = max(1, 1_500_000 // (size * min(size, longest)))
        for i in range(a, b, step):
            own = order[i : min(b, i + step)]
            yield own, np.frombuffer(b"".join(b" " + words[k] for k in own), np.uint8).reshape(len(own), size)


def log_probabilities(pieces: Pieces, words: list[bytes]) -> np.ndarray:
    """Natural log of each word's probability, summed over all its segmentations."""
    out = np.zeros(len(words))
    if words:
        with np.errstate(over="ignore"):
            for own, data in _by_size(words, pieces.longest):
                if data.shape[1] > _LONG:
                    out[own] = [_long_forward(pieces, word)[-1] + pieces.stop for word in data]
                    continue
                arcs = pieces.arcs(data)
                out[own] = _forward(np.where(arcs >= 0, pieces.log[arcs], _NEVER))[:, -1] + pieces.stop
    return out


def expected_counts(pieces: Pieces, words: list[bytes], counts: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in words that occur so often: forward and backward sums over the lattice."""
    total = np.zeros(len(pieces.texts))
    if not words:
        return total
    with np.errstate(over="ignore"):
        for own, data in _by_size(words, pieces.longest):
            if data.shape[1] > _LONG:
                for k, word in zip(own, data, strict=True):
                    total += counts[k] * _long_counts(pieces, word)
                continue
            arcs = pieces.arcs(data)
            weights = np.where(arcs >= 0, pieces.log[arcs], _NEVER)
            n, size, longest = weights.shape
            alpha = _forward(weights)
            beta = np.full((n, size + 1), _NEVER)
            beta[:, size] = 0
            for i in range(size - 1, -1, -1):
                reach = min(longest, size - i)
                k = np.arange(reach)
                beta[:, i] = _log_sum(weights[:, i + k, k] + beta[:, i + 1 : i + 1 + reach])
            row, end, k = np.nonzero(arcs >= 0)
            share = np.exp(alpha[row, end - k] + weights[row, end, k] + beta[row, end + 1] - alpha[row, size])
            total += np.bincount(arcs[row, end, k], weights=share * counts[own][row], minlength=len(total))
    return total


def _word_counts(docs: DataFrame, training: Column) -> DataFrame:
    """word and c, its count in training rows (0 if only other rows have it); the empty word counts the rows' ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        others: set[bytes] = set()
        held = 0  # bytes of long words

        def flush() -> pa.RecordBatch:
            only = [w for w in others if w not in counts]
            out = pa.RecordBatch.from_arrays([pa.array([*counts, *only], pa.binary()), pa.array([*counts.values(), *[0] * len(only)], pa.int64())], names=["word", "c"])
            counts.clear()
            others.clear()
            return out

        for b in batches:
            kept = b.column(1).to_pylist()
            raw, at = K.text_bytes(b.column(0))
            for i, _, part, offsets in K.slices(raw, at):
                data = K.lower_ascii(part).tobytes()
                for k, (x, y) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                    words = data[x:y].split()
                    if y - x > _LONG:
                        held += sum([len(w) for w in words if len(w) > _LONG])
                    if kept[i + k]:
                        counts.update(words)
                        counts[b""] += 1
                    else:
                        others.update(words)
                if len(counts) + len(others) > _COUNTED or held > _HELD:
                    yield flush()
                    held = 0
        yield flush()

    return docs.select("text", training.alias("kept")).mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 30_000) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words and counts of several batches together: the recursions run over many words at once."""
    words: list[bytes] = []
    counts: list[np.ndarray] = []
    held = 0
    for b in batches:
        words += b.column(0).to_pylist()
        counts.append(b.column(1).to_numpy())
        held += b.column(0).nbytes
        if len(words) >= rows or held >= _HELD:
            yield words, np.concatenate(counts)
            words, counts, held = [], [], 0
    if words:
        yield words, np.concatenate(counts)


class Scorer:
    """The model: piece weights, corpus totals and how much weight a seen word's own arc has."""

    def __init__(self, pieces: Pieces, tokens: int, types: int, ends: int):
        self.pieces, self.tokens, self.types, self.ends = pieces, tokens, types, ends
        self.given = copy.copy(pieces)  # the same pieces with the vocabulary's weights alone
        self.given.weigh(np.zeros(len(pieces.texts)), 0.0)
        self.end = (ends + 0.5) / (tokens + 1)
        seen = max(0, tokens - ends)
        self.seen = seen
        self.own = seen / (seen + max(1, types)) if seen else 0.0

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.tokens + 0.1 * (self.types + 1)))

    def model(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """log10 of each word's probability as a token."""
        spelled = log_probabilities(self.pieces, words) + math.log1p(-self.own)
        whole = np.log(np.maximum(self.own * counts / max(1, self.seen), 1e-300))
        both = np.where(counts > 0, np.logaddexp(spelled, whole), spelled)
        return (both + math.log1p(-self.end)) / math.log(10)

    def vocabulary(self, words: list[bytes]) -> np.ndarray:
        """As ``model``, by the vocabulary's weights alone."""
        return (log_probabilities(self.given, words) + math.log1p(-self.end)) / math.log(10)


def train(words: DataFrame, path: str) -> Scorer:
    """Totals and re-estimated piece weights from a table of words and training counts."""
    spark = words.sparkSession
    totals = words.where("c > 0").agg(F.sum("c").alias("n"), F.count("*").alias("v"), F.max(F.when(F.length("word") == 0, F.col("c"))).alias("e")).first()
    pieces = copy.copy(vocabulary(path))  # the cached pieces keep their weights
    pieces.weigh(np.zeros(len(pieces.texts)), 0.0)
    n, v, e = totals["n"] or 0, totals["v"] or 0, totals["e"] or 0
    for _ in range(ROUNDS if n else 0):
        shared = spark.sparkContext.broadcast(pieces)  # the vocabulary

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(shared.value.texts))
            for words, counts in _gathered(batches):
                total += expected_counts(shared.value, words, counts)
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["piece", "n"])

        expected = np.zeros(len(pieces.texts))
        found = words.where("c > 0 and length(word) > 0").select("word", "c").mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        for r in found.collect():  # a row for each piece at most
            expected[r["piece"]] = r["n"]
        pieces.weigh(expected, float(n - e))
    return Scorer(pieces, n, v, e)


def _valued(words: DataFrame, scorer: Scorer) -> DataFrame:
    """h, c, base, model, given for each word."""
    shared = words.sparkSession.sparkContext.broadcast(scorer)  # the vocabulary and a few numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data, counts in _gathered(batches):
            raw, at = np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])
            h = K.span_hashes(raw, at[:-1], at[1:]).view(np.int64) if len(raw) else np.zeros(len(data), np.int64)
            values = (h, counts, shared.value.base(counts), shared.value.model(data, counts), shared.value.vocabulary(data))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in values], names=["h", "c", *_VALUES[1:]])

    return words.where("length(word) > 0").select("word", "c").mapInArrow(run, "h long, c long, base double, model double, given double")


#: What is summed over the words of a document.
_VALUES = ("known", "base", "model", "given")
_DEALT = "bucket int, grp string, d binary, n binary, " + ", ".join(f"v{k} binary" for k in range(len(_VALUES)))
_SUMS = ", ".join(f"s{k} binary" for k in range(len(_VALUES)))


def _bucket(h: Column, buckets: int) -> Column:
    return (F.shiftrightunsigned(h, 33) % buckets).cast("int")


class _Group:
    """Documents that travel together: their sums over words of the head, and their other words."""

    def __init__(self, buckets: int):
        self.buckets, self.docs, self.rest = buckets, 0, 0
        self.ids, self.tokens, self.sums, self.words, self.rows = [], [], [], [], []

    def add(self, ids: pa.Array, tokens: np.ndarray, sums: list[np.ndarray], words: np.ndarray, rows: np.ndarray) -> None:
        self.ids.append(ids)
        self.tokens.append(tokens)
        self.sums.append(sums)
        self.words.append(words)
        self.rows.append(rows + self.docs)
        self.docs, self.rest = self.docs + len(ids), self.rest + len(words)

    def full(self) -> bool:
        return self.docs + K.BATCH_ROWS > _GROUP_DOCS or self.rest >= _GROUP_TOKENS

    def packed(self) -> pa.RecordBatch:
        out = []
        if self.docs:
            group = uuid.uuid4().hex
            ids = pa.chunked_array(self.ids, pa.int64())
            data = ids.fill_null(0).to_numpy().tobytes() + ids.is_null().to_numpy().tobytes()
            out.append((-1, group, data, np.concatenate(self.tokens).astype(np.int64).tobytes(), *(np.concatenate(x).tobytes() for x in zip(*self.sums, strict=True))))
            words, rows = np.concatenate(self.words), np.concatenate(self.rows)
            bucket = ((words.view(np.uint64) >> np.uint64(33)) % np.uint64(self.buckets)).astype(np.int64)
            order = np.lexsort((words, bucket))
            words, rows, bucket = words[order], rows[order].astype(np.uint16), bucket[order]
            fresh = np.append(True, (words[1:] != words[:-1]) | (bucket[1:] != bucket[:-1]))[: len(words)]
            cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(words)])
            for a, z in zip(cut, np.append(cut, len(words))[1:], strict=True):
                own = np.flatnonzero(fresh[a:z])
                out.append((int(bucket[a]), group, rows[a:z].tobytes(), np.diff(np.append(own, z - a)).astype(np.uint32).tobytes(), words[a:z][own].tobytes(), None, None, None))
        types = (pa.int32(), pa.string(), *[pa.binary()] * 6)
        columns = list(zip(*out, strict=True)) or [[]] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["bucket", "grp", "d", "n", *(f"v{k}" for k in range(len(_VALUES)))])


def _meet(_, asked: pa.Table, known: pa.Table) -> pa.Table:
    """Sums over one bucket's words for every group of documents that asks: document, then sums, as arrays."""
    h = known.column("h").to_numpy()
    order = np.argsort(h)
    h, values = h[order], [known.column(x).to_numpy()[order] for x in ("c", *_VALUES[1:])]
    values[0] = (values[0] > 0).astype(np.float64)
    out = []
    for batch in asked.to_batches(max_chunksize=256):
        for r in batch.to_pylist():
            times, of = np.frombuffer(r["n"], np.uint32), np.frombuffer(r["d"], np.uint16)
            at = np.repeat(np.searchsorted(h, np.frombuffer(r["v0"], np.int64)), times)
            docs, index = np.unique(of, return_inverse=True)
            out.append((r["grp"], docs.tobytes(), *(np.bincount(index, weights=x[at]).tobytes() for x in values)))
    types = (pa.string(), *[pa.binary()] * (1 + len(_VALUES)))
    columns = list(zip(*out, strict=True)) or [[]] * len(types)
    return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["grp", "d", *(f"s{k}" for k in range(len(_VALUES)))])


def _head(valued: DataFrame) -> DataFrame:
    """The most frequent words, at most ``HEAD``: those from a count on, which a histogram of counts gives, so that no task and not the driver gets more."""
    step = F.floor(F.log2(F.col("c") + 1) * 16)
    left, least = HEAD, 1 << 30
    for r in sorted(valued.where("c > 0").groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect(), reverse=True):  # 16 rows for each doubling of counts
        left -= r["n"]
        if left < 0:
            break
        least = r["step"]
    return valued.where((F.col("c") > 0) & (step >= least))


def score_documents(docs: DataFrame, path: str, training: Column) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, vocabulary_score of every row; ``training`` says which rows are learned from."""
    spark = docs.sparkSession
    K.prepare(spark)
    scratch = Scratch(spark)
    words = scratch.stored(_word_counts(docs, training))
    scorer = train(words, path)
    valued = scratch.stored(_valued(words, scorer))
    head = _head(valued).toPandas().sort_values("h")
    shared = spark.sparkContext.broadcast((head["h"].to_numpy(), np.stack([(head["c"] > 0).to_numpy(np.float64), *(head[x].to_numpy() for x in _VALUES[1:])])))
    buckets = max(40, scorer.tokens // _BUCKET_TOKENS)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For some documents at a time: a row with their own sums (bucket -1) and one for each bucket of words that aren't in the head."""
        h, values = shared.value
        group = _Group(buckets)
        for b in batches:
            raw, at = K.text_bytes(b.column(1))
            for i, j, part, offsets in K.slices(raw, at):
                low = K.lower_ascii(part)
                starts, ends, rows = K.word_spans(low, offsets)
                own = K.span_hashes(low, starts, ends).view(np.int64)
                place = np.minimum(np.searchsorted(h, own), max(0, len(h) - 1))
                hit = h[place] == own if len(h) else np.zeros(len(own), bool)
                sums = [np.bincount(rows[hit], weights=x[place[hit]], minlength=j - i) for x in values]
                group.add(b.column(0).slice(i, j - i), np.bincount(rows, minlength=j - i), sums, own[~hit], rows[~hit])
                if group.full():
                    yield group.packed()
                    group = _Group(buckets)
        yield group.packed()

    dealt = scratch.stored(docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(deal, _DEALT))
    scratch.drop(valued, dealt)
    table = valued.select(_bucket(F.col("h"), buckets).alias("bucket"), "h", "c", *_VALUES[1:])
    sums = dealt.where("bucket >= 0").groupBy("bucket").cogroup(table.groupBy("bucket")).applyInArrow(_meet, f"grp string, d binary, {_SUMS}")
    named = [F.col(f"v{k}").alias(f"s{k}") for k in range(len(_VALUES))]
    own = dealt.where("bucket < 0").select("grp", F.col("d").alias("i"), F.col("n"), F.lit(None).cast("binary").alias("d"), *named)
    rows = own.unionByName(sums.withColumns({"i": F.lit(None).cast("binary"), "n": F.lit(None).cast("binary")}))
    end = (int(scorer.ends > 0), float(scorer.base(np.array([scorer.ends]))[0]), *[math.log10(scorer.end)] * 2)
    trained = scorer.tokens

    def gather(part: pa.Table) -> pa.Table:
        """Add the sums of one group of documents."""
        parts = part.to_pylist()
        first = next(p for p in parts if p["i"] is not None)
        tokens = np.frombuffer(first["n"], np.int64)
        ids, missing = np.frombuffer(first["i"], np.int64, len(tokens)), np.frombuffer(first["i"], bool, len(tokens), 8 * len(tokens))
        total = [np.frombuffer(first[f"s{k}"], np.float64).copy() for k in range(len(end))]
        for p in sorted((p for p in parts if p["i"] is None), key=lambda p: p["d"]):
            at = np.frombuffer(p["d"], np.uint16)
            for k, t in enumerate(total):
                t[at] += np.frombuffer(p[f"s{k}"], np.float64)
        known = np.rint(total[0]).astype(np.int64) + end[0]
        columns = (pa.array(ids, mask=missing), tokens + 1, known, np.full(len(ids), trained), *(t + e for t, e in zip(total[1:], end[1:], strict=True)))
        return pa.Table.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "vocabulary_score"])

    return rows.groupBy("grp").applyInArrow(gather, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, vocabulary_score double")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = K.documents(spark, sf_dir)
    held_out = K.remainder(F.col("doc_id"), 10) == 0
    out = score_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "vocabulary_score")
