"""Best-fit packing of token sequences by minimum bin slack.

Every whole text is cut into pieces of at most ``capacity`` tokens. Packing needs only how many pieces of
each length there are: at most ``capacity`` numbers, whatever the input's size. For one bin
after another, the longest open length is placed and a subset-sum dynamic program, whose states are the bits
of one integer, finds the fullest feasible combination of the available lengths for what is left of the bin.
That combination is removed as often as the counts allow, as the same bin would be found again.
Pieces are then ranked within their length (in buckets of row numbers, so that no length or repeated row is handled by one task)
and a piece's rank says which bin and which place in it are its own.

Strings of special tokens in a text are ordinary text, as the vocabulary's own notes have it: ``encode_special_tokens`` is set, so
that no text can place a control token in a sequence.

Defined cases: null text is packed like an empty one (its end token alone); longer documents are
cut at multiples of the capacity and nothing else is; ties and repeated rows each take their own place;
other columns don't matter; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import math
import os
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dealspark.llm import kernels as K
from dealspark.session import durable

CAPACITY = 4096
END_ID = 1
#: Words with known ids that a worker keeps; beyond it the cache starts anew.
CACHE_WORDS = 1_000_000
_MARK = b"\x02"
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordTokens:
    """Ids of white-space separated words, as little-endian 32-bit bytes, by cache."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.cache: dict[bytes, bytes] = {}
        (self.mark,) = self.tokenizer.encode(_MARK.decode(), add_special_tokens=False).ids

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The pattern of this vocabulary never joins characters across white space, so words can be encoded alone."""
        cache = self.cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
        rows = [t.split() for t in texts]
        new: set[bytes] = set()
        for row in rows:
            new.update([w for w in row if w not in cache])
        fresh = list(new)
        for i in range(0, len(fresh), 4096):
            self._add(fresh[i : i + 4096])
        return [b"".join([cache[w] for w in row]) for row in rows]

    def _add(self, words: list[bytes]) -> None:
        """Encode new words in one call, parted by a control character that is a token of its own."""
        ids = np.array(self.tokenizer.encode((b"\n" + _MARK + b"\n").join(words).decode("utf-8"), add_special_tokens=False).ids, "<u4")
        marks = np.flatnonzero(ids == self.mark)
        if len(marks) == len(words) - 1:
            data, edges = ids.tobytes(), [-1, *marks.tolist(), len(ids)]
            for word, a, b in zip(words, edges, edges[1:]):
                self.cache[word] = data[4 * a + 4 : 4 * b]
        else:  # some word holds that character itself
            for word, found in zip(words, self.tokenizer.encode_batch([w.decode("utf-8") for w in words], add_special_tokens=False), strict=True):
                self.cache[word] = np.array(found.ids, "<u4").tobytes()


@functools.cache
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every whole text: doc_id, piece, start, length, ids_crc32."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    K.prepare(docs.sparkSession)
    schema = to_arrow_schema(StructType.fromDDL(_PIECES))
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = word_tokens(path)
        for b in batches:
            ids_of, out = b.column(0).to_pylist(), []
            raw, at = K.text_bytes(b.column(1))
            for i, j, part, offsets in K.slices(raw, at):
                data = part.tobytes()
                for doc, ids in zip(ids_of[i:j], own.encode([data[x:y] for x, y in zip(offsets[:-1], offsets[1:])]), strict=True):
                    ids += end
                    for k, start in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[start : start + 4 * capacity]
                        out.append((doc, k, start // 4, len(piece) // 4, zlib.crc32(piece)))
            yield K.batch(schema, [list(c) for c in zip(*out, strict=True)] or [[]] * 5)

    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(run, _PIECES)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each available length fill ``room`` best: subset sums as the bits of one integer."""
    mask, reach, trail = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x, n in counts.items() if n and x <= room), reverse=True):
        left, part = min(counts[length], room // length), 1
        while left:
            part = min(part, left)
            trail.append((length, part, reach))
            reach |= (reach << (length * part)) & mask
            left, part = left - part, part * 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, part, before in reversed(trail):
        if not before >> total & 1:
            total -= length * part
            chosen[length] = chosen.get(length, 0) + part
    return chosen


def minimum_bin_slack(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Bins for so many pieces of each length, as (pieces of each length in the bin, number of such bins)."""
    left, bins = {x: n for x, n in counts.items() if n}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        bin_ = fullest(left, capacity - longest)
        left[longest] += 1
        bin_[longest] = bin_.get(longest, 0) + 1
        times = min(left[x] // n for x, n in bin_.items())
        for x, n in bin_.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
        bins.append((bin_, times))
    return bins


def _places(bins: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """For each length, in order of rank: first rank, pieces in a bin, number of the first bin, offset in a bin."""
    first, taken, rows = 0, {}, []
    for bin_, times in bins:
        offset = 0
        for length in sorted(bin_, reverse=True):
            n = bin_[length]
            rows.append((length, taken.get(length, 0), n, first, offset))
            taken[length] = taken.get(length, 0) + n * times
            offset += length * n
        first += times
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return {"key": columns[0] << 44 | columns[1], "rank": columns[1], "each": columns[2], "bin": columns[3], "offset": columns[4]}


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with sequence_id and offset."""
    spark = docs.sparkSession
    pieces = durable(token_pieces(docs, path, capacity))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    places = _places(minimum_bin_slack(counts, capacity))
    top = max(counts.values(), default=1)
    buckets = math.ceil(top / max(256, math.isqrt(top)))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(buckets)))
    before = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = before.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("base"))
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = dealt.withColumn("within", within).join(before, ["length", "bucket"]).withColumn("rank", F.col("base") + F.col("within") - 1)
    shared = spark.sparkContext.broadcast(places)  # a few numbers for each length in a bin: bounded by the capacity
    ddl = _PIECES + ", sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for b in batches:
            length, rank = b.column(3).to_numpy(zero_copy_only=False), b.column(5).to_numpy(zero_copy_only=False)
            at = np.searchsorted(p["key"], length << 44 | rank, side="right") - 1
            place = rank - p["rank"][at]
            sequence = p["bin"][at] + place // p["each"][at]
            offset = p["offset"][at] + place % p["each"][at] * length
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=[*b.schema.names[:5], "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").cast("long")).mapInArrow(run, ddl)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(K.documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
