"""Hierarchical packing of token sequences into windows of several lengths.

Documents are routed to tiers of windows (2048, 1024, 512 and 256 tokens): whole windows of the longest tier are
cut off a document's front, and what is left goes to the shortest tier that holds it. Each tier is packed from its longest pieces
down; the gap of a window is filled from the same and the shorter tiers by subset sums, and only a combination that
fills the window to its last token is taken, as often as the counts allow. Pieces for which there is no such combination (or none
any more) are laid end to end and cut at every window's end; so at most one piece a window is cut, and the last tokens make windows
of powers of two. No window holds padding.

The plan needs only how many pieces of each length there are: fewer numbers than the longest window has tokens, whatever the
input's size. A piece's rank among those of its length says its window and place. Texts are
read again only for documents of which a piece is cut, since a part's checksum needs its ids.

Windows are dealt to training steps so that every step has the same number of tokens, up to one longest window: windows are lined up from the
longest tier to the shortest, so that 2, 4 or 8 shorter ones fill a slot of the longest one's size, and slots are dealt in turn.

Strings of special tokens in a text are ordinary text, as the vocabulary's own notes have it (``encode_special_tokens``).

Defined cases: null text is packed like an empty one (its end token alone); a very long text becomes whole windows and one rest; ties and
repeated rows, null doc_ids included, each take their own place; other columns don't matter; an empty table gives no rows.
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
from dealspark.llm.packing import fullest
from dealspark.session import Scratch

#: Window lengths, longest first; each is twice the next. Slots of the longest length that make one training step.
TIERS = (2048, 1024, 512, 256)
STEP_SLOTS = 8
END_ID = 1
#: Cut parts, of about 50 bytes each, up to which they are broadcast: the plan knows that there are two for each window of the stream, and one for each last window.
FEW_PARTS = 100_000
#: Chunks of text with known ids that a worker keeps (beyond it the cache starts anew), the longest that are kept, in bytes, and how many are encoded at once.
CACHE_CHUNKS, CACHED_BYTES, AT_ONCE = 1_500_000, 64, 4096
_PIECES = "doc_id long, text_hash long, start long, length long, ids_crc32 long, doc_tokens long"


def chunk_starts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places at which a text may be cut without changing its ids: before white space that follows a character that is none.

    The vocabulary's pattern joins a space only with what follows it, and no match holds white space behind another character.
    Characters beyond ASCII count if their last bytes cannot be those of white space.
    """
    first = np.zeros(len(raw) + 1, bool)
    first[at[:-1]] = True
    if len(raw) > 1:
        solid = (raw - np.uint8(0x21)) < 0x7F - 0x21  # signs of ASCII; smaller bytes wrap
        high = np.flatnonzero(raw >= 0x80)
        if len(high):
            last, second, third = raw[high], raw[np.maximum(high - 1, 0)], raw[np.maximum(high - 2, 0)]
            white = (second == 0xC2) & ((last == 0x85) | (last == 0xA0)) | (third == 0xE1) & (second == 0x9A) | (third == 0xE2) & ((second == 0x80) | (second == 0x81)) | (third == 0xE3) & (second == 0x80)
            solid[high] = ~white
        blank = (raw[1:] == 0x20) | (raw[1:] == 0x0A)
        first[1:-1] |= solid[:-1] & blank
    return np.flatnonzero(first[:-1])


class ChunkTokens:
    """Ids of chunks of text as little-endian 32-bit bytes, by cache."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.cache: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.size_of = np.zeros(max(vocabulary.values()) + 1, np.int64)  # bytes of each token: one for each character of its name
        for token, i in vocabulary.items():
            self.size_of[i] = len(token)

    def encode(self, raw: np.ndarray, at: np.ndarray) -> list[bytes]:
        """The ids of each text. Each distinct chunk is looked up once."""
        cache = self.cache
        if len(cache) > CACHE_CHUNKS:
            cache.clear()
        starts = chunk_starts(raw, at)
        coded = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(raw)).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(raw))]).dictionary_encode()
        _, edges, data = coded.dictionary.buffers()
        edges, data = np.frombuffer(edges, np.int32)[: len(coded.dictionary) + 1].tolist(), data.to_pybytes() if data else b""
        chunks = [data[a:b] for a, b in zip(edges, edges[1:])]
        found = list(map(cache.get, chunks))
        new = [k for k, ids in enumerate(found) if ids is None]
        for k, ids in zip(new, self._encoded(coded.dictionary.take(pa.array(new, pa.int32())))):
            found[k] = ids
            if len(chunks[k]) <= CACHED_BYTES:  # longer ones seldom come again
                cache[chunks[k]] = ids
        each = list(map(found.__getitem__, coded.indices.to_numpy().tolist()))
        cut = np.searchsorted(starts, at).tolist()
        return [b"".join(each[a:b]) for a, b in zip(cut, cut[1:])]

    def _encoded(self, chunks: pa.BinaryArray) -> list[bytes]:
        """Ids of chunks, many in one call: those that begin with white space and end with a sign that is none may follow one another."""
        if not len(chunks):
            return []
        _, ends, data = chunks.buffers()
        ends = np.frombuffer(ends, np.int32)[: len(chunks) + 1]
        raw = np.frombuffer(data, np.uint8)
        first, last = raw[ends[:-1]], raw[ends[1:] - 1]
        joins = ((first == 0x20) | (first == 0x0A)) & (last > 0x20) & (last < 0x7F)
        out: list[bytes] = [b""] * len(chunks)
        alone = np.flatnonzero(~joins)
        for i in range(0, len(alone), AT_ONCE):
            part = alone[i : i + AT_ONCE].tolist()
            texts = [data[ends[k] : ends[k + 1]].to_pybytes().decode("utf-8") for k in part]
            for k, found in zip(part, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                out[k] = np.array(found.ids, "<u4").tobytes()
        together = np.flatnonzero(joins)
        for i in range(0, len(together), AT_ONCE):
            part = together[i : i + AT_ONCE]
            own = chunks.take(pa.array(part))
            _, stops, text = own.buffers()
            stops = np.frombuffer(stops, np.int32)[1 : len(part) + 1]
            (found,) = self.tokenizer.encode_batch_fast([text.to_pybytes()[: stops[-1]].decode("utf-8")], add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            edges = (4 * (np.searchsorted(np.cumsum(self.size_of[ids]), stops) + 1)).tolist()
            bytes_of = ids.tobytes()
            for k, a, b in zip(part.tolist(), [0, *edges], edges):
                out[k] = bytes_of[a:b]
        return out


@functools.cache
def chunk_tokens(path: str) -> ChunkTokens:
    return ChunkTokens(path)


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, text and a hash of the text: equal rows are interchangeable."""
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text, F.octet_length(text)).alias("text_hash"))


def _encoded(b: pa.RecordBatch, path: str) -> Iterator[tuple[int, bytes]]:
    """Row and ids, with the end id, of each text in the second column."""
    own, end = chunk_tokens(path), np.array([END_ID], "<u4").tobytes()
    raw, at = K.text_bytes(b.column(1))
    for i, _, part, offsets in K.slices(raw, at):
        for k, ids in enumerate(own.encode(part, offsets)):
            yield i + k, ids + end


def routed_pieces(docs: DataFrame, path: str, window: int = TIERS[0]) -> DataFrame:
    """Whole windows and the rest of each text: doc_id, text_hash, start, length, ids_crc32, doc_tokens."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    K.prepare(docs.sparkSession)
    schema = to_arrow_schema(StructType.fromDDL(_PIECES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, hashed, out = b.column(0).to_pylist(), b.column(2).to_pylist(), []
            for row, ids in _encoded(b, path):
                for start in range(0, len(ids), 4 * window):
                    piece = ids[start : start + 4 * window]
                    out.append((doc[row], hashed[row], start // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4))
            yield K.batch(schema, [list(c) for c in zip(*out, strict=True)] or [[]] * 6)

    return _identified(docs).mapInArrow(run, _PIECES)


class Plan:
    """Windows for so many pieces of each length.

    ``windows`` holds (tier, pieces of each length in the window, number of such windows); ``stream`` holds (length, number of
    pieces, rank of the first, position of the first) of those laid end to end; ``tail`` holds the ends of the last windows there.
    """

    def __init__(self, counts: dict[int, int], tiers: tuple[int, ...] = TIERS):
        left = {x: n for x, n in counts.items() if n}
        self.tiers, self.windows, rest, taken = tiers, [], [], {}
        for tier, shorter in zip(tiers, [*tiers[1:], 0]):
            for x in range(tier, shorter, -1):
                while left.get(x):
                    left[x] -= 1
                    filled = fullest(left, tier - x)
                    left[x] += 1
                    filled[x] = filled.get(x, 0) + 1
                    if sum(y * n for y, n in filled.items()) < tier:
                        break  # counts only fall, so x is never completed later
                    times = min(left[y] // n for y, n in filled.items())
                    for y, n in filled.items():
                        left[y] -= n * times
                    self.windows.append((tier, filled, times))
                if left.get(x):
                    rest.append((x, left[x]))
                    left[x] = 0
        total, self.stream, position = {t: sum(n for own, _, n in self.windows if own == t) for t in tiers}, [], 0
        for x, n in rest:
            self.stream.append((x, n, counts[x] - n, position))
            position += x * n
        self.streamed, longest = position, tiers[0]
        whole, over = position // longest, position % longest
        self.tail, end = [], whole * longest
        for bit in range(longest.bit_length(), -1, -1):
            if over >> bit & 1:
                end += 1 << bit
                self.tail.append(end)
        total[longest] += whole
        self.first, self.slot, number, slot = {}, {}, 0, 0
        for t in tiers:
            self.first[t], self.slot[t] = number, slot
            number, slot = number + total[t], slot + -(-total[t] // (longest // t))
        self.tail_first, self.tail_slot = number, slot
        self.slots = slot + bool(self.tail)
        next_of, rows = {t: self.first[t] for t in tiers}, []
        next_of[longest] += whole  # those of the stream come first
        for tier, filled, times in self.windows:
            offset = 0
            for x in sorted(filled, reverse=True):
                rows.append((x, taken.get(x, 0), filled[x], next_of[tier], offset))
                taken[x] = taken.get(x, 0) + filled[x] * times
                offset += x * filled[x]
            next_of[tier] += times
        rows += [(x, rank, 0, 0, position) for x, _, rank, position in self.stream]
        rows.sort()
        c = np.array(rows, np.int64).reshape(-1, 5).T
        self.key, self.rank, self.each, self.number, self.offset = c[0] << 44 | c[1], c[1], c[2], c[3], c[4]

    def in_stream(self, position: int) -> tuple[int, int, int]:
        """Window, place in it and end of the window of a position of the stream."""
        longest = self.tiers[0]
        whole = self.streamed // longest
        if position < whole * longest:
            return self.first[longest] + position // longest, position % longest, (position // longest + 1) * longest
        before = whole * longest
        for k, end in enumerate(self.tail):
            if position < end:
                return self.tail_first + k, position - before, end
            before = end
        raise ValueError("position beyond the stream")

    def step_of(self, sequence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window length (0 for a last window of another power of two) and training step of each window."""
        steps = max(1, -(-self.slots // STEP_SLOTS))
        firsts = np.array([self.first[t] for t in self.tiers] + [self.tail_first], np.int64)
        tier = np.searchsorted(firsts, sequence, side="right") - 1
        length = np.array([*self.tiers, 0], np.int64)[tier]
        each = np.array([self.tiers[0] // t for t in self.tiers] + [1 << 40], np.int64)[tier]
        slot = np.array([*self.slot.values(), self.tail_slot], np.int64)[tier] + (sequence - firsts[tier]) // each
        return length, slot % steps


_PLACED = _PIECES + ", sequence_id long, offset long, window long, step_group long, piece_start long, cut boolean"


def _placed(ranked: DataFrame, plan: Plan) -> DataFrame:
    """Pieces, parted where the stream cuts them, with their places; checksums of parts are those of the whole piece still."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    shared = ranked.sparkSession.sparkContext.broadcast(plan)  # a few numbers for each length in a window: bounded by the longest window
    schema = to_arrow_schema(StructType.fromDDL(_PLACED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            length, rank = (b.column(i).to_numpy(zero_copy_only=False) for i in (3, 6))
            start = b.column(2).to_numpy(zero_copy_only=False)
            at = np.searchsorted(p.key, length << 44 | rank, side="right") - 1
            place, each = rank - p.rank[at], p.each[at]
            exact = np.flatnonzero(each > 0)
            sequence = p.number[at[exact]] + place[exact] // each[exact]
            offset = p.offset[at[exact]] + place[exact] % each[exact] * length[exact]
            rows, starts, lengths, sequences, offsets, cuts = list(exact), list(start[exact]), list(length[exact]), list(sequence), list(offset), [False] * len(exact)
            for i in np.flatnonzero(each == 0).tolist():
                position, end = int(p.offset[at[i]] + place[i] * length[i]), int(p.offset[at[i]] + (place[i] + 1) * length[i])
                begin, parts = position, []
                while position < end:
                    number, inside, stop = p.in_stream(position)
                    parts.append((int(start[i]) + position - begin, min(stop, end) - position, number, inside))
                    position = min(stop, end)
                for s, n, number, inside in parts:
                    for column, value in zip((rows, starts, lengths, sequences, offsets, cuts), (i, s, n, number, inside, len(parts) > 1)):
                        column.append(value)
            window, step = p.step_of(np.array(sequences, np.int64))
            whole = b.take(pa.array(rows, pa.int64()))
            yield K.batch(schema, [whole.column(0), whole.column(1), starts, lengths, whole.column(4), whole.column(5), sequences, offsets, window, step, whole.column(2), cuts])

    return ranked.mapInArrow(run, _PLACED)


def _part_sums(docs: DataFrame, cuts: DataFrame, path: str, few: bool) -> DataFrame:
    """Checksums of the parts (start, length) of texts, read again: doc_id, text_hash, start, length, part_crc32; texts are not shuffled for few cuts."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ddl = "doc_id long, text_hash long, start long, length long, part_crc32 long"
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    # equal rows differ in their cuts only: fewer than the longest window has tokens
    asked = cuts.groupBy(F.col("doc_id").alias("asked_id"), F.col("text_hash").alias("asked_hash")).agg(F.collect_set(F.struct("start", "length")).alias("parts"))
    texts = _identified(docs).join(F.broadcast(asked) if few else asked, F.col("doc_id").eqNullSafe(F.col("asked_id")) & (F.col("text_hash") == F.col("asked_hash")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, hashed, parts, out = b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), []
            for row, ids in _encoded(b, path):
                for part in parts[row]:
                    s, n = part["start"], part["length"]
                    out.append((doc[row], hashed[row], s, n, zlib.crc32(ids[4 * s : 4 * (s + n)])))
            yield K.batch(schema, [list(c) for c in zip(*out, strict=True)] or [[]] * 5)

    return texts.select("doc_id", "text", "text_hash", "parts").mapInArrow(run, ddl).distinct()


def pack_hierarchy(docs: DataFrame, path: str, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """Pieces of all documents with sequence_id, offset, the window's length (0 for one of the last, of another power of two) and the training step."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    pieces = scratch.stored(routed_pieces(docs, path, tiers[0]).withColumn("row", F.monotonically_increasing_id()))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # as many rows as the longest window has tokens at most
    plan = Plan(counts, tiers)
    top = max(counts.values(), default=1)
    buckets = math.ceil(top / max(256, math.isqrt(top)))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))  # so that no length is ranked by one task
    before = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = before.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("base"))
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row"))
    ranked = dealt.withColumn("within", within).join(before, ["length", "bucket"])
    placed = _placed(ranked.select("doc_id", "text_hash", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("within") - 1).cast("long").alias("rank")), plan)
    result = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window", "step_group"]
    if not plan.stream:
        return placed.select(result)
    placed = scratch.stored(placed)
    cut = placed.where("cut")
    sums = _part_sums(docs, cut, path, 2 * (plan.streamed // tiers[0]) + len(plan.tail) + 1 <= FEW_PARTS).withColumnsRenamed({c: f"part_{c}" for c in ("doc_id", "text_hash", "start", "length")})
    same = F.col("doc_id").eqNullSafe(F.col("part_doc_id")) & (F.col("text_hash") == F.col("part_text_hash")) & (F.col("start") == F.col("part_start")) & (F.col("length") == F.col("part_length"))
    mended = cut.join(sums, same).withColumn("ids_crc32", F.col("part_crc32"))
    out = placed.where("not cut").select(result).union(mended.select(result))
    scratch.drop(placed)
    return out


def op13_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_hierarchy(K.documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
