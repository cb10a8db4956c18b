"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Boundaries of pre-tokens are found without a regular expression. Every code point has a class
(letter, number, other, apostrophe, space, other white space); a seven-state automaton over those classes
says where a pre-token begins. The automaton is run as a scan over transition functions, which compose
associatively: blocks of characters are reduced to one function each, the functions are scanned by
doubling, and then each block is run from its known entry state. The slices found this
way feed a cache of merged pieces; pieces that are not in it are merged by rank, with a heap where they are long.

Defined cases: null text is encoded like an empty one (no ids; hashes of no bytes); any
length of text or piece is handled; each input row gives one output row, repeated rows included; only
doc_id and text are read, so other columns don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from dealspark.llm import kernels as K

LETTER, NUMBER, OTHER, SPACE, WHITE, QUOTE1, QUOTE2 = range(7)
#: States: 0 at an end, 1 in letters, 2 in numbers, 3 in other signs, 4 after a space, 5 and 6: one, two letters of a contraction to come.
_STATES = 8
_FIRST = 8  # added to the class of a text's first character
_BLOCK = 256
#: Contractions of the pattern, as fixed by the vocabulary: one letter, two letters.
_ONE, _TWO = "stmd", ("re", "ve", "ll")
#: Merged pieces kept by a worker; beyond it the cache starts anew.
CACHE_PIECES = 600_000
_SHORT = 32
_NONE = np.iinfo(np.int32).max
_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a pre-token begins, by class (first-in-text classes from _FIRST) and state."""
    to, begins = np.zeros((16, _STATES), np.uint8), np.ones((16, _STATES), bool)
    for state in range(_STATES):
        for kind, own in ((LETTER, 1), (NUMBER, 2), (OTHER, 3)):
            to[kind, state], begins[kind, state] = own, state not in (own, 4)
        for kind, rest in ((QUOTE1, 5), (QUOTE2, 6)):
            joins = state in (3, 4)
            to[kind, state], begins[kind, state] = (3 if joins else rest), not joins
        to[SPACE, state], to[WHITE, state] = 4, 0
    to[LETTER, 5], begins[LETTER, 5] = 0, False
    to[LETTER, 6], begins[LETTER, 6] = 5, False
    to[_FIRST:] = to[:8, :1]
    return to, begins


_TO, _BEGINS = _automaton()


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All functions that words of symbols make of the states: (element of each symbol, product table, action on states)."""
    found = {tuple(range(_STATES)): 0}
    symbols = [tuple(int(x) for x in row) for row in _TO]
    queue = list(found)
    for f in queue:
        for g in symbols:
            h = tuple(g[x] for x in f)
            if h not in found:
                found[h] = len(found)
                queue.append(h)
    acts = np.array(list(found), np.uint8)
    product = np.array([[found[tuple(int(x) for x in acts[g][acts[f]])] for g in range(len(acts))] for f in range(len(acts))], np.intp)
    return np.array([found[g] for g in symbols], np.intp), product, acts


_ELEMENT, _PRODUCT, _ACT = _monoid()


@functools.cache
def code_point_classes() -> np.ndarray:
    """Class of each code point; white space as in Unicode's White_Space property."""
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for c in range(sys.maxunicode + 1):
        major = unicodedata.category(chr(c))[0]
        if major == "L":
            table[c] = LETTER
        elif major == "N":
            table[c] = NUMBER
    table[[9, 10, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = WHITE
    table[0x20] = SPACE
    return table


def states_before(symbols: np.ndarray) -> np.ndarray:
    """The automaton's state before each symbol, by a blocked scan over transition functions."""
    n = len(symbols)
    k = -(-n // _BLOCK)
    padded = np.zeros(k * _BLOCK, np.uint8)
    padded[:n] = symbols
    columns = np.ascontiguousarray(padded.reshape(k, _BLOCK).T)
    size, flat = len(_ACT), _PRODUCT.ravel()
    so_far = np.zeros(k, np.intp)  # the identity
    before = np.empty((_BLOCK, k), np.uint8)
    for j, c in enumerate(columns):
        before[j] = so_far
        so_far = flat.take(so_far * size + _ELEMENT.take(c))
    step = 1
    while step < k:  # inclusive scan over blocks
        so_far[step:] = flat.take(so_far[:-step] * size + so_far[step:])
        step *= 2
    entry = np.zeros(k, np.intp)
    entry[1:] = _ACT[so_far[:-1], 0]
    return _ACT.T.ravel().take(entry * size + before).T.ravel()[:n]


def boundaries(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Whether a pre-token begins at each code point. firsts: where a text begins."""
    n = len(points)
    kind = code_point_classes()[points]
    first = np.zeros(n + 1, bool)
    first[firsts] = True
    first[n] = True
    white = (kind == SPACE) | (kind == WHITE)
    quotes = np.flatnonzero(points == 0x27)
    if len(quotes):
        ahead = np.append(points, [0, 0])
        one, two = ahead[quotes + 1], ahead[quotes + 2]
        inside1 = ~first[quotes + 1]
        inside2 = inside1 & ~first[np.minimum(quotes + 2, n)]
        pair = np.zeros(len(quotes), bool)
        for a, b in _TWO:
            pair |= (one == ord(a)) & (two == ord(b))
        single = np.isin(one, [ord(c) for c in _ONE]) & inside1
        kind[quotes[single]] = QUOTE1
        kind[quotes[pair & inside2 & ~single]] = QUOTE2
    before = states_before(kind + _FIRST * first[:n])
    begins = _BEGINS[kind, before]
    last = np.ones(n, bool)  # of a run of white space that other characters of the text follow
    last[:-1] = ~white[1:] & ~first[1:n]
    last[-1:] = False
    after = np.zeros(n, bool)
    after[1:] = white[:-1]
    begins = np.where(white, ~after | last, begins)
    return begins | first[:n]


class Merger:
    """Ranks of a vocabulary, merged pieces by cache, and the way back from ids to bytes."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.by_id = {str(v): k for k, v in self.ranks.items()}
        self.cache: dict[bytes, str] = {}
        self.of_byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self._index_pairs()

    def _index_pairs(self) -> None:
        """Open-addressed table from a pair of ids to the id (the rank) that they merge to."""
        keys, values = [], []
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        self.shift = np.uint64(64 - max(4, (4 * len(keys)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, _NONE, np.int32)
        todo, value = np.array(keys, np.int64), np.array(values, np.int32)
        self.probes = 0
        slot = self._slot(todo)
        while len(todo):
            self.probes += 1
            free = self.keys[slot] == -1
            place, own = np.unique(slot[free], return_index=True)
            taken = np.flatnonzero(free)[own]
            self.keys[place], self.values[place] = todo[taken], value[taken]
            left = np.ones(len(todo), bool)
            left[taken] = False
            todo, value, slot = todo[left], value[left], (slot[left] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a.astype(np.int64) << 32 | b
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, self.values[slot], _NONE)
        for _ in range(self.probes - 1):
            slot = (slot + 1) & (len(self.keys) - 1)
            out = np.where(self.keys[slot] == keys, self.values[slot], out)
        return out

    def merge_all(self, pieces: list[bytes]) -> None:
        """Put the ids of pieces into the cache; short ones are merged together, one pair of each a round."""
        ranks, cache = self.ranks, self.cache
        short = []
        for p in pieces:
            if (r := ranks.get(p)) is not None:
                cache[p] = str(r)
            elif len(p) <= _SHORT:
                short.append(p)
            else:
                cache[p] = " ".join(map(str, self._merge_long(p)))
        short.sort(key=len)
        for i in range(0, len(short), 8192):
            part = short[i : i + 8192]
            width = len(part[-1])
            sizes = np.array([len(p) for p in part])
            ids = self.of_byte[np.frombuffer(b"".join(p.ljust(width, b"\0") for p in part), np.uint8)].reshape(len(part), width)
            rank = np.full((len(part), width), _NONE, np.int32)
            rank[:, :-1] = self.pair_ranks(ids[:, :-1], ids[:, 1:])
            rank[np.arange(width) >= (sizes - 1)[:, None]] = _NONE
            active, column = np.arange(len(part)), np.arange(width)
            while len(active):
                low = rank[active].argmin(1)
                best = rank[active, low]
                active, low, best = active[best < _NONE], low[best < _NONE], best[best < _NONE]
                if not len(active):
                    break
                take = np.minimum(column + (column > low[:, None]), width - 1)
                own = np.take_along_axis(ids[active], take, 1)
                costs = np.take_along_axis(rank[active], take, 1)
                costs[:, -1] = _NONE
                at = np.arange(len(active))
                own[at, low] = best
                sizes[active] -= 1
                for place in (low - 1, low):
                    fits = np.flatnonzero((place >= 0) & (place < sizes[active] - 1))
                    costs[at, np.maximum(place, 0)] = np.where((place >= 0), _NONE, costs[at, np.maximum(place, 0)])
                    costs[fits, place[fits]] = self.pair_ranks(own[fits, place[fits]], own[fits, place[fits] + 1])
                ids[active], rank[active] = own, costs
            for p, row, n in zip(part, ids.tolist(), sizes.tolist(), strict=True):
                cache[p] = " ".join(map(str, row[:n]))

    def _merge_long(self, piece: bytes) -> list[int]:
        ranks, n = self.ranks, len(piece)
        end, right, left = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = bytearray(b"\1") * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = right[i] if alive[i] else n
            if j >= n or end[j] != stop:
                continue
            end[i], right[i], alive[j] = stop, right[j], 0
            if right[i] < n:
                left[right[i]] = i
                if (r := ranks.get(piece[i : end[right[i]]])) is not None:
                    heapq.heappush(heap, (r, i, end[right[i]]))
            if left[i] >= 0 and (r := ranks.get(piece[left[i] : stop])) is not None:
                heapq.heappush(heap, (r, left[i], stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = right[i]
        return out

    def encode(self, rows: list[list[bytes]]) -> list[str]:
        """Decimal ids, joined by one space, of each row's consecutive pieces."""
        cache = self.cache
        if len(cache) > CACHE_PIECES:
            cache.clear()
        new: set[bytes] = set()
        for row in rows:
            new.update([p for p in row if p not in cache])
        self.merge_all(list(new))
        return [" ".join([cache[p] for p in row]) for row in rows]

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.by_id.__getitem__, ids.split(" "))) if ids else b""


@functools.cache
def merger(path: str) -> Merger:
    return Merger(path)


def split_texts(raw: np.ndarray, at: np.ndarray) -> Iterator[list[list[bytes]]]:
    """The pre-tokens of every text, in order, some texts at a time."""
    for _, _, part, offsets in K.slices(raw, at):
        data = part.tobytes()
        points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
        places = np.flatnonzero((part & 0xC0) != 0x80)
        firsts = np.searchsorted(places, offsets[:-1][np.diff(offsets) > 0])
        starts = places[boundaries(points, firsts)] if len(points) else places
        cut = np.searchsorted(starts, offsets).tolist()
        edges = np.append(starts, len(data)).tolist()
        yield [[data[x:y] for x, y in zip(edges[a:b], edges[a + 1 : b + 1])] for a, b in zip(cut, cut[1:])]


def encode_documents(docs: DataFrame, path: str, *, with_ids: bool = False) -> DataFrame:
    """Encode every whole text by the ranks at ``path`` (on every node) and decode the ids again.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256 and, if ``with_ids``, ids (array of int).
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    K.prepare(docs.sparkSession)
    ddl = _SCHEMA + (", ids array<int>" if with_ids else "")
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = merger(path)
        for b in batches:
            out: list[tuple] = []
            for rows in split_texts(*K.text_bytes(b.column(1))):
                for ids in own.encode(rows):
                    row = (ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(own.decode(ids)).hexdigest())
                    out.append(row + ((list(map(int, ids.split())),) if with_ids else ()))
            yield K.batch(schema, [b.column(0), *([list(c) for c in zip(*out, strict=True)] or [[]] * (len(schema) - 1))])

    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(run, ddl)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(K.documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"))
