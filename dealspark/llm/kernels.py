"""Array kernels for text inside Arrow batches: whole texts as byte arrays, words as slices of them."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.session import ship_package, table

#: Rows per Arrow batch. Texts may be long, so a batch is kept small; every row is still processed.
BATCH_ROWS = 512
#: Bytes of text that a kernel works on at once (a single longer text is still taken whole).
SLICE_BYTES = 2_000_000

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def prepare(spark: SparkSession) -> None:
    """Ship the package and bound the rows of a Python batch."""
    ship_package(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffles and checkpoints that no plan refers to any more.

    It does so once the driver's collectors have found them, which may take many rounds of a loop whose plans are small.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return table(spark, sf_dir, "documents")


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32(doc_id as text) mod divisor: the fold of a row."""
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(divisor))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, end to end, and each text's offsets; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    if not wide and not pa.types.is_string(texts.type):
        texts, wide = texts.cast(pa.string()), False
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def slices(raw: np.ndarray, at: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of consecutive texts of about ``limit`` bytes together."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, side="right")) - 1)
        yield i, j, raw[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def word_spans(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row of every word ``[^\\x20\\x09-\\x0D]+``; no word crosses two texts."""
    if not len(raw):
        return (np.zeros(0, np.int64),) * 3
    solid = ~_WHITE[raw]
    border = np.zeros(len(raw) + 1, bool)
    border[at[(at < len(raw))]] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | border[1:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | border[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(at, starts, side="right") - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64))
_BYTE_CODE[np.flatnonzero(_WHITE)] = 0
_POWER = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWER
    if len(_POWER) < n:
        size = max(1024, 2 * n)
        with np.errstate(over="ignore"):
            _POWER = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, 0x9E3779B97F4A7C15 | 1, np.uint64)]))
    return _POWER[:n]


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; the spans must be sorted and hold white space only after their ends."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    gaps = np.diff(np.append(starts, len(raw)))
    place = np.arange(starts[0], len(raw)) - np.repeat(starts, gaps)
    np.minimum(place, int((ends - starts).max()) - 1, out=place)  # only white space, which counts 0, lies beyond
    value = _BYTE_CODE[raw[starts[0] :]]
    value *= _powers(int(place.max()) + 1)[place]
    return mix64(np.add.reduceat(value, starts - starts[0]) + (ends - starts).astype(np.uint64))


def grouped(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Offsets of each of n rows in arrays that are sorted by row."""
    return np.searchsorted(rows, np.arange(n + 1))


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
