"""Media columns: lossless Netpbm and BMP samples, area resize by integral images, NPY tiles, difference hashes.

A media value is a binary column. ``decode_media`` turns a Netpbm (P5, P6) or BMP (8 bit
with a palette, 24 bit) value into a numpy array; ``area_resize`` averages source area with an
integral image; ``npy_tile`` writes the small picture in NPY format and ``difference_hash``
compares horizontal neighbours of a 9 x 8 picture.

Defined cases: a null text is stored like an empty one (one block of zero bytes); equal
texts give equal values; rows are handled alone, so ties, repeated rows, empty tables and extra columns
change nothing (the output has its own columns only). A binary value that is no supported
picture raises ValueError.
"""

from __future__ import annotations

import hashlib
import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from dealspark.llm import kernels as K

#: Samples in a row of a stored picture; payloads are padded to a positive multiple of it.
WIDTH = 64

_SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, container string, tile_sha256 string"


def encode_pgm(pixels: np.ndarray) -> bytes:
    """8-bit grey Netpbm, or colour where the array has three planes."""
    h, w = pixels.shape[:2]
    return (b"P5" if pixels.ndim == 2 else b"P6") + f"\n{w} {h}\n255\n".encode() + np.ascontiguousarray(pixels, np.uint8).tobytes()


def encode_bmp(pixels: np.ndarray) -> bytes:
    """8-bit BMP with a grey palette; rows run from the bottom and are padded to four bytes."""
    h, w = pixels.shape
    stride = -(-w // 4) * 4
    rows = np.zeros((h, stride), np.uint8)
    rows[:, :w] = pixels[::-1]
    palette = np.zeros((256, 4), np.uint8)
    palette[:, :3] = np.arange(256, dtype=np.uint8)[:, None]
    head = 14 + 40 + 1024
    return b"BM" + struct.pack("<IHHI", head + rows.size, 0, 0, head) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 8, 0, rows.size, 2835, 2835, 256, 0) + palette.tobytes() + rows.tobytes()


def _netpbm_header(data: bytes) -> tuple[list[int], int]:
    fields, i = [], 2
    while len(fields) < 3:
        while data[i : i + 1].isspace():
            i += 1
        if data[i : i + 1] == b"#":
            i = data.index(b"\n", i)
            continue
        j = i
        while data[j : j + 1].isdigit():
            j += 1
        if i == j:
            raise ValueError("damaged Netpbm header")
        fields.append(int(data[i:j]))
        i = j
    return fields, i + 1


def decode_media(data: bytes) -> np.ndarray:
    """Pixels of a Netpbm (P5, P6) or plain BMP (8 bit with a palette, 24 bit) value: two dimensions if it is grey by its form or palette, else RGB.

    Whatever is cut short, damaged or of another form raises ValueError.
    """
    try:
        return _decoded(data)
    except (struct.error, IndexError) as e:
        raise ValueError("damaged picture") from e


def _decoded(data: bytes) -> np.ndarray:
    if data[:2] in (b"P5", b"P6"):
        (w, h, top), start = _netpbm_header(data)
        if top != 255:
            raise ValueError("only 8-bit Netpbm is supported")
        planes = 1 if data[:2] == b"P5" else 3
        if not (w and h):
            raise ValueError("a picture without pixels")
        pixels = np.frombuffer(data, np.uint8, w * h * planes, start)
        return pixels.reshape(h, w) if planes == 1 else pixels.reshape(h, w, 3)
    if data[:2] == b"BM":
        start, head = struct.unpack_from("<II", data, 10)
        w, h, _, bits, packed = struct.unpack_from("<iiHHI", data, 18)
        if head < 40 or packed or bits not in (8, 24) or w <= 0 or not h:
            raise ValueError("only plain BMP of 8 or 24 bits is supported")
        stride = -(-w * bits // 32) * 4
        rows = np.frombuffer(data, np.uint8, abs(h) * stride, start).reshape(abs(h), stride)
        rows = rows[::-1] if h > 0 else rows
        if bits == 8:
            (used,) = struct.unpack_from("<I", data, 46)
            palette = np.frombuffer(data, np.uint8, 4 * (used or 256), 14 + head).reshape(-1, 4)[:, 2::-1]
            grey = (palette == palette[:, :1]).all()
            return (palette[:, 0] if grey else palette)[rows[:, :w]]
        return rows[:, : 3 * w].reshape(abs(h), w, 3)[:, :, ::-1]
    raise ValueError("neither Netpbm nor BMP")


def area_resize(pixels: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean of the source area of every target pixel, read from an integral image (float64)."""
    h, w = pixels.shape[:2]
    integral = np.zeros((h + 1, w + 1), np.float64)
    np.cumsum(np.cumsum(pixels, 0, dtype=np.float64), 1, out=integral[1:, 1:])

    def along(total: np.ndarray, size: int, parts: int) -> np.ndarray:
        edge = np.linspace(0, size, parts + 1)
        low = np.minimum(edge.astype(np.int64), size - 1)
        part = (edge - low).reshape((-1,) + (1,) * (total.ndim - 1))
        return np.diff(total[low] * (1 - part) + total[low + 1] * part, axis=0) * (parts / size)

    return along(along(integral, h, height).T, w, width).T


def difference_hash(small: np.ndarray) -> str:
    """64 bits, as hex: whether each of 8 x 9 pixels is brighter than its left neighbour."""
    bits = np.round(small[:, 1:], 6) > np.round(small[:, :-1], 6)
    return np.packbits(bits).tobytes().hex()


def npy_tile(small: np.ndarray) -> bytes:
    """The small picture, rounded to 8 bits, as an NPY file."""
    out = io.BytesIO()
    np.save(out, np.clip(np.rint(small), 0, 255).astype(np.uint8))
    return out.getvalue()


def store(payload: bytes) -> tuple[str, bytes]:
    """A padded payload as a picture of 64 columns: BMP for an even number of rows, else Netpbm."""
    pixels = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    return ("bmp", encode_bmp(pixels)) if len(pixels) % 2 == 0 else ("pgm", encode_pgm(pixels))


def _features(text: bytes) -> tuple:
    payload = text + bytes(-len(text) % WIDTH or WIDTH * (not text))
    container, media = store(payload)
    pixels = decode_media(media)
    back = pixels.tobytes()
    small = area_resize(pixels, 8, 9)
    return (len(text), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-WIDTH:]), len(media), hashlib.sha256(media).hexdigest(), difference_hash(small), container, hashlib.sha256(npy_tile(small)).hexdigest())


def media_digests(docs: DataFrame) -> DataFrame:
    """Store each whole text as samples, read them back and return digests and features, one row per input row."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    K.prepare(docs.sparkSession)
    schema = to_arrow_schema(StructType.fromDDL(_SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, at = K.text_bytes(b.column(1))
            rows = [_features(raw[i:j].tobytes()) for i, j in zip(at[:-1], at[1:], strict=True)]
            yield K.batch(schema, [b.column(0), *([list(c) for c in zip(*rows, strict=True)] or [[]] * 9)])

    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(run, _SCHEMA)


def media_tiles(docs: DataFrame, height: int = 32, width: int = 32) -> DataFrame:
    """doc_id, media (stored picture), tile (NPY file of the resized picture), dhash: the outputs themselves."""
    K.prepare(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("media", pa.binary()), ("tile", pa.binary()), ("dhash", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, at = K.text_bytes(b.column(1))
            out: list[tuple] = []
            for i, j in zip(at[:-1], at[1:], strict=True):
                text = raw[i:j].tobytes()
                _, media = store(text + bytes(-len(text) % WIDTH or WIDTH * (not text)))
                pixels = decode_media(media)
                out.append((media, npy_tile(area_resize(pixels, height, width)), difference_hash(area_resize(pixels, 8, 9))))
            yield K.batch(schema, [b.column(0), *([list(c) for c in zip(*out, strict=True)] or [[]] * 3)])

    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(run, "doc_id long, media binary, tile binary, dhash string")


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_digests(K.documents(spark, sf_dir))
