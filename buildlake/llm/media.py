"""Media columns: Netpbm and BMP images as numpy arrays, resized tiles, difference hashes.

An image column holds encoded bytes. Decoding gives height x width x channels
of 8-bit samples; area resizing takes box means from an integral image; tiles
are written in NPY format; the difference hash compares neighbours of a 9 x 8
grey tile. Text columns can be stored as images, one byte a sample.
"""

from __future__ import annotations

import hashlib
import io
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buildlake.llm.common import doc_texts

ROW = 192
BAND = 1 << 20
"""Samples that are summed up at once."""
_TOKEN = re.compile(rb"(?:\s|#[^\n\r]*[\n\r])*([0-9]+)")


def encode_netpbm(image: np.ndarray) -> bytes:
    """Binary PGM (two dimensions) or PPM (three)."""
    kind = b"P5" if image.ndim == 2 else b"P6"
    return b"%s\n%d %d\n255\n" % (kind, image.shape[1], image.shape[0]) + np.ascontiguousarray(image, np.uint8).tobytes()


def encode_bmp(image: np.ndarray) -> bytes:
    """Uncompressed 24-bit BMP of an RGB image, rows bottom up and padded to four bytes."""
    h, w, _ = image.shape
    pad = -3 * w % 4
    rows = np.zeros((h, 3 * w + pad), np.uint8)
    rows[:, : 3 * w] = image[::-1, :, ::-1].reshape(h, 3 * w)
    size = 54 + rows.size
    u4 = lambda x: int(x).to_bytes(4, "little", signed=True)
    head = b"BM" + u4(size) + u4(0) + u4(54) + u4(40) + u4(w) + u4(h) + b"\x01\x00\x18\x00" + u4(0) + u4(rows.size) + u4(2835) * 2 + u4(0) * 2
    return head + rows.tobytes()


def _bits(row_bytes: np.ndarray, width: int) -> np.ndarray:
    return np.unpackbits(row_bytes, axis=1)[:, :width]


def _netpbm(data: bytes) -> np.ndarray:
    kind, at, numbers = data[:2], 2, []
    for _ in range(2 if kind in (b"P1", b"P4") else 3):
        m = _TOKEN.match(data, at)
        if not m:
            raise ValueError("truncated netpbm header")
        numbers.append(int(m[1]))
        at = m.end()
    w, h, most = [*numbers, 1][:3]
    depth = 3 if kind in (b"P3", b"P6") else 1
    if not 0 < most < 65536:
        raise ValueError("netpbm maximum out of range")
    if kind == b"P1":
        flat = np.array([c - 48 for c in data[at:] if c in b"01"][: w * h], np.uint8)
    elif kind in (b"P2", b"P3"):
        flat = np.array(data[at:].split()[: w * h * depth], np.int64)
    elif kind == b"P4":
        flat = _bits(np.frombuffer(data, np.uint8, h * ((w + 7) // 8), at + 1).reshape(h, -1), w).ravel()
    else:
        flat = np.frombuffer(data, np.uint8 if most < 256 else ">u2", w * h * depth, at + 1)
    if flat.size != w * h * depth:
        raise ValueError("truncated netpbm samples")
    if kind in (b"P1", b"P4"):
        flat = (1 - flat) * 255
    elif most != 255:
        flat = (flat.astype(np.int64) * 255 + most // 2) // most
    return flat.astype(np.uint8).reshape((h, w, 3) if depth == 3 else (h, w))


def _bmp(data: bytes) -> np.ndarray:
    num = lambda at, n=4, signed=False: int.from_bytes(data[at : at + n], "little", signed=signed)
    if num(14) < 40:
        raise ValueError("BMP header of an older kind")
    start, w, h, bits, packed = num(10), num(18, signed=True), num(22, signed=True), num(28, 2), num(30)
    if packed not in (0, 3) or bits not in (1, 4, 8, 24, 32) or w <= 0 or h == 0:
        raise ValueError("BMP variant is not supported")
    if packed == 3 and (bits != 32 or [num(54), num(58), num(62)] != [0xFF0000, 0xFF00, 0xFF]):
        raise ValueError("BMP bit fields are not supported")
    stride = (w * bits + 31) // 32 * 4
    rows = np.frombuffer(data, np.uint8, stride * abs(h), start).reshape(abs(h), stride)
    if bits <= 8:
        used = num(46) or 1 << bits
        table = np.frombuffer(data, np.uint8, 4 * used, 14 + num(14)).reshape(used, 4)[:, 2::-1]
        if bits == 8:
            index = rows[:, :w]
        else:
            per = np.unpackbits(rows, axis=1).reshape(abs(h), -1, bits)
            index = (per @ (1 << np.arange(bits - 1, -1, -1))).astype(np.uint8)[:, :w]
        image = table[index]
    else:
        image = rows[:, : w * bits // 8].reshape(abs(h), w, bits // 8)[:, :, 2::-1]
    return np.ascontiguousarray(image[::-1] if h > 0 else image)


def decode(data: bytes) -> np.ndarray:
    """Samples of a Netpbm (P1 to P6) or BMP image; ValueError if it is neither or damaged."""
    if data[:1] == b"P" and data[1:2] in b"123456" and len(data) > 2:
        return _netpbm(data)
    if data[:2] == b"BM":
        return _bmp(data)
    raise ValueError("neither Netpbm nor BMP")


def area_resize(image: np.ndarray, height: int, width: int, band: int = BAND) -> np.ndarray:
    """Box means as float, by an integral image; works for shrinking and enlarging.

    Only the rows of the integral image that box edges touch are kept; the
    others are summed up ``band`` samples at a time.
    """
    flat = image.ndim == 2
    x = image[:, :, None] if flat else image
    rows, columns, depth = x.shape

    def edges(size: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        edge = np.arange(n + 1) * size / n
        low = np.minimum(edge.astype(np.int64), size - 1)
        return low, edge - low

    low, part = edges(rows, height)
    needed = np.unique(np.concatenate([low, low + 1]))
    kept = np.zeros((len(needed), columns + 1, depth), np.int64)
    run = np.zeros((columns, depth), np.int64)
    step = max(1, band // (columns * depth))
    for at in range(0, rows, step):
        sums = np.cumsum(x[at : at + step], axis=0, dtype=np.int64) + run
        here = slice(*np.searchsorted(needed, [at + 1, at + len(sums) + 1]))
        kept[here, 1:] = sums[needed[here] - at - 1]
        run = sums[-1]
    np.cumsum(kept[:, 1:], axis=1, out=kept[:, 1:])
    at = np.searchsorted(needed, low)
    part = part[:, None, None]
    strips = kept[at] * (1 - part) + kept[at + 1] * part
    low, part = edges(columns, width)
    part = part[None, :, None]
    corners = strips[:, low] * (1 - part) + strips[:, low + 1] * part
    sums = corners[1:, 1:] - corners[:-1, 1:] - corners[1:, :-1] + corners[:-1, :-1]
    out = sums / (rows / height * columns / width)
    return out[:, :, 0] if flat else out


def grey(image: np.ndarray) -> np.ndarray:
    return image if image.ndim == 2 else (image.sum(axis=2, dtype=np.uint16) // image.shape[2]).astype(np.uint8)


def difference_hash(image: np.ndarray) -> str:
    """16 hexadecimal digits: whether each of 8 x 8 boxes is darker than its right neighbour."""
    small = np.floor(area_resize(grey(image), 8, 9) * 256 + 0.5)
    return np.packbits(small[:, 1:] > small[:, :-1]).tobytes().hex()


def npy_tile(image: np.ndarray, side: int) -> bytes:
    """NPY bytes of the image resized to ``side`` x ``side``."""
    out = io.BytesIO()
    np.save(out, np.clip(np.rint(area_resize(image, side, side)), 0, 255).astype(np.uint8), allow_pickle=False)
    return out.getvalue()


def media_tiles(images: DataFrame, id_col: str, bytes_col: str, side: int = 16) -> DataFrame:
    """(id, width, height, channels, tile binary, dhash, error) of each encoded image.

    Null, empty or damaged bytes give null fields and an error text; the other
    rows are untouched by them. Repeated rows give repeated results.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for blob in batch.column(1):
                try:
                    image = decode(blob.as_py() or b"")
                    if not image.size:
                        raise ValueError("no samples")
                    rows.append((image.shape[1], image.shape[0], 1 if image.ndim == 2 else image.shape[2], npy_tile(image, side), difference_hash(image), None))
                except (ValueError, IndexError, OverflowError) as e:  # whatever damaged headers or samples lead to
                    rows.append((None, None, None, None, None, str(e)))
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True))] if rows else [batch.column(0), *(pa.array([], t) for t in kinds)], names=["id", "width", "height", "channels", "tile", "dhash", "error"])

    kind = dict(images.dtypes)[id_col]
    return images.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{bytes_col}`").cast("binary").alias("b")).mapInArrow(work, f"id {kind}, width int, height int, channels int, tile binary, dhash string, error string")


def text_image(payload: bytes) -> tuple[str, bytes]:
    """(format, bytes) of a payload of a multiple of 192 bytes, 64 RGB pixels a row: BMP for an odd number of rows, else PPM."""
    image = np.frombuffer(payload, np.uint8).reshape(-1, 64, 3)
    return ("bmp", encode_bmp(image)) if len(image) % 2 else ("ppm", encode_netpbm(image))


STORED = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, format string, tile_crc32 long, tile binary"


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", side: int = 16) -> DataFrame:
    """Each whole text stored as a BMP or PPM image, read back, and described.

    The payload is the text's UTF-8 bytes and spaces up to a positive multiple
    of 192 (a null text is empty: one row of spaces). payload_* are of the
    samples that the decoder gives back, media_* of the encoded image in its
    format; feature is the difference hash, tile an NPY tile. Equal texts give
    equal values; repeated rows are repeated; other columns are ignored; an
    empty table gives an empty result.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in STORED.split(", ")][1:]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), *(pa.string(),) * 3, pa.int64(), pa.binary())
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part, rows = batch.slice(at, 512), []
                for text in part.column(1):
                    raw = text.as_py().encode()
                    kind, stored = text_image(raw + b" " * (-len(raw) % ROW or (0 if raw else ROW)))
                    image = decode(stored)
                    back, tile = image.tobytes(), npy_tile(image, side)
                    rows.append((len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), difference_hash(image), kind, zlib.crc32(tile), tile))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True))], names=["doc_id", *names])

    return doc_texts(docs, id_col, text_col).mapInArrow(work, STORED)
