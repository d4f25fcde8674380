"""Portable executables as they lie in memory: headers and sections decoded, sections put at their addresses."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MOST_BYTES = 1 << 30
"""Size of an image from which on its header is taken for damaged."""


def image_of(data: bytes) -> bytes:
    """The memory image of a 32- or 64-bit executable, from address 0 of its base; ValueError if it is none.

    Headers come first; each section lies at its virtual address, cut to or
    filled with zeros up to its virtual size.
    """
    try:
        start = struct.unpack_from("<I", data, 0x3C)[0]
        if data[:2] != b"MZ" or data[start : start + 4] != b"PE\0\0":
            raise ValueError("no portable executable")
        n_sections, optional = struct.unpack_from("<H", data, start + 6)[0], struct.unpack_from("<H", data, start + 20)[0]
        size, headers = struct.unpack_from("<II", data, start + 24 + 56)
        sections = [struct.unpack_from("<IIII", data, start + 24 + optional + 40 * i + 8) for i in range(n_sections)]
    except struct.error as e:
        raise ValueError("truncated header") from e
    if size > MOST_BYTES:
        raise ValueError("image size out of range")
    out = np.zeros(size, np.uint8)
    raw = np.frombuffer(data, np.uint8)
    for at, begin, n in [(0, 0, headers), *((address, offset, min(stored, virtual or stored)) for virtual, address, stored, offset in sections)]:
        part = raw[begin : begin + n][: max(0, size - at)]
        out[at : at + len(part)] = part
    return out.tobytes()


def mapped_images(files: DataFrame, name: str = "file_name", content: str = "content") -> DataFrame:
    """(file_name, content, error): each file's memory image, or why there is none. Null content is empty."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # one image at a time
                image, error = None, None
                try:
                    image = image_of(batch.column(1)[i].as_py() or b"")
                except ValueError as e:
                    error = str(e)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([image], pa.binary()), pa.array([error], pa.string())], names=["file_name", "content", "error"])

    return files.selectExpr(f"`{name}` as file_name", f"cast(`{content}` as binary) as content").mapInArrow(work, f"file_name {dict(files.dtypes)[name]}, content binary, error string")
