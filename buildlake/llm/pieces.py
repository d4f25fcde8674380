"""SentencePiece encoding that keeps, for every piece, its span of original bytes.

The library gives the ids. The normaliser here reads the model's compiled
character map (a double-array trie and its replacements), takes the longest
prefix at each place, and records for every normalised byte where it came
from; piece lengths summed up are places in the normalised text, which that
record projects to the source.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buildlake.llm.common import doc_texts

SPACE = "▁".encode()
# fixed values: piece types of the model format
UNKNOWN, CONTROL, USER_DEFINED, BYTE = 2, 3, 4, 6


class CharacterMap:
    """Longest-prefix replacements of a compiled character map; an empty one replaces nothing."""

    def __init__(self, blob: bytes) -> None:
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.replacements = blob[4 + size :]
        self.first = np.zeros(256, dtype=bool)
        for c in range(256 if self.units else 0):
            self.first[c] = self._step(self._offset(self.units[0]), c) is not None

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def _step(self, node: int, byte: int) -> int | None:
        at = node ^ byte
        return at if at < len(self.units) and self.units[at] & 0x800000FF == byte else None

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes taken, replacement) of the longest key at a place."""
        node, found = self._offset(self.units[0]), None
        for i in range(at, len(data)):
            here = self._step(node, data[i])
            if here is None:
                break
            unit = self.units[here]
            node = here ^ self._offset(unit)
            if unit >> 8 & 1:
                start = self.units[node] & 0x7FFFFFFF
                found = i + 1 - at, self.replacements[start : self.replacements.index(b"\0", start)]
        return found

    def replaced(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, source begin of each, source end of each) after replacement."""
        raw = np.frombuffer(data, np.uint8)
        place = np.arange(len(raw))
        # a character's bytes share its span
        head = (raw & 0xC0) != 0x80
        begin = np.maximum.accumulate(np.where(head, place, 0)) if len(raw) else place
        edges = np.append(np.flatnonzero(head), len(raw))
        end = edges[np.searchsorted(edges, place, side="right")] if len(raw) else place
        if not self.units or not self.first[raw].any():
            return raw, begin, end
        parts, at = [], 0
        for i in np.flatnonzero(self.first[raw] & head).tolist():
            if i < at or (hit := self.longest(data, i)) is None:
                continue
            taken, new = hit
            parts += [(raw[at:i], begin[at:i], end[at:i]), (np.frombuffer(new, np.uint8), np.full(len(new), i), np.full(len(new), i + taken))]
            at = i + taken
        parts.append((raw[at:], begin[at:], end[at:]))
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


class PieceModel:
    """A .model file: the library's processor, the character map and the pieces' byte lengths."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as f:
            blob = f.read()
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=blob)
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(blob)
        spec = model.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.dummy, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.suffix = model.trainer_spec.treat_whitespace_as_suffix
        self.lengths = np.array([1 if p.type == BYTE else 0 if p.type == CONTROL else -1 if p.type == UNKNOWN else len(p.piece.encode()) for p in model.pieces])

    def normalised(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(normalised bytes, source begin and end of each); an added space has an empty span."""
        raw, begin, end = self.map.replaced(text.encode())
        white = raw == 0x20
        if self.squeeze and len(raw):  # no leading, trailing or repeated spaces
            keep = ~white | np.append(~white[1:], False)
            inked = np.flatnonzero(~white)
            lead = np.arange(len(raw)) < (inked[0] if len(inked) else len(raw))
            keep &= ~lead
            raw, begin, end, white = raw[keep], begin[keep], end[keep], white[keep]
        if not len(raw):
            return raw, begin, end
        if self.dummy:
            put, at = (len(raw), int(end[-1])) if self.suffix else (0, int(begin[0]))
            raw, begin, end, white = np.insert(raw, put, 0x20), np.insert(begin, put, at), np.insert(end, put, at), np.insert(white, put, True)
        if not self.escape:
            return raw, begin, end
        size = np.where(white, len(SPACE), 1)
        first = np.cumsum(size) - size
        out = np.repeat(raw, size)
        for j, c in enumerate(SPACE):
            out[first[white] + j] = c
        return out, np.repeat(begin, size), np.repeat(end, size)

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(begin, end) in the text's bytes of each id's piece; begin and end ids have empty spans at the edges."""
        norm, begin, end = self.normalised(text)
        n = self.lengths[ids]
        if (n < 0).any():  # pieces without bytes of their own share what the known ones leave
            n = self._unknown(norm.tobytes(), ids, n.copy())
        edge = np.cumsum(n)
        if (edge[-1] if len(edge) else 0) != len(norm):
            raise ValueError("the pieces don't add up to the normalised text")
        total = len(text.encode())
        if not len(norm):
            return np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        first, last = np.minimum(edge - n, len(norm) - 1), np.maximum(edge - 1, 0)
        some = n > 0
        at_edge = np.where(edge == 0, 0, total)
        return np.where(some, begin[first], at_edge), np.where(some, end[last], at_edge)

    def _unknown(self, norm: bytes, ids: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Unknown pieces reach to where the next known piece's bytes are found; of several in a row all but the last are one character."""
        at = 0
        for i, size in enumerate(n.tolist()):
            if size < 0:
                known = next((j for j in range(i + 1, len(n)) if self.lengths[ids[j]] > 0), None)
                if i + 1 < len(n) and self.lengths[ids[i + 1]] < 0:
                    to = next((j for j in range(at + 1, len(norm)) if norm[j] & 0xC0 != 0x80), len(norm))
                elif known is None:
                    to = len(norm)
                else:
                    to = norm.find(self.processor.id_to_piece(int(ids[known])).encode(), at + 1)
                    to = len(norm) if to < 0 else to
                n[i] = to - at
            at += int(n[i])
        return n


@functools.lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    return PieceModel(path)


FORM = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long"
PIECES = "doc_id long, ids array<int>, begins array<int>, ends array<int>, decoded string"


def _encoded(batch: pa.RecordBatch, model: PieceModel, least: int = 1 << 18) -> Iterator[tuple[int, list]]:
    """(first row, rows of (text, ids)), a bounded part of a batch at a time."""
    texts, first, held = [], 0, 0
    for i, t in enumerate(batch.column(1)):
        texts.append(t.as_py())
        held += len(texts[-1])
        if held >= least or i + 1 == batch.num_rows:
            yield first, list(zip(texts, model.processor.encode(texts, add_bos=True, add_eos=True, num_threads=1), strict=True))
            texts, first, held = [], i + 1, 0


def encode_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ids with begin and end, each piece's span [begin, end) of the text's UTF-8 bytes, and the decoded text.

    A null text is empty: begin and end ids alone. A piece of an added or
    removed space has the span that it stands for, empty if it was added.
    Bytes of one character that are pieces of their own share its span.
    Repeated rows repeat; other columns are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            for first, rows in _encoded(batch, model):
                spans = [model.spans(t, np.array(i)) for t, i in rows]
                ints = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(rows)), pa.array([i for _, i in rows], ints), pa.array([b.tolist() for b, _ in spans], ints), pa.array([e.tolist() for _, e in spans], ints), pa.array([model.processor.decode(i) for _, i in rows], pa.string())], names=["doc_id", "ids", "begins", "ends", "decoded"])

    return doc_texts(docs, id_col, text_col).mapInArrow(work, PIECES)


def piece_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode_pieces`` with digests in the place of arrays and texts, made where the pieces are."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            for first, rows in _encoded(batch, model):
                out = []
                for text, ids in rows:
                    array = np.array(ids, "<u4")
                    begin, end = model.spans(text, array)
                    out.append((len(ids), hashlib.sha256(array.tobytes()).hexdigest(), hashlib.sha256(model.processor.decode(ids).encode()).hexdigest(), zlib.crc32(end.astype("<i8").tobytes(), zlib.crc32(begin.astype("<i8").tobytes()))))
                kinds = (pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(rows)), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True))], names=[f.split()[0] for f in FORM.split(", ")])

    return doc_texts(docs, id_col, text_col).mapInArrow(work, FORM)
