"""Token ids of public byte-level BPE files, whole texts, one loaded tokenizer a worker.

``tokenizers`` reads the .json file and decides. Where a file with the same
vocabulary as ranks is given, ``tiktoken`` encodes plain Latin texts without
special strings with the same ids at several times the speed; any other text
goes to ``tokenizers``.
"""

from __future__ import annotations

import base64
import functools
import json
import os
import re

import numpy as np

# fixed value: how the vocabulary's makers split a text before merging
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_UNUSUAL = re.compile("[^\n\t\x20-\x7e¡-ɏ‐-‧]")


class BytePairs:
    """Encoder of one .json file, with an optional .tiktoken file of the same vocabulary."""

    def __init__(self, path: str, ranks: str | None = None) -> None:
        self.path, self.ranks = path, ranks
        with open(path, encoding="utf-8") as f:
            added = [t["content"] for t in json.load(f).get("added_tokens") or []]
        self.special = re.compile("|".join(map(re.escape, added))) if added else None
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=table, special_tokens={})

    @functools.cached_property
    def exact(self):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(self.path)
        t.no_truncation()
        t.no_padding()
        return t

    def plain(self, text: str) -> bool:
        """Whether both libraries split the text alike beyond doubt."""
        return self.fast is not None and not _UNUSUAL.search(text) and not (self.special and self.special.search(text))

    def encode(self, text: str) -> np.ndarray:
        if self.plain(text):
            return np.array(self.fast.encode_ordinary(text), dtype=np.uint32)
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def count(self, text: str) -> int:
        return len(self.fast.encode_ordinary(text)) if self.plain(text) else len(self.exact.encode(text, add_special_tokens=False))


class SentencePieces:
    """Counts by a .model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.exact = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.exact.encode(text), dtype=np.uint32)

    def count(self, text: str) -> int:
        return len(self.exact.encode(text))


@functools.lru_cache(maxsize=4)
def load(path: str, ranks: str | None = None) -> BytePairs | SentencePieces:
    return SentencePieces(path) if path.endswith(".model") else BytePairs(path, ranks)


def sentence_ends(path: str) -> np.ndarray:
    """By id: whether the token ends a sentence or line (holds '.', '!', '?' or a line feed)."""
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    out = np.zeros(max(vocabulary.values()) + 2, dtype=bool)
    for token, i in vocabulary.items():
        out[i] = any(c in token for c in ".!?Ċ")
    return out
