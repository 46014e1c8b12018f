"""A byte-level BPE vocabulary, read from a ``tokenizers`` JSON file.

The driver reads the file and broadcasts its text (a vocabulary of fixed size);
workers parse it once each.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import regex

#: Fixed value: how the byte-level pre-tokenizer splits a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ids, merge ranks and added tokens of one byte-level BPE file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        back = byte_alphabet()
        ids = model["vocab"]
        as_bytes = {t: bytes(back[c] for c in t) for t in ids}
        self.added = {a["content"]: a["id"] for a in spec.get("added_tokens") or []}
        self.size = max([*ids.values(), *self.added.values()]) + 1
        self.bytes_of = [b""] * self.size
        for t, i in ids.items():
            self.bytes_of[i] = as_bytes[t]
        for t, i in self.added.items():
            self.bytes_of[i] = t.encode()
        self.byte_id = np.zeros(256, np.int64)
        for t, i in ids.items():
            if len(as_bytes[t]) == 1:
                self.byte_id[as_bytes[t][0]] = i
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.left = np.array([ids[a] for a, _ in pairs], np.int64)
        self.right = np.array([ids[b] for _, b in pairs], np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        key = (self.left << 32) | self.right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = key[order], order
        self.split = regex.compile(SPLIT)
        self.special = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))
                                     + ")") if self.added else None
        self.ids = ids
        self.as_bytes = as_bytes

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of ids, -1 where there is none."""
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def by_id(self) -> bool:
        """Whether later merges have larger ids, as encoders by rank assume."""
        return bool(np.all(np.diff(self.merged) > 0))


@lru_cache(maxsize=2)
def vocabulary(text: str) -> Vocabulary:
    return Vocabulary(text)


def read_vocabulary(path: str) -> str:
    """The vocabulary file's text, read on the driver."""
    with open(path, encoding="utf-8") as f:
        return f.read()
