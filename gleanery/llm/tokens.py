"""Byte-level BPE from the JSON file of a public tokenizer, run by the faster of two libraries.

`tiktoken` gives the ids that `tokenizers` gives for these files (the tests
compare both over all code points) in a quarter of the time. What it cannot
take, such as millions of letters without a break, goes to `tokenizers`.
"""

from __future__ import annotations

import json

import numpy as np
import tiktoken
from tokenizers import Tokenizer

# Fixed value: how the byte-level scheme cuts a text before merging.
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Texts with longer runs without white space, or of it, are left to `tokenizers`.
LONGEST_RUN = 20_000


def _byte_of() -> dict[str, int]:
    """Characters that stand for bytes: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class ByteTokenizer:
    """Ids of whole texts, and the bytes each id stands for."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        byte_of = _byte_of()
        special = {t["content"]: t["id"] for t in described["added_tokens"]}
        ranks = {
            bytes(byte_of[c] for c in token): number
            for token, number in described["model"]["vocab"].items()
            if token not in special
        }
        self.path = path
        self.size = len(ranks) + len(special)
        self.special = special
        self._fast = tiktoken.Encoding(
            "bytes", pat_str=CUTS, mergeable_ranks=ranks, special_tokens=special
        )
        self._slow: Tokenizer | None = None
        self.widths = np.zeros(self.size, np.int64)
        for token, number in ranks.items():
            self.widths[number] = len(token)
        for token, number in special.items():
            self.widths[number] = len(token.encode())

    def encode(self, text: str) -> list[int]:
        if any(name in text for name in self.special) or _long_run(text):
            if self._slow is None:
                self._slow = Tokenizer.from_file(self.path)
            return self._slow.encode(text, add_special_tokens=False).ids
        return self._fast.encode_ordinary(text)


def _long_run(text: str) -> bool:
    if len(text) <= LONGEST_RUN:
        return False
    words = text.split()
    longest = max(map(len, words), default=0)
    blanks = len(text) - sum(map(len, words)) - len(words)
    return longest > LONGEST_RUN or blanks > LONGEST_RUN
