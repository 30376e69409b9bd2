"""Byte-pair merges of many words at once, on flat numpy arrays.

Every round looks at all words together: the pairs of neighbouring symbols are found
by binary search among the sorted pair keys, each word's lowest rank is taken, and all
its occurrences in that word are merged, from the left where they overlap. A word with
no pair left leaves the array. Ranks are kept between rounds; only those beside a merge
are looked up again.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from functools import cache, lru_cache

import numpy as np

NO_RANK = np.iinfo(np.int32).max
# White_Space of the Unicode standard (fixed values).
SPACE = "\t-\r \x85\xa0  -     　"


@cache
def char_class(kind: str) -> str:
    """Code points whose general category begins with ``kind``, as the inside of a character class.

    Taken from Python's own table, which is as old as the vocabularies' libraries; newer tables
    know letters that those take for symbols.
    """
    marks = np.fromiter((unicodedata.category(chr(c))[0] == kind for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    edges = np.flatnonzero(np.diff(np.r_[False, marks, False])).reshape(-1, 2)
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b - 1))}" for a, b in edges.tolist())


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte: itself, or the next one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class Vocabulary:
    """A byte-level merge table from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model = whole["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        self.size = max(vocab.values()) + 1
        self.text = [""] * self.size
        for token, number in vocab.items():
            self.text[number] = token
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + suffix] for c in letters], np.int64)
        left, right, made = (np.array(x, np.int64) for x in zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"])))
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made[order]

    def place(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where each pair stands among the sorted keys, -1 if it is no merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, at, -1)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words in one array, and how many each word has."""
        lengths = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[raw]
        ends = np.cumsum(lengths)[lengths > 0] - 1
        symbols[ends] = self.last[raw[ends]]
        owner = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_owner = [], []
        at = np.full(len(symbols), -1, np.int64)
        if len(symbols) > 1:
            at[:-1] = np.where(owner[:-1] == owner[1:], self.place(symbols[:-1], symbols[1:]), -1)
        while len(symbols):
            rank = np.where(at >= 0, self.ranks[at], NO_RANK)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(owner)])
            lowest = np.minimum.reduceat(rank, starts)
            open_word = np.repeat(lowest < NO_RANK, sizes)
            if not open_word.all():
                done_symbols.append(symbols[~open_word])
                done_owner.append(owner[~open_word])
                lowest, sizes = lowest[lowest < NO_RANK], sizes[lowest < NO_RANK]
                symbols, owner, at, rank = symbols[open_word], owner[open_word], at[open_word], rank[open_word]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == np.repeat(lowest, sizes))
            chain = np.r_[False, np.diff(hit) == 1]
            if chain.any():  # overlapping occurrences: every other one, from the left
                index = np.arange(len(hit))
                head = np.maximum.accumulate(np.where(chain, 0, index))
                hit = hit[(index - head) % 2 == 0]
            symbols[hit] = self.made[at[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            moved = np.cumsum(keep) - 1
            symbols, owner, at = symbols[keep], owner[keep], at[keep]
            beside = np.zeros(len(symbols) + 1, bool)
            beside[moved[hit]] = True
            beside[moved[hit] - 1] = True  # before the first symbol is the spare place
            changed = np.flatnonzero(beside[:-1])
            follows = changed + 1 < len(symbols)
            at[changed] = -1
            changed = changed[follows]
            changed = changed[owner[changed] == owner[changed + 1]]
            at[changed] = self.place(symbols[changed], symbols[changed + 1])
        symbols = np.concatenate([*done_symbols, np.zeros(0, np.int64)])
        owner = np.concatenate([*done_owner, np.zeros(0, np.int64)])
        return symbols[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """The table of a file, read once per process."""
    return Vocabulary(path)
