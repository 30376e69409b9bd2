"""Token counts of whole texts with a byte-level vocabulary, by rank-synchronous merging."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from wordloom.llm.bpe import SPACE, char_class, vocabulary
from wordloom.llm.common import pick, text_slices

#: The vocabulary's own split of a text (fixed value); L, N and S stand for letters, numbers and white space.
PRE_TOKENS = "'s|'t|'re|'ve|'m|'ll|'d| ?[L]+| ?[N]+| ?[^SLN]+|[S]+(?![^S])|[S]+"
#: The same split's coarser units: no pre-token reaches over the end of one.
UNITS = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
CACHE_UNITS = 1_000_000  # some 200 bytes each
#: White space of one byte, and all other white space, whose texts are split by pattern (fixed values).
NARROW = np.zeros(256, bool)
NARROW[list(b"\t\n\x0b\x0c\r ")] = True
WIDE_SPACE = "[\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of all texts one after another, and where each ends; null is empty."""
    flat = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    data = flat.buffers()[2]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data and len(flat) else np.zeros(0, np.uint8), offsets[1:] - offsets[:1]


def unit_starts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the units of ``UNITS`` begin, in texts whose only white space is narrow.

    A word takes one blank before it along. What is left of a run of white space is one unit, but for its
    last character if that is no blank and a word follows.
    """
    size = len(data)
    space = NARROW[data]
    first = np.zeros(size + 1, bool)
    first[np.r_[0, ends]] = True
    first = first[:size]  # the first byte of each text; empty texts share it with the next
    last = np.r_[first[1:], True]
    run = space & (first | ~np.r_[False, space[:-1]])
    before_word = space & ~last & ~np.r_[space[1:], True]
    word = ~space & (first | np.r_[True, space[:-1]])
    alone = word & (first | (np.r_[0, data[:-1]] != ord(" ")))
    return np.flatnonzero(run | before_word | alone)


@cache
def pre_token_pattern() -> re.Pattern:
    classes = {"L": char_class("L"), "N": char_class("N"), "S": SPACE}
    return re.compile(re.sub("[LNS]", lambda m: classes[m[0]], PRE_TOKENS))


class Counter:
    """Tokens per unit of text, remembering what it has seen."""

    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        self.special = re.compile("|".join(map(re.escape, sorted(self.vocab.special, key=len, reverse=True))))
        self.known: dict[str, int] = {}

    def parts(self, text: str) -> tuple[list[str], int]:
        """Units of the text outside special tokens, and how many of these it holds."""
        if not any(s in text for s in self.vocab.special):
            return UNITS.findall(text), 0
        pieces = self.special.split(text)
        return list(chain.from_iterable(UNITS.findall(p) for p in pieces)), len(pieces) - 1

    def learn(self, units: Iterator[str]) -> None:
        if len(self.known) > CACHE_UNITS:
            self.known = {}
        new = list(set(units) - self.known.keys())
        split = pre_token_pattern().findall
        pieces = [split(u) for u in new]
        _, counts = self.vocab.encode([p.encode() for p in chain.from_iterable(pieces)])
        if new:
            totals = np.add.reduceat(np.r_[counts, 0], np.cumsum([0, *map(len, pieces)])[:-1])
            self.known.update(zip(new, totals.tolist(), strict=True))

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text, split by pattern."""
        split = [self.parts(t) for t in texts]
        self.learn(chain.from_iterable(units for units, _ in split))
        return [sum(map(self.known.__getitem__, units)) + special for units, special in split]

    def count_column(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text. Units are cut and told apart in columns, each distinct one is looked up once.

        Texts that hold wide white space or a special token are split by pattern.
        """
        odd = pc.match_substring_regex(texts, WIDE_SPACE)
        for token in self.vocab.special:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        odd = pc.fill_null(odd, False)
        totals = np.zeros(len(texts), np.int64)
        if pc.any(odd).as_py():
            rows = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
            totals[rows] = self.count(texts.take(pa.array(rows)).to_pylist())
            texts = pc.if_else(odd, pa.scalar("", texts.type), texts)
        data, ends = text_bytes(texts)
        starts = unit_starts(data, ends)
        places = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
        units = pa.LargeStringArray.from_buffers(len(starts), places, pa.py_buffer(data)).dictionary_encode()
        listed = units.dictionary.to_pylist()
        self.learn(iter(listed))
        counts = np.fromiter(map(self.known.__getitem__, listed), np.int64, len(listed))
        sums = np.r_[0, np.cumsum(counts[units.indices.to_numpy(zero_copy_only=False)])]
        return totals + np.diff(sums[np.searchsorted(starts, np.r_[0, ends])])


def count_batches(path: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for chunk in text_slices(batches, "text"):
            texts = chunk.column("text")
            counts = counter.count_column(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("id"),
                    pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64()),
                    pa.array(counts),
                    pa.array(counts > limit),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return run


def token_counts(docs: DataFrame, path: str, limit: int = 512, id: str = "doc_id", text: str = "text") -> DataFrame:
    """UTF-8 bytes and tokens of every row's whole text, and whether the tokens exceed ``limit``.

    ``path`` names the vocabulary file, readable where the executors run. Special tokens inside a text count as
    one token each. Returns doc_id, n_bytes, n_tokens, over_limit. Null and empty texts have none; repeated rows
    and null ids are returned as they are; an empty table gives no rows.
    """
    rows = pick(docs, id, text).toDF("id", "text")
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(count_batches(path, limit), f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
