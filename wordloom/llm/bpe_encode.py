"""BPE encoding and decoding of whole texts with a lower-casing word-end vocabulary."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wordloom.llm.bpe import SPACE, char_class, vocabulary
from wordloom.llm.common import as_texts, pick, text_slices

#: The vocabulary's own split of a word (fixed value); L and N stand for letters and numbers.
PIECES = "'s|'t|'re|'ve|'m|'ll|'d|[L]+|[N]|[^ LN]+"
NOT_SPACE = re.compile(rf"[^{SPACE}]+")
#: str.split takes these for white space, Unicode does not.
SEPARATORS = re.compile("[\x1c-\x1f]")
CACHE_WORDS = 100_000


def split_words(text: str) -> list[str]:
    return NOT_SPACE.findall(text) if SEPARATORS.search(text) else text.split()


def normal(word: str) -> str:
    """Composed, then lower-cased letter by letter, so that no letter depends on its neighbours."""
    if word.isascii():
        return word.lower()
    return "".join([c.lower() for c in unicodedata.normalize("NFC", word)])


@cache
def piece_pattern() -> re.Pattern:
    classes = {"L": char_class("L"), "N": char_class("N"), " ": SPACE}
    return re.compile(re.sub("[LN ]", lambda m: classes[m[0]], PIECES))


class Encoder:
    """Words to (number of tokens, ids as text, tokens as text), remembering what it has seen."""

    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.vocab.special, key=len, reverse=True))) + ")")
        self.known: dict[str, tuple[int, str, str]] = {}

    def words_of(self, text: str) -> list[str]:
        """White-space words; special tokens stand alone, marked by a leading space that no word has."""
        if not any(s in text for s in self.vocab.special):
            return split_words(text)
        parts = self.special.split(text)
        return list(chain.from_iterable([" " + p] if i % 2 else split_words(p) for i, p in enumerate(parts)))

    def learn(self, words: list[str]) -> None:
        """Encodes words not yet known, all in one run of merge rounds."""
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        new = [w for w in set(words) if w not in self.known]
        plain = [w for w in new if w[0] != " "]
        for word in new:
            if word[0] == " ":
                number = self.vocab.special[word[1:]]
                self.known[word] = (1, str(number), word[1:])
        split = piece_pattern().findall
        pieces = [split(normal(w)) for w in plain]
        flat = list(chain.from_iterable(pieces))
        ids, counts = self.vocab.encode([p.encode() for p in flat])
        of_word = np.add.reduceat(np.r_[counts, 0], np.cumsum([0, *map(len, pieces)])[:-1]) if plain else []
        names, at = self.vocab.text, 0
        for word, n in zip(plain, np.asarray(of_word).tolist(), strict=True):
            own = ids[at : at + n].tolist()
            at += n
            self.known[word] = (n, " ".join(map(str, own)), " ".join([names[i] for i in own]))

    def digest(self, text_words: list[str]) -> tuple[int, str, str]:
        found = [self.known[w] for w in text_words]
        ids = " ".join([x[1] for x in found])
        decoded = " ".join([x[2] for x in found])
        return (
            sum([x[0] for x in found]),
            hashlib.sha256(ids.encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )


def encode_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for chunk in text_slices(batches, "text"):
            texts = [encoder.words_of(t) for t in as_texts(chunk.column("text"))]
            encoder.learn(list(chain.from_iterable(texts)))
            rows = [encoder.digest(words) for words in texts]
            yield pa.RecordBatch.from_arrays(
                [chunk.column("id"), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.string(), pa.string())))],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def encode(texts: list[str | None], path: str) -> list[list[int]]:
    """Token ids of each text."""
    encoder = Encoder(path)
    words = [encoder.words_of(t or "") for t in texts]
    encoder.learn(list(chain.from_iterable(words)))
    return [[int(i) for w in ws for i in encoder.known[w][1].split()] for ws in words]


def decode(ids: list[int], path: str) -> str:
    """The tokens of the ids, joined by spaces: the vocabulary names no decoder that would glue them."""
    vocab = vocabulary(path)
    special = {number: token for token, number in vocab.special.items()}
    return " ".join(special[i] if i in special else vocab.text[i] for i in ids)


def bpe_digests(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token count and digests of the ids and of the decoded text, for every row.

    ``path`` names the vocabulary file, readable where the executors run. Texts are composed (NFC), white
    space parts words, letters are lower-cased, special tokens inside a text are taken whole.
    Returns doc_id, n_tokens, ids_sha256, decoded_sha256. Null and empty texts have no tokens and the digest of
    the empty text; repeated rows and null ids are returned as they are; an empty table gives no rows.
    """
    rows = pick(docs, id, text).toDF("id", "text")
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(encode_batches(path), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
