"""Language of a text by rank-order profiles of its most frequent letter n-grams.

A profile is the list of the most frequent n-grams of one to three letters, words padded
by a blank on both sides; ties go to the lower code. A document is compared to each
language by the out-of-place distance: the sum over the document's own profile of how
far each n-gram stands from its place in the language's, or the profile length if it is
not there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.common import as_texts, fold, pick, plain_names, text_slices

PROFILE = 300
LETTER_BITS = 18  # every letter of Unicode lies below U+40000
SALTS = 64
LENGTH_BANDS = 13  # by binary digits of the length: the last holds all texts of 4,096 characters and more
BAND_ROWS = 1000  # with fewer training rows a band takes the cut of all rows
LIKENESS_STEPS = 1000
LOW_SHARE = 0.01
SLICE_BYTES = 1 << 20  # of text counted at once: its n-gram keys take some sixty times that


@cache
def letter_table() -> np.ndarray:
    """Whether each code point below U+40000 is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(1 << LETTER_BITS)), bool, 1 << LETTER_BITS)


def letters_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters of all texts, a zero between words and around each text, and the text of each place."""
    points = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    lengths = np.array([len(p) + 1 for p in points])
    flat = np.zeros(int(lengths.sum()) + 1, np.int64)
    at = 1
    for p in points:
        flat[at : at + len(p)] = p
        at += len(p) + 1
    owner = np.r_[0, np.repeat(np.arange(len(texts)), lengths)]
    inside = flat < (1 << LETTER_BITS)
    flat[~inside] = 0
    flat[~letter_table()[flat]] = 0
    keep = np.r_[True, (flat[1:] != 0) | (flat[:-1] != 0)]
    return flat[keep], owner[keep]


def count_ngrams(texts: list[str], groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, n-gram, count), sorted by group and n-gram; texts of one group are counted together.

    An n-gram is its length in the top bits over three letters of 18 bits each.
    """
    flat, owner = letters_of(texts)
    letters, dense = np.unique(flat, return_inverse=True)
    bits = max(1, int(len(letters)).bit_length())
    owner_group = groups[owner]
    spare = 61 - 3 * bits  # dense letters and the length leave this many bits for the group
    out = []
    n_groups = int(groups.max()) + 1 if len(groups) else 0
    step = 1 << min(spare, 40)
    for low in range(0, n_groups, step):
        parts = []
        for n in (1, 2, 3):
            if len(dense) < n:
                continue
            size = len(dense) - n + 1
            key = np.full(size, n, np.int64)
            for k in range(n):
                key = (key << bits) | dense[k : k + size]
            key = key - (n << (n * bits)) + (n << (3 * bits))
            if n == 1:
                usable = flat[:size] != 0
            elif n == 2:
                usable = (flat[:-1] != 0) | (flat[1:] != 0)
            else:
                usable = flat[1:-1] != 0
            # the blank before a text's first word is listed under the text before it
            if n == 1:
                group = owner_group
            elif n == 2:
                group = np.where(flat[:-1] != 0, owner_group[:-1], owner_group[1:])
            else:
                group = owner_group[1:-1]
            usable &= (group >= low) & (group < low + step)
            parts.append((((group - low) << (3 * bits + 2)) | key)[usable])
        keys = np.sort(np.concatenate([*parts, np.zeros(0, np.int64)]))
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
        keys, counts = keys[starts], np.diff(np.r_[starts, len(keys)])
        mask = (1 << bits) - 1
        code = (keys >> (3 * bits)) & 3
        for k in (2, 1, 0):
            code = (code << LETTER_BITS) | letters[(keys >> (k * bits)) & mask]
        out.append((low + (keys >> (3 * bits + 2)), code, counts))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts per language of each slice of training texts."""
    for chunk in text_slices(batches, "text", SLICE_BYTES):
        coded = chunk.column("lang").dictionary_encode()
        names = coded.dictionary.to_pylist()
        group, code, count = count_ngrams(as_texts(chunk.column("text")), coded.indices.to_numpy().astype(np.int64))
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array(names, pa.string()).take(pa.array(group)), "code": code, "n": count,
        })


def profiles(train: DataFrame, size: int = PROFILE) -> DataFrame:
    """(lang, code, place) of each language's most frequent n-grams, from rows of lang and text."""
    counts = (
        train.mapInArrow(count_batches, "lang string, code long, n long")
        .groupBy("lang", "code").agg(F.sum("n").alias("n"))
        .withColumn("salt", F.pmod(F.xxhash64("code"), F.lit(SALTS)))
    )
    order = [F.desc("n"), F.asc("code")]
    some = counts.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("place") <= size)
    best = some.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return best.filter(F.col("place") <= size).select("lang", "code", (F.col("place") - 1).alias("place"))


class Identifier:
    """Places of all n-grams in all profiles; a bounded table: profile length times languages."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        self.size = size
        self.langs = sorted({r[0] for r in rows})
        self.codes = np.unique(np.array([r[1] for r in rows], np.int64))
        self.places = np.full((len(self.codes) + 1, len(self.langs)), size, np.int32)
        column = {name: k for k, name in enumerate(self.langs)}
        for lang, code, place in rows:
            self.places[np.searchsorted(self.codes, code), column[lang]] = place

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Nearest language and likeness: one less the distance over the largest possible one."""
        group, code, count = count_ngrams(texts, np.arange(len(texts)))
        order = np.argsort((group << 32) - count, kind="stable")
        group, code = group[order], code[order]
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, int)
        place = np.arange(len(group)) - np.repeat(starts, np.diff(np.r_[starts, len(group)]))
        top = place < self.size
        group, code, place = group[top], code[top], place[top]
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        if not len(group) or not self.langs:
            return langs, scores
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        at = np.where(self.codes[at] == code, at, len(self.codes))
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        apart = np.empty((len(starts), len(self.langs)))
        for k in range(len(self.langs)):
            known = self.places[at, k]
            apart[:, k] = np.add.reduceat(np.where(known < self.size, np.abs(known - place), self.size), starts)
        best = apart.argmin(axis=1)
        worst = np.diff(np.r_[starts, len(group)]) * self.size
        likeness = 1 - apart[np.arange(len(starts)), best] / worst
        for row, k, value in zip(group[starts].tolist(), best.tolist(), likeness.tolist(), strict=True):
            langs[row], scores[row] = self.langs[k], value
        return langs, scores


def identify_batches(identifier: Identifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_slices(batches, "text", SLICE_BYTES):
            langs, scores = identifier.predict(as_texts(chunk.column("text")))
            kept = [chunk.column(k) for k in range(chunk.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*chunk.schema.names, "lang_pred", "score"],
            )

    return run


def training_rows(docs: DataFrame, folds: int, held_out: int, id: str, text: str, lang: str) -> DataFrame:
    """lang and text of all rows that have both and are not held out."""
    rows = pick(docs, id, text, lang).toDF("id", "text", "lang")
    return rows.filter((fold(F.col("id"), folds) != held_out) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")


def train_identifier(docs: DataFrame, folds: int = 4, held_out: int = 2, size: int = PROFILE, id: str = "doc_id", text: str = "text", lang: str = "lang") -> Identifier:
    """Profiles of all languages named in rows whose crc32(id) modulo ``folds`` is not ``held_out``.

    Rows without a text or a language teach nothing. What comes to the driver is ``size`` n-grams per language.
    """
    train = training_rows(docs, folds, held_out, id, text, lang)
    return Identifier([tuple(r) for r in profiles(train, size).collect()], size)


def length_band(text: Column) -> Column:
    """Band of a text by its length, from 0."""
    return F.least(F.length(F.bin(F.length(F.coalesce(text, F.lit(""))))), F.lit(LENGTH_BANDS)) - 1


def band_scores(identifier: Identifier):
    """Likeness of each text that has any, beside its band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_slices(batches, "text", SLICE_BYTES):
            langs, scores = identifier.predict(as_texts(chunk.column("text")))
            known = pa.array([name != "und" for name in langs], pa.bool_())
            yield pa.RecordBatch.from_arrays([chunk.column("band"), pa.array(scores, pa.float64())], names=["band", "score"]).filter(known)

    return run


def low_fence(steps: np.ndarray) -> float:
    """As far below the low quantile of a histogram of likeness as the median lies above it; 0 if it is empty."""
    sums = np.cumsum(steps)
    low, middle = np.searchsorted(sums, np.array([LOW_SHARE, 0.5]) * sums[-1]) if sums[-1] else (0, 0)
    return max(0, 2 * int(low) - int(middle)) / LIKENESS_STEPS


def likeness_cuts(docs: DataFrame, identifier: Identifier, folds: int = 4, held_out: int = 2, id: str = "doc_id", text: str = "text", lang: str = "lang") -> list[float]:
    """Least likeness of a text of a known language, for each band of lengths, from all rows that the profiles were learned from;
    no band's is below that of all rows.

    What comes to the driver is a histogram of ``LIKENESS_STEPS`` steps per band.
    """
    train = training_rows(docs, folds, held_out, id, text, lang).select(length_band(F.col("text")).alias("band"), "text")
    told = train.mapInArrow(band_scores(identifier), "band int, score double")
    steps = np.zeros((LENGTH_BANDS, LIKENESS_STEPS + 1), np.int64)
    for band, step, n in told.groupBy("band", F.floor(F.col("score") * LIKENESS_STEPS).cast("int").alias("step")).count().collect():
        steps[band, step] = n
    least = low_fence(steps.sum(axis=0))
    return [max(least, low_fence(band)) if band.sum() >= BAND_ROWS else least for band in steps]


def predict_languages(docs: DataFrame, identifier: Identifier, id: str = "doc_id", text: str = "text", folds: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score (0 to 1) for every row, from its whole text alone.

    Null texts and texts without a letter are ``und`` with score 0, as is all if nothing was learned; ties go to
    the language first by name; repeated rows and null ids are returned as they are; an empty table gives no rows.
    """
    rows = pick(docs, id, text).toDF("id", "text").select("id", (fold(F.col("id"), folds) == held_out).alias("held_out"), "text")
    kind = rows.schema["id"].dataType.simpleString()
    told = rows.mapInArrow(identify_batches(identifier), f"id {kind}, held_out boolean, text string, lang_pred string, score double")
    return told.select(F.col("id").alias("doc_id"), "held_out", "lang_pred", "score")


def keep_known(docs: DataFrame, identifier: Identifier, least: float | Sequence[float], text: str = "text") -> DataFrame:
    """The rows, unchanged, whose text is like some language by at least ``least``: one number, or one per band of lengths."""
    plain = plain_names(docs, text=text)
    schema = T.StructType([*plain.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    cut = F.lit(least) if isinstance(least, (int, float)) else F.get(F.array(*map(F.lit, least)), length_band(F.col("text")))
    told = plain.mapInArrow(identify_batches(identifier), schema).filter((F.col("lang_pred") != "und") & (F.col("score") >= cut))
    return told.select(*plain.columns).toDF(*docs.columns)
