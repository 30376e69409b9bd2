"""Text cleaning as column expressions.

The character classes are spelled out so that Java and RE2 read them alike:
a word character is a Unicode letter, number or underscore.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.lexicon import CONTRACTIONS, ENGLISH, FILLERS

WORD = r"\p{L}\p{N}_"
SPACE = r"\s\x0B\x1C-\x1F\x{85}\p{Z}"
NOT_WORD_OR_SPACE = f"[^{WORD}{SPACE}]"
SPACES = f"[{SPACE}]+"
CLOCK_TIME = r"\b\d{1,2}:\d{2}(:\d{2})?(\.\d{1,3})?\b"
ALPHANUMERIC = "^[a-zA-Z0-9]+$"


def split_words(text: Column) -> Column:
    """White-space tokens of punctuation-free text, contractions split in two."""

    def parts(token: Column) -> Column:
        pair = F.array(token)
        for whole, pieces in CONTRACTIONS:
            pair = F.when(token == whole, F.array(*[F.lit(p) for p in pieces])).otherwise(pair)
        return F.when(token.isin(*[whole for whole, _ in CONTRACTIONS]), pair).otherwise(F.array(token))

    return F.flatten(F.transform(F.split(text, SPACES), parts))


def clean_tokens(text: Column, stop_words: Sequence[str] = ENGLISH, min_length: int = 3) -> Column:
    """Keyword tokens: lower case, no punctuation, no stop words, no short words; null gives []."""
    bare = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD_OR_SPACE, "")
    return F.filter(
        split_words(bare), lambda t: (F.length(t) >= min_length) & ~t.isin(*stop_words)
    )


def clean_transcript(
    text: Column,
    stop_words: Sequence[str] = ENGLISH,
    fillers: Sequence[str] = FILLERS,
) -> Column:
    """Transcript text without clock times, punctuation, stop and filler words."""
    drop = sorted(set(stop_words) | set(fillers))
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), "(?U)" + CLOCK_TIME, "")
    bare = F.regexp_replace(bare, NOT_WORD_OR_SPACE, "")
    bare = F.lower(F.trim(F.regexp_replace(bare, SPACES, " ")))
    return F.array_join(F.filter(split_words(bare), lambda t: (t != "") & ~t.isin(*drop)), " ")


def vector_tokens(text: Column, stop_words: Sequence[str] = ENGLISH) -> Column:
    """Tokens the scorer weighs: runs of two or more word characters, stop words left out."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(f"[{WORD}]{{2,}}"), F.lit(0))
    return F.filter(runs, lambda t: ~t.isin(*stop_words)) if stop_words else runs


def word_runs(text: Column) -> Column:
    """All maximal runs of word characters, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"[{WORD}]+"), F.lit(0))


def is_blank(text: Column) -> Column:
    return F.coalesce(F.regexp_replace(text, SPACES, ""), F.lit("")) == ""


def once(value: Column) -> Column:
    """Selects ``value`` through a generator, so that later uses of it read a column.

    Without it the optimiser copies a costly expression into every place that
    names it, and each copy is evaluated.
    """
    return F.explode(F.array(value))


def rows_of(df: DataFrame, keep: Sequence[str], items: Column, *names: str) -> DataFrame:
    """One row per item (with its position, given two names), the array built once per input row."""
    built = df.select(*keep, once(items).alias("_items"))
    explode = F.posexplode if len(names) == 2 else F.explode
    return built.select(*keep, explode("_items").alias(*names))


def join_texts(*texts: Column) -> Column:
    """Texts joined by one space, nulls skipped; all null gives an empty text."""
    return F.concat_ws(" ", *texts)


def preview(text: Column, n: int) -> Column:
    """The first n characters, with dots when there are more."""
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(text)
