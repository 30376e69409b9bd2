"""Rule ledger: every quality rule once per text, kept as failure bits beside its measurements.

``ledger`` measures each text and notes in one 64-bit mask which rules it fails. A policy is a
version number and the set of rules that it enforces; applying one, or comparing many, reads
the mask alone and never a text again. Column expressions only; no row leaves its task, so one
source, text or group of copies costs no more than its own length.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import pick

#: White space between words, and the characters that count as symbols (fixed values).
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SPLIT = r"[\x20\x09-\x0D]+"
WINDOW = 3

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_alpha_words", "n_bullet_lines", "n_cut_lines")


@dataclass(frozen=True)
class Rule:
    """A named bit and the condition, over the measurements alone, under which a text fails it."""

    name: str
    bit: int
    fails: str


#: Thresholds after the rules published for the Gopher corpus (Rae et al., 2021), in whole numbers; two are the contract's own.
RULES = (
    Rule("few_words", 0, "n_words < 50"),
    Rule("repeated_words", 1, "100 * n_repeat_words > 50 * n_words"),
    Rule("many_words", 2, "n_words > 100000"),
    Rule("short_words", 3, "word_chars < 3 * n_words"),
    Rule("long_words", 4, "word_chars > 10 * n_words"),
    Rule("symbols", 5, "10 * n_symbols > n_words"),
    Rule("repeated_lines", 6, "100 * n_dup_lines > 30 * n_lines"),
    Rule("few_letters", 7, "100 * n_alpha_words < 80 * n_words"),
    Rule("bullets", 8, "100 * n_bullet_lines > 90 * n_lines"),
    Rule("cut_lines", 9, "100 * n_cut_lines > 30 * n_lines"),
)
BASE = ("few_words", "repeated_words")

#: Version of a policy -> the rules that it enforces. Length has no upper limit from version 2 on: long documents are kept.
POLICIES: dict[int, tuple[str, ...]] = {
    1: tuple(r.name for r in RULES),
    2: tuple(r.name for r in RULES if r.name != "many_words"),
}
CURRENT = 2


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_in_repeats(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in a run of ``window`` words that the text holds twice or more.

    Runs are compared by the 64-bit hash of their words: sorted, equal runs are neighbours. The places of
    those that have an equal neighbour, in order, cover up to ``window`` words each, less where the next begins.
    """
    last = F.size(words) - window
    runs = F.when(last < 1, F.array().cast("array<struct<h:bigint,at:int>>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.struct(
            F.xxhash64(*[F.get(words, i + k) for k in range(window)]).alias("h"), i.alias("at")
        ))
    )

    def repeated(ordered: Column) -> Column:
        same = lambda run, at: F.coalesce(F.get(ordered, at)["h"] == run["h"], F.lit(False))
        found = F.filter(ordered, lambda run, i: (F.when(i > 0, same(run, i - 1)).otherwise(F.lit(False))) | same(run, i + 1))
        return F.sort_array(F.transform(found, lambda run: run["at"]))

    def covered(places: Column) -> Column:
        width = F.transform(places, lambda at, i: F.least(F.lit(window), F.coalesce(F.get(places, i + 1) - at, F.lit(window))))
        return F.aggregate(width, F.lit(0).cast("long"), lambda total, one: total + one)

    return let(F.sort_array(runs), lambda ordered: let(repeated(ordered), covered))


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def measurements(text: Column) -> dict[str, Column]:
    """Every measurement of a text that is not null, each a long; ``words`` and ``lines`` are made once per text."""
    words = F.array_remove(F.split(text, SPLIT), "")
    lines = F.filter(F.split(text, "\n"), lambda line: without(line, SPACES) != "")
    long = lambda value: value.cast("long")
    told = let(
        words,
        lambda w: let(
            lines,
            lambda rows: F.struct(
                long(F.size(w)).alias("n_words"),
                long(F.size(rows)).alias("n_lines"),
                long(F.size(rows) - F.size(F.array_distinct(rows))).alias("n_dup_lines"),
                words_in_repeats(w).alias("n_repeat_words"),
                long(F.size(F.filter(w, lambda x: x.rlike(r"\p{L}")))).alias("n_alpha_words"),
                long(F.size(F.filter(rows, lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•]")))).alias("n_bullet_lines"),
                long(F.size(F.filter(rows, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$")))).alias("n_cut_lines"),
            ),
        ),
    )
    kept = F.char_length(text)
    return {
        "told": told,
        "word_chars": long(F.char_length(without(text, SPACES))),
        "n_symbols": long(kept - F.char_length(without(text, SYMBOLS))),
    }


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, all measurements and ``failed``, the mask of failed rules, for every row from its whole text.

    Null and empty texts, and texts of white space, have no words and no lines: all measurements are 0. Repeated rows
    and null ids are measured as they are; columns of other names play no part; an empty table gives no rows.
    """
    rows = pick(docs, id, text).toDF("id", "text").select("id", F.coalesce("text", F.lit("")).alias("text"))
    made = measurements(F.col("text"))
    told = rows.select(F.col("id").alias("doc_id"), *[value.alias(name) for name, value in made.items()])
    flat = told.select("doc_id", *[F.col(name if name in made else f"told.{name}").alias(name) for name in MEASURES])
    bits = [F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long") for rule in rules]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return flat.withColumn("failed", mask)


def mask_of(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    """The bits of the named rules; an unknown name is an error."""
    bits = {rule.name: 1 << rule.bit for rule in rules}
    return sum(bits[name] for name in dict.fromkeys(names))


def passes(names: Sequence[str], rules: Sequence[Rule] = RULES, failed: str = "failed") -> Column:
    """Whether a ledger row fails none of the named rules."""
    return F.col(failed).bitwiseAND(F.lit(mask_of(names, rules))) == 0


def apply_policies(noted: DataFrame, policies: Mapping[int, Sequence[str]] = POLICIES, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The ledger with ``passed``, the mask of policy versions (bit = version) that keep the row."""
    verdict = F.lit(0).cast("long")
    for version, names in policies.items():
        verdict = verdict.bitwiseOR(F.when(passes(names, rules), F.lit(1 << version)).otherwise(F.lit(0)).cast("long"))
    return noted.withColumn("passed", verdict)


def ablations(noted: DataFrame, policies: Mapping[int, Sequence[str]] = POLICIES, rules: Sequence[Rule] = RULES) -> DataFrame:
    """For each policy and each of its rules: rows that fail the rule, that fail it alone, and that pass without it.

    (version, rule, n_rows, n_kept, n_failed, n_only, n_kept_without, fails_with): ``fails_with`` is the union, bit by bit, of
    what the rows that fail the rule fail too. Only the count of each distinct mask is shuffled, at most two to the
    power of the number of rules, and the masks are read bit by bit from there. A policy without rules has no row.
    """
    masks = noted.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    asked = [
        F.struct(F.lit(version).alias("version"), F.lit(name).alias("rule"), F.lit(mask_of(names, rules)).cast("long").alias("mask"),
                 F.lit(mask_of([name], rules)).cast("long").alias("bit"))
        for version, names in policies.items() for name in dict.fromkeys(names)
    ]
    if not asked:
        asked_rows = masks.select("failed", "n", F.explode(F.array().cast("array<struct<version:int,rule:string,mask:bigint,bit:bigint>>")).alias("a"))
    else:
        asked_rows = masks.select("failed", "n", F.explode(F.array(*asked)).alias("a"))
    enforced = F.col("failed").bitwiseAND(F.col("a.mask"))
    hit = F.col("failed").bitwiseAND(F.col("a.bit")) != 0
    total = lambda when: F.sum(F.when(when, F.col("n")).otherwise(F.lit(0)))
    return asked_rows.groupBy("a.version", "a.rule").agg(
        F.sum("n").alias("n_rows"),
        total(enforced == 0).alias("n_kept"),
        total(hit).alias("n_failed"),
        total(enforced == F.col("a.bit")).alias("n_only"),
        total((enforced == 0) | (enforced == F.col("a.bit"))).alias("n_kept_without"),
        F.coalesce(F.bit_or(F.when(hit, F.col("failed"))), F.lit(0).cast("long")).alias("fails_with"),
    )


def rule_verdicts(docs: DataFrame, version: int = CURRENT, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The ledger of every row with ``base_failed`` (a rule of the base fails) and ``kept`` (the policy fails no rule, nor does the base).

    Rows without words fail the base. For nulls, repeated rows and empty tables see ``ledger``.
    """
    noted = ledger(docs, id=id, text=text)
    base = passes(BASE)
    return noted.withColumns({"base_failed": ~base, "kept": base & passes(POLICIES[version])})
