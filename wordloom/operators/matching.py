"""Matching descriptions against a keyword network.

Descriptions are ``(key..., text)``; a network is ``keywords(pos, keyword, nested,
is_sufficient)`` and ``sequences(pos, sequence, is_sufficient)``, both of one
category or joined on ``category`` by the caller through ``on``. Patterns are
never tried against texts one by one: texts give words, and words meet patterns
in equi-joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.text import WORD, rows_of, word_runs
from wordloom.operators import text_blocks
from wordloom.session import discard, passes, passing, stage, stage_each


def match_keywords(tokens: DataFrame, keywords: DataFrame, key: Sequence[str], on: Sequence[str] = ()) -> DataFrame:
    """Whole-word matches in cleaned texts: (key, on, pos, keyword).

    A keyword of several words (a network from elsewhere) is found by its first
    word and then looked for in the cleaned text itself.
    """
    words = rows_of(tokens, [*key, *on], F.array_distinct("tokens"), "_w")
    cut = keywords.select(*on, "pos", "keyword", F.split(F.lower("keyword"), " ").alias("_ws"))
    met = words.join(cut.withColumn("_w", F.get("_ws", F.lit(0))), [*on, "_w"])
    single = met.filter(F.size("_ws") == 1).select(*key, *on, "pos", "keyword")
    several = (
        met.filter(F.size("_ws") > 1)
        .join(tokens.select(*key, F.array_join("tokens", " ").alias("_t")), list(key))
        .filter(F.concat(F.lit(" "), "_t", F.lit(" ")).contains(
            F.concat(F.lit(" "), F.lower("keyword"), F.lit(" "))))
        .select(*key, *on, "pos", "keyword")
    )
    return single.unionByName(several)


def _lower(sequences: DataFrame) -> DataFrame:
    return sequences.withColumn("sequence", F.transform("sequence", lambda w: F.lower(w)))


def _in_words(sequences: DataFrame) -> DataFrame:
    """Sequences as lists of single words; ``_phrases`` holds the members of several, ``_members`` all as they were."""
    return sequences.select(
        *[c for c in sequences.columns if c != "sequence"],
        F.flatten(F.transform("sequence", lambda m: F.split(m, " "))).alias("sequence"),
        F.filter("sequence", lambda m: F.contains(m, F.lit(" "))).alias("_phrases"),
        F.col("sequence").alias("_members"),
    )


def _anchored(held: DataFrame, sequences: DataFrame, on: Sequence[str]) -> DataFrame:
    """Pairs of a row of ``held(.., on, _words)`` and a sequence that may match it.

    A sequence is tried only where its rarest word occurs, so a word shared by
    many sequences, or found in many texts, does not multiply the pairs. Equal
    sequences are tried once; ``_poss`` lists where they stand in the network.
    """
    own = [*on, "sequence", "_phrases", "_members"]
    distinct = sequences.groupBy(*own).agg(F.collect_list("pos").alias("_poss"))
    rows = held.select("*", F.explode("_words").alias("_w"))
    frequency = rows.groupBy(*on, "_w").agg(F.count(F.lit(1)).alias("_n"))
    anchors = (
        distinct.select(*own, "_poss", F.explode(F.array_distinct("sequence")).alias("_w"))
        .join(frequency, [*on, "_w"], "left")
        .groupBy(*own, "_poss")
        .agg(F.min_by("_w", F.struct(F.coalesce("_n", F.lit(0)), "_w")).alias("_w"))
    )
    return rows.join(anchors, [*on, "_w"])


def match_sequences_all(tokens: DataFrame, sequences: DataFrame, key: Sequence[str], on: Sequence[str] = ()) -> DataFrame:
    """Sequences all of whose members occur, in any order and case: (key, on, pos).

    A member of several words must stand as such in the cleaned text, which is looked at only where all words are.
    """
    sequences = _in_words(_lower(sequences))
    wanted = sequences.select(*on, F.explode("sequence").alias("_w")).distinct()
    held = stage(
        rows_of(tokens, [*key, *on], F.array_distinct("tokens"), "_w")
        .join(wanted, [*on, "_w"], "left_semi")
        .groupBy(*key, *on)
        .agg(F.collect_list("_w").alias("_words")),
        "held-words",
    )
    met = _anchored(held, sequences, on).filter(F.size(F.array_except("sequence", "_words")) == 0)
    single = met.filter(F.size("_phrases") == 0)
    several = met.filter(F.size("_phrases") > 0).join(
        tokens.select(*key, *on, F.concat(F.lit(" "), F.array_join("tokens", " "), F.lit(" ")).alias("_t")), [*key, *on]
    ).filter(F.forall("_phrases", lambda p: F.contains(F.col("_t"), F.concat(F.lit(" "), p, F.lit(" ")))))
    return single.select(*key, *on, "_poss").unionByName(several.select(*key, *on, "_poss")).select(
        *key, *on, F.explode("_poss").alias("pos")
    )


def run_counts(texts: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, run, n): the runs of word characters of each text, counted."""
    return (
        rows_of(texts, key, word_runs(F.col("text")), "run")
        .groupBy(*key, "run")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _grams(text: Column, size: int) -> Column:
    return F.regexp_extract_all(text, F.lit("(?=(.{%d}))" % size), F.lit(1))


def rarest_grams(wanted: DataFrame, postings: DataFrame) -> DataFrame:
    """``wanted(.., _p)`` with ``_g``: of the three-letter parts of ``_p`` (itself if shorter) the one with the fewest ``postings(_run, _g)``.

    Every run that holds the piece holds all its parts, so any of them finds it; ties go to the first in order. A piece with a
    part that no run holds is in no run and has no row.
    """
    frequency = postings.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    pieces = wanted.select("_p").distinct().select("_p", F.explode(F.when(F.length("_p") < 3, F.array("_p")).otherwise(F.array_distinct(_grams(F.col("_p"), 3)))).alias("_g"))
    best = pieces.join(frequency, "_g", "left").groupBy("_p").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_g").alias("g"))).alias("_b"))
    return wanted.join(best.filter("_b.n > 0").select("_p", F.col("_b.g").alias("_g")), "_p")


def runs_holding(runs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted(.., _p)`` with the runs of the dictionary ``runs(_run)`` that hold ``_p``; staged, part after part of many postings.

    Of the three-letter parts of a piece the one that the fewest runs hold meets the runs, and the few pairs that meet are checked.
    """
    shorter = [r[0] for r in wanted.select(F.least(F.length("_p"), F.lit(3))).distinct().collect() if r[0] < 3]
    parts = F.array_distinct(F.concat(*[_grams(F.col("_run"), n) for n in (*shorter, 3)]))
    postings = stage(rows_of(runs, ["_run"], parts, "_g"), "postings")
    rarest = stage(rarest_grams(wanted, postings), "rarest")
    n = passes(postings.count())
    turn = F.pmod(F.xxhash64("_g", F.lit("turn")), F.lit(n))
    held = stage_each((postings.filter(turn == i).join(rarest.filter(turn == i), "_g").filter(F.col("_run").contains(F.col("_p"))).drop("_g") for i in range(n)), "holding")
    discard(postings)
    discard(rarest)
    return held


def one_run(keyword: Column) -> Column:
    """Whether a keyword is a run of word characters and nothing else."""
    return F.lower(keyword).rlike(f"^[{WORD}]+\\z")


def substring_answers(runs: DataFrame, networks: Sequence[DataFrame]) -> DataFrame:
    """(_run, net, hits, inside): the keywords of each network that lie inside a run of the dictionary, of those that are a run themselves; staged.

    ``inside`` has the sufficient ones by name, in lower case.
    """
    wanted = None
    for net, keywords in enumerate(networks):
        known = F.col("is_sufficient") if "is_sufficient" in keywords.columns else F.lit(None).cast("boolean")
        one = keywords.filter(one_run(F.col("keyword"))).select(F.lit(net).alias("net"), text_blocks.hit(F.col("pos"), known).alias("hit"), F.lower("keyword").alias("_p"))
        wanted = one if wanted is None else wanted.unionByName(one)
    with passing():
        return stage(runs_holding(runs, wanted).groupBy("_run", "net").agg(
            F.collect_list("hit").cast(text_blocks.HITS).alias("hits"), F.collect_set(F.when(F.col("hit") % 4 == 2, F.col("_p"))).alias("inside")
        ), "substrings", keep=True)


def substring_hits(lists: DataFrame, networks: Sequence[DataFrame], key: Sequence[str], listed: bool = True) -> DataFrame:
    """(key, net, pos, n, yes, no): the keywords of each network inside the runs of each row of ``lists`` (``text_blocks.run_lists``), one row each."""
    with passing():
        asked = text_blocks.asked_runs(lists)
        answers = substring_answers(asked.select("_run").distinct(), networks)
        answers = answers.select("_run", "net", "hits", F.lit(None).cast("double").alias("idf"), F.lit(None).cast(text_blocks.PARTS).alias("parts"))
        told = text_blocks.told(lists, asked, answers, key, [0.0] * len(networks), listed=listed, keep=True)
    return told.filter("n > 0").select(*key, "net", "pos", "n", "yes", "no")


def match_substrings(
    texts: DataFrame, keywords: DataFrame, key: Sequence[str], lists: DataFrame | None = None
) -> DataFrame:
    """Keywords contained anywhere in the lower-cased text: (key, pos).

    A keyword of word characters lies inside one run of word characters, so it is
    looked for in the dictionary of distinct runs; texts then take the keywords of their runs, block by block.
    Of a keyword with other characters its longest run is looked for, and the text itself is checked.
    A keyword without a word character is looked for in the texts that hold its
    first character. ``lists`` takes counted runs (``text_blocks.run_lists``) that are at hand already.
    """
    lists = text_blocks.run_lists(texts, key) if lists is None else lists
    whole = substring_hits(lists, [keywords], key).select(*key, F.explode("pos").alias("pos"))
    return add_mixed(whole, texts, keywords, key, lists)


def add_mixed(whole: DataFrame, texts: DataFrame, keywords: DataFrame, key: Sequence[str], lists: DataFrame) -> DataFrame:
    """``whole`` and the matches of the keywords that are no run of word characters, if there are any."""
    rest = keywords.filter(~one_run(F.col("keyword")))
    return whole if rest.isEmpty() else whole.unionByName(mixed_substrings(texts, rest, key, lists))


def mixed_substrings(texts: DataFrame, keywords: DataFrame, key: Sequence[str], lists: DataFrame) -> DataFrame:
    """(key, pos) of keywords that hold other characters than those of words."""
    bare = keywords.withColumn("_kw", F.lower("keyword")).filter(F.size(word_runs(F.col("keyword"))) == 0)
    signs = rows_of(texts, key, F.array_distinct(F.split(F.regexp_replace(F.lower("text"), f"[{WORD}]+", ""), "")), "_c")
    odd = (
        bare.select("pos", "_kw", F.substring("_kw", 1, 1).alias("_c")).filter("_kw <> ''").join(signs, "_c")
        .join(texts.select(*key, F.lower("text").alias("_t")), list(key))
        .filter(F.col("_t").contains(F.col("_kw"))).select(*key, "pos")
    )
    pieces = word_runs(F.col("keyword"))
    longest = F.array_max(F.transform(pieces, lambda p: F.struct(F.length(p).alias("n"), p.alias("p"))))["p"]
    wanted = keywords.filter(F.size(pieces) > 0).select("pos", F.lower("keyword").alias("_kw"), longest.alias("_p"))
    runs = lists.select(*key, F.explode("terms").alias("_run"))
    met = runs.join(runs_holding(runs.select("_run").distinct(), wanted), "_run").select(*key, "pos", "_kw").distinct()
    partly = met.join(texts.select(*key, F.lower("text").alias("_t")), list(key)).filter(F.col("_t").contains(F.col("_kw"))).select(*key, "pos")
    return partly.unionByName(odd)


def match_sequences_ordered(texts: DataFrame, sequences: DataFrame, key: Sequence[str]) -> DataFrame:
    """Sequences whose words occur in order within one line, any gap: (key, pos).

    Words are word-character runs. Of each line only the words of sequences are
    kept, in order; walking them, every word that is the next one wanted moves the
    sequence on by one. Where members have several words, these must follow each
    other in the line: lines that hold all words are read again for the members.
    """
    sequences = _in_words(_lower(sequences))
    wanted = sequences.select(F.explode("sequence").alias("_w")).distinct()
    lines = rows_of(texts, key, F.split(F.col("text"), "\n"), "_line", "_text")
    held = stage(
        rows_of(lines, [*key, "_line"], word_runs(F.col("_text")), "_at", "_w")
        .join(wanted, "_w", "left_semi")
        .groupBy(*key, "_line")
        .agg(F.array_sort(F.collect_list(F.struct("_at", "_w"))).alias("_seen"))
        .select(*key, "_line", F.col("_seen._w").alias("_seen"), F.array_distinct("_seen._w").alias("_words")),
        "held-lines",
    )
    walk = F.aggregate(
        "_seen", F.lit(0), lambda i, w: F.when(F.get("sequence", i) == w, i + 1).otherwise(i)
    )
    met = _anchored(held, sequences, []).filter((F.size(F.array_except("sequence", "_words")) == 0) & (walk == F.size("sequence")))
    single = met.filter(F.size("_phrases") == 0).select(*key, "_poss")
    spaced = lines.select(*key, "_line", F.array_join(word_runs(F.col("_text")), "  ").alias("_t"))
    pattern = F.array_join(F.transform("_members", lambda m: F.concat(F.lit(" "), F.replace(m, F.lit(" "), F.lit("  ")), F.lit(" "))), ".*")
    several = (
        met.filter(F.size("_phrases") > 0).join(spaced, [*key, "_line"])
        .filter(F.rlike(F.concat(F.lit(" "), "_t", F.lit(" ")), pattern)).select(*key, "_poss")
    )
    return single.unionByName(several).select(*key, F.explode("_poss").alias("pos")).distinct()


def match_counts(keyword_hits: DataFrame, sequence_hits: DataFrame, keywords: DataFrame,
                 sequences: DataFrame, key: Sequence[str]) -> DataFrame:
    """Matches per text on four lists: keywords and sequences, sufficient and not."""
    hits = (
        keyword_hits.join(keywords.select("pos", "is_sufficient"), "pos")
        .select(*key, F.lit("k").alias("kind"), "is_sufficient")
        .unionByName(
            sequence_hits.join(sequences.select("pos", "is_sufficient"), "pos")
            .select(*key, F.lit("s").alias("kind"), "is_sufficient")
        )
    )
    yes = F.col("is_sufficient")
    return hits.groupBy(*key).agg(
        F.count_if((F.col("kind") == "k") & yes).alias("suff_keywords"),
        F.count_if((F.col("kind") == "k") & ~yes).alias("insuff_keywords"),
        F.count_if((F.col("kind") == "s") & yes).alias("suff_sequences"),
        F.count_if((F.col("kind") == "s") & ~yes).alias("insuff_sequences"),
    )


def other_hits(texts: DataFrame, networks: Sequence[tuple[DataFrame, DataFrame]], key: Sequence[str], lists: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """(key, pos) twice for each network: the keywords matched that are no run of word characters, and the sequences in order."""
    found = []
    for keywords, sequences in networks:
        in_order = match_sequences_ordered(texts, sequences, key)
        found.append((add_mixed(in_order.filter(F.lit(False)), texts, keywords, key, lists), in_order))
    return found


def network_counts(hits: DataFrame, texts: DataFrame, networks: Sequence[tuple[DataFrame, DataFrame]], key: Sequence[str], lists: DataFrame,
                   others: list[tuple[DataFrame, DataFrame]] | None = None) -> DataFrame:
    """(net, key, ..): ``match_counts`` of each text with matches and each network (keywords, sequences), ``hits`` having the keywords inside runs counted.

    ``others`` takes ``other_hits`` that are at hand already.
    """
    zero = F.lit(0).cast("long")
    names = ["suff_keywords", "insuff_keywords", "suff_sequences", "insuff_sequences"]
    found = hits.filter("n > 0").select("net", *key, F.col("yes").alias(names[0]), F.col("no").alias(names[1]), zero.alias(names[2]), zero.alias(names[3]))
    for net, (mixed, in_order) in enumerate(others or other_hits(texts, networks, key, lists)):
        found = found.unionByName(match_counts(mixed, in_order, *networks[net], key).withColumn("net", F.lit(net)))
    return found.groupBy("net", *key).agg(*[F.sum(c).alias(c) for c in names])


def check_sufficiency(
    rows: DataFrame, tokens: DataFrame, keywords: DataFrame, sequences: DataFrame, min_members: int = 3
) -> DataFrame:
    """Adds Is_Sufficient, Matched_Keywords, Matched_Sequences to ``rows(row_id, category, ..)``.

    A row suffices if a sufficient keyword has enough of itself and its nested
    keywords matched, or a sufficient sequence is matched. A category the network
    lacks leaves the defaults.
    """
    key, on = ["row_id"], ["category"]
    hits = match_keywords(tokens, keywords, key, on)
    seqs = match_sequences_all(tokens, sequences, key, on).join(sequences, [*on, "pos"])
    members = keywords.filter("is_sufficient").select(
        "category", F.col("pos").alias("owner"), F.explode(F.concat(F.array("keyword"), "nested")).alias("keyword")
    )
    enough = (
        hits.join(members, ["category", "keyword"])
        .groupBy("row_id", "owner")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_members)
    )
    facts = (
        hits.select("row_id", F.lit("k").alias("kind"), "pos", F.col("keyword").alias("label"), F.lit(False).alias("ok"))
        .unionByName(seqs.select(
            "row_id", F.lit("s").alias("kind"), "pos",
            F.array_join("sequence", ", ").alias("label"), F.col("is_sufficient").alias("ok")))
        .unionByName(enough.select(
            "row_id", F.lit("e").alias("kind"), F.col("owner").alias("pos"),
            F.lit("").alias("label"), F.lit(True).alias("ok")))
    )

    def listed(kind: str, glue: str):
        found = F.collect_list(F.when(F.col("kind") == kind, F.struct("pos", "label")))
        return F.array_join(F.transform(F.array_sort(found), lambda x: x["label"]), glue)

    summary = facts.groupBy("row_id").agg(
        F.bool_or("ok").alias("_ok"), listed("k", ", ").alias("_k"), listed("s", "; ").alias("_s")
    )
    return rows.join(summary, "row_id", "left").select(
        *rows.columns,
        F.coalesce("_ok", F.lit(False)).alias("Is_Sufficient"),
        F.coalesce("_k", F.lit("")).alias("Matched_Keywords"),
        F.coalesce("_s", F.lit("")).alias("Matched_Sequences"),
    )


def sufficiency_summary(checked: DataFrame) -> DataFrame:
    total, good = F.count(F.lit(1)), F.count_if(F.col("Is_Sufficient"))

    def percent(part):
        return F.round(F.coalesce(F.try_divide(part * F.lit(100.0), total), F.lit(0.0)), 6)

    return checked.agg(
        total.alias("total_rows"),
        good.alias("sufficient_count"),
        (total - good).alias("insufficient_count"),
        percent(good).alias("sufficient_percent"),
        percent(total - good).alias("insufficient_percent"),
    )
