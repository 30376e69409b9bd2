import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wordloom.functions.text import clean_tokens
from wordloom.operators import matching, scoring, text_blocks

KW = "category string, pos bigint, keyword string, nested array<string>, is_sufficient boolean"
SEQ = "category string, pos bigint, sequence array<string>, is_sufficient boolean"
KEYWORDS = [
    ("automatable", 0, "server", ["disk", "reset"], True),
    ("automatable", 1, "disk", ["server"], False),
    ("automatable", 2, "reset", [], False),
    ("automatable", 3, "printer", ["server", "unknown"], True),
]
SEQUENCES = [
    ("automatable", 0, ["reset", "printer"], True),
    ("automatable", 1, ["disk", "server"], False),
    ("automatable", 2, ["reset", "printer"], False),
]
TEXTS = {
    1: "Server disk reset now", 2: "servers and disks", 3: "printer then\nreset", 4: "reset the printer!", 5: "   ", 6: None,
    7: "disk or server, été serverx", 8: "nothing here", 9: "reset reset printer printer disk",
}


@pytest.fixture(scope="module")
def net(spark):
    return spark.createDataFrame(KEYWORDS, KW), spark.createDataFrame(SEQUENCES, SEQ)


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(TEXTS.items()), "row_id bigint, text string")


def brute_check(tokens, keywords, sequences):
    if not tokens:
        return False, "", ""
    hit = [k for _, _, k, _, _ in keywords if k in tokens]
    seqs = [(s, ok) for _, _, s, ok in sequences if all(w in tokens for w in s)]
    good = any(ok and sum(w in hit for w in [k, *nested]) >= 3 for _, _, k, nested, ok in keywords) or any(ok for _, ok in seqs)
    return good, ", ".join(hit), "; ".join(", ".join(s) for s, _ in seqs)


def test_check_sufficiency(spark, net, texts):
    rows = texts.withColumn("category", F.when(F.col("row_id") == 8, "absent").otherwise("automatable"))
    tokens = rows.select("row_id", "category", clean_tokens(F.col("text")).alias("tokens")).cache()
    got = {r.row_id: (r.Is_Sufficient, r.Matched_Keywords, r.Matched_Sequences)
           for r in matching.check_sufficiency(rows, tokens, *net).collect()}
    words = {r.row_id: r.tokens for r in tokens.collect()}
    for i in TEXTS:
        assert got[i] == ((False, "", "") if i == 8 else brute_check(words[i], KEYWORDS, SEQUENCES))
    assert got[1][0] and got[3][0] and not got[2][0]
    summary = matching.sufficiency_summary(matching.check_sufficiency(rows, tokens, *net)).first()
    assert (summary.total_rows, summary.sufficient_count) == (9, sum(v[0] for v in got.values()))
    empty = matching.sufficiency_summary(matching.check_sufficiency(rows, tokens, *net).limit(0)).first()
    assert (empty.total_rows, empty.sufficient_percent) == (0, 0.0)


def test_keywords_of_several_words(spark):
    tokens = spark.createDataFrame([(1, "disk server reset".split()), (2, "server disk".split())], "row_id bigint, tokens array<string>")
    kws = spark.createDataFrame([("c", 0, "disk server", [], True), ("c", 1, "disk", [], True)], KW)
    got = {(r.row_id, r.pos) for r in matching.match_keywords(tokens, kws, ["row_id"]).collect()}
    assert got == {(1, 0), (1, 1), (2, 1)}


def test_substrings_as_in_python(spark):
    rnd = random.Random(5)
    words = ["ab", "abc", "a-b", "über", "Server_1", "x", "disk full", "bcd", "c d", "abab"]
    texts = {i: "".join(rnd.choice("ab cd-über\nSERVER_1 disk full xy") for _ in range(rnd.randint(0, 40))) for i in range(60)}
    texts[60], texts[61] = "Disk full on SERVER_1", None
    df = spark.createDataFrame(list(texts.items()), "row_id bigint, text string")
    kws = spark.createDataFrame([("c", i, w, [], True) for i, w in enumerate(words)], KW)
    got = sorted((r.row_id, r.pos) for r in matching.match_substrings(df, kws, ["row_id"]).collect())
    want = sorted((i, p) for i, t in texts.items() if t for p, w in enumerate(words) if w.lower() in t.lower())
    assert got == want


def test_ordered_sequences_as_in_python(spark):
    rnd = random.Random(6)
    vocabulary = ["aa", "bb", "cc", "dd", "\n", "aabb", "bb,", "(cc)"]
    texts = {i: " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 12))) for i in range(80)}
    sequences = [["aa", "bb"], ["bb", "aa", "bb"], ["cc"], ["aa", "aa"], ["dd", "cc", "bb", "aa"]]
    df = spark.createDataFrame(list(texts.items()), "row_id bigint, text string")
    seqs = spark.createDataFrame([("c", i, s, True) for i, s in enumerate(sequences)], SEQ)
    got = sorted((r.row_id, r.pos) for r in matching.match_sequences_ordered(df, seqs, ["row_id"]).collect())
    want = sorted((i, p) for i, t in texts.items() for p, s in enumerate(sequences)
                  if re.search(r"\b" + r"\b.*\b".join(s) + r"\b", t))
    assert got == want


def brute_score(text, keywords, sequences, enhance, failing):
    """Fits TF-IDF over all patterns and the text, as the definition says."""
    text = text or ""
    low = text.lower()
    seq_hit = lambda s: re.search(r"\b" + r"\b.*\b".join(s) + r"\b", low)
    docs = {True: [k for *_, k, _, ok in keywords if ok] + [" ".join(s) for *_, s, ok in sequences if ok],
            False: [k for *_, k, _, ok in keywords if not ok] + [" ".join(s) for *_, s, ok in sequences if not ok]}
    hits = {ok: sum(k in low for *_, k, _, o in keywords if o == ok) + sum(bool(seq_hit(s)) for *_, s, o in sequences if o == ok)
            for ok in (True, False)}
    if not text.strip():
        return failing, 0.0
    if enhance:
        text = " ".join([text] + [k for *_, k, _, ok in keywords if ok and k in low] + [" ".join(s) for *_, s, ok in sequences if ok and seq_hit(s)])
    from wordloom.functions.lexicon import ENGLISH
    split = lambda t: [w for w in re.findall(r"\b\w\w+\b", t.lower()) if w not in ENGLISH]
    rows = [split(t) for t in docs[True] + docs[False] + [text]]
    n, df = len(rows), Counter(t for r in rows for t in set(r))

    def vector(r):
        x = {t: c * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in Counter(r).items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        return {t: v / norm for t, v in x.items()} if norm else {}

    vs = [vector(r) for r in rows]
    sims = [sum(v * vs[-1].get(t, 0) for t, v in p.items()) for p in vs[:-1]]
    cut = len(docs[True])
    mean = lambda x: sum(x) / len(x) if x else 0
    yes, no = mean(sims[:cut]), mean(sims[cut:])
    final = min((yes - no if no > 0 else yes) + min(0.1 * hits[True], 0.5), 1)
    good = final > 0.5 or (hits[True] > hits[False] and final > 0)
    return ("sufficient" if good else failing), round(final * 100, 2)


@pytest.mark.parametrize("enhance,failing", [(False, "not sufficient"), (True, "insufficient")])
def test_scores_match_a_refit_per_text(spark, net, texts, enhance, failing):
    got = {r.row_id: (r.label, r.percentage) for r in scoring.score_descriptions(texts, *net, ["row_id"], enhance, failing).collect()}
    for i, t in TEXTS.items():
        label, percentage = brute_score(t, KEYWORDS, SEQUENCES, enhance, failing)
        assert got[i][0] == label and abs(got[i][1] - percentage) < 0.0101, (i, got[i], percentage)


def test_no_patterns_is_not_sufficient(spark, net, texts):
    empty = [df.limit(0) for df in net]
    rows = scoring.score_descriptions(texts, *empty, ["row_id"]).collect()
    assert len(rows) == 9 and {(r.label, r.percentage) for r in rows} == {("not sufficient", 0.0)}


def test_members_of_several_words(spark):
    seqs = spark.createDataFrame([(0, ["Disk Full", "server"], True), (1, ["full disk", "server"], True), (2, ["server"], True)], "pos bigint, sequence array<string>, is_sufficient boolean")
    texts = spark.createDataFrame([(1, "the disk full on server"), (2, "server disk\nfull disk full"), (3, "disk and full server")], "row_id bigint, text string")
    tokens = texts.select("row_id", F.split("text", "\\s").alias("tokens"))
    got = sorted(map(tuple, matching.match_sequences_all(tokens, seqs, ["row_id"]).collect()))
    assert got == [(1, 0), (1, 2), (2, 0), (2, 1), (2, 2), (3, 2)]
    got = sorted(map(tuple, matching.match_sequences_ordered(texts, seqs, ["row_id"]).collect()))
    assert got == [(1, 0), (1, 2), (2, 2), (3, 2)]


def test_keywords_without_a_word_character(spark):
    words = spark.createDataFrame([(0, "++"), (1, "c++"), (2, "server"), (3, "é!")], "pos bigint, keyword string")
    texts = spark.createDataFrame([(1, "C++ server"), (2, "a+b"), (3, None), (4, "É! +++")], "row_id bigint, text string")
    assert sorted(map(tuple, matching.match_substrings(texts, words, ["row_id"]).collect())) == [(1, 0), (1, 1), (1, 2), (4, 0), (4, 3)]


def test_substrings_are_looked_up_by_their_rarest_part(spark):
    runs = ["common%02d" % i for i in range(30)] + ["commonxyz", "xyzzy", "ab"]
    postings = spark.createDataFrame([(r, r[i : i + 3]) for r in runs for i in range(max(len(r) - 2, 1))], "_run string, _g string").distinct()
    wanted = spark.createDataFrame([("commonxyz",), ("common",), ("ab",), ("commonqqq",)], "_p string")
    met = postings.join(matching.rarest_grams(wanted, postings), "_g")
    assert {r._p: r["count"] for r in met.groupBy("_p").count().collect()} == {"commonxyz": 1, "common": 31, "ab": 1}


def test_networks_are_scored_in_one_pass(spark):
    """Both networks at once and over several blocks give what each gives alone; a repeated key is one text, a null key meets nothing."""
    rows = [(i, TEXTS[1 + i % len(TEXTS)]) for i in range(200)] + [(3, "printer reset"), (None, "server disk"), (None, "disk")]
    texts = spark.createDataFrame(rows, "row_id bigint, text string").repartition(5)
    words = spark.createDataFrame(KEYWORDS, KW), spark.createDataFrame([("o", 0, "set", [], True), ("o", 1, "reset printer", [], False)], KW)
    lists = spark.createDataFrame(SEQUENCES, SEQ), spark.createDataFrame([("o", 0, ["disk", "server"], True)], SEQ)
    networks = list(zip(words, lists))
    found = scoring.score_networks(texts, networks, ["row_id"])
    assert found.count() == 2 * len(rows)
    got = {(r.net, r.row_id, r.percentage) for r in found.collect() if r.row_id not in (3, None)}
    for net, (k, s) in enumerate(([KEYWORDS, SEQUENCES], [[("o", 0, "set", [], True), ("o", 1, "reset printer", [], False)], [("o", 0, ["disk", "server"], True)]])):
        told = {t: brute_score(t, k, s, False, "not sufficient")[1] for t in set(TEXTS.values())}
        assert {(i, p) for n, i, p in got if n == net} == {(i, told[t]) for i, t in rows[:200] if i != 3}
    assert {r.suff_matches + r.insuff_matches for r in found.filter("row_id IS NULL").collect()} == {0}


def test_rows_that_hold_keywords_are_not_shuffled_by_keyword(spark):
    """One row per text and network comes out of the blocks, however many keywords it holds; no join goes by text and keyword."""
    texts = spark.createDataFrame([(i, "abc abcd xabc") for i in range(50)], "row_id bigint, text string")
    words = spark.createDataFrame([(p, w, p % 2 == 0) for p, w in enumerate(["a", "ab", "abc", "bc", "bcd", "x"])], "pos bigint, keyword string, is_sufficient boolean")
    hits = matching.substring_hits(text_blocks.run_lists(texts, ["row_id"]), [words], ["row_id"])
    assert [(r.n, r.yes, r.no, sorted(r.pos)) for r in hits.collect()] == [(6, 3, 3, [0, 1, 2, 3, 4, 5])] * 50
    assert hits._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") <= 1


def test_enhanced_scores_as_term_by_term(spark):
    """Blocks of texts give what appending every matched sufficient pattern and refitting gives; two networks at once."""
    key = ["row_id", "field"]
    texts = spark.createDataFrame([
        (1, "a", "concatenate the cats and a dog\nalpha beta gamma"), (1, "b", "beta alpha"), (2, "a", None), (2, "b", "  \n"), (3, "a", "cat-dog at x-ray, x-ray"),
        (4, "a", "nothing known here"), (5, "a", "gamma dogma alpha\nbeta; hot dog stand"), (6, "a", "the"), (7, "a", "CAT cat Cat"), (7, "a", "more of alpha, beta and gamma"),
    ], "row_id bigint, field string, text string")
    words = "pos bigint, keyword string, nested array<string>, is_sufficient boolean"
    lists = "pos bigint, sequence array<string>, is_sufficient boolean"
    first = (
        spark.createDataFrame([(0, "cat", [], True), (1, "at", [], True), (2, "dog", [], False), (3, "x-ray", [], True), (4, "alpha", [], None), (5, "Cat", [], True), (6, "the", [], True), (7, "zebra", [], True)], words),
        spark.createDataFrame([(0, ["alpha", "beta"], True), (1, ["beta", "gamma"], False), (2, ["alpha", "beta", "gamma"], True), (3, ["hot dog", "stand"], True)], lists),
    )
    second = spark.createDataFrame([(0, "dogma", [], True), (1, "gamma", [], True), (2, "nothing", [], False)], words), spark.createDataFrame([], lists)
    got = scoring.score_networks(texts, [first, second], key, "insufficient", enhance=True)
    for net, (keywords, sequences) in enumerate((first, second)):
        patterns = scoring.patterns_of(keywords, sequences)
        held, in_order = matching.match_substrings(texts, keywords, key), matching.match_sequences_ordered(texts, sequences, key)
        terms = scoring.enhanced_terms(scoring.text_terms(texts, key), patterns, held, in_order, key).localCheckpoint()
        matched = matching.match_counts(held, in_order, keywords, sequences, key)
        want = texts.join(matched, key, "left").join(scoring.mean_similarity(terms, patterns, key), key, "left")
        want = want.select(*key, *scoring._scores(scoring.is_blank(F.col("text")), "insufficient"))
        rows = sorted(tuple(r) for r in got.filter(F.col("net") == net).drop("net").collect())
        assert rows == sorted(tuple(r) for r in want.collect()) and len({r[-1] for r in rows}) > 3
        one = scoring.score_descriptions(texts, keywords, sequences, key, enhance=True, failing_label="insufficient")
        assert rows == sorted(tuple(r) for r in one.collect())
