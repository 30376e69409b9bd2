import math
import random
from collections import Counter

from pyspark.sql import functions as F

from wordloom.functions.lexicon import ENGLISH
from wordloom.functions.text import clean_tokens, clean_transcript, preview
from wordloom.operators import ranking, tfidf

STOP = set(ENGLISH)


def cleaned(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r[0] for r in df.orderBy("i").select(F.array_join(clean_tokens(F.col("t")), " ")).collect()]


def test_clean_tokens_literal_cases(spark):
    got = cleaned(spark, [None, "", "   ", "the and of", "e-mail can't gonna cannot", "été, l'eau_x", "a bcd\u0085efg", "It's NOT well-known"])
    assert got == ["", "", "", "", "email cant gon", "été leau_x", "bcd efg", "wellknown"]


def test_clean_transcript(spark):
    df = spark.createDataFrame([("00:01:02.500 12:34 um so, Hello  there, you know okay WORLD 1:2",), (None,)], "t string")
    assert [r[0] for r in df.select(clean_transcript(F.col("t"))).collect()] == ["hello know world 12", ""]


def test_preview(spark):
    row = spark.range(1).select(preview(F.lit("abcdef"), 3), preview(F.lit("abc"), 3)).first()
    assert tuple(row) == ("abc...", "abc")


def brute_tfidf(docs):
    n = len(docs)
    df = Counter(t for d in docs.values() for t in set(d))
    out = {}
    for i, d in docs.items():
        x = {t: c * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in Counter(d).items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        out.update({(i, t): v / norm for t, v in x.items()})
    return out


def random_docs(seed, n=20):
    rnd = random.Random(seed)
    return {i: [rnd.choice("alpha beta gamma delta eps zeta eta theta".split()) for _ in range(rnd.randint(1, 12))] for i in range(n)}


def test_tfidf_matches_definition_with_and_without_cap(spark):
    docs = random_docs(1)
    tokens = spark.createDataFrame([("c", i, d) for i, d in docs.items()], "category string, doc_id bigint, tokens array<string>")
    stats = tfidf.term_statistics(tokens)
    got = {(r.doc_id, r.term): r.w for r in tfidf.tfidf(tokens, stats).collect()}
    want = brute_tfidf(docs)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)

    total = Counter(t for d in docs.values() for t in d)
    kept = {t for t, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:3]}
    capped = {(r.doc_id, r.term): r.w for r in tfidf.tfidf(tokens, stats, tfidf.top_terms(stats, 3)).collect()}
    # Documents left without terms still count, so the frequencies are those of the whole set.
    n, df = len(docs), Counter(t for d in docs.values() for t in set(d))
    for i, d in docs.items():
        x = {t: c * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in Counter(t for t in d if t in kept).items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        for t, v in x.items():
            assert abs(capped.pop((i, t)) - v / norm) < 1e-12
    assert not capped


def test_rank_breaks_ties_by_term(spark):
    rows = [("c", t, s) for t, s in [("b", 1.0), ("a", 1.0), ("z", 2.0), ("y", 0.1)]] + [("d", "q", 5.0)]
    scores = spark.createDataFrame(rows, "category string, term string, score double")
    want = {("c", "z"): 1, ("c", "a"): 2, ("c", "b"): 3, ("c", "y"): 4, ("d", "q"): 1}
    for ranked in (tfidf.rank_terms(scores), tfidf.rank_short_list(scores)):
        assert {(r.category, r.term): r["rank"] for r in ranked.collect()} == want


def test_filter_keywords(spark):
    scores = spark.createDataFrame([("c", "ok1", 0.2), ("c", "low", 0.19), ("c", "été", 3.0), ("c", "a_b", 3.0)], "category string, term string, score double")
    assert [r.term for r in tfidf.filter_keywords(scores).collect()] == ["ok1"]


def test_number_rows_with_one_hot_group(spark):
    rnd = random.Random(3)
    rows = [("hot" if i % 3 else f"g{i % 7}", rnd.random(), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v double, i int").repartition(7)
    got = {r.i: r.n for r in ranking.number_rows(df, ["g"], [F.asc("v"), F.asc("i")], "n").collect()}
    groups = {}
    for g, v, i in sorted(rows):
        groups.setdefault(g, []).append(i)
    assert got == {i: n for members in groups.values() for n, i in enumerate(members, 1)}


def test_weights_take_no_row_per_document_and_term_through_a_shuffle(spark, monkeypatch):
    """Repeated and null ids are one document; entries stay with their block, words are asked for once per block."""
    rows = [(1, ["cat", "dog", "cat"]), (1, ["cat", "owl"]), (None, ["owl", "elk"]), (None, ["elk"]), (2, ["dog"]), (3, [])]
    tokens = spark.createDataFrame([("c", d, t) for d, t in rows], "category string, doc_id bigint, tokens array<string>")
    documents = tfidf.document_terms(tokens)
    statistics = tfidf.statistics_of(documents)
    assert {r.term: (r.total, r.df) for r in statistics.collect()} == {
        None: (0, 6), "cat": (3, 2), "dog": (2, 2), "owl": (2, 2), "elk": (2, 2)
    }
    weights = tfidf.weights_of(documents, statistics)
    assert {(r.doc_id, r.term): (r.tf, r.n_terms) for r in weights.collect()} == {
        (1, "cat"): (3, 3), (1, "dog"): (1, 3), (1, "owl"): (1, 3), (None, "owl"): (1, 2), (None, "elk"): (2, 2), (2, "dog"): (1, 1)
    }
    listed = tfidf.weights_of(documents, statistics, statistics.filter("term IS NOT NULL"))
    assert {(r.doc_id, r.term, round(r.w, 12)) for r in weights.collect()} == {(r.doc_id, r.term, round(r.w, 12)) for r in listed.collect()}
    plan = weights._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and not [x for x in plan.split("hashpartitioning(")[1:] if "doc_id" in x.split(")")[0]]


def test_staged_weights_are_the_weights_without_their_room(spark, monkeypatch):
    """In parts by blocks, bit for bit the same; on disk lie the factors, which repeat."""
    from wordloom import session

    monkeypatch.setattr(session, "ROWS_PER_PASS", 2)
    rows = [(1, ["cat", "dog", "cat"]), (1, ["cat", "owl"]), (None, ["owl", "elk"]), (None, ["elk"]), (2, ["dog"]), (3, []), (4, ["elk", "dog", "owl", "owl"])]
    tokens = spark.createDataFrame([(c, d, t) for c in "ce" for d, t in rows], "category string, doc_id bigint, tokens array<string>")
    documents = session.stage(tfidf.document_terms(tokens), "documents")
    statistics = tfidf.statistics_of(documents)
    staged = tfidf.staged_weights(documents, statistics)
    assert staged.columns == tfidf.weights_of(documents, statistics).columns
    assert sorted(map(repr, staged.collect())) == sorted(map(repr, tfidf.weights_of(documents, statistics).collect()))
    assert {"idf", "norm"} <= set(spark.read.parquet(staged.inputFiles()[0]).columns)
