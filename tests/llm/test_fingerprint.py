import hashlib
import random

import pytest
from pyspark.sql import functions as F

from wordloom.llm.fingerprint import containment, distinct_shingles, fingerprints, merge, resemblance, sketch


def shingles(text, w=5):
    words = text.lower().split()
    return {tuple(words[i : i + w]) for i in range(max(1, len(words) - w + 1))} if words else set()


def sketches(spark, texts, k=64):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").withColumn("s", sketch(F.col("text"), k))


def test_small_sets_are_exact(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(30))) for _ in range(12)]
    df = sketches(spark, texts)
    pairs = df.alias("a").join(df.alias("b"), F.col("a.i") <= F.col("b.i")).select(
        "a.i", F.col("b.i").alias("j"), resemblance(F.col("a.s"), F.col("b.s")).alias("r"), containment(F.col("a.s"), F.col("b.s")).alias("c"),
        distinct_shingles(F.col("a.s")).alias("n"), F.size(merge(F.col("a.s"), F.col("b.s"))).alias("m"),
    )
    for x in pairs.collect():
        a, b = shingles(texts[x.i]), shingles(texts[x.j])
        assert x.n == len(a) and x.m == len(a | b)
        assert x.r == pytest.approx(len(a & b) / len(a | b) if a | b else 1)
        assert x.c == pytest.approx(len(a & b) / len(a) if a else 1)


def test_large_sets_are_estimated(spark):
    rng = random.Random(5)
    words = [str(rng.randrange(10**9)) for _ in range(6000)]
    a, b = " ".join(words[:4000]), " ".join(words[2000:])
    x = sketches(spark, [a, b], 256).agg(F.max(F.when(F.col("i") == 0, F.col("s"))).alias("a"), F.max(F.when(F.col("i") == 1, F.col("s"))).alias("b")).select(
        resemblance(F.col("a"), F.col("b"), 256).alias("r"), containment(F.col("a"), F.col("b"), 256).alias("c"), distinct_shingles(F.col("a"), 256).alias("n")
    ).first()
    assert abs(x.r - 1 / 3) < 0.1 and abs(x.c - 1 / 2) < 0.15 and abs(x.n / 4000 - 1) < 0.25


def test_edited_texts(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["alpha", "béta", "\U0001f600", "d"]) for _ in range(rng.randrange(40))) for _ in range(30)]
    rows = [(i * 3 + (i > 15) * 1000, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    for n, (i, t) in enumerate(rows):
        following = rows[(n + 1) % len(rows)]
        half = len(t) // 2
        edited = t[: len(t) - half] + following[1][:half]
        r = got[i]
        assert (r.n_chars, r.next_doc_id) == (len(t), following[0])
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for other, near in ((edited, r.near_edited), (following[1], r.near_next)):
            a, b = shingles(t), shingles(other)
            assert near == pytest.approx(len(a & b) / len(a | b) if a | b else 1)
        assert (r.fingerprint == r.edited_fingerprint) == (shingles(t) == shingles(edited))


def test_odd_rows(odd_docs, no_docs):
    rows = fingerprints(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, []).append(r)
    assert len(of[1]) == 2 and of[1][0] == of[1][1] and of[1][0].next_doc_id == 2
    assert of[3][0].fingerprint == "" == of[5][0].fingerprint[:0] and of[3][0].near_next == 1.0
    assert of[None][0].next_doc_id == 1 and of[8][0].next_doc_id is None
    assert fingerprints(no_docs).count() == 0
    one = odd_docs.filter("doc_id = 2")
    assert fingerprints(one).first().near_next == 1.0


def test_no_python_in_the_plan(odd_docs):
    plan = fingerprints(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
