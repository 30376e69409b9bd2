import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.llm.quality import N_STATS, Fourier, describe_texts, keep_good, pool_adjacent, quality_scores, solve, statistics

SF = "/root/testdata/sf0.01"


def test_pool_adjacent_is_the_isotonic_fit():
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 60).astype(float)
    x, n = np.arange(60.0), rng.integers(1, 5, 60).astype(float)
    centres, values = pool_adjacent(x, y, n)
    fitted = np.array([max(min((y[a : b + 1] * n[a : b + 1]).sum() / n[a : b + 1].sum() for b in range(i, 60)) for a in range(i + 1)) for i in range(60)])
    assert (np.diff(values) > 0).all()
    assert sorted(set(np.round(fitted, 12))) == sorted(set(np.round(values, 12)))


def test_summed_normal_equations_are_ridge(spark):
    rng = np.random.default_rng(4)
    stats, y = rng.normal(size=(90, N_STATS)), rng.integers(0, 2, 90).astype(float)
    fourier = Fourier(stats.mean(axis=0), stats.std(axis=0), features=40)
    df = spark.createDataFrame([(s.tolist(), float(v)) for s, v in zip(stats, y)], "stats array<double>, y double").repartition(5)
    z = fourier(stats)
    assert np.allclose(solve(df, fourier, 0.3), np.linalg.solve(z.T @ z + 0.3 * np.eye(41), z.T @ y))


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(30, N_STATS))
    fourier = Fourier(np.zeros(N_STATS), np.ones(N_STATS), features=20000, width=4.0)
    z = fourier(x)[:, 1:]
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / 32)
    assert np.abs(z @ z.T - want).max() < 0.05


def test_statistics_of_empty_text():
    rows = statistics([b"", b"A b!", b""])
    assert not rows[0].any() and not rows[2].any() and rows[1].any()


def test_held_out_quality(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    told = quality_scores(docs, labels).join(labels, "doc_id").filter("held_out")
    right = told.filter("predicted = quality").count()
    assert right >= 0.95 * told.count() > 0
    good = told.filter("quality = 1")
    assert good.filter("predicted = 1").count() == good.count()


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, None), (2, 0, 1), (None, 1, 1), (7, None, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality_scores(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4)}) == 1
    kept = keep_good(odd_docs, labels)
    assert kept.columns == odd_docs.columns
    none = labels.limit(0)
    assert {r.score for r in quality_scores(odd_docs, none).collect()} == {0.5}
    assert quality_scores(no_docs, labels).count() == 0
    assert describe_texts(no_docs).agg(F.count("stats")).first()[0] == 0


@pytest.mark.parametrize("value", [0, 1])
def test_one_class_only(spark, odd_docs, value):
    labels = spark.createDataFrame([(1, value), (2, value)], "doc_id long, quality int")
    assert all(abs(r.score - value) < 0.2 for r in quality_scores(odd_docs, labels).collect() if r.doc_id in (1, 2))
