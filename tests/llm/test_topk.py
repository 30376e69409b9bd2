import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.llm import topk
from wordloom.llm.topk import exact_top_k


def brute(rows, is_query, k):
    whole = []
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            whole.append((i, [math.floor(256 * x) for x in v]))
    queries = {}
    for i, v in whole:
        if is_query(i):
            queries[i] = min(queries.get(i, (len(v), v)), (len(v), v))
    out = []
    for q, (_, v) in queries.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q and len(w) == len(v))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("seed,segment,chunk", [(1, 10_000, 4096), (2, 40, 3), (3, 25, 100)])
def test_against_all_products(spark, seed, segment, chunk):
    rng = random.Random(seed)
    rows = [(i, [round(rng.gauss(0, 0.2), 3) for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(60)]
    rows += [(2000, None), (2002, []), (2004, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2006, [math.nan] * 6), (2008, [math.inf] + [0.0] * 5), (None, [1.0] * 6), (3000, [0.5, 0.5]), (3002, [0.25, 1.0]), (10, [0.0] * 6), (3000, [0.5, 0.5])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, id int, V string")
    got = sorted(map(tuple, exact_top_k(df, F.col("id") % 20 == 0, 5, segment=segment, chunk=chunk).collect()))
    exact = [(i, v and [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert got == brute(exact, lambda i: i % 20 == 0, 5)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert exact_top_k(df, F.col("id") % 20 == 0).count() == 0


def test_blocks_below_the_threshold_are_not_scored(monkeypatch):

    values = np.zeros((640, 4), np.int64)
    values[:, 0] = np.arange(640)
    monkeypatch.setattr(topk, "by_likeness", lambda ids, v: (ids, v))
    at, ids, scores = topk.search_segment(np.array([-1]), np.array([[2, 0, 0, 0]]), np.array([-(1 << 62)]), np.arange(640), values, 3)
    assert ids.tolist() == [639, 638, 637] and scores.tolist() == [1278, 1276, 1274]
