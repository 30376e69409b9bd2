import random

import numpy as np
import pytest

from wordloom.llm import jaccard_join
from wordloom.llm.jaccard_join import BITMAP, Threshold, bitmap, components, jaccard_components, keep_one, wide_apart, wide_bitmap


def shingles(text, w):
    words = (text or "").lower().split()
    return {tuple(words[i : i + w]) for i in range(max(1, len(words) - w + 1))} if words else set()


def brute(rows, w, over, under):
    sets = [(i, shingles(t, w)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and len(a & b) * under >= over * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in root}, {i: {len(s) for j, s in sets if j == i} for i in root}


def near_copies(rng, n):
    """Texts of many sizes with groups of copies that differ by a few words."""
    rows = []
    while len(rows) < n:
        words = [rng.choice("abcdefghij") + rng.choice("klmnop") for _ in range(rng.choice([0, 1, 2, 4, 6, 9, 13, 21, 40, 90]))]
        for _ in range(rng.choice([1, 1, 2, 5])):
            own = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                if own:
                    own[rng.randrange(len(own))] = rng.choice("xyz")
            if own and rng.random() < 0.3:
                own.pop()
            rows.append((len(rows) * 2 + 5, " ".join(own)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,w,over,under,block", [(1, 3, 9, 10, 1024), (2, 5, 4, 5, 1024), (3, 2, 3, 5, 4)])
def test_components_against_all_pairs(spark, monkeypatch, seed, w, over, under, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = near_copies(random.Random(seed), 260)
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), w, over, under).collect()
    want, sizes = brute(rows, w, over, under)
    assert {r.doc_id: r.component_id for r in got} == want and len(got) == len(rows)
    assert all(r.n_shingles in sizes[r.doc_id] for r in got)
    full = {i: t for i, t in rows if t}
    assert len({want[i] for i in full}) < len(set(full.values()))


@pytest.mark.parametrize("small", [0, 3, 12, 30])
def test_any_boundary_gives_the_same(spark, monkeypatch, small):
    monkeypatch.setattr(jaccard_join, "small_limit", lambda *_: small)
    rows = near_copies(random.Random(8), 150)
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 2, 4, 5).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(rows, 2, 4, 5)[0]


def test_overlap_bounds():
    t = Threshold(9, 10)
    for n in range(1, 60):
        for m in range(1, 60):
            for k in range(min(n, m) + 1):
                if k * 10 >= 9 * (n + m - k):
                    assert k >= t.shared(n, m) and k >= t.least_of(n) and m >= t.least_of(n)


def test_wide_bitmaps_bound_the_difference_of_long_sets():
    rng = np.random.default_rng(4)
    assert wide_bitmap(np.arange(BITMAP)) is None
    pool = np.unique(rng.integers(0, 1 << 62, 30_000))
    for n, m, both in [(1100, 1030, 1000), (5000, 4600, 4550), (6000, 6000, 0), (9000, 4100, 2000), (2100, 2100, 2100)]:
        a, b = np.sort(pool[:n]), np.sort(pool[n - both : n - both + m])
        apart = n + m - 2 * both
        bound = wide_apart(wide_bitmap(a), wide_bitmap(b))
        assert bound <= apart and bound == wide_apart(wide_bitmap(b), wide_bitmap(a))
        short = int(np.bitwise_count(np.frombuffer(bitmap(a), np.uint8) ^ np.frombuffer(bitmap(b), np.uint8)).sum(dtype=int))
        assert bound >= short and (apart < 1000 or bound > apart / 4)


def test_long_texts_against_all_pairs(spark):
    rng = random.Random(6)
    base = [f"w{rng.randrange(10_000)}" for _ in range(5000)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:4700])), (3, " ".join(base[:2500] + [f"v{rng.randrange(10_000)}" for _ in range(2500)]))]
    rows += [(4, " ".join(base[300:])), (5, " ".join(base[:1050])), (6, " ".join(base[:1000]))]
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 9, 10).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(rows, 3, 9, 10)[0] == {1: 1, 2: 1, 3: 3, 4: 1, 5: 5, 6: 5}


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 200) if i % 50], "a long, b long")
    got = {r.id: r.component for r in components(edges).collect()}
    assert got == {i: (i - 1) // 50 * 50 + 1 for i in range(1, 201)}


def test_odd_rows(spark, odd_docs, no_docs):
    rows = jaccard_components(odd_docs, 3, 9, 10).collect()
    assert len(rows) == odd_docs.count()
    assert sorted((r.doc_id or 0, r.component_id) for r in rows if r.doc_id != 5) == [(0, None), (1, 1), (1, 1), (2, 2), (3, 3), (4, 4), (7, 7), (8, 8)]
    assert {r.n_shingles for r in rows if r.doc_id in (3, 4)} == {0} and {r.n_shingles for r in rows if r.doc_id == 7} == {3}
    kept = keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 1
    assert jaccard_components(no_docs).count() == 0 and keep_one(no_docs).count() == 0
    same = spark.createDataFrame([(4, "a b c", 1), (2, "A b  c", 2), (2, "x", 3), (9, "x", 4)], "doc_id long, text string, key int")
    assert {r.component_id for r in jaccard_components(same).collect()} == {2}
    assert [tuple(r) for r in keep_one(same).collect()] == [(2, "A b  c", 2)]
