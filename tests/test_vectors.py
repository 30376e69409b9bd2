import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.operators import vectors
from wordloom.streaming import ingest

VEC = "vec_id bigint, text string, embedding array<float>"
ASK = "query_id bigint, embedding array<float>, reference string"


def sample(spark, n=30, d=4, seed=0):
    rnd = np.random.default_rng(seed)
    v = rnd.integers(0, 3, size=(n, d)).astype(float)  # many equal distances
    texts = ["Alpha report" if i % 4 == 0 else "beta note" for i in range(n)]
    return v, texts, spark.createDataFrame([(i, texts[i], v[i].tolist()) for i in range(n)], VEC)


@pytest.mark.parametrize("block", [1000, 4])
@pytest.mark.parametrize("by_reference", [False, True])
def test_knn_against_brute_force(spark, monkeypatch, block, by_reference):
    monkeypatch.setattr(vectors, "ROWS_PER_TASK", 11)
    v, texts, store = sample(spark)
    q = np.random.default_rng(9).integers(0, 3, size=(9, 4)).astype(float)
    words = ["ALPHA", "beta", "gamma"] * 3
    asked = spark.createDataFrame([(i, q[i].tolist(), words[i]) for i in range(9)], ASK)
    got = vectors.knn(asked, store, 5, by_reference=by_reference, query_block=block).collect()
    for i in range(9):
        def key(j):
            miss = not (by_reference and words[i].lower() in texts[j].lower())
            return miss, ((q[i] - v[j]) ** 2).sum(), j
        want = sorted(range(30), key=key)[:5]
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == i), key=lambda r: r["rank"])] == want


def test_knn_small_store_wrong_dimension_no_queries(spark):
    _, _, store = sample(spark, n=3)
    asked = spark.createDataFrame([(1, [0.0] * 4, ""), (2, [0.0] * 3, "")], ASK)
    assert {r.query_id: 1 for r in vectors.knn(asked, store, 5, dim=4).collect()} == {1: 1}
    assert vectors.knn(asked, store, 5, dim=4).count() == 3
    assert vectors.knn(asked, store, 5, dim=7).count() == 0


def test_retrieval_records(spark):
    queries = spark.createDataFrame([(1, "what"), (2, "  "), (3, "none")], "query_id bigint, query string")
    hits = spark.createDataFrame([(1, 2, "b"), (1, 1, "a")], "query_id bigint, rank bigint, text string")
    got = {r.query_id: tuple(r)[1:] for r in vectors.retrieval_records(queries, hits).collect()}
    assert got[1] == ("- a\n- b", 2, None)
    assert got[2] == ("", 0, "User query is empty or missing")
    assert got[3] == (vectors.NOTHING_FOUND, 0, None)
    prompts = {r.query_id: r.prompt for r in vectors.query_prompts(queries, hits).collect()}
    assert prompts[1].endswith('["a","b"]') and prompts[3].endswith("[]")


def test_embed_gates(spark):
    rows = spark.createDataFrame([("ok", None), ("", None), (None, None), ("An eRRor", None), ("ok", "bad"), ("ok", "")], "content string, error_message string")
    got = [(r.by_text, r.by_metrics) for r in vectors.embed_gate(rows).collect()]
    assert got == [(True, True), (False, False), (False, False), (False, True), (True, False), (True, True)]


def test_hash_embed(spark):
    tokens = spark.createDataFrame([(1, ["aa", "bb", "aa"]), (2, [])], "doc_id bigint, tokens array<string>")
    rows = vectors.hash_embed(tokens, "doc_id", 10).collect()
    want = np.zeros(10)
    for t in ["aa", "bb", "aa"]:
        want[int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % 10] += 1
    assert len(rows) == 1 and np.allclose(rows[0].embedding, want / np.linalg.norm(want), atol=1e-6)


def stamped(df):
    return df.withColumns({"ingested_at": F.current_timestamp(), "content_hash": F.md5("text")})


def test_store_appends_and_starts_anew_on_another_dimension(spark, tmp_path):
    path = str(tmp_path / "store")
    assert vectors.read_store(spark, path) is None
    _, _, first = sample(spark, n=3)
    _, _, wide = sample(spark, n=2, d=6)
    assert vectors.append_vectors(stamped(first), path, 4) == 1
    assert vectors.append_vectors(stamped(first), path, 4) == 1
    assert vectors.read_store(spark, path).count() == 6
    assert vectors.append_vectors(stamped(wide), path, 6) == 2
    assert {len(r.embedding) for r in vectors.read_store(spark, path).collect()} == {6}


def test_stream_equals_batch_and_repeats_add_nothing(spark, tmp_path):
    folder, store, marks = (str(tmp_path / p) for p in ("in", "store", "marks"))
    docs = [(i, f"text number{i % 4} about server{i % 3}") for i in range(12)] + [(20, "um so the"), (21, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    df.filter("doc_id < 8").coalesce(1).write.mode("append").parquet(folder)
    ingest.watch(spark, folder, store, marks, 16).awaitTermination()
    df.filter("doc_id >= 6").coalesce(1).write.mode("append").parquet(folder)
    ingest.watch(spark, folder, store, marks, 16).awaitTermination()
    ingest.ingest(df, store, 16)
    want = {(r.vec_id, r.text): r.embedding for r in ingest.new_vectors(df, None, 16).collect()}
    got = vectors.read_store(spark, store).collect()
    assert len(got) == len(want) == 12 and {(r.vec_id, r.text): r.embedding for r in got} == want


def test_each_document_keeps_its_own_vector(spark):
    batch = spark.createDataFrame([(1, "alpha server"), (1, "printer reset"), (2, "alpha server"), (2, "alpha server")], "doc_id bigint, text string")
    rows = {(r.vec_id, r.text): r.embedding for r in ingest.new_vectors(batch, None, 16).collect()}
    alone = {t: ingest.new_vectors(batch.filter(F.col("text") == t).limit(1), None, 16).first().embedding for t in ("alpha server", "printer reset")}
    assert rows == {(1, "alpha server"): alone["alpha server"], (1, "printer reset"): alone["printer reset"], (2, "alpha server"): alone["alpha server"]}


def test_vectors_of_another_length_are_refused(spark, tmp_path):
    _, _, first = sample(spark, n=3)
    _, _, wide = sample(spark, n=2, d=6)
    path = str(tmp_path / "store")
    with pytest.raises(ValueError, match="2 of the new vectors"):
        vectors.append_vectors(stamped(first.unionByName(wide)), path, 4)
    assert vectors.read_store(spark, path) is None


def test_hashing_needs_no_exchange(spark):
    tokens = spark.createDataFrame([(1, ["aa"])], "doc_id bigint, tokens array<string>")
    assert "Exchange" not in vectors.hash_embed(tokens, "doc_id")._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("by_reference", [False, True])
def test_knn_over_many_pieces(spark, by_reference):
    """Several blocks, slices and pieces, equal distances and few hits, against the plain order."""
    rng = np.random.default_rng(11)
    texts = ["Alpha one", "beta two", "alphabet", None]
    store = [(i, [float(x) for x in rng.integers(0, 3, 4)], texts[int(rng.choice(4, p=[0.01, 0.5, 0.01, 0.48]))]) for i in range(1500)]
    asked = [(i, [float(x) for x in rng.integers(0, 3, 4)], ["ALPHA", "two", None, "none"][i % 4]) for i in range(70)]
    found = vectors.knn(
        spark.createDataFrame(asked, "query_id bigint, embedding array<float>, reference string"),
        spark.createDataFrame(store, "vec_id bigint, embedding array<float>, text string"), k=4, by_reference=by_reference, query_block=2,
    )
    got = sorted((r.query_id, r.rank, r.vec_id, r.l2, r.mentions) for r in found.collect())
    want = []
    for q, e, word in asked:
        rows = []
        for v, x, text in store:
            hit = by_reference and word is not None and text is not None and word.lower() in text.lower()
            rows.append((not hit, sum((a - b) ** 2 for a, b in zip(e, x)), v))
        want += [(q, n, v, d, not miss) for n, (miss, d, v) in enumerate(sorted(rows)[:4], 1)]
    assert got == sorted(want)


def test_words_are_hashed_once_per_batch_not_once_per_dimension(spark):
    lists = [["a", "b", "a", "ü"], ["b"], [], None]
    tokens = spark.createDataFrame([(i, t) for i, t in enumerate(lists)], "doc_id bigint, tokens array<string>")
    made = vectors.hash_embed(tokens, "doc_id", 7)
    want = {}
    for i, t in enumerate(lists[:2]):
        n = np.zeros(7)
        for w in t:
            n[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 7] += 1
        want[i] = (n / np.sqrt((n * n).sum())).astype(np.float32).tolist()
    assert {r.doc_id: r.embedding for r in made.collect()} == want
    assert "md5" not in made._jdf.queryExecution().executedPlan().toString()


def test_references_in_blocks(spark, monkeypatch):
    """References that are no word, blank, shared or missing; texts that come twice, are null or hold several references."""
    monkeypatch.setattr(vectors, "BLOCKS_PER_TASK", 2)
    rng = np.random.default_rng(5)
    words = ["cat", "Dog", "a-b", "", None, "cat", "at", "zebra"]
    asked = [(i, [float(x) for x in rng.random(4)], words[i % len(words)]) for i in range(24)]
    texts = ["The CAT sat", "concat a-b", "hotdog stand", None, "na-by at", "", "plain", "dog-cat a-b"]
    store = [(i, [float(x) for x in rng.random(4)], texts[i % len(texts)]) for i in range(60)]
    rows = [*store, *store[:8]]
    found = vectors.knn(
        spark.createDataFrame(asked, "query_id bigint, embedding array<float>, reference string"),
        spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, text string"), k=6, by_reference=True, query_block=4,
    ).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.mentions))
    f = lambda v: np.array(v, dtype=np.float32).astype(float)
    for i, e, word in asked:
        best = []
        for j, v, text in rows:
            hit = word is not None and text is not None and word.lower() in text.lower()
            best.append((not hit, round(float(((f(e) - f(v)) ** 2).sum()), 10), j))
        assert got[i] == [(j, not miss) for miss, _, j in sorted(best)[:6]], (i, word)
