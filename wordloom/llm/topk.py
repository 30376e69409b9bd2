"""Exact top-k by inner product with block-at-a-time pruning.

Each component of a vector is a term, its integer value the weight. Candidates stand in
blocks of neighbouring rows, each with the greatest and least weight of every term; a
query's sum of the larger products with these bounds every score of the block. Blocks
are taken by falling bound and scored through their forward index until the bound is
below the query's k-th best score.

A task holds one segment of the candidates and meets the queries in bounded chunks. A
first round takes each query's threshold from the segment it hashes to, the second
round visits the other segments with it, so that most return little.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import pick
from wordloom.session import stage

BLOCK = 64
SEGMENT = 16_384
CHUNK = 4096


def integer_vectors(vectors: DataFrame, id: str, vector: str, scale: int = 256) -> DataFrame:
    """(id, v) with floor(scale * x) of each component; vectors that are null, empty or not all finite are left out."""
    rows = pick(vectors, id, vector).toDF("id", "v").filter(F.col("id").isNotNull() & (F.size("v") > 0))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return rows.filter(~F.coalesce(bad, F.lit(True))).select("id", whole.alias("v"))


def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("id").to_numpy()
    values = table.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
    order = np.lexsort((*values.T[:8][::-1], ids))
    return ids[order], values[order]


def by_likeness(ids: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ordered so that blocks hold vectors of like signs."""
    rng = np.random.default_rng(5)
    planes = rng.normal(size=(values.shape[1], 16))
    signs = (values @ planes > 0) @ (1 << np.arange(16))
    order = np.lexsort((ids, signs))
    return ids[order], values[order]


def search_segment(query_ids, queries, floors, ids, values, k: int):
    """(query position, candidate id, score) of each query's best k in the segment that reach its floor."""
    ids, values = by_likeness(ids, values)
    starts = np.arange(0, len(ids), BLOCK)
    high, low = np.maximum.reduceat(values, starts), np.minimum.reduceat(values, starts)
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    order = np.argsort(-bounds, axis=1, kind="stable")
    best_scores = [np.zeros(0, np.int64)] * len(queries)
    best_ids = [np.zeros(0, np.int64)] * len(queries)
    floors = floors.copy()
    live = np.arange(len(queries))
    for step in range(len(starts)):
        block = order[live, step]
        going = bounds[live, block] >= floors[live]
        live, block = live[going], block[going]
        if not len(live):
            break
        for b in np.unique(block):
            own = live[block == b]
            rows = slice(starts[b], starts[b] + BLOCK)
            scores = queries[own] @ values[rows].T
            scores = np.where(ids[rows][None, :] == query_ids[own][:, None], np.iinfo(np.int64).min, scores)
            hit = scores >= floors[own][:, None]
            for row in np.flatnonzero(hit.any(axis=1)).tolist():
                q = own[row]
                found = hit[row] & (scores[row] > np.iinfo(np.int64).min)
                s = np.r_[best_scores[q], scores[row][found]]
                i = np.r_[best_ids[q], ids[rows][found]]
                top = np.lexsort((i, -s))[:k]
                best_scores[q], best_ids[q] = s[top], i[top]
                if len(top) == k:
                    floors[q] = max(floors[q], s[top][-1])
    sizes = [len(x) for x in best_scores]
    return np.repeat(np.arange(len(queries)), sizes), np.concatenate([*best_ids, np.zeros(0, np.int64)]), np.concatenate([*best_scores, np.zeros(0, np.int64)])


HITS = "query_id long, vec_id long, score long"


def search_pair(k: int):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        empty = pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})
        if not queries.num_rows or not rows.num_rows:
            return empty
        query_ids, q = matrix(queries.select(["id", "v"]))
        floor = dict(zip(queries.column("id").to_pylist(), queries.column("floor").to_pylist(), strict=True))
        floors = np.array([floor[i] for i in query_ids.tolist()], np.int64)
        ids, values = matrix(rows.select(["id", "v"]))
        at, found, score = search_segment(query_ids, q, floors, ids, values, k)
        return pa.table({"query_id": query_ids[at], "vec_id": found, "score": score})

    return run


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 5, id: str = "vec_id", vector: str = "embedding", segment: int = SEGMENT, chunk: int = CHUNK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best integer inner products over all other rows.

    ``is_query`` is a condition on the column ``id``. Ties go to the smaller id. Vectors that are null, empty or hold a null,
    NaN or infinity take no part, nor do rows without an id; vectors of another length than a query's are no
    candidates of it. A repeated id is a row of its own as a candidate, never of a query with the same id; as a query
    it stands once, with the least of its vectors. An empty table gives no rows.
    """
    rows = stage(integer_vectors(vectors, id, vector).withColumn("length", F.size("v")), "topk_rows")
    lowest = F.lit(-(1 << 62)).cast("long")
    sizes = rows.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    cut = sizes.select("length", F.greatest(F.lit(1), F.ceil(F.col("n") / segment)).cast("int").alias("segments"))
    placed = rows.join(cut, "length").withColumn("segment", F.pmod(F.xxhash64("id"), F.col("segments")).cast("int"))
    asked = rows.filter(is_query).groupBy("id").agg(F.min(F.struct("length", "v")).alias("one")).select("id", "one.length", "one.v")
    queries = stage(asked.join(cut, "length"), "topk_queries")
    total = queries.count()
    chunks = max(1, -(-total // chunk))
    queries = queries.withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(chunks)).cast("int"))

    def search(asked: DataFrame) -> DataFrame:
        keys = ["length", "segment", "chunk"]
        sides = placed.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        return asked.groupBy(*keys).cogroup(sides.groupBy(*keys)).applyInArrow(search_pair(k), HITS)

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    own = queries.withColumn("segment", F.pmod(F.xxhash64("id"), F.col("segments")).cast("int"))
    first = stage(search(own.withColumn("floor", lowest)), "topk_first")
    floors = first.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    others = queries.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", lowest))
    others = others.withColumn("segment", F.explode(F.sequence(F.lit(0), F.col("segments") - 1)))
    others = others.filter(F.col("segment") != F.pmod(F.xxhash64("id"), F.col("segments")).cast("int"))
    hits = first.unionByName(search(others))
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
