"""Vectors: hashing, the Parquet vector store, exact nearest neighbours, retrieval records."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructType

from wordloom.operators import matching, text_blocks
from wordloom.session import passing, stage

TOP_K = 5
QUERY_BLOCK = 1024
BLOCKS_PER_TASK = 64  # blocks of queries that share a copy of a slice of the store
LEAST_TASKS = 24
ROWS_PER_TASK = 100_000
FIRST_PIECE, LARGEST_PIECE = 32, 4096
PAIRS_AT_ONCE = 200_000  # multiplied in one step
SLACK = 1e-9  # what rounding to ten digits may still bring as near as the last of the k
NOTHING_FOUND = "No relevant information found for the query."


def embed_rows(rows: DataFrame, dim: int = 64) -> DataFrame:
    """The rows with ``embedding`` in place of ``tokens``: feature hashing, L2-normalised, within the row.

    A row without tokens has no vector and is left out.
    """
    others = [c for c in rows.columns if c != "tokens"]
    rows = rows.filter(F.size("tokens") > 0).select(*others, "tokens")
    schema = StructType([f for f in rows.schema if f.name != "tokens"]).add("embedding", ArrayType(FloatType()))

    def embedded(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            lists = batch.column("tokens")
            words = pc.dictionary_encode(lists.flatten())
            # Each word of a batch is hashed once; a null token has no place, but the row stays.
            place = np.array([int.from_bytes(hashlib.md5(w.encode()).digest()[:4]) % dim for w in words.dictionary.to_pylist()] or [0])
            row = np.repeat(np.arange(len(batch)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            known = pc.is_valid(words.indices).to_numpy(zero_copy_only=False)
            at = place[pc.fill_null(words.indices, 0).to_numpy(zero_copy_only=False)]
            n = np.bincount(row[known] * dim + at[known], minlength=len(batch) * dim).reshape(-1, dim)
            norm = np.sqrt((n * n).sum(axis=1))[:, None]
            values = pa.array((n / np.where(norm == 0, np.nan, norm)).astype(np.float32).ravel(), from_pandas=True)
            begin = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * dim)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in others] + [pa.ListArray.from_arrays(begin, values)], names=[*others, "embedding"])

    return rows.mapInArrow(embedded, schema)


def hash_embed(tokens: DataFrame, id_col: str, dim: int = 64) -> DataFrame:
    """(id, embedding array<float>) of fixed length; a text without tokens has no row."""
    return embed_rows(tokens.select(id_col, "tokens"), dim)


def embed_gate(records: DataFrame) -> DataFrame:
    """Adds both gates: by_text (no "error" in it) and by_metrics (no error message)."""
    some = F.coalesce("content", F.lit("")) != ""
    return records.withColumns({
        "by_text": some & ~F.lower("content").contains("error"),
        "by_metrics": some & (F.coalesce("error_message", F.lit("")) == ""),
    })


# --- store -----------------------------------------------------------------------------------------

STORE_SCHEMA = "vec_id bigint, text string, embedding array<float>, ingested_at timestamp, content_hash string, version int"


def read_store(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows of the newest version of the store, or None if there is no store yet."""
    try:
        everything = spark.read.schema(STORE_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    newest = everything.agg(F.max("version")).first()[0]
    return None if newest is None else everything.filter(F.col("version") == newest)


def append_vectors(rows: DataFrame, path: str, dim: int) -> int:
    """Append ``rows(vec_id, text, embedding, ingested_at, content_hash)``; returns the version written.

    If the stored vectors have another length, a new version is begun instead;
    the old files stay. Rows whose vector is missing or not ``dim`` long are an error, and nothing is written.
    """
    rows = stage(rows, "new-vectors")
    other = rows.filter(F.coalesce(F.size("embedding"), F.lit(-1)) != dim).count()
    if other:
        raise ValueError(f"{other} of the new vectors are not {dim} long")
    store = read_store(rows.sparkSession, path)
    version = 1
    if store is not None:
        old = store.select("version", F.size("embedding").alias("d")).first()
        version = old.version if old.d == dim else old.version + 1
    (
        rows.withColumn("version", F.lit(version))
        .write.mode("append").partitionBy("version").parquet(path)
    )
    return version


# --- search ----------------------------------------------------------------------------------------


def mentions(store: DataFrame, asked: DataFrame, blocks: int) -> DataFrame:
    """(_key, qb, held): which references of each block of queries the texts of ``store(_key, text)`` contain; one row per text and block with any.

    ``asked(qb, pos, keyword)`` has the distinct references of each block. They are looked for in the dictionary of distinct runs of the
    texts, and texts take those of their runs block by block (``text_blocks``): no reference is tried against texts one by one.
    """
    lists = text_blocks.run_lists(store, ["_key"])
    nets = [asked.filter(F.col("qb") == b).select("pos", "keyword") for b in range(blocks)]
    found = matching.substring_hits(lists, nets, ["_key"]).select("_key", F.col("net").alias("qb"), F.col("pos").alias("held"))
    rest = asked.filter(~matching.one_run(F.col("keyword")))
    if rest.isEmpty():
        return found
    mixed = matching.mixed_substrings(store, rest.select("pos", "keyword").distinct(), ["_key"], lists).join(rest.select("qb", "pos"), "pos")
    return found.unionByName(mixed.distinct().groupBy("_key", "qb").agg(F.collect_list("pos").alias("held")))


def knn(queries: DataFrame, store: DataFrame, k: int = TOP_K, dim: int | None = None,
        by_reference: bool = False, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, vec_id, l2, mentions, rank): the k nearest by squared distance, ties by vec_id.

    ``queries(query_id, embedding)``, ``store(vec_id, embedding)``. Vectors of
    another length than ``dim`` are no candidates. With ``by_reference`` the
    queries also carry a ``reference`` and the store its ``text``; texts that
    contain the reference, in any case, come before all others.

    Up to one block of queries without references is sent to every task that scans the store; of more, and with references,
    each task compares 64 blocks with one slice of the store, so that it is copied
    once per 64 blocks. Products are taken in single precision first; those that come near a query's k-th so far are taken again in double.
    A query that has k texts with its reference is compared with such texts alone.
    A task returns at most k rows per query, so what is shuffled does not grow with the store.
    """
    if dim is not None:
        queries = queries.filter(F.size("embedding") == dim)
        store = store.filter(F.size("embedding") == dim)
    named = [F.lower("reference").alias("reference")] if by_reference else []
    texts = [F.lower("text").alias("text")] if by_reference else []
    queries = queries.select("query_id", "embedding", *named)
    store = store.select("vec_id", "embedding", *texts)
    schema = "query_id bigint, vec_id bigint, l2 double, mentions boolean"
    rows_at_once, first_piece, largest_piece, pairs_at_once, slack = QUERY_BLOCK, FIRST_PIECE, LARGEST_PIECE, PAIRS_AT_ONCE, SLACK

    def matrix(table):
        import numpy as np
        import pyarrow.compute as pc

        values = pc.list_flatten(table["embedding"]).to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) else pc.list_flatten(table["embedding"]).to_numpy()
        return values.astype(np.float64).reshape(len(table), -1) if len(table) else np.zeros((0, 1))

    def expanded(lo, hi):
        """(owner, entry) for the ranges of entries from ``lo`` to ``hi``."""
        import numpy as np

        n = hi - lo
        return np.repeat(np.arange(len(lo)), n), np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)

    def pieces(parts):
        """Pieces of the parts (vec_id, vectors, has a text, references and the rows that mention them, by row), small at first: then little of the later, larger ones comes near."""
        import numpy as np

        step = first_piece
        for ids, x, told, hits in parts:
            i = 0
            while i < len(x):
                some = slice(i, i + step)
                lo, hi = np.searchsorted(hits[1], [i, i + step])
                yield ids.slice(i, step), x[some], told[some], (hits[0][lo:hi], hits[1][lo:hi] - i)
                i, step = i + step, min(2 * step, largest_piece)

    def nearest(asked, q, pos, parts):
        """``pos`` has the number of each query's reference: -1 for none, -2 for the blank one, which is in all texts."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        q_sq, blank = (q * q).sum(axis=1), pos == -2
        by_pos = np.argsort(pos, kind="stable")
        by_pos_of = pos[by_pos]
        # The k best so far, one after the other, and what the last of them is; infinite while there are fewer.
        best = [np.empty(0, dtype=np.int64), np.empty(0), np.empty(0, dtype=bool), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)]
        last, last_miss = np.full(len(q), np.inf), np.ones(len(q), dtype=bool)
        waiting, ids, seen = [], [], 0

        def settled():
            row, dist, miss, order, at = (np.concatenate(c) for c in zip(best, *waiting))
            by = np.lexsort((at, order, dist, miss, row))
            row = row[by]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            by, row, place = by[place < k], row[place < k], place[place < k]
            best[:] = row, dist[by], miss[by], order[by], at[by]
            full = np.flatnonzero(place == k - 1)
            last[row[full]], last_miss[row[full]] = best[1][full], best[2][full]
            waiting.clear()

        for names, x, told, (hit_pos, hit_row) in pieces(parts):
            x_sq = (x * x).sum(axis=1)
            scale = q_sq.max(initial=0) + x_sq.max(initial=0)
            single = scale < 1e30
            room = slack + scale * (x.shape[1] + 8) * 2.0**-22 if single else slack
            kind = np.float32 if single else np.float64
            other = np.concatenate([x, x_sq[:, None]], axis=1).astype(kind).T
            # With k texts that mention the reference no other is asked for; a blank one is in all texts.
            open_ = np.flatnonzero(last_miss | blank)
            limit = np.where(blank & last_miss, np.inf, last) + room - q_sq
            order = pc.fill_null(names, -(1 << 63)).to_numpy(zero_copy_only=False)

            def take(r, c, miss):
                d = q_sq[r] - 2 * np.einsum("ij,ij->i", q[r], x[c]) + x_sq[c]  # noqa: B023
                keep = ~(d > last[r] + slack) | (last_miss[r] & ~miss)
                r, c, d, miss = r[keep], c[keep], d[keep], miss[keep]
                waiting.append((r, np.round(np.maximum(d, 0), 10), miss, order[c], c + seen))  # noqa: B023
                if sum(len(w[0]) for w in waiting) > max(k * len(q), pairs_at_once):
                    settled()

            # The texts that mention a reference and the queries that ask for it, some at a time.
            lo = np.searchsorted(by_pos_of, hit_pos, "left")
            n = np.searchsorted(by_pos_of, hit_pos, "right") - lo
            asks = n > 0
            lo, n, mentioned = lo[asks], n[asks], hit_row[asks]
            cuts = np.flatnonzero(np.diff(np.cumsum(n) // pairs_at_once, prepend=-1) != 0)
            for i, j in zip(cuts, np.append(cuts[1:], len(n))):
                owner, at = expanded(lo[i:j], lo[i:j] + n[i:j])
                take(by_pos[at], mentioned[i:j][owner], np.zeros(len(at), dtype=bool))
            codes, which = np.unique(hit_pos, return_inverse=True)
            hit_code = np.unique(which * len(x) + hit_row)
            for i in range(0, len(open_), rows_at_once):
                some = open_[i:i + rows_at_once]
                mine = np.concatenate([-2 * q[some], np.ones((len(some), 1))], axis=1).astype(kind)
                # Not further than the last: this keeps what cannot be compared, as the full order does.
                r, c = np.nonzero(~(mine @ other > limit[some].astype(kind)[:, None]))
                r = some[r]
                if len(codes):
                    at = np.minimum(np.searchsorted(codes, pos[r]), len(codes) - 1)
                    code = at * len(x) + c
                    twice = (codes[at] == pos[r]) & (hit_code[np.minimum(np.searchsorted(hit_code, code), len(hit_code) - 1)] == code)
                    r, c = r[~twice], c[~twice]
                for j in range(0, len(r), pairs_at_once):
                    a, b = r[j:j + pairs_at_once], c[j:j + pairs_at_once]
                    take(a, b, ~(blank[a] & told[b]))
            ids.append(names)
            seen += len(x)
        settled()
        row, dist, miss, _, at = best
        names = pa.concat_arrays(ids) if ids else pa.array([], pa.int64())
        return pa.table({
            "query_id": asked.take(pa.array(row)).cast(pa.int64()), "vec_id": names.take(pa.array(at)).cast(pa.int64()),
            "l2": pa.array(dist, from_pandas=True), "mentions": pa.array(~miss),
        })

    def whole(column):
        return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column

    few = None if by_reference else queries.limit(query_block + 1).toArrow()
    if few is not None and len(few) <= query_block:
        sent = store.sparkSession.sparkContext.broadcast((whole(few["query_id"]), matrix(few)))

        def scan(batches):
            import numpy as np

            none = np.empty(0, dtype=np.int64)
            parts = ((b.column("vec_id"), matrix(b), np.zeros(len(b), dtype=bool), (none, none)) for b in batches)
            asked, q = sent.value
            yield from nearest(asked, q, np.full(len(q), -1), parts).to_batches()

        local = store.mapInArrow(scan, schema) if len(few) else store.select(
            F.lit(0).cast("bigint").alias("query_id"), "vec_id", F.lit(0.0).alias("l2"), F.lit(False).alias("mentions")
        ).limit(0)
    else:
        blocks = max(1, math.ceil(queries.count() / (query_block * BLOCKS_PER_TASK)))
        slices = max(math.ceil(store.count() / ROWS_PER_TASK), math.ceil(LEAST_TASKS / blocks))
        queries = queries.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
        part = lambda key: F.pmod(F.xxhash64(key), F.lit(slices)).cast("int").alias("sb")
        no_list = F.lit(None).cast("array<bigint>").alias("held")
        key = "vec_id"
        if by_reference:
            key = "_key"
            store = store.withColumn("_key", F.xxhash64("vec_id", "text"))
            references = queries.select("reference").filter("reference <> ''").distinct()
            references = stage(references.withColumn("pos", F.monotonically_increasing_id()), "references")
            queries = queries.join(references, "reference", "left").withColumn("pos", F.when(F.col("reference") == "", -2).otherwise(F.coalesce("pos", F.lit(-1))))
            asked = queries.filter("pos >= 0").select("qb", "pos", F.col("reference").alias("keyword")).distinct()
            with passing():
                found = stage(mentions(store.select("_key", "text"), stage(asked, "asked-references"), blocks), "mentions", keep=True)
            found = found.select("qb", part("_key"), "_key", F.lit(None).cast("bigint").alias("vec_id"), F.lit(None).cast(store.schema["embedding"].dataType).alias("embedding"), F.lit(False).alias("told"), "held")
        cut_q = queries.withColumn("sb", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).select("qb", "sb", "query_id", "embedding", F.col("pos") if by_reference else F.lit(-1).cast("bigint").alias("pos"))
        told = F.col("text").isNotNull() if by_reference else F.lit(False)
        cut_s = store.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
            "qb", part(key), F.xxhash64(key).alias("_key") if not by_reference else F.col("_key"), "vec_id", "embedding", told.alias("told"), no_list
        )
        cut_s = cut_s.unionByName(found) if by_reference else cut_s

        def compare(asked: pa.Table, stored: pa.Table) -> pa.Table:
            import numpy as np
            import pyarrow.compute as pc

            rows, held = stored.filter(pc.is_null(stored["held"])), stored.filter(pc.is_valid(stored["held"]))
            hits = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
            if len(held) and len(rows):
                # From a text's references to its rows.
                order = np.argsort(rows["_key"].to_numpy(), kind="stable")
                mine, wanted = rows["_key"].to_numpy()[order], held["_key"].to_numpy()
                size = pc.list_value_length(held["held"]).to_numpy()
                listed = pc.list_flatten(held["held"]).to_numpy()
                owner, at = expanded(np.searchsorted(mine, wanted, "left"), np.searchsorted(mine, wanted, "right"))
                begin = (np.cumsum(size) - size)[owner]
                found, entry = expanded(begin, begin + size[owner])
                row = order[at][found]
                by_row = np.argsort(row, kind="stable")
                hits = listed[entry][by_row], row[by_row]
            parts = [(whole(rows["vec_id"]), matrix(rows), rows["told"].to_numpy().astype(bool), hits)]
            return nearest(whole(asked["query_id"]), matrix(asked), asked["pos"].to_numpy(), parts if len(asked) else [])

        local = cut_q.groupBy("qb", "sb").cogroup(cut_s.groupBy("qb", "sb")).applyInArrow(compare, schema)

    order = Window.partitionBy("query_id").orderBy(F.desc("mentions"), "l2", "vec_id")
    return local.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= k)


def hit_texts(hits: DataFrame, store: DataFrame) -> DataFrame:
    """The hits with their texts. They are written first: then their size is known, and few hits are sent to the
    store's scan instead of shuffling the store."""
    hits = stage(hits, "hits")
    return hits.join(store.select("vec_id", "text"), "vec_id")


def retrieval_records(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """One record per query: bullet list of the texts found, their number, the error.

    ``queries(query_id, query)``, ``hits(query_id, rank, text)``. A blank query is
    an error, a query without hits says so.
    """
    line = F.struct("rank", F.concat(F.lit("- "), F.col("text")).alias("line"))
    found = hits.groupBy("query_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["line"]), "\n").alias("bullets"),
        F.count(F.lit(1)).alias("n"),
    )
    blank = F.trim("query") == ""
    return queries.join(found, "query_id", "left").select(
        "query_id",
        F.when(blank, "").otherwise(F.coalesce("bullets", F.lit(NOTHING_FOUND))).alias("results"),
        F.when(blank, 0).otherwise(F.coalesce("n", F.lit(0))).cast("bigint").alias("num_retrieved"),
        F.when(blank, "User query is empty or missing").alias("error_message"),
    )


def query_prompts(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """(query_id, prompt): the query with the retrieved texts as a JSON array."""
    texts = F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda x: x["text"])
    found = hits.groupBy("query_id").agg(F.to_json(texts).alias("texts"))
    return queries.join(found, "query_id", "left").select(
        "query_id",
        F.concat_ws(
            "\n",
            F.concat(F.lit("**User Query**: "), "query"), F.lit("**Retrieved Documents**:"),
            F.coalesce("texts", F.lit("[]")),
        ).alias("prompt"),
    )
