"""TF-IDF weights, keyword scores and ranks, per category.

Input is ``(category, doc_id, tokens)``. Each row's words are counted once, in the task that reads the row, and kept as a
list of distinct terms per row. Blocks of rows ask for the frequencies of their distinct terms and take the weights where the rows are, so no row is
shuffled per document and term. A block holds a bounded number of rows; each is one Arrow batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructType

from wordloom.functions.text import ALPHANUMERIC, once
from wordloom.operators.ranking import number_rows
from wordloom.session import passes, same_files, stage, stage_each

MIN_SCORE = 0.2
KEY = ("category", "doc_id")


def tokens_of(corpus: DataFrame, cleaner, keep_empty: bool = False) -> DataFrame:
    """Corpus rows with their tokens; documents without any are dropped unless asked for."""
    out = corpus.select("category", "doc_id", once(cleaner(F.col("text"))).alias("tokens"))
    return out if keep_empty else out.filter(F.size("tokens") > 0)


def document_terms(tokens: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """(key, block, terms, tfs): the distinct terms of each row with their counts; ``block`` numbers the Arrow batch of the row.

    Should be staged before it is used twice. Rows whose tokens are null are left out.
    """
    key = list(key)
    tokens = tokens.select(*key, "tokens").filter(F.col("tokens").isNotNull())
    schema = StructType([f for f in tokens.schema if f.name != "tokens"]).add("block", LongType())
    schema = schema.add("terms", ArrayType(StringType())).add("tfs", ArrayType(IntegerType()))

    def counted(batches):
        import numpy as np
        import pyarrow.compute as pc
        from pyspark import TaskContext

        task = TaskContext.get().partitionId() << 32
        for i, batch in enumerate(batches):
            lists = batch.column("tokens")
            words = pc.dictionary_encode(lists.flatten())
            n = len(words.dictionary) or 1
            row = np.repeat(np.arange(len(batch)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            met, count = np.unique(row * n + words.indices.to_numpy(zero_copy_only=False), return_counts=True)
            begin = pa.array(np.searchsorted(met, np.arange(len(batch) + 1) * n).astype(np.int32))
            terms = words.dictionary.take(pa.array(met % n)).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in key], pa.array(np.full(len(batch), task + i)),
                 pa.ListArray.from_arrays(begin, terms), pa.ListArray.from_arrays(begin, pa.array(count.astype(np.int32)))],
                names=[*key, "block", "terms", "tfs"],
            )

    return tokens.mapInArrow(counted, schema)


def _block_terms(documents: DataFrame) -> DataFrame:
    """(category, block, term, total, df) by category and block, of each batch; the null term has the number of rows."""
    given = documents.select("category", "block", "terms", "tfs")
    schema = StructType([given.schema["category"], given.schema["block"]]).add("term", StringType()).add("total", LongType()).add("df", LongType())

    def summed(batches):
        import numpy as np
        import pyarrow.compute as pc

        for batch in batches:
            if not len(batch):
                continue
            groups = pa.table({"category": batch.column("category"), "block": batch.column("block"), "at": pa.array(np.arange(len(batch)))})
            groups = groups.group_by(["category", "block"]).aggregate([("at", "list"), ("at", "min")])
            for rows, first in zip(groups["at_list"].to_pylist(), groups["at_min"].to_pylist()):
                part = batch.take(pa.array(rows))
                words = pc.dictionary_encode(part.column("terms").flatten())
                code, n = words.indices.to_numpy(zero_copy_only=False), len(words.dictionary)
                total = np.bincount(code, part.column("tfs").flatten().to_numpy(zero_copy_only=False), n).astype(np.int64)
                same = lambda name: batch.column(name).take(pa.array(np.full(n + 1, first)))  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [same("category"), same("block"), pa.concat_arrays([words.dictionary.cast(pa.string()), pa.nulls(1, pa.string())]),
                     pa.array(np.append(total, 0)), pa.array(np.append(np.bincount(code, minlength=n), len(rows)).astype(np.int64))],
                    names=["category", "block", "term", "total", "df"],
                )

    return given.mapInArrow(summed, schema)


def statistics_of(documents: DataFrame) -> DataFrame:
    """``term_statistics`` out of ``document_terms``."""
    return _block_terms(documents).groupBy("category", "term").agg(F.sum("total").alias("total"), F.sum("df").alias("df"))


def term_statistics(tokens: DataFrame) -> DataFrame:
    """(category, term, total, df): occurrences and documents of each term.

    The row with a null term holds the number of documents of the category.
    """
    return statistics_of(document_terms(tokens))


def top_terms(statistics: DataFrame, n: int) -> DataFrame:
    """The n terms with the largest total count per category, ties by term."""
    order = Window.partitionBy("category").orderBy(F.desc("total"), "term")
    return (
        statistics.filter(F.col("term").isNotNull())
        .withColumn("_pos", F.row_number().over(order))
        .filter(F.col("_pos") <= n)
        .drop("_pos")
    )


def idf(n_docs: Column, df: Column) -> Column:
    return F.log((n_docs + 1) / (df + 1)) + 1


def one_row_each(documents: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """The same with the rows of a repeated document taken together, as long as there are any; a null id is one document."""
    key = list(key)
    many = stage(
        documents.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("block").alias("first")).filter("n > 1").drop("n"), "repeated"
    )
    if many.isEmpty():
        return documents
    met = many.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)], "first")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(key)])
    entries = documents.join(met, same).select(*key, "first", F.explode(F.arrays_zip("terms", "tfs")).alias("e"))
    entries = entries.groupBy(*key, "first", "e.terms").agg(F.sum("e.tfs").cast("int").alias("tfs"))
    merged = entries.groupBy(*key, "first").agg(F.collect_list(F.struct("terms", "tfs")).alias("e"))
    merged = merged.select(*key, F.col("first").alias("block"), F.col("e.terms").alias("terms"), F.col("e.tfs").alias("tfs"))
    return stage(documents.join(met, same, "left_anti").unionByName(merged), "documents")


def _idfs(statistics: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    n_docs = statistics.filter(F.col("term").isNull()).select("category", F.col("df").alias("n_docs"))
    return (
        (statistics.filter(F.col("term").isNotNull()) if vocabulary is None else vocabulary)
        .join(n_docs, "category")
        .select("category", "term", idf(F.col("n_docs"), F.col("df")).alias("idf"))
    )


def weights_of(documents: DataFrame, statistics: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """``tfidf`` out of ``document_terms``, which should be staged; without a vocabulary also ``n_terms``, the terms of the document."""
    documents, weighed = one_row_each(documents), _idfs(statistics, vocabulary)
    if vocabulary is not None:
        # Meet the short list first: it drops most entries before they are shuffled.
        entries = documents.select("category", "doc_id", F.explode(F.arrays_zip("terms", "tfs")).alias("e"))
        raw = entries.select("category", "doc_id", F.col("e.terms").alias("term"), F.col("e.tfs").cast("bigint").alias("tf"))
        raw = raw.join(weighed, ["category", "term"]).withColumn("x", F.col("tf") * F.col("idf"))
        norm = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy("category", "doc_id")))
        return raw.select("category", "doc_id", "term", "tf", (F.col("x") / norm).alias("w"))
    return _weighed(_factors(documents, weighed))


def staged_weights(documents: DataFrame, statistics: DataFrame) -> DataFrame:
    """``weights_of`` without a vocabulary, staged as the factors of the weights, block after block in a few passes.

    The factors repeat from row to row (a term's idf, a document's norm) where no weight does, so they take a fraction of its room.
    """
    documents, weighed = one_row_each(documents), _idfs(statistics)
    n = passes(documents.agg(F.sum(F.size("terms"))).first()[0] or 0)
    turn = F.pmod(F.col("block") + F.shiftright("block", 32), F.lit(n))
    staged = stage_each((_factors(documents.filter(turn == i), weighed) for i in range(n)), "weights")
    return same_files(_weighed(staged), staged)


def _weighed(factors: DataFrame) -> DataFrame:
    return factors.select("category", "doc_id", "term", "tf", (F.col("tf").cast("double") * F.col("idf") / F.col("norm")).alias("w"), "n_terms")


def _factors(documents: DataFrame, weighed: DataFrame) -> DataFrame:
    """(category, doc_id, term, tf, idf, norm, n_terms): the weight is ``tf * idf / norm``; documents have one row each."""
    schema = StructType([documents.schema["category"], documents.schema["doc_id"]]).add("term", StringType())
    schema = schema.add("tf", LongType()).add("idf", DoubleType()).add("norm", DoubleType()).add("n_terms", IntegerType())

    def weigh(rows: pa.Table, answers: pa.Table) -> pa.Table:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        rows = rows.combine_chunks()
        lists, terms = rows["terms"], pc.list_flatten(rows["terms"])
        length = pc.list_value_length(lists).to_numpy()
        row = np.repeat(np.arange(len(rows)), length)
        at = pc.index_in(terms, value_set=answers["term"])
        known = pc.is_valid(at)
        terms, tf, row = terms.filter(known), pc.list_flatten(rows["tfs"]).filter(known).to_numpy(), row[known.to_numpy()]
        idfs = answers["idf"].to_numpy()[at.drop_null().to_numpy()]
        x = tf * idfs
        norm = np.sqrt(np.bincount(row, x * x, len(rows)))
        held, here = np.bincount(row, minlength=len(rows)), pa.array(row)
        return pa.table({
            "category": rows["category"].take(here), "doc_id": rows["doc_id"].take(here), "term": terms,
            "tf": pa.array(tf.astype(np.int64)), "idf": pa.array(idfs), "norm": pa.array(norm[row]), "n_terms": pa.array(held[row].astype(np.int32)),
        })

    key = ["category", "block"]
    # A term may be asked for twice, where a block is read in two pieces; the first answer counts, both are equal.
    asked = _block_terms(documents).filter(F.col("term").isNotNull()).select(*key, "term")
    answers = asked.join(weighed, ["category", "term"]).select(*key, "term", "idf")
    return documents.groupBy(*key).cogroup(answers.groupBy(*key)).applyInArrow(weigh, schema)


def tfidf(tokens: DataFrame, statistics: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """(category, doc_id, term, tf, w): raw counts times smoothed idf, each document L2-normalised.

    With a vocabulary (some rows of the statistics), other terms are left out
    before the norms are taken.
    """
    weights = weights_of(stage(document_terms(tokens), "documents"), statistics, vocabulary)
    return weights.select("category", "doc_id", "term", "tf", "w")


def term_scores(weights: DataFrame) -> DataFrame:
    """Corpus score of a term: the sum of its weights, rounded so that ties are ties."""
    return weights.groupBy("category", "term").agg(F.round(F.sum("w"), 10).alias("score"))


def rank_terms(scores: DataFrame) -> DataFrame:
    """Position of every term within its category by score, ties by term; for lists of any length."""
    return number_rows(scores, ["category"], [F.desc("score"), F.asc("term")], "rank")


def rank_short_list(scores: DataFrame) -> DataFrame:
    """As ``rank_terms`` for a list already cut to a vocabulary cap: one window per category."""
    order = Window.partitionBy("category").orderBy(F.desc("score"), "term")
    return scores.select("category", "term", "score", F.row_number().over(order).cast("bigint").alias("rank"))


def filter_keywords(scores: DataFrame, min_score: float = MIN_SCORE, pattern: str = ALPHANUMERIC) -> DataFrame:
    return scores.filter((F.col("score") >= min_score) & F.col("term").rlike(pattern))
