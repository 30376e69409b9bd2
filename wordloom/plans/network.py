"""The keyword network: corpus -> keywords -> graph -> nested keywords and sequences."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.text import clean_tokens
from wordloom.operators import graph, paths, quotient, tfidf
from wordloom.operators.similarity import ColumnGraph, column_units, graph_of, member_edges
from wordloom.session import discard, passing, stage


THRESHOLD = 0.9


@dataclass(frozen=True)
class Network:
    ranked: DataFrame  # (category, term, score, rank)
    links: DataFrame  # edges as built
    edges: DataFrame  # edges after refinement
    keywords: DataFrame  # (category, pos, keyword, nested<struct<keyword, weight>>, is_sufficient)
    sequences: DataFrame  # (category, pos, sequence, ranks, is_sufficient)

    def keyword_rows(self) -> DataFrame:
        """Keywords as the matching operators take them, nested words without weights."""
        return self.keywords.withColumn("nested", F.col("nested.keyword"))


def corpus_weights(corpus: DataFrame, cap: int | None = None, keep_empty: bool = False) -> DataFrame:
    """TF-IDF weights over the vocabulary of each category; with a cap, over its most frequent terms only."""
    weights = block_weights(corpus, cap, keep_empty)
    return weights.select("category", "doc_id", "term", "tf", "w")


def counted_terms(corpus: DataFrame, keep_empty: bool = False) -> tuple[DataFrame, DataFrame]:
    """Distinct terms of each document and their statistics."""
    documents = stage(tfidf.document_terms(tfidf.tokens_of(corpus, clean_tokens, keep_empty)), "documents")
    return documents, stage(tfidf.statistics_of(documents), "statistics")


def block_weights(corpus: DataFrame, cap: int | None = None, keep_empty: bool = False) -> DataFrame:
    """As ``corpus_weights``, with the number of terms of each document if there is no cap. Each text is cleaned and counted once."""
    documents, statistics = counted_terms(corpus, keep_empty)
    vocabulary = tfidf.top_terms(statistics, cap) if cap else None
    return tfidf.weights_of(documents, statistics, vocabulary)


def keyword_classes(corpus: DataFrame, cap: int | None = None, threshold: float = THRESHOLD) -> tuple[DataFrame, ColumnGraph]:
    """Ranked keywords and the graph between their classes of equal columns; of what is staged on the way nothing else stays."""
    with passing():
        if cap:
            weights = stage(block_weights(corpus, cap), "weights")
        else:
            documents, statistics = counted_terms(corpus)
            weights = tfidf.staged_weights(documents, statistics)
            discard(documents)
        ranked = stage(tfidf.rank_terms(tfidf.filter_keywords(tfidf.term_scores(weights))), "keywords", keep=True)
        units = column_units(weights, ranked, threshold)
        discard(weights)
        return ranked, graph_of(units, ranked, threshold)


def keyword_graph(corpus: DataFrame, cap: int | None = None, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Ranked keywords and the edges between them, over all keywords unless the caller caps the vocabulary."""
    ranked, columns = keyword_classes(corpus, cap, threshold)
    return ranked, stage(member_edges(columns), "links")


def build_network(
    corpus: DataFrame,
    cap: int | None = None,
    threshold: float = THRESHOLD,
    rounds: int = graph.ROUNDS,
    min_weight: float = graph.MIN_WEIGHT,
    sample: int | None = None,
    sequence_cap: int | None = None,
    built: tuple[DataFrame, ColumnGraph] | None = None,
) -> Network:
    """Keywords of ``corpus(doc_id, category, text)`` with their neighbours and paths.

    All keywords, edges and paths, unless the caller asks for a vocabulary cap, for paths between a sample of
    the nodes, or for the first paths only. ``built`` takes the classes of the corpus that are at hand already.
    Refinement and sufficiency are taken on the classes; all tables are written once and read from there.
    """
    ranked, columns = built or keyword_classes(corpus, cap, threshold)
    refined = quotient.refine(columns, rounds, min_weight)
    links, edges = stage(member_edges(columns), "links"), stage(quotient.expand(columns, refined), "edges")
    enough = quotient.node_sufficiency(columns, refined, min_weight=min_weight)
    near = graph.connected(edges).select("category", F.col("keyword").alias("term"), "nested")
    none = F.array().cast(near.schema["nested"].dataType)
    keywords = stage(
        enough.join(near, ["category", "term"], "left").select(
            "category", (F.col("rank") - 1).alias("pos"), F.col("term").alias("keyword"),
            F.coalesce("nested", none).alias("nested"), "is_sufficient",
        ),
        "network-keywords",
    )
    ends = ranked if sample is None else graph.sample_nodes(ranked, sample)
    found = paths.simple_paths(ends, edges, cap=sequence_cap).select(
        "category", F.col("n").alias("path_id"), "path", "ranks"
    )
    sequences = graph.path_sufficiency(found, edges, min_weight=min_weight).select(
        "category", (F.col("path_id") - 1).alias("pos"), F.col("path").alias("sequence"), "ranks", "is_sufficient"
    )
    return Network(ranked, links, edges, keywords, stage(sequences, "network-sequences"))
