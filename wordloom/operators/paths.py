"""Paths in the keyword graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.operators.graph import both_ways
from wordloom.operators.ranking import number_rows
from wordloom.session import stage

MAX_EDGES = 3


def _arcs(edges: DataFrame) -> DataFrame:
    return both_ways(edges).select("category", F.col("rn").alias("tail"), "rp", "peer", "w")


def simple_paths(
    sample: DataFrame,
    edges: DataFrame,
    max_edges: int = MAX_EDGES,
    cap: int | None = None,
    distinct: bool = False,
    first_sources: int = 128,
) -> DataFrame:
    """Simple paths of up to ``max_edges`` edges between sampled nodes, in emission order.

    For every source, every limit from 2 to ``max_edges`` and every target, all
    paths within the limit; short paths thus appear once per limit unless
    ``distinct``. (category, n, max_len, path, ranks). With a cap only as many
    sources as it takes are grown: their number doubles until every category has
    reached the cap or used up its sources, so the result is the exact prefix.
    ``edges`` should be staged.
    """
    arcs = _arcs(edges)
    ends = sample.select("category", F.col("rank").alias("end"))
    linked = sample.join(
        arcs.select("category", F.col("tail").alias("rank")).distinct(), ["category", "rank"], "left_semi"
    )
    if cap is None:
        linked = linked.withColumn("turn", F.lit(1))
    else:
        linked = number_rows(linked, ["category"], [F.asc("rank")], "turn")
    sources = stage(linked.select("category", "term", "rank", "turn"), "sources")
    most = sources.agg(F.max("turn")).first()[0] or 0

    def grow(limit: int) -> DataFrame:
        walk = sources.filter(F.col("turn") <= limit).select(
            "category", F.array("term").alias("path"), F.array("rank").alias("ranks")
        )
        levels = []
        for _ in range(max_edges):
            walk = (
                walk.withColumn("tail", F.element_at("ranks", -1))
                .join(arcs, ["category", "tail"])
                .filter(~F.array_contains("ranks", F.col("rp")))
                .select("category", F.array_append("path", F.col("peer")).alias("path"),
                        F.array_append("ranks", F.col("rp")).alias("ranks"))
            )
            levels.append(walk)
        out = levels[0]
        for level in levels[1:]:
            out = out.unionByName(level)
        out = out.withColumn("end", F.element_at("ranks", -1)).join(ends, ["category", "end"], "left_semi")
        limits = F.sequence(F.greatest(F.size("ranks") - 1, F.lit(2)), F.lit(max_edges))
        if distinct:
            limits = F.slice(limits, 1, 1)
        return out.select("category", "path", "ranks", "end", F.explode(limits).alias("max_len")).withColumn(
            "max_len", F.col("max_len").cast("bigint")
        )

    def cut(rows: DataFrame) -> DataFrame:
        order = [F.get("ranks", F.lit(0)), F.col("max_len"), F.col("end"), F.col("ranks")]
        if cap is None:
            out = number_rows(rows, ["category"], order, "n")
        else:
            turn = F.row_number().over(Window.partitionBy("category").orderBy(*order))
            out = rows.withColumn("n", turn.cast("bigint")).filter(F.col("n") <= cap)
        return out.select("category", "n", "max_len", "path", "ranks")

    if cap is None:
        return cut(grow(most))
    limit = first_sources
    while True:
        rows = stage(cut(grow(limit)), "paths")
        if limit >= most:
            return rows
        more = sources.filter(F.col("turn") > limit).select("category").distinct()
        short = more.join(rows.filter(F.col("n") == cap).select("category").distinct(), "category", "left_anti")
        if short.isEmpty():
            return rows
        limit *= 2


def sub_sequences(path: Column) -> Column:
    """All contiguous parts of two or more members, by length, then by start."""
    n = F.size(path)
    return F.when(n < 2, F.array().cast("array<array<string>>")).otherwise(
        F.flatten(
            F.transform(
                F.sequence(F.lit(2), n),
                lambda size: F.transform(F.sequence(F.lit(1), n - size + 1), lambda at: F.slice(path, at, size)),
            )
        )
    )


def shortest_paths(edges: DataFrame) -> DataFrame:
    """Cheapest path between each two connected nodes, weights taken as costs.

    One row per pair with the lower rank first: (category, source, target, path,
    cost). Ties go to the lexicographically smallest path. Each round extends
    only the pairs that improved in the round before by one edge and keeps the
    best path per pair.
    """
    arcs = stage(_arcs(edges), "arcs")
    names = arcs.select("category", F.col("rp").alias("rs"), F.col("peer").alias("source")).distinct()
    best = stage(
        names.select("category", "rs", F.col("rs").alias("rt"), F.array("source").alias("path"),
                     F.lit(0.0).alias("cost"), F.lit(True).alias("fresh")),
        "best",
    )
    while True:
        longer = (
            best.filter("fresh")
            .withColumn("tail", F.col("rt"))
            .join(arcs, ["category", "tail"])
            .filter(~F.array_contains("path", F.col("peer")))
            .select(
                "category", "rs", F.col("rp").alias("rt"), F.array_append("path", F.col("peer")).alias("path"),
                F.round(F.col("cost") + F.col("w"), 10).alias("cost"), F.lit(True).alias("fresh"),
            )
        )
        choice = F.struct("cost", "path", "fresh")
        best = stage(
            best.withColumn("fresh", F.lit(False))
            .unionByName(longer)
            .groupBy("category", "rs", "rt")
            .agg(F.min(choice).alias("m"))
            .select("category", "rs", "rt", "m.path", "m.cost", "m.fresh"),
            "best",
        )
        if best.filter("fresh").isEmpty():
            break
    return best.filter("rs < rt").select(
        "category", F.get("path", F.lit(0)).alias("source"), F.element_at("path", -1).alias("target"), "path", "cost"
    )
