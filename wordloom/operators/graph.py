"""Keyword graph operators.

Edges are ``(category, a, b, ra, rb, w)``, one row per undirected edge with
``ra < rb``; ranks are the node order. Iterations stage their state each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.operators.ranking import number_rows
from wordloom.session import stage

MIN_WEIGHT = 7.0
MIN_SIZE = 3
ROUNDS = 2

EDGE = ["category", "a", "b", "ra", "rb", "w"]


def both_ways(edges: DataFrame) -> DataFrame:
    """(category, node, rn, peer, rp, w): every edge seen from both ends, in one scan."""
    ends = F.array(
        F.struct(F.col("a").alias("node"), F.col("ra").alias("rn"), F.col("b").alias("peer"), F.col("rb").alias("rp")),
        F.struct(F.col("b").alias("node"), F.col("rb").alias("rn"), F.col("a").alias("peer"), F.col("ra").alias("rp")),
    )
    return edges.select("category", F.explode(ends).alias("e"), "w").select("category", "e.*", "w")


def two_hop(edges: DataFrame, min_weight: float = MIN_WEIGHT) -> DataFrame:
    """Pairs of neighbours of a centre that are not adjacent: (.., rc, w), w the mean of both edges.

    A mean above the limit needs one edge above it, so of each pair the heavier
    edge is looked up first; wedges of two light edges are never formed.
    """
    seen = both_ways(edges)
    one = seen.select("category", F.col("node").alias("c"), F.col("rn").alias("rc"),
                      F.col("peer").alias("p"), F.col("rp").alias("r1"), F.col("w").alias("w1"))
    two = seen.select("category", F.col("node").alias("c"),
                      F.col("peer").alias("q"), F.col("rp").alias("r2"), F.col("w").alias("w2"))
    heavy = one.filter(F.col("w1") > min_weight)
    # The heavier edge (ties by rank) leads, so each unordered pair is formed once.
    lead = (F.col("w1") > F.col("w2")) | ((F.col("w1") == F.col("w2")) & (F.col("r1") < F.col("r2")))
    wedges = heavy.join(two, ["category", "c"]).filter(lead).withColumn(
        "w", (F.col("w1") + F.col("w2")) / 2
    ).filter(F.col("w") > min_weight)
    first = F.col("r1") < F.col("r2")
    pairs = wedges.select(
        "category",
        F.when(first, F.col("p")).otherwise(F.col("q")).alias("a"),
        F.when(first, F.col("q")).otherwise(F.col("p")).alias("b"),
        F.least("r1", "r2").alias("ra"),
        F.greatest("r1", "r2").alias("rb"),
        "rc",
        "w",
    )
    return pairs.join(edges.select("category", "a", "b"), ["category", "a", "b"], "left_anti")


def refine(
    edges: DataFrame,
    rounds: int = ROUNDS,
    min_weight: float = MIN_WEIGHT,
    cap: int | None = None,
) -> DataFrame:
    """Add transitive edges round by round, until a round adds none.

    A pair reached through several centres keeps the weight of the centre of
    highest rank. The cap counts such repeats and cuts by (centre, pair) rank.
    ``edges`` should be staged; the result is the union of staged tables.
    """
    current = edges.select(*EDGE)
    for _ in range(rounds):
        found = two_hop(current, min_weight)
        if cap is not None:
            order = [F.asc("rc"), F.asc("ra"), F.asc("rb")]
            found = number_rows(found, ["category"], order, "_n").filter(F.col("_n") <= cap)
        new = stage(
            found.groupBy("category", "a", "b", "ra", "rb").agg(F.max_by("w", "rc").alias("w")).select(*EDGE),
            "new-edges",
        )
        if new.isEmpty():
            break
        current = current.unionByName(new)
    return current


def connected(edges: DataFrame) -> DataFrame:
    """Neighbours of each keyword by weight, heaviest first, ties by rank.

    (category, keyword, rank, nested array<struct<keyword, weight>>). A list
    is at most as long as the keyword list of its category.
    """
    entry = F.struct((-F.col("w")).alias("k"), F.col("rp").alias("r"), F.col("peer").alias("t"))
    return (
        both_ways(edges)
        .groupBy("category", F.col("node").alias("keyword"), F.col("rn").alias("rank"))
        .agg(F.array_sort(F.collect_list(entry)).alias("n"))
        .select(
            "category", "keyword", "rank",
            F.transform("n", lambda x: F.struct(x["t"].alias("keyword"), (-x["k"]).alias("weight"))).alias("nested"),
        )
    )


def triangles(edges: DataFrame) -> DataFrame:
    """Each triangle once, as three edges (x, y, z with weights).

    Every edge is pointed from its end of lower degree, so a hub has few
    outgoing edges and no node forms pairs of all its neighbours.
    """
    seen = both_ways(edges)
    degree = seen.groupBy("category", "node").agg(F.count(F.lit(1)).alias("d"))
    da = degree.select("category", F.col("node").alias("a"), F.col("d").alias("da"))
    db = degree.select("category", F.col("node").alias("b"), F.col("d").alias("db"))
    forward = F.struct("da", "ra") < F.struct("db", "rb")
    arcs = stage(
        edges.join(da, ["category", "a"]).join(db, ["category", "b"]).select(
            "category",
            F.when(forward, F.col("a")).otherwise(F.col("b")).alias("u"),
            F.when(forward, F.col("b")).otherwise(F.col("a")).alias("v"),
            "w",
        ),
        "arcs",
    )
    one = arcs.select("category", F.col("u").alias("x"), F.col("v").alias("y"), F.col("w").alias("w_xy"))
    two = arcs.select("category", F.col("u").alias("x"), F.col("v").alias("z"), F.col("w").alias("w_xz"))
    close = arcs.select("category", F.col("u").alias("y"), F.col("v").alias("z"), F.col("w").alias("w_yz"))
    return one.join(two, ["category", "x"]).filter("y <> z").join(close, ["category", "y", "z"])


def node_sufficiency(
    nodes: DataFrame, edges: DataFrame, min_size: int = MIN_SIZE, min_weight: float = MIN_WEIGHT
) -> DataFrame:
    """For each keyword with its neighbours: size, strong edges inside, and whether it suffices.

    The strong edges are the keyword's own plus, per triangle it is part of, the
    edge opposite to it.
    """
    own = both_ways(edges).groupBy("category", F.col("node").alias("term")).agg(
        F.count(F.lit(1)).alias("degree"), F.count_if(F.col("w") >= min_weight).alias("own")
    )
    opposite = F.array(
        F.struct(F.col("x").alias("term"), F.col("w_yz").alias("w")),
        F.struct(F.col("y").alias("term"), F.col("w_xz").alias("w")),
        F.struct(F.col("z").alias("term"), F.col("w_xy").alias("w")),
    )
    across = (
        triangles(edges)
        .select("category", F.explode(opposite).alias("o"))
        .groupBy("category", F.col("o.term").alias("term"))
        .agg(F.count_if(F.col("o.w") >= min_weight).alias("across"))
    )
    strong = F.coalesce("own", F.lit(0)) + F.coalesce("across", F.lit(0))
    size = F.coalesce("degree", F.lit(0)) + 1
    return (
        nodes.select("category", "term", "rank")
        .join(own, ["category", "term"], "left")
        .join(across, ["category", "term"], "left")
        .select(
            "category", "term", "rank",
            size.alias("n_nodes"),
            strong.alias("strong_edges"),
            ((size >= min_size) & (strong >= min_size - 1)).alias("is_sufficient"),
        )
    )


def path_sufficiency(
    paths: DataFrame, edges: DataFrame, min_size: int = MIN_SIZE, min_weight: float = MIN_WEIGHT
) -> DataFrame:
    """Adds ``is_sufficient`` to node lists of a few members (``ranks``), keyed by ``path_id``."""
    n = F.size("ranks")
    index_pairs = F.flatten(
        F.transform(
            F.sequence(F.lit(0), n - 2),
            lambda i: F.transform(F.sequence(i + 1, n - 1), lambda j: F.struct(
                F.least(F.get("ranks", i), F.get("ranks", j)).alias("ra"),
                F.greatest(F.get("ranks", i), F.get("ranks", j)).alias("rb"),
            )),
        )
    )
    inside = (
        paths.filter(n >= 2)
        .select("category", "path_id", F.explode(index_pairs).alias("p"))
        .select("category", "path_id", "p.ra", "p.rb")
        .join(edges.filter(F.col("w") >= min_weight).select("category", "ra", "rb"), ["category", "ra", "rb"])
        .groupBy("category", "path_id")
        .agg(F.count(F.lit(1)).alias("strong"))
    )
    return paths.join(inside, ["category", "path_id"], "left").withColumn(
        "is_sufficient", (n >= min_size) & (F.coalesce("strong", F.lit(0)) >= min_size - 1)
    ).drop("strong")


def sample_nodes(nodes: DataFrame, n: int, seed: str = "0") -> DataFrame:
    """At most n nodes per category, chosen by a seeded hash."""
    order = Window.partitionBy("category").orderBy(F.md5(F.concat(F.lit(seed), F.col("term"))), "term")
    return nodes.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n).drop("_n")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Connected component of each node, named by its lowest rank.

    Alternates the large-star and small-star steps (Kiveris et al., 2014): stars
    shrink the diameter fast and no node's neighbour list is ever collected.
    """

    def step(arcs: DataFrame, keep: str) -> DataFrame:
        seen = arcs.unionByName(arcs.select("category", F.col("v").alias("u"), F.col("u").alias("v")))
        near = seen if keep == "large" else seen.filter("v < u")
        low = near.groupBy("category", "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = near.join(low, ["category", "u"])
        if keep == "large":
            out = joined.filter("v > u").select("category", F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.select("category", F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                low.select("category", "u", F.col("m").alias("v"))
            )
        return out.filter("u <> v").select("category", "u", "v").distinct()

    arcs = stage(edges.select("category", F.col("rb").alias("u"), F.col("ra").alias("v")), "arcs")
    mark = None
    while True:
        arcs = stage(step(step(arcs, "large"), "small"), "arcs")
        row = arcs.agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("category", "u", "v")).alias("h")
        ).first()
        if (row.n, row.h) == mark:
            break
        mark = (row.n, row.h)
    root = arcs.groupBy("category", F.col("u").alias("rank")).agg(F.min("v").alias("root"))
    return nodes.join(root, ["category", "rank"], "left").select(
        "category", "term", "rank", F.coalesce("root", "rank").alias("component")
    )
