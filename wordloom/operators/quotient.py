"""The keyword graph with one node per class of equal columns.

All members of a class are linked to each other with the full weight and to other classes alike. So the graph between classes, with their
sizes, says all that the graph between terms does: refinement, degrees, strong edges and neighbours are
taken there in closed form, and no row is made per pair of members or per triangle through them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.operators import cliques, graph, paths
from wordloom.operators.similarity import WEIGHT_SCALE, ColumnGraph
from wordloom.session import stage


def class_edges(columns: ColumnGraph) -> DataFrame:
    """Links between classes as edges (category, a, b, ra, rb, w).

    A class is named by its lowest rank and ranked by its highest: where several centres lead from one keyword to
    another, the one of highest rank decides, and it is the last member of its class.
    """
    top = columns.members.groupBy("category", "class").agg(F.max("rank").alias("top"))
    side = lambda key, name: top.select("category", F.col("class").alias(key), F.col("class").cast("string").alias(name), F.col("top").alias("r" + name))
    met = columns.links.join(side("ca", "x"), ["category", "ca"]).join(side("cb", "y"), ["category", "cb"])
    first = F.col("rx") < F.col("ry")
    return met.select(
        "category", F.when(first, F.col("x")).otherwise(F.col("y")).alias("a"), F.when(first, F.col("y")).otherwise(F.col("x")).alias("b"),
        F.least("rx", "ry").alias("ra"), F.greatest("rx", "ry").alias("rb"), F.round(F.col("sim") * WEIGHT_SCALE, 10).alias("w"),
    )


def refine(columns: ColumnGraph, rounds: int = graph.ROUNDS, min_weight: float = graph.MIN_WEIGHT) -> DataFrame:
    """Class edges after transitive refinement, equal to refining the edges between terms.

    Two classes without a link have no member in common reach but through a third class, and all their members then have the same
    centres; members of one class are linked already.
    """
    return graph.refine(stage(class_edges(columns), "class-edges"), rounds, min_weight)


def expand(columns: ColumnGraph, edges: DataFrame) -> DataFrame:
    """Edges between terms (category, a, b, ra, rb, w) out of class edges, and those within the classes."""
    side = lambda key, name: columns.members.select(
        "category", F.col("class").cast("string").alias(key), F.col("term").alias(name), F.col("rank").alias("r" + name)
    )
    across = edges.select("category", F.col("a").alias("ca"), F.col("b").alias("cb"), "w")
    across = across.join(side("ca", "x"), ["category", "ca"]).join(side("cb", "y"), ["category", "cb"])
    first = F.col("rx") < F.col("ry")
    across = across.select(
        "category", F.when(first, F.col("x")).otherwise(F.col("y")).alias("a"), F.when(first, F.col("y")).otherwise(F.col("x")).alias("b"),
        F.least("rx", "ry").alias("ra"), F.greatest("rx", "ry").alias("rb"), "w",
    )
    many = columns.classes.filter("size > 1").select("category", F.col("class").cast("string").alias("c"))
    inside = side("c", "a").join(many, ["category", "c"]).join(side("c", "b"), ["category", "c"]).filter("ra < rb")
    return across.unionByName(inside.select("category", "a", "b", "ra", "rb", F.lit(WEIGHT_SCALE).alias("w")))


def class_sufficiency(columns: ColumnGraph, edges: DataFrame, min_size: int = graph.MIN_SIZE, min_weight: float = graph.MIN_WEIGHT) -> DataFrame:
    """(category, class, size, n_nodes, strong_edges, is_sufficient) of each class: what holds for each of its members.

    Among a member, its class and the classes linked to it lie: the pairs within each of these classes, the pairs between its own and
    each linked class, and those between two linked classes that are linked themselves: a triangle of classes.
    """
    sizes = columns.classes.select("category", F.col("class").cast("string").alias("c"), F.col("size").cast("long").alias("m"))
    pairs = lambda m: m * (m - 1) / 2
    whole = F.lit(1 if min_weight <= WEIGHT_SCALE else 0)
    seen = graph.both_ways(edges).select("category", F.col("node").alias("c"), F.col("peer").alias("p"), "w")
    strong = lambda w: F.when(w >= min_weight, 1).otherwise(0)
    linked = seen.join(sizes.select("category", F.col("c").alias("p"), F.col("m").alias("mp")), ["category", "p"])
    beside = linked.groupBy("category", "c").agg(
        F.sum("mp").alias("near"), F.sum(F.col("mp") * strong(F.col("w"))).alias("own"), F.sum(pairs(F.col("mp"))).alias("inside")
    )
    corner = F.explode(F.array(*[
        F.struct(F.col(c).alias("c"), F.col(f"w_{opposite}").alias("w"), F.col(opposite[0]).alias("p"), F.col(opposite[1]).alias("q"))
        for c, opposite in (("x", "yz"), ("y", "xz"), ("z", "xy"))
    ]))
    across = graph.triangles(edges).select("category", corner.alias("t")).select("category", "t.*").filter(F.col("w") >= min_weight)
    size_of = lambda key: sizes.select("category", F.col("c").alias(key), F.col("m").alias("m" + key))
    across = across.join(size_of("p"), ["category", "p"]).join(size_of("q"), ["category", "q"])
    across = across.groupBy("category", "c").agg(F.sum(F.col("mp") * F.col("mq")).alias("across"))
    zero = F.lit(0)
    met = sizes.join(beside, ["category", "c"], "left").join(across, ["category", "c"], "left")
    n_nodes = F.col("m") + F.coalesce("near", zero)
    count = whole * (pairs(F.col("m")) + F.coalesce("inside", zero)) + F.col("m") * F.coalesce("own", zero) + F.coalesce("across", zero)
    rows = met.select("category", F.col("c").cast("long").alias("class"), F.col("m").alias("size"), n_nodes.cast("long").alias("n_nodes"), count.cast("long").alias("strong_edges"))
    return rows.withColumn("is_sufficient", (F.col("n_nodes") >= min_size) & (F.col("strong_edges") >= min_size - 1))


def class_neighbours(columns: ColumnGraph, edges: DataFrame) -> DataFrame:
    """(category, class, size, nested array<struct<weight, class, size>>): linked classes, heaviest first, ties by name.

    A member's neighbours are the other members of its class and all members of these; the list has one entry per class.
    """
    sizes = columns.classes.select("category", F.col("class").cast("string").alias("c"), "size")
    seen = graph.both_ways(edges).select("category", F.col("node").alias("c"), F.col("peer").alias("p"), "w")
    entry = F.struct((-F.col("w")).alias("k"), F.col("p").cast("long").alias("class"), F.col("ps").alias("size"))
    lists = seen.join(sizes.select("category", F.col("c").alias("p"), F.col("size").alias("ps")), ["category", "p"]).groupBy("category", "c").agg(
        F.array_sort(F.collect_list(entry)).alias("n")
    )
    nested = F.transform(F.coalesce("n", F.array().cast(lists.schema["n"].dataType)), lambda x: F.struct((-x["k"]).alias("weight"), x["class"], x["size"]))
    return sizes.join(lists, ["category", "c"], "left").select("category", F.col("c").cast("long").alias("class"), "size", nested.alias("nested"))


def node_sufficiency(columns: ColumnGraph, edges: DataFrame, min_size: int = graph.MIN_SIZE, min_weight: float = graph.MIN_WEIGHT) -> DataFrame:
    """(category, term, rank, n_nodes, strong_edges, is_sufficient) of every term, from its class."""
    told = class_sufficiency(columns, edges, min_size, min_weight).drop("size")
    return columns.members.join(told, ["category", "class"]).select("category", "term", "rank", "n_nodes", "strong_edges", "is_sufficient")


def named(columns: ColumnGraph, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes as nodes (category, term, rank, size) and class edges between them: the class number as rank, its first keyword by name as term."""
    first = columns.members.groupBy("category", "class").agg(F.min("term").alias("term"))
    nodes = stage(first.join(columns.classes, ["category", "class"]).select("category", "term", F.col("class").alias("rank"), "size"), "class-nodes")
    side = lambda key, name: nodes.select("category", F.col("rank").cast("string").alias(key), F.col("term").alias(name), F.col("rank").alias("r" + name))
    across = edges.select("category", F.col("a").alias("ca"), F.col("b").alias("cb"), "w").join(side("ca", "a"), ["category", "ca"]).join(side("cb", "b"), ["category", "cb"])
    return nodes, stage(across.select("category", "a", "b", "ra", "rb", "w"), "named-edges")


def class_cliques(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(category, members, ranks, size): the maximal cliques of the classes, ``size`` being their number of keywords.

    Members of a class are linked to each other and to the same others, so a maximal clique of keywords holds all of a
    class or none of it: these are the cliques of the keywords, with one entry per class.
    """
    found = stage(cliques.maximal_cliques(nodes, edges).drop("size"), "cliques")
    sizes = found.select("category", "ranks", F.explode("ranks").alias("rank")).join(nodes.select("category", "rank", "size"), ["category", "rank"])
    sizes = sizes.groupBy("category", "ranks").agg(F.sum("size").cast("bigint").alias("size"))
    return stage(found.join(sizes, ["category", "ranks"]).select("category", "members", "ranks", "size"), "class-cliques")


def nested_keywords(columns: ColumnGraph, found: DataFrame) -> DataFrame:
    """Each keyword under the first clique that holds it: (category, nest, size). A class goes with its first keyword."""
    first = columns.members.groupBy("category", "class").agg(F.min("term").alias("head"))
    heads = columns.members.join(first, ["category", "class"]).select("category", "head", "term")
    nests = cliques.nested_keywords(found).select("category", "nest", F.explode("nest").alias("head"))
    return nests.join(heads, ["category", "head"]).groupBy("category", F.col("nest").alias("heads")).agg(F.array_sort(F.collect_list("term")).alias("nest")).select(
        "category", "nest", F.size("nest").cast("bigint").alias("size")
    )


def class_paths(edges: DataFrame) -> DataFrame:
    """Cheapest path between each two connected classes, as ``paths.shortest_paths``, over their first keywords.

    Members of two classes are linked alike, so a cheapest path never visits a class twice: between other members it is the same
    path with its ends put in their place, and the first names inside are the smallest, as ties ask. Two members of
    one class are one step apart, as any second step costs more than the full weight.
    """
    return paths.shortest_paths(edges)
