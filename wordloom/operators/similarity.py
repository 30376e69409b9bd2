"""Similarity graphs: all pairs above a cosine threshold, exact.

Nothing is cross-joined. Term columns are sparse: equal ones are taken together, and two of them meet only in a document
that both hold among their leading entries and only if what they have left can still lift them over the threshold.
Given vectors are dense: they are cut into blocks of bounded size, a task multiplies two blocks and returns matches.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructType

from wordloom.session import PASSES, discard, passes, passing, stage, stage_each

THRESHOLD = 0.7
WEIGHT_SCALE = 10.0
VECTOR_BLOCK = 2048
SLACK = 1e-9  # bounds keep what rounding to ten digits may still lift over the threshold
FOLDS = 64  # parts of a column whose norms bound a product
FOLD_STEPS = 60_000
SHARE = 4  # one document in so many is multiplied first
CELLS_PER_TASK = 2_000_000
PAIRS_PER_TASK = 2_000_000
CELLS_AT_ONCE = 1_000_000  # looked up in one step of a task
LEAST_TASKS = 8
LEAST_BLOCKS = 4
LEVELS = 8  # steps of document length per power of two


def _to_edges(pairs: DataFrame, threshold: float) -> DataFrame:
    return (
        pairs.withColumn("sim", F.round("sim", 10))
        .filter(F.col("sim") > threshold)
        .select("category", "a", "b", "ra", "rb", F.round(F.col("sim") * WEIGHT_SCALE, 10).alias("w"))
    )


def _with_block_pairs(rows: DataFrame, own: str, blocks: int) -> DataFrame:
    """Repeat each row for every pair of blocks that its block is part of."""
    pair = lambda other: F.struct(
        F.least(F.col(own), other).alias("bi"), F.greatest(F.col(own), other).alias("bj")
    )
    others = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), pair)
    return rows.withColumn("_pair", F.explode(others)).select("*", "_pair.bi", "_pair.bj").drop("_pair")


@dataclass(frozen=True)
class ColumnGraph:
    """Terms with equal columns as one node: the graph between these classes, and who is in them.

    ``links`` has class pairs (``ca < cb``, the rank of their first members) above the threshold, with the rounded
    cosine. Members of one class have cosine 1 with each other; no row is kept for such a pair.
    """

    classes: DataFrame  # (category, class, size)
    members: DataFrame  # (category, class, term, rank)
    links: DataFrame  # (category, ca, cb, sim)


def placed_columns(weights: DataFrame, keywords: DataFrame, threshold: float) -> DataFrame:
    """(category, doc_id, class, u, rest, df, h1, h2): the columns of the keywords, unit length, ``class`` being the keyword's own rank.

    All that is known of a column comes from one exchange by its term: its length, the number of its documents and two 64-bit sums over (document,
    weight) that tell unequal columns apart. ``rest`` as in ``leading_entries``, null for an entry that does not lead;
    documents are ordered by their number of terms if ``weights`` has ``n_terms``, else by the number of keywords they hold.
    """
    if "n_terms" not in weights.columns:
        held = weights.join(keywords.select("category", "term"), ["category", "term"])
        weights = held.withColumn("n_terms", F.count(F.lit(1)).over(Window.partitionBy("category", "doc_id")))
    level = F.floor(F.log2("n_terms") * LEVELS).cast("byte").alias("level")
    # Dealt by term before anything is derived, so that the exchange has these five columns alone and the join adds none.
    entries = weights.select("category", "term", "doc_id", "w", level).repartition("category", "term")
    entries = entries.join(keywords.select("category", "term", "rank"), ["category", "term"])
    column = Window.partitionBy("rank", "category", "term")
    square = F.col("w") * F.col("w")
    cell = lambda seed: F.bit_xor(F.xxhash64("doc_id", "w", F.lit(seed))).over(column)
    placed = entries.withColumn("later", F.sum(square).over(column.orderBy(F.desc("level"))))
    placed = placed.select(
        "category", "doc_id", F.col("rank").alias("class"), "w", F.sum(square).over(column).alias("norm2"),
        F.count(F.lit(1)).over(column).alias("df"), cell(1).alias("h1"), cell(2).alias("h2"), "later",
    )
    rest = F.col("later") / F.col("norm2")
    return placed.select(
        "category", "doc_id", "class", (F.col("w") / F.sqrt("norm2")).alias("u"),
        F.when(rest >= threshold * threshold - SLACK, rest).alias("rest"), "df", "h1", "h2",
    )


def column_classes(placed: DataFrame) -> DataFrame:
    """(category, rank, class): terms with the same weight in the same documents share a class, named by its lowest rank."""
    marked = stage(placed.select("category", F.col("class").alias("rank"), "df", "h1", "h2").distinct(), "columns")
    key = ["category", "df", "h1", "h2"]
    first = marked.groupBy(*key).agg(F.min("rank").alias("class"))
    return marked.join(first, key).select("category", "rank", "class")


def leading_entries(units: DataFrame, threshold: float) -> DataFrame:
    """(category, doc_id, class, u, rest): the entries by which a column can meet another above the threshold.

    Documents are ordered by how many columns they hold, fewest first, in steps. ``rest`` is the squared norm of an entry and all that
    come at its step or later. Entries whose ``rest`` is below the squared threshold are left out: what begins there
    cannot reach it, so two columns above the threshold share a leading entry, and the first document they share is one.
    """
    held = units.groupBy("category", "doc_id").agg(F.floor(F.log2(F.count(F.lit(1))) * LEVELS).cast("int").alias("level"))
    placed = stage(units.join(held, ["category", "doc_id"]), "units")
    mass = placed.groupBy("category", "class", "level").agg(F.sum(F.col("u") * F.col("u")).alias("mass"))
    later = Window.partitionBy("category", "class").orderBy(F.desc("level"))
    rest = mass.select("category", "class", "level", F.sum("mass").over(later).alias("rest"))
    leading = rest.filter(F.col("rest") >= threshold * threshold - SLACK)
    return placed.join(leading, ["category", "class", "level"]).select("category", "doc_id", "class", "u", "rest")


def candidate_pairs(leading: DataFrame, threshold: float) -> DataFrame:
    """(category, ca, cb): columns that may lie above the threshold, by the bound at each leading entry they share.

    At the first document two columns share, their product is at most the product of these entries plus that of
    the norms of what is left. The join itself drops pairs whose bound stays below.
    """
    left = lambda alias: F.sqrt(F.greatest(F.col(f"{alias}.rest") - F.col(f"{alias}.u") * F.col(f"{alias}.u"), F.lit(0.0)))
    x, y = leading.alias("x"), leading.alias("y")
    bound = F.col("x.u") * F.col("y.u") + left("x") * left("y")
    on = (
        (F.col("x.category") == F.col("y.category")) & (F.col("x.doc_id") == F.col("y.doc_id"))
        & (F.col("x.class") < F.col("y.class")) & (bound >= threshold - SLACK)
    )
    return x.join(y, on).select("x.category", F.col("x.class").alias("ca"), F.col("y.class").alias("cb")).distinct()


def folded_norms(units: DataFrame) -> DataFrame:
    """(category, class, folds): the norms of a column in ``FOLDS`` parts of the documents, rounded up to ``FOLD_STEPS`` steps, as 16-bit numbers.

    Rows of one column that follow each other make one row. A column may have several: the norms of a whole are at most the sums of theirs.
    """
    folds, steps = FOLDS, FOLD_STEPS
    placed = units.select("category", "class", F.pmod(F.xxhash64("doc_id"), F.lit(folds)).cast("int").alias("at"), "u")

    def folded(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def told(category, owner, sums):
            norms = np.minimum(np.ceil(np.sqrt(sums) * (1 + 1e-9) * steps), 65535).astype("<u2")
            return pa.RecordBatch.from_arrays([category, pa.array(owner), pa.array([n.tobytes() for n in norms], pa.binary())], names=["category", "class", "folds"])

        last = None  # category, class and sums of the column that the next batch may go on with
        for batch in batches:
            if not len(batch):
                continue
            owner, category = batch.column("class").to_numpy(), pc.dictionary_encode(batch.column("category"), null_encoding="encode").indices.to_numpy()
            new = (np.diff(owner, prepend=owner[0] - 1) != 0) | (np.diff(category, prepend=category[0]) != 0)
            begin, run = np.flatnonzero(new), np.cumsum(new) - 1
            u = batch.column("u").to_numpy()
            sums = np.bincount(run * folds + batch.column("at").to_numpy(), u * u, len(begin) * folds).reshape(-1, folds)
            names, owners = batch.column("category").take(pa.array(begin)), owner[begin]
            if last is not None:
                if last[0][0] == names[0] and last[1][0] == owners[0]:
                    sums[0] += last[2][0]
                else:
                    yield told(*last)
            if len(begin) > 1:
                yield told(names[:-1], owners[:-1], sums[:-1])
            last = (names[-1:], owners[-1:], sums[-1:])
        if last is not None:
            yield told(*last)

    return placed.mapInArrow(folded, StructType([placed.schema["category"], placed.schema["class"]]).add("folds", BinaryType()))


def near_pairs(norms: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose norms (``folded_norms``) let their product reach the threshold; staged.

    Pairs are cut by column into parts of bounded size; the norms of a column go to the parts that name it, a few bytes each.
    Many parts are taken in a few passes, so that the norms lie in the exchange for some of the parts at a time.
    """
    blocks = max(LEAST_BLOCKS, math.ceil(pairs.count() / PAIRS_PER_TASK))
    turns = min(PASSES, blocks // LEAST_BLOCKS)
    norms = stage(norms, "norms") if turns > 1 else norms
    cut = pairs.withColumn("block", F.pmod(F.xxhash64("ca"), F.lit(blocks)).cast("int"))
    named = stage(cut.select("category", F.explode(F.array("ca", "cb")).alias("class"), "block").distinct(), "named")
    folds, least, at_once = FOLDS, (threshold - SLACK) * FOLD_STEPS**2, CELLS_AT_ONCE // FOLDS

    def bounded(norms: pa.Table, pairs: pa.Table) -> pa.Table:
        import numpy as np
        import pyarrow as pa

        pairs = pairs.select(["category", "ca", "cb"])
        if not len(pairs) or not len(norms):
            return pairs.slice(0, 0)
        names, row = np.unique(norms["class"].to_numpy(), return_inverse=True)
        table = np.zeros((len(names), folds), dtype=np.float32)
        step = np.concatenate([np.frombuffer(b"".join(c.to_pylist()), dtype="<u2") for c in norms["folds"].chunks]).reshape(-1, folds)
        np.add.at(table, row, step)
        ia, ib = (np.minimum(np.searchsorted(names, c.to_numpy()), len(names) - 1) for c in (pairs["ca"], pairs["cb"]))
        bound = np.concatenate([
            np.einsum("ij,ij->i", table[ia[i:i + at_once]].astype(np.float64), table[ib[i:i + at_once]].astype(np.float64)) for i in range(0, len(ia), at_once)
        ])
        held = (names[ia] == pairs["ca"].to_numpy()) & (names[ib] == pairs["cb"].to_numpy())
        return pairs.filter(pa.array(held & (bound >= least)))

    key = ["category", "block"]

    def part(i: int) -> DataFrame:
        turn = F.col("block") % turns == i
        sent = norms.join(named.filter(turn), ["category", "class"]).select("category", "block", "class", "folds")
        return sent.groupBy(*key).cogroup(cut.filter(turn).groupBy(*key)).applyInArrow(bounded, cut.select("category", "ca", "cb").schema)

    return stage_each((part(i) for i in range(turns)), "near-pairs")


def pair_products(cells: DataFrame, pairs: DataFrame, least_slices: int = LEAST_TASKS) -> DataFrame:
    """(category, ca, cb, dot): the product of the two columns of each pair, 0 without a common place.

    ``cells`` is (category, class, at, v), ``pairs`` (category, ca, cb); both should be staged. No row is made per pair and cell: the cells
    are cut by place and the pairs by column into parts of bounded size, a task multiplies one part of each.
    A cell goes to the parts of the pairs that name its column.
    """
    slices = max(least_slices, math.ceil(cells.count() / CELLS_PER_TASK))
    blocks = max(math.ceil(LEAST_TASKS / slices), math.ceil(pairs.count() / PAIRS_PER_TASK))
    cut = pairs.withColumn("block", F.pmod(F.xxhash64("ca"), F.lit(blocks)).cast("int"))
    named = stage(cut.select("category", F.explode(F.array("ca", "cb")).alias("class"), "block").distinct(), "named")
    sent = cells.filter(F.col("at").isNotNull()).join(named, ["category", "class"]).select(
        "category", F.pmod(F.xxhash64("at"), F.lit(slices)).cast("int").alias("slice"), "block", "class", "at", "v"
    )
    asked = cut.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).select("category", "slice", "block", "ca", "cb")
    at_once = CELLS_AT_ONCE

    def products(cells: pa.Table, pairs: pa.Table) -> pa.Table:
        """One row per pair, ``dot`` summed over the cells (class, at, v) that its two columns have here; both tables are bounded."""
        import numpy as np
        import pyarrow as pa

        ca, cb = pairs["ca"].to_numpy(), pairs["cb"].to_numpy()
        dot = np.zeros(len(ca))
        if len(cells) and len(ca):
            place = cells["at"].combine_chunks().dictionary_encode()
            place = (place.combine_chunks() if isinstance(place, pa.ChunkedArray) else place).indices.to_numpy()
            owner, value = cells["class"].to_numpy(), cells["v"].to_numpy()
            order = np.argsort(owner, kind="stable")
            owner, place, value = owner[order], place[order], value[order]
            names, begin = np.unique(owner, return_index=True)
            size = np.diff(np.append(begin, len(owner)))
            ia, ib = (np.minimum(np.searchsorted(names, c), len(names) - 1) for c in (ca, cb))
            held = np.flatnonzero((names[ia] == ca) & (names[ib] == cb))
            # The longer column is spread out over the places, the shorter ones of its pairs are looked up there.
            long, short = np.where(size[ia] >= size[ib], ia, ib)[held], np.where(size[ia] >= size[ib], ib, ia)[held]
            order = np.argsort(long, kind="stable")
            held, long, short = held[order], long[order], short[order]
            work = np.cumsum(size[short])
            cuts = np.flatnonzero((np.diff(long, prepend=-1) != 0) | (np.diff(work // at_once, prepend=-1) != 0))
            spread = np.zeros(int(place.max()) + 1)
            for lo, hi in zip(cuts, np.append(cuts[1:], len(held))):
                own = slice(begin[long[lo]], begin[long[lo]] + size[long[lo]])
                np.add.at(spread, place[own], value[own])
                n = size[short[lo:hi]]
                first = np.cumsum(n) - n
                index = np.arange(n.sum()) + np.repeat(begin[short[lo:hi]] - first, n)
                dot[held[lo:hi]] = np.add.reduceat(spread[place[index]] * value[index], first)
                spread[place[own]] = 0.0
        return pa.table({"category": pairs["category"], "ca": pairs["ca"], "cb": pairs["cb"], "dot": pa.array(dot)})

    def multiply(left: pa.Table, right: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        found = products(left, right)
        # Every pair is told once at least, by the first slice.
        if len(right) and right["slice"][0].as_py() != 0:
            found = found.filter(pc.not_equal(found["dot"], 0.0))
        return found

    key = ["category", "slice", "block"]
    parts = sent.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(multiply, "category string, ca bigint, cb bigint, dot double")
    return parts.groupBy("category", "ca", "cb").agg(F.sum("dot").alias("dot"))


def probable_pairs(pairs: DataFrame, units: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose product can still reach the threshold: by the norms of their parts, then by the entries of a part of the documents.

    Norms of few parts tell short columns apart. Long ones have about the same norm in each part; of them ``1 / SHARE`` of the
    documents are multiplied, and what the others may add is at most the product of the norms there.
    """
    key = ["category", "ca", "cb"]
    near = near_pairs(folded_norms(units), pairs, threshold)
    # Another seed than that of the parts and slices.
    seen = units.filter(F.pmod(F.xxhash64("doc_id", F.lit("share")), F.lit(SHARE)) == 0)
    mass = stage(seen.groupBy("category", "class").agg(F.sum(F.col("u") * F.col("u")).alias("mass")), "mass")
    part = lambda side: mass.select("category", F.col("class").alias(f"c{side}"), F.col("mass").alias(f"m{side}"))
    rest = lambda side: F.greatest(1 - F.coalesce(f"m{side}", F.lit(0.0)), F.lit(0.0))
    told = pair_products(seen.select("category", "class", F.col("doc_id").alias("at"), F.col("u").alias("v")), near)
    told = told.join(part("a"), ["category", "ca"], "left").join(part("b"), ["category", "cb"], "left")
    return told.filter(F.col("dot") + F.sqrt(rest("a") * rest("b")) >= threshold - SLACK).select(*key)


def _turn(n: int, *by: str):
    return F.pmod(F.xxhash64(*by, F.lit("turn")), F.lit(n))


def named_entries(units: DataFrame, pairs: DataFrame) -> DataFrame:
    """The entries of the columns that ``pairs`` names; staged, column after column in a few passes."""
    names = stage(pairs.select("category", F.explode(F.array("ca", "cb")).alias("class")).distinct(), "names")
    n = passes(units.count())
    turn, by = _turn(n, "class"), ["category", "class"]
    return stage_each((units.filter(turn == i).join(names.filter(turn == i), by, "left_semi") for i in range(n)), "entries")


def column_graph(weights: DataFrame, keywords: DataFrame, threshold: float = THRESHOLD) -> ColumnGraph:
    """The exact similarity graph of TF-IDF columns, one node per class of equal columns.

    ``weights`` is (category, doc_id, term, w), ``keywords`` (category, term, rank); both should be staged.
    """
    return graph_of(column_units(weights, keywords, threshold), keywords, threshold)


def column_units(weights: DataFrame, keywords: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``placed_columns``, staged in a few passes; the weights are not needed after it."""
    # Without the terms of a document given they are counted over all keywords, so there are no parts.
    n = passes(weights.count()) if "n_terms" in weights.columns else 1
    turn = _turn(n, "category", "term")
    return stage_each((placed_columns(weights.filter(turn == i), keywords.filter(turn == i), threshold) for i in range(n)), "units")


def graph_of(units: DataFrame, keywords: DataFrame, threshold: float = THRESHOLD) -> ColumnGraph:
    """``column_graph`` out of ``column_units``, which are removed as soon as they are read for the last time."""
    classed = stage(column_classes(units), "classes")
    # Only the first of a class is compared with others; no other is named by a pair.
    heads = classed.filter("rank = class").select("category", "class")
    leading = units.filter(F.col("rest").isNotNull()).select("category", "doc_id", "class", "u", "rest").join(heads, ["category", "class"])
    candidates = stage(candidate_pairs(leading, threshold), "candidates")
    with passing():
        pairs = stage(probable_pairs(candidates, units, threshold), "probable", keep=True)
    discard(candidates)
    entries = named_entries(units.select("category", "doc_id", "class", "u"), pairs)
    discard(units)
    dots = pair_products(entries.select("category", "class", F.col("doc_id").alias("at"), F.col("u").alias("v")), pairs)
    sims = dots.select("category", "ca", "cb", F.round("dot", 10).alias("sim"))
    members = classed.join(keywords.select("category", "term", "rank"), ["category", "rank"]).select("category", "class", "term", "rank")
    graph = ColumnGraph(
        stage(classed.groupBy("category", "class").agg(F.count(F.lit(1)).alias("size")), "class-sizes", keep=True),
        stage(members, "members", keep=True),
        stage(sims.filter(F.col("sim") > threshold), "class-links", keep=True),
    )
    discard(entries)
    return graph


def member_edges(graph: ColumnGraph) -> DataFrame:
    """Every edge between terms: those between members of linked classes, and those within a class."""
    side = lambda key, name: graph.members.select("category", F.col("class").alias(key), F.col("term").alias(name), F.col("rank").alias("r" + name))
    across = graph.links.join(side("ca", "x"), ["category", "ca"]).join(side("cb", "y"), ["category", "cb"])
    first = F.col("rx") < F.col("ry")
    turned = across.select(
        "category", F.when(first, F.col("x")).otherwise(F.col("y")).alias("a"), F.when(first, F.col("y")).otherwise(F.col("x")).alias("b"),
        F.least("rx", "ry").alias("ra"), F.greatest("rx", "ry").alias("rb"), "sim",
    )
    many = graph.classes.filter("size > 1").select("category", F.col("class").alias("c"))
    inside = side("c", "a").join(many, ["category", "c"]).join(side("c", "b"), ["category", "c"]).filter("ra < rb")
    return turned.unionByName(inside.select("category", "a", "b", "ra", "rb", F.lit(1.0).alias("sim"))).select(
        "category", "a", "b", "ra", "rb", F.round(F.col("sim") * WEIGHT_SCALE, 10).alias("w")
    )


def term_edges(weights: DataFrame, keywords: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Edges between keywords whose TF-IDF columns have cosine above the threshold, one row per pair of keywords."""
    return member_edges(column_graph(weights, keywords, threshold))


def vector_edges(vectors: DataFrame, threshold: float, block_rows: int = VECTOR_BLOCK) -> DataFrame:
    """Edges between terms whose given vectors have cosine above the threshold.

    ``vectors`` is (category, term, rank, embedding). Missing and zero vectors
    are left out. Each task sees two blocks of about ``block_rows`` vectors.
    """
    usable = vectors.filter(F.col("embedding").isNotNull() & F.exists("embedding", lambda x: x != 0))
    n = usable.count()
    blocks = max(1, math.ceil(n / block_rows))
    rows = usable.withColumn("blk", F.pmod(F.xxhash64("category", "rank"), F.lit(blocks)).cast("int"))
    paired = _with_block_pairs(rows, "blk", blocks)

    def matches(key, pdf):
        import numpy as np
        import pandas as pd

        category, bi, bj = key

        def unit(part):
            m = np.stack(part["embedding"].to_numpy()).astype(np.float64)
            return m / np.linalg.norm(m, axis=1, keepdims=True)

        left = pdf[pdf["blk"] == bi].reset_index(drop=True)
        right = pdf[pdf["blk"] == bj].reset_index(drop=True)
        empty = pd.DataFrame({"category": [], "a": [], "b": [], "ra": [], "rb": [], "sim": []})
        if not len(left) or not len(right):
            return empty
        sim = unit(left) @ unit(right).T
        i, j = np.nonzero(sim > threshold - 1e-9)
        ri, rj = left["rank"].to_numpy()[i], right["rank"].to_numpy()[j]
        keep = ri < rj if bi == bj else ri != rj
        i, j, ri, rj = i[keep], j[keep], ri[keep], rj[keep]
        flip = ri > rj
        ti, tj = left["term"].to_numpy()[i], right["term"].to_numpy()[j]
        return pd.DataFrame(
            {
                "category": category,
                "a": np.where(flip, tj, ti), "b": np.where(flip, ti, tj),
                "ra": np.where(flip, rj, ri), "rb": np.where(flip, ri, rj),
                "sim": sim[i, j],
            }
        )

    pairs = paired.groupBy("category", "bi", "bj").applyInPandas(
        matches, "category string, a string, b string, ra bigint, rb bigint, sim double"
    )
    return _to_edges(pairs, threshold)
