import math
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.operators import cliques, graph, path_index, paths, quotient, similarity

NODES = "category string, term string, rank bigint"
EDGES = "category string, a string, b string, ra bigint, rb bigint, w double"
KEYS = "category string, keyword string"


def name(i):
    return f"n{i:02d}"


def random_graph(seed, n=9, p=0.3):
    rnd = random.Random(seed)
    return {(i, j): round(rnd.uniform(7.01, 10), 3) for i, j in itertools.combinations(range(1, n + 1), 2) if rnd.random() < p}


def frames(spark, edges, n=9):
    nodes = spark.createDataFrame([("c", name(i), i) for i in range(1, n + 1)], NODES)
    rows = [("c", name(i), name(j), i, j, w) for (i, j), w in edges.items()]
    return nodes, spark.createDataFrame(rows, EDGES)


def around(edges, n=9):
    near = {i: {} for i in range(1, n + 1)}
    for (i, j), w in edges.items():
        near[i][j] = near[j][i] = w
    return near


def brute_refine(edges, rounds, cap=None, low=7.0, n=9):
    edges = dict(edges)
    for _ in range(rounds):
        near, found = around(edges, n), []
        for c in sorted(near):
            for p, q in itertools.combinations(sorted(near[c]), 2):
                mean = (near[c][p] + near[c][q]) / 2
                if q not in near[p] and mean > low:
                    found.append(((p, q), mean))
        if cap is not None:
            found = found[:cap]
        if not found:
            break
        edges.update(dict(found))
    return edges


@pytest.mark.parametrize("seed,cap", [(1, None), (2, 3), (3, 5)])
def test_refine(spark, seed, cap):
    edges = random_graph(seed)
    if seed == 2:  # light edges: some means fail
        edges = {k: w - 2 for k, w in edges.items()}
    _, df = frames(spark, edges)
    got = {(r.ra, r.rb): r.w for r in graph.refine(df, rounds=2, cap=cap).collect()}
    assert got == brute_refine(edges, 2, cap)


def test_refine_last_centre_wins(spark):
    edges = {(1, 2): 8.0, (1, 3): 8.0, (2, 4): 10.0, (3, 4): 9.0}
    _, df = frames(spark, edges, 4)
    got = {(r.ra, r.rb): r.w for r in graph.refine(df, rounds=1, cap=None).collect()}
    assert got[(2, 3)] == 9.5 and got[(1, 4)] == 8.5


@pytest.mark.parametrize("seed", [4, 5])
def test_sufficiency(spark, seed):
    edges = {k: w - 1 for k, w in random_graph(seed, p=0.4).items()}
    nodes, df = frames(spark, edges)
    near = around(edges)
    for r in graph.node_sufficiency(nodes, df).collect():
        inside = {r["rank"], *near[r["rank"]]}
        strong = sum(w >= 7 for (i, j), w in edges.items() if i in inside and j in inside)
        assert (r.n_nodes, r.strong_edges, r.is_sufficient) == (len(inside), strong, len(inside) >= 3 and strong >= 2)


def test_sufficiency_is_degree_two_when_all_edges_are_strong(spark):
    edges = random_graph(6)
    nodes, df = frames(spark, edges)
    near = around(edges)
    assert {r["rank"]: r.is_sufficient for r in graph.node_sufficiency(nodes, df).collect()} == {i: len(near[i]) >= 2 for i in near}


def test_connected_order(spark):
    _, df = frames(spark, {(1, 2): 8.0, (1, 3): 9.0, (1, 4): 8.0}, 4)
    row = graph.connected(df).filter("rank = 1").first()
    assert [(x.keyword, x.weight) for x in row.nested] == [("n03", 9.0), ("n02", 8.0), ("n04", 8.0)]


def brute_cliques(edges, n=9):
    near = around(edges, n)
    full = [set(s) for k in range(1, n + 1) for s in itertools.combinations(range(1, n + 1), k)
            if all(b in near[a] for a, b in itertools.combinations(s, 2))]
    return {tuple(sorted(s)) for s in full if not any(s < t for t in full)}


@pytest.mark.parametrize("seed,p", [(7, 0.3), (8, 0.6), (9, 0.9)])
def test_maximal_cliques_and_nesting(spark, seed, p):
    edges = random_graph(seed, p=p)
    nodes, df = frames(spark, edges)
    found = cliques.maximal_cliques(nodes, df).cache()
    want = brute_cliques(edges)
    assert {tuple(r.ranks) for r in found.collect()} == want
    order = sorted(want, key=lambda c: (-len(c), [name(i) for i in c]))
    used, nests = set(), set()
    for c in order:
        rest = tuple(name(i) for i in c if i not in used)
        used |= set(c)
        if rest:
            nests.add(rest)
    assert {tuple(r.nest) for r in cliques.nested_keywords(found).collect()} == nests


def brute_paths(edges, sample, cap=None, n=9):
    near, out = around(edges, n), []

    def walk(path, target, limit):
        if path[-1] == target:
            yield path
        elif len(path) <= limit:
            for x in sorted(near[path[-1]]):
                if x not in path:
                    yield from walk(path + [x], target, limit)

    for s in sample:
        for limit in (2, 3):
            for t in sample:
                if t != s:
                    out += [(limit, p) for p in walk([s], t, limit)]
    return out[:cap] if cap else out


@pytest.mark.parametrize("seed,cap", [(10, None), (11, 20), (12, 500)])
def test_simple_paths(spark, seed, cap):
    edges = random_graph(seed)
    nodes, df = frames(spark, edges)
    sample = [1, 2, 3, 5, 6, 8]
    got = paths.simple_paths(nodes.filter(F.col("rank").isin(sample)), df, cap=cap, first_sources=1).orderBy("n").collect()
    assert [(r.max_len, r.ranks) for r in got] == brute_paths(edges, sample, cap)
    once = paths.simple_paths(nodes, df, cap=None, distinct=True).collect()
    assert len({tuple(r.ranks) for r in once}) == len(once)


def test_sub_sequences(spark):
    row = spark.createDataFrame([(list("abc"), ["a"])], "x array<string>, y array<string>").select(
        paths.sub_sequences(F.col("x")), paths.sub_sequences(F.col("y"))).first()
    assert row[0] == [["a", "b"], ["b", "c"], ["a", "b", "c"]] and row[1] == []


@pytest.mark.parametrize("seed,shift", [(13, 0), (14, 6.9)])
def test_shortest_paths_and_nesting(spark, seed, shift):
    edges = {k: round(w - shift, 3) for k, w in random_graph(seed).items()}
    nodes, df = frames(spark, edges)
    near, best = around(edges), {}
    for s in range(1, 10):
        todo = [(0.0, [name(s)], s)]
        while todo:
            cost, path, at = todo.pop()
            key = (round(cost, 9), path)
            if (s, at) not in best or key < best[(s, at)]:
                best[(s, at)] = key
            todo += [(cost + w, path + [name(x)], x) for x, w in near[at].items() if name(x) not in path]
    want = {(name(s), name(t)): p for (s, t), (_, p) in best.items() if s < t}
    short = paths.shortest_paths(df).cache()
    assert {(r.source, r.target): r.path for r in short.collect()} == want
    if shift == 0:  # weights in (7, 10]: only single edges lie in a clique
        held = cliques.nested_paths(short, cliques.maximal_cliques(nodes, df)).collect()
        assert all((r.clique is not None) == (len(r.path) == 2) for r in held)


def test_components(spark):
    edges = {(1, 2): 8.0, (2, 3): 8.0, (5, 9): 8.0, (6, 9): 8.0, (4, 6): 8.0}
    nodes, df = frames(spark, edges)
    got = {r.term: r.component for r in graph.components(nodes, df).collect()}
    assert got == {name(i): c for i, c in {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4, 9: 4, 7: 7, 8: 8}.items()}


def test_components_of_a_long_chain(spark):
    n = 60
    order = list(range(1, n + 1))
    random.Random(1).shuffle(order)
    edges = {tuple(sorted(e)): 8.0 for e in zip(order, order[1:])}
    nodes, df = frames(spark, edges, n)
    assert {r.component for r in graph.components(nodes, df).collect()} == {1}


def test_vector_edges_over_several_blocks(spark):
    rnd = np.random.default_rng(0)
    v = rnd.normal(size=(40, 6)).astype(np.float32)
    v[7] = v[3]
    v[9] = 0
    rows = [("c", name(i), i, v[i].tolist() if i != 11 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "category string, term string, rank bigint, embedding array<float>")
    got = {(r.ra, r.rb): r.w for r in similarity.vector_edges(df, 0.5, block_rows=7).collect()}
    x = v.astype(float)
    want = {}
    for i, j in itertools.combinations([k for k in range(40) if k not in (9, 11)], 2):
        s = x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j])
        if s > 0.5:
            want[(i, j)] = 10 * s
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-8 for k in want)
    assert got[(3, 7)] == 10.0


@pytest.mark.parametrize("threshold", [0.4, 0.7, 0.9])
def test_term_edges_are_all_pairs_above_the_threshold(spark, threshold):
    rnd = np.random.default_rng(1)
    m = rnd.random((60, 40)) * (rnd.random((60, 40)) < 0.2)
    m[:, 4] = 2 * m[:, 2]  # cosine 1, but not equal
    m[:, 7] = m[:, 11] = m[:, 13] = m[:, 2]  # a class of four
    m[:, 20] = m[:, 21] * (1 + 0.2 * rnd.random(60))
    m[:, 30] = m[:, 31] = 0
    m[5, 30] = m[5, 31] = 0.5  # a class in one document
    weights = [("c", d, name(t), float(m[d, t])) for d in range(60) for t in range(40) if m[d, t]]
    w = spark.createDataFrame(weights, "category string, doc_id bigint, term string, w double")
    k = spark.createDataFrame([("c", name(t), t + 1) for t in range(40)], NODES)
    graph_ = similarity.column_graph(w, k, threshold)
    got = {(r.ra - 1, r.rb - 1): r.w for r in similarity.member_edges(graph_).collect()}
    unit = m / np.linalg.norm(m, axis=0)
    sim = unit.T @ unit
    want = {(i, j): 10 * sim[i, j] for i, j in itertools.combinations(range(40), 2) if round(sim[i, j], 10) > threshold}
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-8 for p in want)
    assert {r["size"] for r in graph_.classes.filter("class IN (3, 31)").collect()} == {4, 2}


def test_pairs_below_the_bound_do_not_leave_the_join(spark):
    # a hub document that holds every column, and one document of its own for each
    rows = [("c", 0, name(t), 0.1) for t in range(300)] + [("c", 1 + t, name(t), 0.9) for t in range(300)]
    rows += [("c", 1000, name(t), 0.5) for t in (300, 301)] + [("c", 1001, name(t), 0.5 + t / 1e4) for t in (300, 301)]
    w = spark.createDataFrame(rows, "category string, doc_id bigint, term string, w double")
    units = w.selectExpr("category", "doc_id", "CAST(substring(term, 2) AS BIGINT) AS class", "w AS u")
    norms = units.groupBy("class").agg(F.sqrt(F.sum(F.col("u") * F.col("u"))).alias("norm"))
    units = units.join(norms, "class").select("category", "doc_id", "class", (F.col("u") / F.col("norm")).alias("u"))
    leading = similarity.leading_entries(units, 0.9)
    assert leading.filter("doc_id = 0").count() == 0
    assert [(r.ca, r.cb) for r in similarity.candidate_pairs(leading, 0.9).collect()] == [(300, 301)]


def test_sample_is_seeded(spark):
    nodes, _ = frames(spark, {(1, 2): 8.0}, 50)
    pick = lambda seed: {r.term for r in graph.sample_nodes(nodes, 10, seed).collect()}
    assert pick("a") == pick("a") and len(pick("a")) == 10 and pick("a") != pick("b")


@pytest.mark.parametrize("seed,n,p", [(1, 9, 0.3), (2, 7, 0.9), (3, 12, 0.15)])
def test_path_index_counts_and_reads_every_path(spark, seed, n, p):
    nodes, edges = frames(spark, random_graph(seed, n, p), n)
    want = [(r.n, r.max_len, r.path, r.ranks) for r in paths.simple_paths(nodes, edges).orderBy("n").collect()]
    index = path_index.path_index(edges).cache()
    counted = {}
    for _, limit, _, ranks in want:
        counted[ranks[0], limit, ranks[-1]] = counted.get((ranks[0], limit, ranks[-1]), 0) + 1
    assert {(r.rs, r.max_len, r.rt): r.n_paths for r in index.collect()} == counted
    assert index.agg(F.sum("n_paths")).first()[0] == len(want)
    for low, high in ((1, len(want)), (3, 3), (len(want) // 2, len(want) // 2 + 10), (len(want) + 1, len(want) + 9)):
        got = [(r.n, r.max_len, r.path, r.ranks) for r in path_index.read_paths(index, edges, low, high).orderBy("n").collect()]
        assert got == want[low - 1 : high]


def test_path_index_between_given_ends(spark):
    nodes, edges = frames(spark, random_graph(5, 10, 0.4), 10)
    some = nodes.filter("rank IN (1, 4, 5, 9)")
    want = [(r.max_len, r.ranks) for r in paths.simple_paths(some, edges).orderBy("n").collect()]
    index = path_index.path_index(edges, some)
    got = path_index.read_paths(index, edges, 1, len(want)).orderBy("n").collect()
    assert [(r.max_len, r.ranks) for r in got] == want and index.agg(F.sum("n_paths")).first()[0] == len(want)


def test_path_index_of_a_large_clique_has_no_row_per_path(spark):
    n = 120
    nodes, edges = frames(spark, {(i, j): 10.0 for i, j in itertools.combinations(range(1, n + 1), 2)}, n)
    index = path_index.path_index(edges)
    counts = {r.max_len: (r.c, r.n) for r in index.groupBy("max_len").agg(F.count("*").alias("c"), F.sum("n_paths").alias("n")).collect()}
    pairs = n * (n - 1)
    assert counts == {2: (pairs, pairs * (1 + n - 2)), 3: (pairs, pairs * (1 + n - 2 + (n - 2) * (n - 3)))}
    last = counts[2][1] + counts[3][1]
    assert [r.n for r in path_index.read_paths(index, edges, last - 2, last + 5).orderBy("n").collect()] == [last - 2, last - 1, last]


def blown_up(spark, sizes, links):
    """A graph between classes of given sizes, and the same between their members."""
    ranks, at = {}, 0
    order = [c for c, m in sizes.items() for _ in range(m)]
    random.Random(2).shuffle(order)
    for c in order:
        at += 1
        ranks.setdefault(c, []).append(at)
    first = {c: min(r) for c, r in ranks.items()}
    rows = [("c", *sorted((first[x], first[y])), w / 10) for (x, y), w in links.items()]
    columns = similarity.ColumnGraph(
        spark.createDataFrame([("c", first[c], m) for c, m in sizes.items()], "category string, class bigint, size bigint"),
        spark.createDataFrame([("c", first[c], name(r), r) for c in sizes for r in ranks[c]], "category string, class bigint, term string, rank bigint"),
        spark.createDataFrame(rows, "category string, ca bigint, cb bigint, sim double"),
    )
    edges = {tuple(sorted((i, j))): w for (x, y), w in links.items() for i in ranks[x] for j in ranks[y]}
    edges |= {pair: 10.0 for r in ranks.values() for pair in itertools.combinations(sorted(r), 2)}
    return columns, edges, at


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_quotient_graph_equals_the_graph_of_members(spark, seed):
    rnd = random.Random(seed)
    sizes = {c: rnd.choice([1, 1, 2, 4]) for c in range(8)}
    links = {(x, y): round(rnd.uniform(7.01, 9.9), 3) for x, y in itertools.combinations(range(8), 2) if rnd.random() < 0.3}
    columns, edges, n = blown_up(spark, sizes, links)
    nodes, plain = frames(spark, edges, n)
    kinds = ["category", "a", "b", "ra", "rb", "w"]
    flat = lambda df: sorted((*r[:5], round(r.w, 8)) for r in df.select(*kinds).collect())
    assert flat(similarity.member_edges(columns)) == flat(plain)
    refined, want = quotient.refine(columns, 2), graph.refine(plain, 2)
    assert flat(quotient.expand(columns, refined)) == flat(want)
    for some, expanded in ((quotient.class_edges(columns), plain), (refined, want)):
        for low in (7.0, 8.5, 11.0):
            a = sorted(map(tuple, quotient.node_sufficiency(columns, some, min_weight=low).collect()))
            assert a == sorted(map(tuple, graph.node_sufficiency(nodes, expanded, min_weight=low).collect()))


def test_a_class_of_3000_equal_columns_is_one_row(spark):
    columns, _, _ = blown_up(spark, {"big": 3000, "x": 2, "y": 1}, {})
    first = {r["size"]: r["class"] for r in columns.classes.collect()}
    links = spark.createDataFrame([("c", *sorted((first[3000], first[2])), 0.95)], columns.links.schema)
    columns = similarity.ColumnGraph(columns.classes, columns.members, links)
    rows = {r["size"]: r for r in quotient.class_sufficiency(columns, quotient.class_edges(columns)).collect()}
    assert (rows[3000].n_nodes, rows[3000].strong_edges) == (3002, 3000 * 2999 // 2 + 3000 * 2 + 1)
    assert (rows[2].n_nodes, rows[2].strong_edges) == (3002, 3000 * 2999 // 2 + 3000 * 2 + 1)
    assert (rows[1].n_nodes, rows[1].strong_edges, rows[1].is_sufficient) == (1, 0, False)
    near = {r["size"]: [(n["size"], n.weight) for n in r.nested] for r in quotient.class_neighbours(columns, quotient.class_edges(columns)).collect()}
    assert near == {3000: [(2, 9.5)], 2: [(3000, 9.5)], 1: []}


def test_cliques_and_paths_of_classes_are_those_of_the_keywords(spark):
    rnd = random.Random(5)
    sizes = dict(enumerate([1, 3, 2, 1, 1, 2], 1))
    terms, members = {}, []
    ranks = list(range(1, sum(sizes.values()) + 1))
    rnd.shuffle(ranks)
    for c, m in sizes.items():
        own = sorted(ranks.pop() for _ in range(m))
        terms[c] = own
        members += [("c", own[0], name(r), r) for r in own]
    links = {(c, d): round(rnd.uniform(0.91, 0.99), 3) for c, d in itertools.combinations(sizes, 2) if rnd.random() < 0.45}
    n = len(members)
    edges = {tuple(sorted((x, y))): round(w * 10, 10) for (c, d), w in links.items() for x in terms[c] for y in terms[d]}
    edges |= {(x, y): 10.0 for own in terms.values() for x, y in itertools.combinations(own, 2)}
    columns = similarity.ColumnGraph(
        spark.createDataFrame([("c", own[0], len(own)) for own in terms.values()], "category string, class bigint, size bigint"),
        spark.createDataFrame(members, "category string, class bigint, term string, rank bigint"),
        spark.createDataFrame([("c", *sorted((terms[c][0], terms[d][0])), w) for (c, d), w in links.items()], "category string, ca bigint, cb bigint, sim double"),
    )
    nodes, heads = quotient.named(columns, quotient.class_edges(columns))
    of = {name(own[0]): own for own in terms.values()}
    found = quotient.class_cliques(nodes, heads)
    got = {tuple(sorted(r for m in row.members for r in of[m])): row.size for row in found.collect()}
    want = brute_cliques(edges, n)
    assert set(got) == want and all(len(k) == v for k, v in got.items())
    nests = sorted(tuple(r.nest) for r in quotient.nested_keywords(columns, found).collect())
    assert sorted(x for nest in nests for x in nest) == sorted(m[2] for m in members)
    term_nodes, term_edges = frames(spark, edges, n)
    short = {(r.source, r.target): (r.path, r.cost) for r in paths.shortest_paths(term_edges).collect()}
    short |= {(t, s): (p[::-1], c) for (s, t), (p, c) in short.items()}
    classed = quotient.class_paths(heads).collect()
    for r in classed:
        for s, t in itertools.product(of[r.source], of[r.target]):
            there, cost = short[name(s), name(t)]
            assert cost == r.cost and len(there) == len(r.path)
    ends = [m[2] for m in members]
    head = {name(x): name(own[0]) for own in terms.values() for x in own}
    assert {frozenset((head[s], head[t])) for s, t in short if head[s] != head[t]} == {frozenset((r.source, r.target)) for r in classed}
    assert all(c == 10.0 for (s, t), (_, c) in short.items() if head[s] == head[t]) and set(head) == set(ends)


def test_a_hub_sends_none_of_its_pairs(spark):
    n = 400
    edges = {(1, i): 9.5 for i in range(2, n + 1)} | {(2, 3): 9.5, (3, 4): 9.5}
    nodes, df = frames(spark, edges, n)
    found = {tuple(r.ranks) for r in cliques.maximal_cliques(nodes, df).collect()}
    assert found == {(1, 2, 3), (1, 3, 4)} | {(1, i) for i in range(5, n + 1)}


def test_pair_products_by_parts(spark, monkeypatch):
    """Products over many small parts of cells and pairs; places repeat, are null or are missing."""
    for limit in ("CELLS_PER_TASK", "PAIRS_PER_TASK", "CELLS_AT_ONCE"):
        monkeypatch.setattr(similarity, limit, 7)
    rnd = random.Random(5)
    cells = [(c, i, rnd.choice([None, *range(12)]), rnd.random()) for c in "xy" for i in range(9) for _ in range(6)]
    pairs = [(c, i, j) for c in "xy" for i, j in itertools.combinations(range(11), 2)]
    found = similarity.pair_products(
        spark.createDataFrame(cells, "category string, class bigint, at bigint, v double"), spark.createDataFrame(pairs, "category string, ca bigint, cb bigint")
    )
    got = {(r.category, r.ca, r.cb): r.dot for r in found.collect()}
    want = {
        (c, i, j): sum(u * w for d, k, p, u in cells for e, m, q, w in cells if (d, k, e, m) == (c, i, c, j) and p is not None and p == q)
        for c, i, j in pairs
    }
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_long_columns_are_told_apart_by_a_share_of_the_documents(spark):
    """Columns longer than the parts of the norms: unlike ones go before the exact product, like ones stay."""
    rnd = np.random.default_rng(3)
    even, odd = np.where(np.arange(4000) % 2, 0.0, rnd.random((2, 4000)) + 0.5)
    odd = np.roll(odd, 1)
    columns = [even, even * (1 + 0.2 * rnd.random(4000)), odd]
    rows = [("c", i, d, float(x)) for i, col in enumerate(columns) for d, x in enumerate(col / np.linalg.norm(col)) if x]
    units = spark.createDataFrame(rows, "category string, class bigint, doc_id bigint, u double")
    pairs = spark.createDataFrame([("c", 0, 1), ("c", 0, 2), ("c", 1, 2)], "category string, ca bigint, cb bigint")
    assert sorted((r.ca, r.cb) for r in similarity.probable_pairs(pairs, units, 0.9).collect()) == [(0, 1)]


def test_columns_take_one_exchange_of_the_weights(spark):
    """Norms, documents and leading entries of a column come from one exchange of the weights; only the short list of keywords has its own."""
    w = spark.createDataFrame([("c", d, name(t), 0.5, 2) for d in range(6) for t in range(3)], "category string, doc_id bigint, term string, w double, n_terms int")
    k = spark.createDataFrame([("c", name(t), t + 1) for t in range(3)], NODES)
    placed = similarity.placed_columns(w, k, 0.9)
    exchanges = placed._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert exchanges <= 2
    rows = placed.collect()
    assert {(r.u, r.df) for r in rows} == {(1 / math.sqrt(6), 6)} and len({(r.h1, r.h2) for r in rows}) == 1
    assert {(r["class"], r["rank"]) for r in similarity.column_classes(placed).collect()} == {(1, 1), (1, 2), (1, 3)}


def test_norms_of_parts_bound_products_also_where_a_column_is_cut(spark):
    rnd = np.random.default_rng(7)
    m = rnd.random((6, 300)) * (rnd.random((6, 300)) < 0.4)
    m[1] = m[0] * (1 + 0.1 * rnd.random(300))
    m /= np.linalg.norm(m, axis=1)[:, None]
    rows = [(c, i, d, float(m[i, d])) for c in "xy" for i in range(6) for d in range(300) if m[i, d]]
    for order in (rows, rows[::2] + rows[1::2]):
        units = spark.createDataFrame(order, "category string, class bigint, doc_id bigint, u double")
        pairs = spark.createDataFrame([(c, i, j) for c in "xy" for i, j in itertools.combinations(range(7), 2)], "category string, ca bigint, cb bigint")
        near = {(r.category, r.ca, r.cb) for r in similarity.near_pairs(similarity.folded_norms(units), pairs, 0.9).collect()}
        assert {(c, 0, 1) for c in "xy"} <= near and not any(b == 6 for _, _, b in near)
    short = [(c, i, 10 * i, 1.0) for c in "xy" for i in range(3)]
    units = spark.createDataFrame(short, "category string, class bigint, doc_id bigint, u double")
    assert similarity.near_pairs(similarity.folded_norms(units), spark.createDataFrame([("x", 0, 1), ("x", 1, 2)], "category string, ca bigint, cb bigint"), 0.9).count() == 0


def test_columns_made_in_parts_are_those_made_at_once(spark, monkeypatch):
    """The wide steps of the classes in several passes: the same classes and links, the parts in folders of their own."""
    from wordloom import session

    rnd = np.random.default_rng(11)
    m = rnd.random((40, 30)) * (rnd.random((40, 30)) < 0.3)
    m[:, 7] = m[:, 2]
    m[:, 22] = m[:, 21] * (1 + 0.2 * rnd.random(40))
    rows = [("c" if t % 5 else "e", d, name(t), float(m[d, t]), int((m[d] > 0).sum())) for d in range(40) for t in range(30) if m[d, t]]
    w = spark.createDataFrame(rows, "category string, doc_id bigint, term string, w double, n_terms int")
    k = spark.createDataFrame([("c" if t % 5 else "e", name(t), t + 1) for t in range(30)], NODES)

    def found():
        made = similarity.column_graph(w, k, 0.6)
        return {tuple(r) for r in made.members.collect()}, {(r.category, r.ca, r.cb): r.sim for r in made.links.collect()}

    whole = found()
    monkeypatch.setattr(session, "ROWS_PER_PASS", 50)
    monkeypatch.setattr(similarity, "PAIRS_PER_TASK", 12)
    monkeypatch.setattr(similarity, "LEAST_BLOCKS", 1)
    written = []
    monkeypatch.setattr(similarity, "stage_each", lambda parts, what: written.append((what, len(parts := list(parts)))) or session.stage_each(parts, what))
    parts = found()
    assert whole[0] == parts[0] and whole[1].keys() == parts[1].keys() and whole[1]
    assert all(parts[1][p] == pytest.approx(s, abs=1e-9) for p, s in whole[1].items())
    assert dict(written)["units"] == dict(written)["entries"] == session.PASSES and dict(written)["near-pairs"] > 1
