"""The same queries in SQL, for checking with another engine.

Common table expressions are kept by name; a query lists its own text and gets
the ones it needs, in order.
"""

from __future__ import annotations

import re

from wordloom.functions.lexicon import CONTRACTIONS, ENGLISH, FILLERS, POLARITY
from wordloom.functions.text import ALPHANUMERIC, CLOCK_TIME, NOT_WORD_OR_SPACE, SPACES, WORD
from wordloom.operators import documents, routing
from wordloom.operators.vectors import NOTHING_FOUND
from wordloom.plans.catalog import CLOCK_PREFIX, DIM, EXTENSIONS

CTES: dict[str, str] = {}
ORACLES: dict[str, str] = {}


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lits(texts) -> str:
    return ", ".join(lit(t) for t in texts)


def with_ctes(body: str) -> str:
    """Prefix the body with the expressions it names, and those they name."""
    order: list[str] = []
    begun: set[str] = set()

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b[a-z_0-9]+\b", text)):
            if name in CTES and name not in begun:
                begun.add(name)
                visit(CTES[name])
                order.append(name)

    visit(body)
    parts = []
    for name in order:
        how = "" if "-- recursive" in CTES[name] else "MATERIALIZED "
        parts.append(f"{name} AS {how}({CTES[name]})")
    head = "WITH RECURSIVE " if any("-- recursive" in CTES[n] for n in order) else "WITH "
    return (head + ",\n".join(parts) + "\n" if parts else "") + body


def oracle(name: str, body: str) -> None:
    ORACLES[name] = with_ctes(body)


# --- texts -------------------------------------------------------------------------------------------

_SPLIT_CASE = " ".join(f"WHEN {lit(w)} THEN [{lits(p)}]" for w, p in CONTRACTIONS)


def split_words(text: str) -> str:
    return (
        f"flatten(list_transform(regexp_split_to_array({text}, {lit(SPACES)}), "
        f"lambda t: CASE t {_SPLIT_CASE} ELSE [t] END))"
    )


def clean_tokens(text: str) -> str:
    bare = f"regexp_replace(lower(coalesce({text}, '')), {lit(NOT_WORD_OR_SPACE)}, '', 'g')"
    return f"list_filter({split_words(bare)}, lambda t: length(t) >= 3 AND t NOT IN ({lits(ENGLISH)}))"


def clean_transcript(text: str) -> str:
    bare = f"regexp_replace(coalesce({text}, ''), {lit(CLOCK_TIME)}, '', 'g')"
    bare = f"regexp_replace({bare}, {lit(NOT_WORD_OR_SPACE)}, '', 'g')"
    bare = f"lower(trim(regexp_replace({bare}, {lit(SPACES)}, ' ', 'g')))"
    drop = lits(sorted(set(ENGLISH) | set(FILLERS)))
    return f"array_to_string(list_filter({split_words(bare)}, lambda t: t <> '' AND t NOT IN ({drop})), ' ')"


FIRST_LINE = "string_split(text, chr(10))[1]"
CATEGORY = "CASE WHEN l.quality = 1 THEN 'automatable' ELSE 'non_automatable' END"

CTES["corpus"] = f"SELECT d.doc_id, {CATEGORY} AS category, d.text FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"
CTES["tok"] = f"SELECT doc_id, category, {clean_tokens('text')} AS tokens FROM corpus"
CTES["full_tok"] = "SELECT * FROM tok WHERE len(tokens) > 0"
CTES["all_tok"] = "SELECT doc_id, 'all' AS category, tokens FROM tok"

oracle("scan_corpus", "SELECT doc_id, category, text FROM corpus")
oracle("stage_parquet", "SELECT doc_id, category, text FROM corpus")
oracle(
    "combine_desc",
    f"SELECT doc_id, concat_ws(' ', CASE WHEN n_chars % 3 <> 0 THEN {FIRST_LINE} END, "
    "CASE WHEN n_chars % 5 <> 0 THEN text END) AS combined FROM documents",
)
oracle("clean_keywords", "SELECT doc_id, array_to_string(tokens, ' ') AS cleaned, len(tokens) AS n_tokens FROM full_tok")

CTES["turns"] = (
    f"SELECT conv_id, turn, role, {lit(CLOCK_PREFIX)} || text AS raw, "
    f"{clean_transcript(lit(CLOCK_PREFIX) + ' || text')} AS cleaned FROM conversations"
)
oracle(
    "clean_transcript",
    "SELECT conv_id, turn, cleaned, length(raw) AS original_length, length(cleaned) AS cleaned_length, "
    "length(raw) - length(cleaned) AS reduction FROM turns",
)
oracle(
    "cleaning_totals",
    "SELECT role, count(*) AS n, CAST(sum(length(raw)) AS BIGINT) AS original_length, "
    "CAST(sum(length(cleaned)) AS BIGINT) AS cleaned_length, CAST(sum(length(raw) - length(cleaned)) AS BIGINT) AS reduction "
    "FROM turns GROUP BY role",
)
oracle(
    "text_preview",
    "SELECT doc_id, CASE WHEN length(text) > 300 THEN substr(text, 1, 300) || '...' ELSE text END AS preview FROM documents",
)

# --- keywords ----------------------------------------------------------------------------------------


def keyword_ctes(prefix: str, tokens: str, cap: int | None) -> None:
    """words, counts, vocabulary, weights and scores over one token table."""
    p = prefix
    CTES[f"{p}words"] = f"SELECT category, doc_id, unnest(tokens) AS term FROM {tokens}"
    CTES[f"{p}n"] = f"SELECT category, count(*) AS n FROM {tokens} GROUP BY category"
    CTES[f"{p}counts"] = f"SELECT category, doc_id, term, count(*) AS tf FROM {p}words GROUP BY ALL"
    cut = f"QUALIFY row_number() OVER (PARTITION BY category ORDER BY sum(tf) DESC, term) <= {cap}" if cap else ""
    CTES[f"{p}vocabulary"] = f"SELECT category, term, count(*) AS df FROM {p}counts GROUP BY category, term {cut}"
    CTES[f"{p}raw"] = (
        f"SELECT c.category, c.doc_id, c.term, c.tf, c.tf * (ln((n.n + 1) / (v.df + 1)) + 1) AS x FROM {p}counts c "
        f"JOIN {p}vocabulary v ON v.category = c.category AND v.term = c.term JOIN {p}n n ON n.category = c.category"
    )
    CTES[f"{p}weights"] = (
        f"SELECT category, doc_id, term, tf, x / sqrt(sum(x * x) OVER (PARTITION BY category, doc_id)) AS w FROM {p}raw"
    )
    CTES[f"{p}scores"] = f"SELECT category, term, round(sum(w), 10) AS score FROM {p}weights GROUP BY category, term"
    CTES[f"{p}keywords"] = (
        f"SELECT category, term, score, row_number() OVER (PARTITION BY category ORDER BY score DESC, term) AS rank "
        f"FROM {p}scores WHERE score >= 0.2 AND regexp_matches(term, {lit(ALPHANUMERIC)})"
    )


keyword_ctes("t_", "full_tok", None)
keyword_ctes("c_", "full_tok", None)
CTES["all_full"] = "SELECT * FROM all_tok WHERE len(tokens) > 0"
keyword_ctes("u_", "all_full", None)
keyword_ctes("k_", "all_tok", 1000)

RANKED = "SELECT category, term, score, row_number() OVER (PARTITION BY category ORDER BY score DESC, term) AS rank FROM "
oracle("tfidf_weights", "SELECT category, doc_id, term, tf, round(w, 6) AS w FROM t_weights")
oracle("keyword_scores", RANKED + "t_scores")
oracle("keywords_filtered", "SELECT category, term, score, rank FROM t_keywords")
oracle("keywords_union", RANKED + "u_scores")
oracle("keywords_capped", RANKED + "k_scores")

# --- graph -------------------------------------------------------------------------------------------

def link_ctes(words: str, links: str, threshold: float) -> None:
    CTES[f"{words}columns"] = (
        "SELECT w.category, w.doc_id, w.term, k.rank, w.w / sqrt(sum(w.w * w.w) OVER (PARTITION BY w.category, w.term)) AS u "
        f"FROM {words}weights w JOIN {words}keywords k ON k.category = w.category AND k.term = w.term"
    )
    CTES[links] = (
        "SELECT x.category, x.term AS a, y.term AS b, x.rank AS ra, y.rank AS rb, round(round(sum(x.u * y.u), 10) * 10, 10) AS w "
        f"FROM {words}columns x JOIN {words}columns y ON x.category = y.category AND x.doc_id = y.doc_id AND x.rank < y.rank "
        f"GROUP BY ALL HAVING round(sum(x.u * y.u), 10) > {threshold}"
    )


link_ctes("c_", "links", 0.9)


def two_way(edges: str) -> str:
    return (
        f"SELECT category, a AS node, ra AS rn, b AS peer, rb AS rp, w FROM {edges} "
        f"UNION ALL SELECT category, b, rb, a, ra, w FROM {edges}"
    )


def refine_ctes(prefix: str, rounds: int, cap: int | None) -> str:
    """Unrolled rounds; returns the name of the last edge table."""
    edges = "links"
    for i in range(1, rounds + 1):
        p = f"{prefix}{i}_"
        CTES[f"{p}seen"] = two_way(edges)
        mean = "(s.w + t.w) / 2"
        cut = f"QUALIFY row_number() OVER (PARTITION BY s.category ORDER BY s.rn, s.rp, t.rp) <= {cap}" if cap else ""
        CTES[f"{p}pairs"] = (
            f"SELECT s.category, s.rn AS rc, s.peer AS a, t.peer AS b, s.rp AS ra, t.rp AS rb, {mean} AS w FROM {p}seen s "
            f"JOIN {p}seen t ON s.category = t.category AND s.node = t.node AND s.rp < t.rp WHERE {mean} > 7 AND NOT EXISTS "
            f"(SELECT 1 FROM {edges} e WHERE e.category = s.category AND e.ra = s.rp AND e.rb = t.rp) {cut}"
        )
        CTES[f"{p}edges"] = (
            f"SELECT category, a, b, ra, rb, w FROM {edges} UNION ALL "
            f"SELECT category, a, b, ra, rb, arg_max(w, rc) AS w FROM {p}pairs GROUP BY category, a, b, ra, rb"
        )
        edges = f"{p}edges"
    return edges


FREE = refine_ctes("free_", 3, None)
CAPPED = refine_ctes("capped_", 2, 10_000)
REFINED = refine_ctes("ref_", 2, None)
SHOWN = "SELECT category, a, b, w FROM "
oracle("term_edges", SHOWN + "links")
oracle("refine_edges", SHOWN + FREE)
oracle("refine_edges_capped", SHOWN + CAPPED)

CTES["vecs"] = "SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings"
CTES["vec_pairs"] = (
    "SELECT x.vec_id AS i, y.vec_id AS j, round(list_cosine_similarity(x.v, y.v), 10) AS sim FROM vecs x "
    "JOIN vecs y ON x.vec_id < y.vec_id"
)
oracle(
    "similarity_edges",
    "SELECT 'all' AS category, CAST(i AS VARCHAR) AS a, CAST(j AS VARCHAR) AS b, round(sim * 10, 10) AS w FROM vec_pairs WHERE sim > 0.35",
)

CTES["linked"] = two_way("links")
CTES["column_lists"] = "SELECT category, rank, list({'d': doc_id, 'u': round(u, 9)} ORDER BY doc_id) AS cells FROM c_columns GROUP BY category, rank"
CTES["column_class"] = "SELECT category, rank, min(rank) OVER (PARTITION BY category, cells) AS class, count(*) OVER (PARTITION BY category, cells) AS size FROM column_lists"
CTES["class_pairs"] = (
    "SELECT x.category, x.class, y.class AS linked, y.size AS linked_size, max(l.w) AS weight FROM linked l "
    "JOIN column_class x ON x.category = l.category AND x.rank = l.rn JOIN column_class y ON y.category = l.category AND y.rank = l.rp WHERE x.class <> y.class GROUP BY ALL"
)
oracle(
    "class_links",
    "SELECT c.category, c.class, c.size, p.linked, p.linked_size, p.weight FROM (SELECT DISTINCT category, class, size FROM column_class) c "
    "LEFT JOIN class_pairs p ON p.category = c.category AND p.class = c.class",
)
oracle(
    "connected_keywords",
    "SELECT category, node AS keyword, count(*) AS degree, "
    "string_agg(peer || ' ' || printf('%.4f', w), '; ' ORDER BY w DESC, rp) AS nested FROM linked GROUP BY category, node",
)


def sufficiency_ctes(prefix: str, edges: str, limit: float) -> None:
    """Strong edges and nodes in the induced subgraph of each keyword and its neighbours."""
    p = prefix
    CTES[f"{p}seen"] = two_way(edges)
    CTES[f"{p}sets"] = (
        f"SELECT category, rank AS owner, rank AS member FROM c_keywords UNION ALL SELECT category, rn, rp FROM {p}seen"
    )
    CTES[f"{p}strong"] = (
        f"SELECT s.category, s.owner, count(*) AS n FROM {p}sets s JOIN {edges} e ON e.category = s.category AND e.ra = s.member "
        f"JOIN {p}sets t ON t.category = s.category AND t.owner = s.owner AND t.member = e.rb WHERE e.w >= {limit} GROUP BY ALL"
    )
    CTES[f"{p}size"] = f"SELECT category, owner, count(*) AS n FROM {p}sets GROUP BY ALL"
    CTES[f"{p}nodes"] = (
        "SELECT k.category, k.term, k.rank, z.n AS n_nodes, coalesce(s.n, 0) AS strong_edges, "
        f"z.n >= 3 AND coalesce(s.n, 0) >= 2 AS is_sufficient FROM c_keywords k "
        f"JOIN {p}size z ON z.category = k.category AND z.owner = k.rank "
        f"LEFT JOIN {p}strong s ON s.category = k.category AND s.owner = k.rank"
    )


sufficiency_ctes("eight_", "links", 8.0)
sufficiency_ctes("net_", REFINED, 7.0)
oracle("node_sufficiency", "SELECT category, term, n_nodes, strong_edges, is_sufficient FROM eight_nodes")

CTES["sampled"] = (
    "SELECT category, term, rank FROM c_keywords QUALIFY row_number() OVER (PARTITION BY category ORDER BY md5('0' || term), term) <= 500"
)
oracle("node_sample", "SELECT category, term, rank FROM sampled")

CTES["reach"] = (
    "SELECT category, rank, rank AS root FROM c_keywords UNION -- recursive\n"
    "SELECT l.category, l.rp, r.root FROM reach r JOIN linked l ON l.category = r.category AND l.rn = r.rank"
)
oracle(
    "components",
    "SELECT k.category, k.term, min(r.root) AS component FROM c_keywords k JOIN reach r ON r.category = k.category AND r.rank = k.rank "
    "GROUP BY k.category, k.term",
)

CTES["heads"] = (
    "SELECT c.category, c.class, c.size, min(k.term) AS head FROM column_class c JOIN c_keywords k ON k.category = c.category AND k.rank = c.rank GROUP BY ALL"
)
oracle(
    "class_members",
    "SELECT c.category, k.term, c.class, h.head FROM column_class c JOIN c_keywords k ON k.category = c.category AND k.rank = c.rank "
    "JOIN heads h ON h.category = c.category AND h.class = c.class",
)
CTES["head_links"] = (
    "SELECT p.category, p.class AS rn, h.head AS node, p.linked AS rp, g.head AS peer, p.weight AS w FROM class_pairs p "
    "JOIN heads h ON h.category = p.category AND h.class = p.class JOIN heads g ON g.category = p.category AND g.class = p.linked"
)
CTES["near"] = "SELECT category, rn, list(rp) AS peers FROM head_links GROUP BY category, rn"
CTES["cliques_"] = (
    "SELECT h.category, [h.head] AS members, CAST(h.size AS BIGINT) AS size, h.class AS last, coalesce(n.peers, []) AS common FROM heads h "
    "LEFT JOIN near n ON n.category = h.category AND n.rn = h.class UNION ALL -- recursive\n"
    "SELECT c.category, list_append(c.members, h.head), c.size + h.size, c.nx, list_intersect(c.common, n.peers) FROM "
    "(SELECT category, members, size, last, common, unnest(list_filter(common, lambda x: x > last)) AS nx FROM cliques_) c "
    "JOIN near n ON n.category = c.category AND n.rn = c.nx JOIN heads h ON h.category = c.category AND h.class = c.nx"
)
CTES["maximal"] = "SELECT category, list_sort(members) AS members, size FROM cliques_ WHERE len(common) = 0"
oracle("maximal_cliques", "SELECT category, array_to_string(members, ' ') AS members, len(members) AS n_classes, size FROM maximal")
CTES["ordered_cliques"] = (
    "SELECT *, row_number() OVER (PARTITION BY category ORDER BY size DESC, members) AS turn FROM maximal"
)
CTES["clique_words"] = "SELECT category, turn, unnest(members) AS term FROM ordered_cliques"
CTES["first_clique"] = "SELECT category, term, min(turn) AS turn FROM clique_words GROUP BY category, term"
oracle(
    "nested_keywords",
    "SELECT f.category, string_agg(k.term, ' ' ORDER BY k.term) AS nest, count(*) AS size FROM first_clique f JOIN heads h ON h.category = f.category "
    "AND h.head = f.term JOIN column_class c ON c.category = h.category AND c.class = h.class JOIN c_keywords k ON k.category = c.category AND k.rank = c.rank "
    "GROUP BY f.category, f.turn",
)

ROUNDS = 40
CTES["best_0"] = "SELECT DISTINCT category, rn AS rs, rn AS rt, [node] AS path, CAST(0 AS DOUBLE) AS cost FROM head_links"
for _i in range(1, ROUNDS + 1):
    CTES[f"best_{_i}"] = (
        "SELECT category, rs, rt, m.path AS path, m.cost AS cost FROM (SELECT category, rs, rt, min({'cost': cost, 'path': path}) AS m FROM "
        f"(SELECT category, rs, rt, path, cost FROM best_{_i - 1} UNION ALL "
        "SELECT b.category, b.rs, l.rp, list_append(b.path, l.peer), round(b.cost + l.w, 10) "
        f"FROM best_{_i - 1} b JOIN head_links l ON l.category = b.category AND l.rn = b.rt WHERE NOT list_contains(b.path, l.peer)) "
        "GROUP BY category, rs, rt)"
    )
CTES["shortest"] = f"SELECT category, path, cost FROM best_{ROUNDS} WHERE rs < rt"
oracle(
    "shortest_paths",
    "SELECT category, path[1] AS source, path[-1] AS target, array_to_string(path, ' ') AS path, cost FROM shortest",
)
CTES["path_words"] = "SELECT category, path, unnest(path) AS term FROM shortest"
CTES["held"] = (
    "SELECT p.category, p.path, c.turn FROM path_words p JOIN clique_words c ON c.category = p.category AND c.term = p.term "
    "GROUP BY p.category, p.path, c.turn HAVING count(*) = len(p.path)"
)
oracle(
    "nested_paths",
    "SELECT s.category, array_to_string(s.path, ' ') AS path, array_to_string(o.members, ' ') AS clique FROM shortest s LEFT JOIN "
    "(SELECT category, path, min(turn) AS turn FROM held GROUP BY category, path) h ON h.category = s.category AND h.path = s.path "
    "LEFT JOIN ordered_cliques o ON o.category = h.category AND o.turn = h.turn",
)


def path_ctes(prefix: str, edges: str, cap: int = 500) -> None:
    p = prefix
    CTES[f"{p}seen"] = two_way(edges)
    CTES[f"{p}p0"] = "SELECT category, [term] AS path, [rank] AS ranks, rank AS tail FROM sampled"
    for i in (1, 2, 3):
        CTES[f"{p}p{i}"] = (
            f"SELECT w.category, list_append(w.path, s.peer) AS path, list_append(w.ranks, s.rp) AS ranks, s.rp AS tail FROM {p}p{i - 1} w "
            f"JOIN {p}seen s ON s.category = w.category AND s.rn = w.tail WHERE NOT list_contains(w.ranks, s.rp)"
        )
    grown = " UNION ALL ".join(f"SELECT {m} AS max_len, * FROM {p}p{i}" for m in (2, 3) for i in range(1, m + 1))
    CTES[f"{p}paths"] = (
        f"SELECT g.category, row_number() OVER (PARTITION BY g.category ORDER BY ranks[1], max_len, tail, ranks) AS n, max_len, path, ranks "
        f"FROM ({grown}) g JOIN sampled e ON e.category = g.category AND e.rank = g.tail QUALIFY n <= {cap}"
    )


path_ctes("lp_", "links")
path_ctes("np_", REFINED)
oracle("simple_paths_sampled", "SELECT category, n, CAST(max_len AS BIGINT) AS max_len, array_to_string(path, ' ') AS path FROM lp_paths")
oracle(
    "nested_sequences_sampled",
    "SELECT category, n, row_number() OVER (PARTITION BY category, n ORDER BY size, start) - 1 AS pos, "
    "array_to_string(path[start:start + size - 1], ' ') AS part FROM (SELECT category, n, path, size, unnest(range(1, len(path) - size + 2)) AS start "
    "FROM (SELECT category, n, path, unnest(range(2, len(path) + 1)) AS size FROM lp_paths))",
)

CTES["path_ends"] = (
    "SELECT category, rn AS rs, rp AS rt, 1 AS size, count(*) AS n FROM linked GROUP BY ALL UNION ALL "
    "SELECT x.category, x.rn, y.rp, 2, count(*) FROM linked x JOIN linked y ON y.category = x.category AND y.rn = x.rp WHERE y.rp <> x.rn GROUP BY ALL UNION ALL "
    "SELECT x.category, x.rn, z.rp, 3, count(*) FROM linked x JOIN linked y ON y.category = x.category AND y.rn = x.rp "
    "JOIN linked z ON z.category = y.category AND z.rn = y.rp WHERE y.rp <> x.rn AND z.rp <> x.rn AND z.rp <> x.rp GROUP BY ALL"
)
CTES["path_counts"] = (
    "SELECT e.category, e.rs, m.max_len, e.rt, CAST(sum(e.n) AS BIGINT) AS n_paths FROM path_ends e "
    "JOIN (SELECT unnest([2, 3]) AS max_len) m ON e.size <= m.max_len GROUP BY ALL"
)
oracle(
    "simple_paths",
    "SELECT p.category, s.term AS source, CAST(p.max_len AS BIGINT) AS max_len, t.term AS target, n_paths, "
    "CAST(sum(n_paths) OVER (PARTITION BY p.category ORDER BY p.rs, p.max_len, p.rt) - n_paths + 1 AS BIGINT) AS first FROM path_counts p "
    "JOIN c_keywords s ON s.category = p.category AND s.rank = p.rs JOIN c_keywords t ON t.category = p.category AND t.rank = p.rt",
)

# --- network -----------------------------------------------------------------------------------------

CTES["nk"] = "SELECT category, rank, rank - 1 AS pos, term AS keyword, n_nodes, is_sufficient FROM net_nodes"
CTES["np_inside"] = (
    "SELECT p.category, p.n, count(*) AS strong FROM (SELECT category, n, unnest(ranks) AS m FROM np_paths) p "
    "JOIN (SELECT category, n, unnest(ranks) AS m FROM np_paths) q ON q.category = p.category AND q.n = p.n "
    f"JOIN {REFINED} e ON e.category = p.category AND e.ra = p.m AND e.rb = q.m WHERE e.w >= 7 GROUP BY p.category, p.n"
)
CTES["nseq"] = (
    "SELECT p.category, p.n - 1 AS pos, p.path AS sequence, len(p.path) >= 3 AND coalesce(i.strong, 0) >= 2 AS is_sufficient "
    "FROM np_paths p LEFT JOIN np_inside i ON i.category = p.category AND i.n = p.n"
)
oracle(
    "network_json",
    "SELECT k.category, k.pos, k.keyword, k.is_sufficient, s.peer AS nested_keyword, s.w AS weight FROM nk k "
    "LEFT JOIN net_seen s ON s.category = k.category AND s.rn = k.rank",
)
oracle(
    "network_shred",
    "SELECT category, 'keyword' AS kind, pos, keyword AS label, n_nodes - 1 AS n_nested, is_sufficient FROM nk UNION ALL "
    "SELECT category, 'sequence', pos, array_to_string(sequence, ' '), CAST(len(sequence) * (len(sequence) - 1) / 2 AS BIGINT), is_sufficient FROM nseq",
)

# --- matching ----------------------------------------------------------------------------------------

CTES["validation"] = f"SELECT doc_id AS row_id, category, concat_ws(' ', {FIRST_LINE}, text) AS text FROM corpus"
CTES["vtok"] = f"SELECT row_id, category, list_distinct({clean_tokens('text')}) AS tokens FROM validation"
CTES["vwords"] = "SELECT row_id, category, unnest(tokens) AS word FROM vtok"
CTES["kmatch"] = (
    "SELECT v.row_id, v.category, k.pos, k.keyword FROM vwords v JOIN nk k ON k.category = v.category AND k.keyword = v.word"
)
CTES["smatch"] = (
    "SELECT v.row_id, v.category, s.pos, s.sequence, s.is_sufficient FROM vtok v JOIN nseq s ON s.category = v.category "
    "AND list_has_all(v.tokens, s.sequence)"
)
oracle("match_keywords", "SELECT row_id, category, pos, keyword FROM kmatch")
oracle("match_sequences_sampled", "SELECT row_id, category, pos FROM smatch")
CTES["member_rows"] = (
    "SELECT category, pos AS owner, keyword AS member FROM nk WHERE is_sufficient UNION ALL "
    "SELECT k.category, k.pos, s.peer FROM nk k JOIN net_seen s ON s.category = k.category AND s.rn = k.rank WHERE k.is_sufficient"
)
CTES["checked"] = (
    "SELECT v.row_id, v.category, v.row_id IN (SELECT m.row_id FROM kmatch m JOIN member_rows o ON o.category = m.category AND o.member = m.keyword "
    "GROUP BY m.row_id, o.owner HAVING count(*) >= 3) OR v.row_id IN (SELECT row_id FROM smatch WHERE is_sufficient) AS is_sufficient, "
    "coalesce(k.t, '') AS matched_keywords, coalesce(s.t, '') AS matched_sequences FROM validation v "
    "LEFT JOIN (SELECT row_id, string_agg(keyword, ', ' ORDER BY pos) AS t FROM kmatch GROUP BY row_id) k ON k.row_id = v.row_id "
    "LEFT JOIN (SELECT row_id, string_agg(array_to_string(sequence, ', '), '; ' ORDER BY pos) AS t FROM smatch GROUP BY row_id) s ON s.row_id = v.row_id"
)
oracle("check_sufficiency_sampled", "SELECT row_id, category, is_sufficient, matched_keywords, matched_sequences FROM checked")
CTES["vkeys"] = "SELECT v.row_id, v.category, k.rank FROM vwords v JOIN c_keywords k ON k.category = v.category AND k.term = v.word"
CTES["vlinks"] = (
    "SELECT x.row_id, x.category, s.rn AS u, s.rp AS v FROM vkeys x JOIN net_seen s ON s.category = x.category AND s.rn = x.rank "
    "JOIN vkeys y ON y.row_id = x.row_id AND y.rank = s.rp"
)
CTES["vdegree"] = "SELECT row_id, u, count(*) AS d FROM vlinks GROUP BY ALL"
CTES["vcounts"] = (
    "SELECT row_id, sum(one) AS one, sum(two) AS two, sum(three) AS three FROM (SELECT row_id, d AS one, d * (d - 1) AS two, 0 AS three FROM vdegree UNION ALL "
    "SELECT l.row_id, 0, 0, (x.d - 1) * (y.d - 1) FROM vlinks l JOIN vdegree x ON x.row_id = l.row_id AND x.u = l.u JOIN vdegree y ON y.row_id = l.row_id AND y.u = l.v UNION ALL "
    "SELECT p.row_id, 0, 0, -count(*) FROM vlinks p JOIN vlinks q ON q.row_id = p.row_id AND q.u = p.v JOIN vlinks r ON r.row_id = p.row_id AND r.u = q.v AND r.v = p.u "
    "GROUP BY p.row_id) GROUP BY row_id"
)
CTES["vmatched"] = (
    "SELECT k.row_id, k.category, CAST(coalesce(2 * any_value(c.one) + 2 * any_value(c.two) + any_value(c.three), 0) AS BIGINT) AS n_sequences, "
    "CAST(coalesce(2 * any_value(c.two) + any_value(c.three), 0) AS BIGINT) AS n_sufficient FROM vkeys k LEFT JOIN vcounts c ON c.row_id = k.row_id GROUP BY k.row_id, k.category"
)
oracle("match_sequences_all", "SELECT row_id, category, n_sequences, n_sufficient FROM vmatched")
CTES["whole_checked"] = (
    "SELECT v.row_id, v.category, v.row_id IN (SELECT m.row_id FROM kmatch m JOIN member_rows o ON o.category = m.category AND o.member = m.keyword "
    "GROUP BY m.row_id, o.owner HAVING count(*) >= 3) OR coalesce(n.n_sufficient, 0) > 0 AS is_sufficient, coalesce(k.t, '') AS matched_keywords, "
    "coalesce(n.n_sequences, 0) AS n_sequences, coalesce(n.n_sufficient, 0) AS n_sufficient FROM validation v LEFT JOIN vmatched n ON n.row_id = v.row_id "
    "LEFT JOIN (SELECT row_id, string_agg(keyword, ', ' ORDER BY pos) AS t FROM kmatch GROUP BY row_id) k ON k.row_id = v.row_id"
)
oracle(
    "result_table",
    "SELECT d.doc_id AS row_id, lang, source, n_chars, category, is_sufficient, matched_keywords, n_sequences, n_sufficient FROM documents d "
    "LEFT JOIN whole_checked c ON c.row_id = d.doc_id",
)
oracle("check_sufficiency", "SELECT row_id, category, is_sufficient, matched_keywords, n_sequences, n_sufficient FROM whole_checked")
oracle(
    "sufficiency_summary",
    "SELECT count(*) AS total_rows, count(*) FILTER (is_sufficient) AS sufficient_count, count(*) FILTER (NOT is_sufficient) AS insufficient_count, "
    "round(coalesce(100.0 * count(*) FILTER (is_sufficient) / nullif(count(*), 0), 0), 6) AS sufficient_percent, "
    "round(coalesce(100.0 * count(*) FILTER (NOT is_sufficient) / nullif(count(*), 0), 0), 6) AS insufficient_percent FROM whole_checked",
)

# --- scoring: TF-IDF refitted per text, as the definition has it ---------------------------------------

CTES["fk"] = "SELECT pos, keyword, is_sufficient FROM nk WHERE category = 'automatable'"
CTES["fs"] = "SELECT pos, sequence, is_sufficient FROM nseq WHERE category = 'automatable'"
CTES["texts"] = (
    f"SELECT doc_id AS row_id, 'short_description' AS field, {FIRST_LINE} AS text FROM documents UNION ALL "
    "SELECT doc_id, 'description', text FROM documents"
)
CTES["sub"] = "SELECT t.row_id, t.field, k.pos, k.keyword, k.is_sufficient FROM texts t JOIN fk k ON contains(lower(t.text), lower(k.keyword))"
CTES["spaced"] = (
    "SELECT row_id, field, '  ' || array_to_string(regexp_extract_all(line, " + lit(f"[{WORD}]+") + "), '  ') || '  ' AS line FROM "
    "(SELECT row_id, field, unnest(string_split(lower(text), chr(10))) AS line FROM texts)"
)
CTES["fs_like"] = "SELECT DISTINCT sequence, '% ' || array_to_string(sequence, ' % ') || ' %' AS pattern FROM fs"
CTES["ord"] = (
    "SELECT DISTINCT t.row_id, t.field, s.pos, s.sequence, s.is_sufficient FROM spaced t JOIN fs_like p ON t.line LIKE p.pattern "
    "JOIN fs s ON s.sequence = p.sequence"
)
CTES["hits"] = "SELECT row_id, field, 'k' AS kind, pos, is_sufficient FROM sub UNION ALL SELECT row_id, field, 's', pos, is_sufficient FROM ord"
CTES["counted"] = (
    "SELECT row_id, field, count(*) FILTER (kind = 'k' AND is_sufficient) AS suff_keywords, "
    "count(*) FILTER (kind = 'k' AND NOT is_sufficient) AS insuff_keywords, count(*) FILTER (kind = 's' AND is_sufficient) AS suff_sequences, "
    "count(*) FILTER (kind = 's' AND NOT is_sufficient) AS insuff_sequences FROM hits GROUP BY row_id, field"
)
CTES["pat"] = (
    "SELECT 'k' AS kind, pos, is_sufficient, keyword AS text FROM fk UNION ALL "
    "SELECT 's', pos, is_sufficient, array_to_string(sequence, ' ') FROM fs"
)
CTES["pat_n"] = "SELECT count(*) + 1 AS n, count(*) FILTER (is_sufficient) AS n_yes, count(*) FILTER (NOT is_sufficient) AS n_no FROM pat"


def vector_words(text: str) -> str:
    return (
        f"unnest(list_filter(regexp_extract_all(lower({text}), {lit('[' + WORD + ']{2,}')}), lambda t: t NOT IN ({lits(ENGLISH)})))"
    )


CTES["pat_terms"] = (
    f"SELECT kind, pos, is_sufficient, term, count(*) AS tf FROM (SELECT kind, pos, is_sufficient, {vector_words('text')} AS term FROM pat) GROUP BY ALL"
)
CTES["pat_df"] = "SELECT term, count(*) AS df FROM pat_terms GROUP BY term"
CTES["txt_words"] = f"SELECT row_id, field, {vector_words('text')} AS term FROM texts"
CTES["txt_terms"] = "SELECT row_id, field, term, count(*) AS tf FROM txt_words GROUP BY ALL"
CTES["more_words"] = (
    "SELECT row_id, field, term FROM txt_words UNION ALL "
    "SELECT h.row_id, h.field, w.term FROM hits h JOIN (SELECT kind, pos, is_sufficient, "
    f"{vector_words('text')} AS term FROM pat) w ON w.kind = h.kind AND w.pos = h.pos WHERE h.is_sufficient"
)
CTES["more_terms"] = "SELECT row_id, field, term, count(*) AS tf FROM more_words GROUP BY ALL"


def similarity_ctes(prefix: str, terms: str) -> None:
    p = prefix
    CTES[f"{p}norm"] = (
        f"SELECT t.row_id, t.field, sum(pow(t.tf * (ln((1 + n.n) / (1 + coalesce(f.df, 0) + 1)) + 1), 2)) AS d2 FROM {terms} t "
        f"CROSS JOIN pat_n n LEFT JOIN pat_df f ON f.term = t.term GROUP BY t.row_id, t.field"
    )
    CTES[f"{p}met"] = f"SELECT DISTINCT t.row_id, t.field, p.kind, p.pos FROM {terms} t JOIN pat_terms p ON p.term = t.term"
    idf = "(ln((1 + n.n) / (1 + f.df + CASE WHEN t.tf IS NULL THEN 0 ELSE 1 END)) + 1)"
    CTES[f"{p}sim"] = (
        f"SELECT m.row_id, m.field, m.kind, m.pos, p.is_sufficient, sum(coalesce(t.tf, 0) * p.tf * {idf} * {idf}) / "
        f"sqrt(any_value(z.d2) * sum(p.tf * p.tf * {idf} * {idf})) AS sim FROM {p}met m JOIN pat_terms p ON p.kind = m.kind AND p.pos = m.pos "
        f"JOIN pat_df f ON f.term = p.term CROSS JOIN pat_n n LEFT JOIN {terms} t ON t.row_id = m.row_id AND t.field = m.field AND t.term = p.term "
        f"JOIN {p}norm z ON z.row_id = m.row_id AND z.field = m.field GROUP BY m.row_id, m.field, m.kind, m.pos, p.is_sufficient"
    )


def score_ctes(prefix: str, terms: str, failing: str) -> None:
    p = prefix
    similarity_ctes(p, terms)
    CTES[f"{p}mean"] = (
        f"SELECT row_id, field, sum(sim) FILTER (is_sufficient) / any_value(greatest(n_yes, 1)) AS s_yes, "
        f"sum(sim) FILTER (NOT is_sufficient) / any_value(greatest(n_no, 1)) AS s_no FROM {p}sim CROSS JOIN pat_n GROUP BY row_id, field"
    )
    CTES[f"{p}parts"] = (
        "SELECT t.row_id, t.field, t.text, coalesce(c.suff_keywords + c.suff_sequences, 0) AS yes, coalesce(c.insuff_keywords + c.insuff_sequences, 0) AS no, "
        f"coalesce(m.s_yes, 0) AS s_yes, coalesce(m.s_no, 0) AS s_no FROM texts t LEFT JOIN counted c ON c.row_id = t.row_id AND c.field = t.field "
        f"LEFT JOIN {p}mean m ON m.row_id = t.row_id AND m.field = t.field"
    )
    CTES[f"{p}final"] = (
        "SELECT *, round(least(CASE WHEN s_no > 0 THEN s_yes - s_no ELSE s_yes END + least(CAST(yes AS DOUBLE) * 0.1, 0.5), 1), 10) AS final, "
        f"coalesce(regexp_replace(text, {lit(SPACES)}, '', 'g'), '') = '' OR (SELECT n FROM pat_n) = 1 AS void FROM {p}parts"
    )
    CTES[f"{p}scored"] = (
        "SELECT row_id, field, yes AS suff_matches, no AS insuff_matches, CASE WHEN NOT void AND (final > 0.5 OR (yes > no AND final > 0)) "
        f"THEN 'sufficient' ELSE {lit(failing)} END AS label, CASE WHEN void THEN 0.0 ELSE CAST(printf('%.2f', final * 100) AS DOUBLE) END AS percentage FROM {p}final"
    )


score_ctes("plain_", "txt_terms", "not sufficient")
score_ctes("more_", "more_terms", "insufficient")
CTES["report_rows"] = (
    f"SELECT d.doc_id AS row_id, {FIRST_LINE} AS short, d.text AS long, s.label AS l1, s.percentage AS p1, e.label AS l2, e.percentage AS p2 FROM documents d "
    "JOIN plain_scored s ON s.row_id = d.doc_id AND s.field = 'short_description' JOIN plain_scored e ON e.row_id = d.doc_id AND e.field = 'description'"
)
BOUND = [name for name in list(CTES)[list(CTES).index("fk") :] if name not in ("texts", "spaced", "txt_words", "txt_terms")]
for _name in BOUND:
    CTES[f"other_{_name}"] = re.sub(r"\b(" + "|".join(BOUND) + r")\b", r"other_\1", CTES[_name]).replace("'automatable'", "'non_automatable'")


def per_category(name: str, columns: str, source: str) -> None:
    """The same from the tables of each category's network."""
    oracle(name, f"SELECT 'automatable' AS category, {columns} FROM {source} UNION ALL SELECT 'non_automatable', {columns} FROM other_{source}")


per_category("match_substrings", "row_id, field, pos", "sub")
per_category("match_sequences_ordered", "row_id, field, pos", "ord")
per_category("match_counts", "*", "counted")
per_category("pattern_similarity", "row_id, field, kind, pos, is_sufficient, round(sim, 6) AS sim", "plain_sim")
per_category("score_description", "*", "plain_scored")
per_category("score_description_enhanced", "*", "more_scored")
per_category(
    "row_report",
    "row_id, concat_ws(chr(10), 'Row ' || row_id || ':', '  Short description: ' || coalesce(short, ''), "
    "'    Sufficiency: ' || l1 || ', Percentage: ' || printf('%.2f', p1) || '%', '  Description: ' || coalesce(long, ''), "
    "'    Sufficiency: ' || l2 || ', Percentage: ' || printf('%.2f', p2) || '%', repeat('-', 50)) AS report", "report_rows",
)

# --- annotations and labels --------------------------------------------------------------------------

CTES["doc_words"] = r"SELECT doc_id, regexp_split_to_array(text, '\s+') AS w FROM documents"
CTES["orgs"] = (
    "SELECT doc_id, i AS pos, i AS start_, i + 1 AS end_, w[i + 1] AS text FROM (SELECT doc_id, w, unnest(range(0, len(w))) AS i FROM doc_words) "
    "WHERE regexp_matches(w[i + 1], '^[A-Z]')"
)
CTES["chunks"] = (
    "SELECT doc_id, i AS pos, i AS start_, i + 2 AS end_, w[i + 1] || ' ' || w[i + 2] AS text FROM "
    "(SELECT doc_id, w, unnest(range(0, len(w) - 1, 2)) AS i FROM doc_words WHERE len(w) >= 2)"
)
CTES["merged"] = (
    "SELECT doc_id, 0 AS grp, pos, lower(text) AS text, 'ORG' AS type FROM orgs UNION ALL "
    "SELECT doc_id, 1, pos, lower(text), 'NOUN_CHUNK' FROM chunks c WHERE NOT EXISTS "
    "(SELECT 1 FROM orgs o WHERE o.doc_id = c.doc_id AND (o.start_ = c.start_ OR o.start_ = c.start_ + 1))"
)
oracle("annotation_merge", "SELECT doc_id, CAST(grp AS BIGINT) AS grp, pos, text, type FROM merged")
oracle(
    "annotation_sufficiency",
    "SELECT d.doc_id, length(trim(d.text)) >= 20 AND (coalesce(e, 0) > 0 OR coalesce(c, 0) > 2) AS sufficient, "
    "CASE WHEN length(trim(d.text)) >= 20 THEN coalesce(e, 0) ELSE 0 END AS n_entities, "
    "CASE WHEN length(trim(d.text)) >= 20 THEN coalesce(c, 0) ELSE 0 END AS n_chunks, "
    "CASE WHEN length(trim(d.text)) >= 20 THEN coalesce(k, '') ELSE '' END AS keywords FROM documents d LEFT JOIN "
    "(SELECT doc_id, count(*) FILTER (grp = 0) AS e, count(*) FILTER (grp = 1) AS c, string_agg(text, ', ' ORDER BY grp, pos, text) AS k "
    "FROM merged GROUP BY doc_id) m ON m.doc_id = d.doc_id",
)
_POLAR = " ".join(f"WHEN {lit(t)} THEN {p}" for t, p in POLARITY)
CTES["polar"] = (
    f"SELECT conv_id, turn, CAST(list_sum(list_transform(regexp_split_to_array(lower(text), {lit('[^' + WORD + ']+')}), "
    f"lambda t: CASE t {_POLAR} ELSE 0 END)) AS BIGINT) AS polarity FROM conversations"
)
oracle(
    "sentiment_label",
    "SELECT conv_id, turn, polarity, CASE WHEN polarity > 0 THEN 'positive' WHEN polarity < 0 THEN 'negative' ELSE 'neutral' END AS label FROM polar",
)

# --- vectors -----------------------------------------------------------------------------------------


def hash_ctes(prefix: str, tokens: str, id_col: str) -> None:
    p = prefix
    CTES[f"{p}buckets"] = (
        f"SELECT {id_col} AS id, CAST(concat('0x', substr(md5(term), 1, 8)) AS BIGINT) % {DIM} AS dim_no, count(*) AS n FROM "
        f"(SELECT {id_col}, unnest(tokens) AS term FROM {tokens}) GROUP BY ALL"
    )
    CTES[f"{p}dims"] = (
        f"SELECT i.id, d.dim_no, CAST(coalesce(b.n, 0) / sqrt(sum(coalesce(b.n * b.n, 0)) OVER (PARTITION BY i.id)) AS FLOAT) AS value "
        f"FROM (SELECT DISTINCT id FROM {p}buckets) i CROSS JOIN (SELECT unnest(range({DIM})) AS dim_no) d "
        f"LEFT JOIN {p}buckets b ON b.id = i.id AND b.dim_no = d.dim_no"
    )
    CTES[f"{p}vectors"] = f"SELECT id, list(CAST(value AS DOUBLE) ORDER BY dim_no) AS v FROM {p}dims GROUP BY id"


hash_ctes("d_", "tok", "doc_id")
oracle("hash_embed", "SELECT id AS doc_id, dim_no, round(CAST(value AS DOUBLE), 5) AS value FROM d_dims")
CTES["gated"] = (
    "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '' WHEN doc_id % 5 = 1 THEN 'An ERROR: ' || text ELSE text END AS content, "
    "CASE WHEN doc_id % 3 = 0 THEN 'failed' END AS error_message FROM documents"
)
oracle(
    "embed_gate",
    "SELECT doc_id, content <> '' AND NOT contains(lower(content), 'error') AS by_text, "
    "content <> '' AND coalesce(error_message, '') = '' AS by_metrics FROM gated",
)
oracle(
    "vector_append",
    "SELECT e.vec_id, coalesce(d.text, '') AS text, len(e.embedding) AS n_dims, CAST(1 AS BIGINT) AS version FROM embeddings e "
    "LEFT JOIN documents d ON d.doc_id = e.vec_id",
)
DISTANCE = "round(list_sum(list_transform(list_zip({0}, {1}), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 10)"
CTES["near_vecs"] = f"SELECT q.vec_id AS query_id, s.vec_id, {DISTANCE.format('q.v', 's.v')} AS l2 FROM vecs q CROSS JOIN vecs s"
oracle(
    "knn_search",
    "SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY l2, vec_id) AS rank, vec_id, l2 FROM near_vecs QUALIFY rank <= 5",
)
CTES["questions"] = (
    f"SELECT conv_id * 1000 + turn AS query_id, text AS query, {clean_tokens('text')} AS tokens FROM conversations WHERE role = 'user'"
)
hash_ctes("q_", "questions", "query_id")
CTES["references_"] = (
    "SELECT query_id, list_sort(list_filter(tokens, lambda t: length(t) = list_max(list_transform(tokens, lambda u: length(u)))))[-1] AS word FROM questions"
)
CTES["asked"] = (
    f"SELECT q.id AS query_id, s.id AS vec_id, {DISTANCE.format('q.v', 's.v')} AS l2, contains(lower(d.text), r.word) AS mentions "
    "FROM q_vectors q JOIN references_ r ON r.query_id = q.id CROSS JOIN d_vectors s JOIN documents d ON d.doc_id = s.id"
)
CTES["found"] = (
    "SELECT a.query_id, a.vec_id, row_number() OVER (PARTITION BY a.query_id ORDER BY a.l2, a.vec_id) AS rank, d.text FROM asked a "
    "JOIN documents d ON d.doc_id = a.vec_id QUALIFY rank <= 5"
)
oracle(
    "knn_with_reference",
    "SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY mentions DESC, l2, vec_id) AS rank, vec_id, mentions FROM asked QUALIFY rank <= 5",
)
CTES["retrieved"] = (
    "SELECT q.query_id, q.query, CASE WHEN trim(q.query) = '' THEN '' ELSE coalesce(f.bullets, " + lit(NOTHING_FOUND) + ") END AS results, "
    "CASE WHEN trim(q.query) = '' THEN 0 ELSE coalesce(f.n, 0) END AS num_retrieved, "
    "CASE WHEN trim(q.query) = '' THEN 'User query is empty or missing' END AS error_message FROM questions q LEFT JOIN "
    "(SELECT query_id, string_agg('- ' || text, chr(10) ORDER BY rank) AS bullets, count(*) AS n FROM found GROUP BY query_id) f ON f.query_id = q.query_id"
)
oracle("retrieval_record", "SELECT query_id, results, num_retrieved, error_message FROM retrieved")
oracle(
    "retrieval_report",
    "SELECT query_id, concat_ws(chr(10), '## Document Query Report', '', '### Query Metadata', '- Query: ' || query, '', '### Query Metrics', "
    "'- Documents Retrieved: ' || num_retrieved, CASE WHEN coalesce(error_message, '') <> '' THEN '- Error: ' || error_message ELSE 'No errors reported.' END, "
    "'', '### Query Results', results) AS report FROM retrieved",
)
oracle(
    "query_prompts",
    "SELECT q.query_id, concat_ws(chr(10), '**User Query**: ' || q.query, '**Retrieved Documents**:', coalesce(f.t, '[]')) AS prompt FROM questions q "
    "LEFT JOIN (SELECT query_id, CAST(to_json(list(text ORDER BY rank)) AS VARCHAR) AS t FROM found GROUP BY query_id) f ON f.query_id = q.query_id",
)

# --- records -----------------------------------------------------------------------------------------

CTES["rec"] = (
    "SELECT doc_id, text, n_chars, doc_id % 5 AS form, CASE WHEN doc_id % 3 = 0 THEN 'partial read' END AS err, "
    "to_json({'content': text}) AS short_json FROM documents"
)
oracle(
    "parse_records",
    "SELECT doc_id, CASE form WHEN 3 THEN 'Error: Malformed JSON from agent' WHEN 4 THEN 'No relevant information found.' ELSE text END AS results, "
    "CASE WHEN form IN (3, 4) THEN 0 ELSE n_chars % 7 END AS num_retrieved, "
    "CASE form WHEN 3 THEN 'JSON decode error. Received: ' || substr(text, 1, 500) || '...' WHEN 4 THEN NULL ELSE err END AS error_message FROM rec",
)
CTES["doc_rec"] = (
    "SELECT doc_id, n_chars, form, CASE form WHEN 3 THEN 'Error: Agent returned malformed JSON.' ELSE text END AS content, "
    "CASE WHEN form < 3 THEN 'DOCX' END AS file_type, CASE WHEN form < 3 THEN n_chars END AS size, "
    "CASE WHEN form < 3 THEN n_chars - n_chars % 97 END AS cleaned, CASE WHEN form < 3 THEN '2025-05-27T06:51:20Z' END AS started, "
    "CASE form WHEN 3 THEN 'JSONDecodeError. Received: ' || substr(text, 1, 200) || '...' WHEN 4 THEN NULL ELSE err END AS error_message FROM rec"
)
oracle(
    "parse_document_records",
    "SELECT doc_id, content, file_type, CAST(size AS VARCHAR) AS file_size, size AS original_length, error_message FROM doc_rec",
)
_HEAD = (
    "'### File Metadata', '- Type: ' || coalesce(file_type, 'N/A'), '- Size: ' || coalesce(printf('%.2f KB', size / 1024), 'N/A'), "
    "'- Process Started (Overall): 2025-05-27T06:51:20Z', '', '### Processing Metrics', "
)
_TAIL = (
    "'', CASE WHEN coalesce(error_message, '') <> '' THEN '### Errors during Processing' || chr(10) || '- ' || error_message "
    "ELSE 'No errors reported by agent.' END, '', '### Analysis Results', "
)
oracle(
    "document_report",
    f"SELECT doc_id, concat_ws(chr(10), '## Transcript Processing Report', '', {_HEAD}"
    "'1. Parsing Stage:', '   - Duration: ' || coalesce(printf('%.2fs', size / 1000), 'N/A'), '   - Started: ' || coalesce(started, 'N/A'), '', "
    "'2. Cleaning Stage:', '   - Duration: N/A', '   - Started: N/A', '   - Original Length: ' || coalesce(CAST(size AS VARCHAR), 'N/A') || ' characters', "
    "'   - Cleaned Length: ' || coalesce(CAST(cleaned AS VARCHAR), 'N/A') || ' characters', "
    f"'   - Content Reduction: ' || coalesce(CAST(size - cleaned AS VARCHAR) || ' characters', 'N/A'), {_TAIL} content, '', '### Final Output', "
    "'Generated at: 2025-05-27T07:00:00Z') AS report FROM doc_rec",
)
oracle(
    "image_report",
    f"SELECT doc_id, concat_ws(chr(10), '## Image Processing Report', '', {_HEAD}"
    "'1. OCR Extraction Stage:', '   - Duration: ' || coalesce(printf('%.2fs', size / 1000), 'N/A'), '   - Started: ' || coalesce(started, 'N/A'), "
    f"{_TAIL} "
    "coalesce(nullif(content, ''), 'No text extracted')) AS report FROM doc_rec",
)
oracle(
    "parse_assignments",
    "SELECT doc_id, unnest(CASE doc_id % 4 WHEN 0 THEN ['Email Agent', 'Transcript Agent'] WHEN 1 THEN ['Email Agent'] "
    "WHEN 2 THEN ['Email Agent', 'Transcript Agent'] ELSE [] END) AS agent, '/assets/' || source || '/' || doc_id AS path FROM documents",
)
oracle(
    "email_fields",
    f"SELECT doc_id, source || '@host.example' AS mail_to, 'desk@host.example' AS mail_from, trim({FIRST_LINE}, ' ') AS subject, text AS body FROM documents",
)
oracle("rows_as_json", "SELECT doc_id, '{\"doc_id\":' || doc_id || ',\"quality\":' || quality || ',\"toxic\":' || toxic || '}' AS row_json FROM labels")

# --- pages and images --------------------------------------------------------------------------------

_page = f"regexp_replace(regexp_replace(html, {lit(documents.HIDDEN)}, ' ', 'g'), {lit(SPACES)}, ' ', 'g')"
_page = f"regexp_replace(regexp_replace({_page}, {lit(documents.BLOCK)}, chr(10), 'g'), {lit(documents.TAG)}, '', 'g')"
for _entity, _char in documents.ENTITIES:
    _page = f"replace({_page}, {lit(_entity)}, {lit(_char)})"
CTES["elements"] = (
    f"SELECT page_id, list_filter(list_transform(string_split({_page}, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS e FROM pages"
)
oracle(
    "page_elements",
    "SELECT page_id, i AS pos, e[i + 1] AS element FROM (SELECT page_id, e, unnest(range(len(e))) AS i FROM elements)",
)
CTES["uris"] = (
    "SELECT page_id, page_id % 4 AS form, list_transform(range(6), lambda i: 'data:image/png;base64,' || to_base64(encode(url || '#' || i))) AS u, "
    "url FROM pages"
)
oracle(
    "image_rows",
    "SELECT 'app' || page_id AS app_name, form <> 2 AS status, CAST(CASE form WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 0 END AS BIGINT) AS total_images, "
    "CASE WHEN form < 2 THEN u[1] END AS first_image, CASE form WHEN 2 THEN 'Failed to parse app_images JSON' "
    "ELSE 'Images Fetched Successfully' END AS message FROM uris UNION ALL "
    "SELECT 'no-app' || page_id, false, 0, NULL, 'Images Not Found' FROM uris",
)
oracle(
    "image_payloads",
    "SELECT 'app' || page_id AS app_name, CAST(i AS BIGINT) AS pos, 'image/png' AS mime, CAST(octet_length(encode(url || '#' || i)) AS BIGINT) AS n_bytes FROM "
    "(SELECT page_id, url, unnest(range(CASE form WHEN 0 THEN 6 WHEN 1 THEN 2 ELSE 0 END)) AS i FROM uris)",
)

# --- paths and routing -------------------------------------------------------------------------------

CTES["paths_"] = (
    f"SELECT doc_id, source, n_chars, [{lits(EXTENSIONS)}][doc_id % 9 + 1] AS ext, '/assets/' || source || '/' || doc_id || "
    f"[{lits(EXTENSIONS)}][doc_id % 9 + 1] AS local_path FROM documents"
)
CTES["routed"] = (
    "SELECT CASE WHEN doc_id % 10 = 0 THEN 'https://host.example' || local_path || '?v=1' ELSE local_path END AS path, "
    "doc_id % 10 = 0 AS url, doc_id % 10 = 0 OR doc_id % 2 = 0 AS images, ext FROM paths_"
)
oracle("file_metadata", "SELECT doc_id, local_path AS path, upper(replace(ext, '.', '')) AS file_type, n_chars AS file_size FROM paths_")


def route_sql(mail_images: bool, site: bool) -> str:
    f, i, m, t, s = (lit(a) for a in (routing.FILE, routing.IMAGE, routing.EMAIL, routing.TRANSCRIPT, routing.SHAREPOINT))
    pictured = "ext IN ('.pdf', '.pptx', '.xlsx'" + (", '.eml'" if mail_images else "") + ")"
    if site:
        pictured += " OR (ext = '' AND url)"  # an unclear URL counts as .pdf
    return (
        f"SELECT path, unnest(list_filter([CASE ext WHEN '.eml' THEN {m} WHEN '.vtt' THEN {t} WHEN '.txt' THEN {t} WHEN '.png' THEN {i} ELSE {f} END, "
        f"CASE WHEN images AND ({pictured}) THEN {i} END, " + (f"CASE WHEN url THEN {s} END" if site else "NULL") + "], lambda a: a IS NOT NULL)) AS agent FROM routed"
    )


oracle(
    "route_documents",
    f"SELECT path, agent, 'with_site' AS rules FROM ({route_sql(False, True)}) UNION ALL "
    f"SELECT path, agent, 'with_mail_images' FROM ({route_sql(True, False)})",
)
oracle("routing_summary", f"SELECT agent, 'processed' AS status, count(*) AS n FROM ({route_sql(False, True)}) GROUP BY agent")
oracle(
    "resolve_paths",
    "SELECT doc_id AS request_id, CASE doc_id % 7 WHEN 0 THEN 'assets/' || source || '/./' || doc_id || '.txt' "
    "WHEN 1 THEN '/data/assets/' || source || '/' || doc_id || '.txt' WHEN 2 THEN source || '/' || doc_id || '.txt' "
    "WHEN 3 THEN 'elsewhere/' || doc_id || '.md' WHEN 4 THEN 'missing/' || doc_id || '.bin' WHEN 5 THEN '  ' ELSE '{{ params.file_name }}' END AS file_name, "
    "CASE WHEN doc_id % 7 < 3 THEN '/data/assets/' || source || '/' || doc_id || '.txt' WHEN doc_id % 7 = 3 THEN '/data/assets/' || doc_id || '.md' END AS path, "
    "CASE WHEN doc_id % 7 < 3 THEN 'found' WHEN doc_id % 7 = 3 THEN 'fallback' WHEN doc_id % 7 = 4 THEN 'not found' ELSE 'invalid' END AS status FROM documents",
)
oracle(
    "path_guard",
    "SELECT doc_id, '/data/assets/' || source || '/' || doc_id || '.txt' AS expected, CASE doc_id % 4 WHEN 0 THEN '/data/assets/' || source || '/' || doc_id || '.txt' "
    "WHEN 1 THEN '/data//assets/./' || source || '/' || doc_id || '.txt/' WHEN 2 THEN '/data/old/../assets/' || source || '/' || doc_id || '.txt' "
    "ELSE '/data/other/' || source || '/' || doc_id || '.txt' END AS actual, CASE WHEN doc_id % 4 = 3 THEN 'Path mismatch: expected /data/assets/' || source || '/' || doc_id || "
    "'.txt, got /data/other/' || source || '/' || doc_id || '.txt' END AS error FROM documents",
)

# --- sections and versions ---------------------------------------------------------------------------

oracle(
    "compose_sections",
    "SELECT CAST(substr(source, 4) AS BIGINT) AS pos, CAST(0 AS BIGINT) AS part, '' AS source, CAST(0 AS BIGINT) AS item, source AS section, '## ' || source AS line FROM "
    "(SELECT DISTINCT source FROM documents) UNION ALL SELECT CAST(substr(source, 4) AS BIGINT), 1, 'documents', doc_id, source, text FROM documents UNION ALL "
    "SELECT CASE WHEN 'src' || (conv_id % 20) IN (SELECT source FROM documents) THEN conv_id % 20 END, 1, 'conversations', conv_id * 1000 + turn, 'src' || (conv_id % 20), text FROM conversations",
)
oracle(
    "version_history",
    "SELECT conv_id, turn, row_number() OVER v AS version, md5(text) AS content_hash, "
    "lag(md5(text)) OVER v IS DISTINCT FROM md5(text) AS changed FROM conversations WINDOW v AS (PARTITION BY conv_id ORDER BY turn)",
)
