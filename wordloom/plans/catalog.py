"""Every query by name: ``(spark, sf_dir) -> DataFrame`` over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions import records
from wordloom.functions.lexicon import POLARITY
from wordloom.functions.text import clean_tokens, clean_transcript, join_texts, once, preview, rows_of
from wordloom.operators import cliques, documents, graph, matching, path_index, paths, quotient, ranking, routing, scoring, sufficiency, text_blocks, tfidf, vectors
from wordloom.operators.similarity import ColumnGraph, member_edges, vector_edges
from wordloom.plans.network import Network, build_network, corpus_weights, keyword_classes
from wordloom.session import lasting, new_path, spread, stage
from wordloom.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DIM = 64
#: Limits that are the feature of the queries that name them: sampled nodes, first paths, vocabulary, new edges of a round.
SAMPLED_NODES = 500
FIRST_PATHS = 500
VOCABULARY = 1000
NEW_EDGES = 10_000
EXTENSIONS = (".pdf", ".pptx", ".xlsx", ".docx", ".eml", ".vtt", ".txt", ".png", "")
#: The time that the checked reports are given as theirs.
REPORTED = "2025-05-27 07:00:00"
CLOCK_PREFIX = "00:01:02.500 12:34 um so, "


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    return readers.labelled_corpus(spread(table(spark, sf, "documents").select("doc_id", "text")), table(spark, sf, "labels"))


def whole_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Both categories united."""
    return spread(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", F.lit("all").alias("category"), "text")


def first_line(text: Column) -> Column:
    return F.get(F.split(text, "\n"), F.lit(0))


_written: dict[tuple[str, str, str], object] = {}


def written_once(spark: SparkSession, sf: str, name: str, build: Callable):
    """What ``build`` wrote for this input; the queries of one session that need it read the same tables."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _written:
        with lasting():
            _written[key] = build()
    return _written[key]


def whole_classes(spark: SparkSession, sf: str) -> tuple[DataFrame, ColumnGraph]:
    """Ranked keywords and the graph between their classes."""
    return written_once(spark, sf, "classes", lambda: keyword_classes(corpus(spark, sf)))


def whole_graph(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Ranked keywords and their edges."""
    ranked, columns = whole_classes(spark, sf)
    return ranked, written_once(spark, sf, "links", lambda: stage(member_edges(columns), "links"))


def network(spark: SparkSession, sf: str) -> Network:
    """All keywords and edges; the first paths between sampled nodes."""
    return written_once(spark, sf, "network", lambda: build_network(
        corpus(spark, sf), sample=SAMPLED_NODES, sequence_cap=FIRST_PATHS, built=whole_classes(spark, sf)
    ))


def refined_classes(spark: SparkSession, sf: str) -> tuple[ColumnGraph, DataFrame]:
    """Classes, and the refined edges of the network between them."""
    _, columns = whole_classes(spark, sf)
    return columns, written_once(spark, sf, "refined", lambda: stage(quotient.refine(columns), "refined"))


def text_of(value: Column, digits: int = 6) -> Column:
    return F.round(value, digits)


# --- sources -----------------------------------------------------------------------------------------


@query
def scan_corpus(spark, sf):
    return corpus(spark, sf)


@query
def stage_parquet(spark, sf):
    path = new_path(spark, "staged-corpus")
    readers.stage_parquet(corpus(spark, sf), path)
    return readers.stage_parquet(corpus(spark, sf), path)


def derived_paths(spark, sf) -> DataFrame:
    ext = F.get(F.array(*[F.lit(e) for e in EXTENSIONS]), (F.col("doc_id") % len(EXTENSIONS)).cast("int"))
    local = F.concat(F.lit("/assets/"), "source", F.lit("/"), F.col("doc_id").cast("string"), ext)
    url = F.concat(F.lit("https://host.example"), local, F.lit("?v=1"))
    return table(spark, sf, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 10 == 0, url).otherwise(local).alias("path"),
        local.alias("local_path"),
        (F.col("doc_id") % 2 == 0).alias("has_images"),
        F.col("n_chars").alias("file_size"),
    )


@query
def file_metadata(spark, sf):
    rows = derived_paths(spark, sf)
    return rows.select(
        "doc_id", F.col("local_path").alias("path"), documents.file_type(F.col("local_path")).alias("file_type"), "file_size"
    )


@query
def page_elements(spark, sf):
    pages = rows_of(spread(table(spark, sf, "pages").select("page_id", "html")), ["page_id"], documents.page_elements(F.col("html")), "pos", "element")
    return pages.withColumn("pos", F.col("pos").cast("bigint"))


@query
def resolve_paths(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", F.col("doc_id").cast("string").alias("n"))
    full = F.concat(F.lit("/data/assets/"), "source", F.lit("/"), "n", F.lit(".txt"))
    manifest = docs.select(F.explode(F.array(full, F.concat(F.lit("/data/assets/"), "n", F.lit(".md")))).alias("full_path"))
    kinds = [
        F.concat(F.lit("assets/"), "source", F.lit("/./"), "n", F.lit(".txt")),
        full,
        F.concat("source", F.lit("/"), "n", F.lit(".txt")),
        F.concat(F.lit("elsewhere/"), "n", F.lit(".md")),
        F.concat(F.lit("missing/"), "n", F.lit(".bin")),
        F.lit("  "),
        F.lit("{{ params.file_name }}"),
    ]
    requests = docs.select(F.col("doc_id").alias("request_id"), F.get(F.array(*kinds), (F.col("doc_id") % 7).cast("int")).alias("file_name"))
    return documents.resolve_paths(requests, manifest, "/data", "/data/assets")


@query
def path_guard(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", F.col("doc_id").cast("string").alias("n"))
    want = F.concat(F.lit("/data/assets/"), "source", F.lit("/"), "n", F.lit(".txt"))
    forms = [
        want,
        F.concat(F.lit("/data//assets/./"), "source", F.lit("/"), "n", F.lit(".txt/")),
        F.concat(F.lit("/data/old/../assets/"), "source", F.lit("/"), "n", F.lit(".txt")),
        F.concat(F.lit("/data/other/"), "source", F.lit("/"), "n", F.lit(".txt")),
    ]
    rows = docs.select("doc_id", want.alias("expected"), F.get(F.array(*forms), (F.col("doc_id") % 4).cast("int")).alias("actual"))
    return documents.path_guard(rows)


def image_table(spark, sf) -> DataFrame:
    """app_images as JSON lists, JSON objects, bad JSON and nulls, made from the page URLs."""
    def uri(i):
        payload = F.replace(F.base64(F.concat("url", F.lit(f"#{i}")).cast("binary")), F.lit("\r\n"), F.lit(""))
        return F.concat(F.lit("data:image/png;base64,"), payload)

    pages = table(spark, sf, "pages")
    forms = F.when(F.col("page_id") % 4 == 0, F.to_json(F.array(*[uri(i) for i in range(6)]))).when(
        F.col("page_id") % 4 == 1, F.to_json(F.create_map(F.lit("a"), uri(0), F.lit("b"), uri(1)))
    ).when(F.col("page_id") % 4 == 2, F.concat(F.lit("[broken "), "url"))
    return pages.select("page_id", F.concat(F.lit("app"), F.col("page_id").cast("string")).alias("app_name"), forms.alias("app_images"))


@query
def image_rows(spark, sf):
    rows = image_table(spark, sf)
    asked = rows.select("app_name").unionByName(rows.select(F.concat(F.lit("no-"), "app_name").alias("app_name")))
    return records.image_envelopes(asked, rows.select("app_name", "app_images")).select(
        "app_name", "status", "total_images", F.get("images", F.lit(0)).alias("first_image"), "message"
    )


@query
def image_payloads(spark, sf):
    listed = rows_of(image_table(spark, sf), ["app_name"], records.image_list(F.col("app_images")), "pos", "uri")
    mime, size = records.image_payload(F.col("uri"))
    return listed.select("app_name", F.col("pos").cast("bigint").alias("pos"), mime.alias("mime"), size.alias("n_bytes"))


# --- texts -------------------------------------------------------------------------------------------


def validation_rows(spark, sf) -> DataFrame:
    """(row_id, category, short, description, text): the two text columns joined."""
    return corpus(spark, sf).select(
        F.col("doc_id").alias("row_id"), "category", first_line(F.col("text")).alias("short"),
        F.col("text").alias("description"),
    ).withColumn("text", join_texts(F.col("short"), F.col("description")))


@query
def combine_desc(spark, sf):
    docs = table(spark, sf, "documents")
    short = F.when(F.col("n_chars") % 3 != 0, first_line(F.col("text")))
    desc = F.when(F.col("n_chars") % 5 != 0, F.col("text"))
    return docs.select("doc_id", join_texts(short, desc).alias("combined"))


@query
def clean_keywords(spark, sf):
    tokens = tfidf.tokens_of(corpus(spark, sf), clean_tokens)
    return tokens.select(
        "doc_id", F.array_join("tokens", " ").alias("cleaned"), F.size("tokens").cast("bigint").alias("n_tokens")
    )


def cleaned_turns(spark, sf) -> DataFrame:
    raw = F.concat(F.lit(CLOCK_PREFIX), "text")
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", "role", raw.alias("raw"), clean_transcript(raw).alias("cleaned")
    )


def _lengths(rows: DataFrame) -> DataFrame:
    before, after = F.length("raw").cast("bigint"), F.length("cleaned").cast("bigint")
    return rows.withColumns({"original_length": before, "cleaned_length": after, "reduction": before - after})


@query
def clean_transcript_turns(spark, sf):
    return _lengths(cleaned_turns(spark, sf)).select(
        "conv_id", "turn", "cleaned", "original_length", "cleaned_length", "reduction"
    )


QUERIES["clean_transcript"] = QUERIES.pop("clean_transcript_turns")


@query
def cleaning_totals(spark, sf):
    return _lengths(cleaned_turns(spark, sf)).groupBy("role").agg(
        F.count(F.lit(1)).alias("n"), F.sum("original_length").alias("original_length"),
        F.sum("cleaned_length").alias("cleaned_length"), F.sum("reduction").alias("reduction"),
    )


@query
def text_preview(spark, sf):
    return table(spark, sf, "documents").select("doc_id", preview(F.col("text"), 300).alias("preview"))


# --- keywords ----------------------------------------------------------------------------------------


@query
def tfidf_weights(spark, sf):
    return corpus_weights(corpus(spark, sf), cap=None).withColumn("w", text_of(F.col("w")))


def _ranked(scores: DataFrame) -> DataFrame:
    return tfidf.rank_terms(scores)


@query
def keyword_scores(spark, sf):
    return _ranked(tfidf.term_scores(corpus_weights(corpus(spark, sf), cap=None)))


@query
def keywords_filtered(spark, sf):
    return _ranked(tfidf.filter_keywords(tfidf.term_scores(corpus_weights(corpus(spark, sf), cap=None))))


@query
def keywords_union(spark, sf):
    return _ranked(tfidf.term_scores(corpus_weights(whole_corpus(spark, sf), cap=None)))


@query
def keywords_capped(spark, sf):
    scores = tfidf.term_scores(corpus_weights(whole_corpus(spark, sf), VOCABULARY, keep_empty=True))
    return tfidf.rank_short_list(scores)


# --- graph -------------------------------------------------------------------------------------------


def _shown(edges: DataFrame) -> DataFrame:
    return edges.select("category", "a", "b", "w")


@query
def term_edges(spark, sf):
    return _shown(whole_graph(spark, sf)[1])


@query
def similarity_edges(spark, sf):
    rows = table(spark, sf, "embeddings").select(
        F.lit("all").alias("category"), F.col("vec_id").cast("string").alias("term"), F.col("vec_id").alias("rank"), "embedding"
    )
    return _shown(vector_edges(rows, 0.35))


@query
def refine_edges(spark, sf):
    _, columns = whole_classes(spark, sf)
    return _shown(quotient.expand(columns, quotient.refine(columns, rounds=3)))


@query
def class_links(spark, sf):
    """Classes of equal columns with their sizes, and each class that is linked to them."""
    _, columns = whole_classes(spark, sf)
    rows = quotient.class_neighbours(columns, quotient.class_edges(columns)).select("category", "class", "size", F.explode_outer("nested").alias("n"))
    return rows.select(
        "category", "class", "size", F.col("n.class").alias("linked"), F.col("n.size").alias("linked_size"), F.col("n.weight").alias("weight")
    )


@query
def refine_edges_capped(spark, sf):
    return _shown(graph.refine(whole_graph(spark, sf)[1], rounds=2, cap=NEW_EDGES))


@query
def connected_keywords(spark, sf):
    ranked, links = whole_graph(spark, sf)
    label = F.transform("nested", lambda x: F.concat(x["keyword"], F.lit(" "), F.format_string("%.4f", x["weight"])))
    return graph.connected(links).select(
        "category", "keyword", F.size("nested").cast("bigint").alias("degree"), F.array_join(label, "; ").alias("nested")
    )


@query
def node_sufficiency(spark, sf):
    _, columns = whole_classes(spark, sf)
    edges = stage(quotient.class_edges(columns), "class-edges")
    return quotient.node_sufficiency(columns, edges, min_weight=8.0).select("category", "term", "n_nodes", "strong_edges", "is_sufficient")


@query
def node_sample(spark, sf):
    ranked, _ = whole_graph(spark, sf)
    return graph.sample_nodes(ranked, SAMPLED_NODES).select("category", "term", "rank")


@query
def components(spark, sf):
    ranked, links = whole_graph(spark, sf)
    return graph.components(ranked, links).select("category", "term", "component")


def class_nodes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Classes by their first keywords, and the edges between them."""
    _, columns = whole_classes(spark, sf)
    return written_once(spark, sf, "class nodes", lambda: quotient.named(columns, quotient.class_edges(columns)))


def class_cliques(spark: SparkSession, sf: str) -> DataFrame:
    return written_once(spark, sf, "class cliques", lambda: quotient.class_cliques(*class_nodes(spark, sf)))


def class_paths(spark: SparkSession, sf: str) -> DataFrame:
    return written_once(spark, sf, "class paths", lambda: stage(quotient.class_paths(class_nodes(spark, sf)[1]), "class-paths"))


@query
def class_members(spark, sf):
    """Each keyword with its class and the first keyword of it, by which cliques and shortest paths name the class."""
    _, columns = whole_classes(spark, sf)
    first = columns.members.groupBy("category", "class").agg(F.min("term").alias("head"))
    return columns.members.join(first, ["category", "class"]).select("category", "term", "class", "head")


@query
def maximal_cliques(spark, sf):
    """All maximal cliques of the keyword graph, one name per class (members: ``class_members``); ``size`` counts keywords."""
    return class_cliques(spark, sf).select(
        "category", F.array_join(F.array_sort("members"), " ").alias("members"), F.size("members").cast("bigint").alias("n_classes"), "size"
    )


@query
def nested_keywords(spark, sf):
    _, columns = whole_classes(spark, sf)
    found = quotient.nested_keywords(columns, class_cliques(spark, sf))
    return found.select("category", F.array_join("nest", " ").alias("nest"), "size")


@query
def shortest_paths(spark, sf):
    """Cheapest paths between classes; between other members the ends alone change."""
    return class_paths(spark, sf).select("category", "source", "target", F.array_join("path", " ").alias("path"), "cost")


@query
def nested_paths(spark, sf):
    held = cliques.nested_paths(class_paths(spark, sf).select("category", "path"), class_cliques(spark, sf))
    return held.select("category", F.array_join("path", " ").alias("path"), F.array_join("clique", " ").alias("clique"))


def _sequences(spark, sf) -> DataFrame:
    ranked, links = whole_graph(spark, sf)
    return paths.simple_paths(graph.sample_nodes(ranked, SAMPLED_NODES), links, cap=FIRST_PATHS)


@query
def simple_paths(spark, sf):
    """All simple paths, as counts and numbers per source, limit and target."""
    ranked, links = whole_graph(spark, sf)
    name = lambda key, alias: ranked.select("category", F.col("rank").alias(key), F.col("term").alias(alias))
    index = path_index.path_index(links).join(name("rs", "source"), ["category", "rs"]).join(name("rt", "target"), ["category", "rt"])
    return index.select("category", "source", "max_len", "target", "n_paths", "first")


@query
def simple_paths_sampled(spark, sf):
    """The first paths between sampled nodes, written out."""
    return _sequences(spark, sf).select("category", "n", "max_len", F.array_join("path", " ").alias("path"))


@query
def nested_sequences_sampled(spark, sf):
    """The parts of the first paths between sampled nodes."""
    parts = _sequences(spark, sf).select("category", "n", F.posexplode(paths.sub_sequences(F.col("path"))).alias("pos", "part"))
    return parts.select("category", "n", F.col("pos").cast("bigint").alias("pos"), F.array_join("part", " ").alias("part"))


def _network_documents(spark, sf) -> DataFrame:
    net = network(spark, sf)
    path = new_path(spark, "network-json")
    writers.write_network(writers.network_documents(net.keywords, net.sequences), path)
    return readers.read_network(spark, path)


@query
def network_json(spark, sf):
    rows = readers.network_entries(_network_documents(spark, sf), "Keyword", "Keywords")
    nested = rows.select(
        "category", "pos", "entry.keyword", "entry.is_sufficient", F.explode_outer("entry.nested_keywords").alias("n"),
    )
    return nested.select(
        "category", "pos", "keyword", "is_sufficient", F.col("n.keyword").alias("nested_keyword"),
        F.col("n.weight").alias("weight"),
    )


@query
def network_shred(spark, sf):
    net = stage(_network_documents(spark, sf), "network")
    words = readers.network_keywords(net).select(
        "category", F.lit("keyword").alias("kind"), "pos", F.col("keyword").alias("label"),
        F.size("nested").cast("bigint").alias("n_nested"), "is_sufficient",
    )
    lists = readers.network_sequences(net).select(
        "category", F.lit("sequence").alias("kind"), "pos", F.array_join("sequence", " ").alias("label"),
        F.size("nested_sequences").cast("bigint").alias("n_nested"), "is_sufficient",
    )
    return words.unionByName(lists)


# --- matching and scoring ----------------------------------------------------------------------------


def _validation_tokens(rows: DataFrame) -> DataFrame:
    return rows.select("row_id", "category", once(clean_tokens(F.col("text"))).alias("tokens"))


@query
def match_keywords(spark, sf):
    net = network(spark, sf)
    tokens = _validation_tokens(validation_rows(spark, sf))
    return matching.match_keywords(tokens, net.keyword_rows(), ["row_id"], ["category"])


@query
def match_sequences_all(spark, sf):
    """How many of all sequences each text holds in full."""
    columns, edges = refined_classes(spark, sf)
    held = sufficiency.held_keywords(_validation_tokens(validation_rows(spark, sf)), columns, ["row_id"])
    return sufficiency.sequence_counts(sufficiency.held_classes(held, ["row_id"]), edges, ["row_id"])


@query
def match_sequences_sampled(spark, sf):
    """The first sequences between sampled nodes that each text holds in full, one by one."""
    net = network(spark, sf)
    tokens = _validation_tokens(validation_rows(spark, sf))
    return matching.match_sequences_all(tokens, net.sequences, ["row_id"], ["category"])


@query
def check_sufficiency(spark, sf):
    """Texts against all keywords and all sequences of the network."""
    columns, edges = refined_classes(spark, sf)
    rows = validation_rows(spark, sf)
    return sufficiency.check_rows(rows.select("row_id", "category"), _validation_tokens(rows), columns, edges)


@query
def check_sufficiency_sampled(spark, sf):
    """Texts against all keywords and the first sequences between sampled nodes, with these spelled out."""
    net = network(spark, sf)
    rows = validation_rows(spark, sf)
    checked = matching.check_sufficiency(
        rows.select("row_id", "category"), _validation_tokens(rows), net.keyword_rows(), net.sequences
    )
    return checked.select(
        "row_id", "category", F.col("Is_Sufficient").alias("is_sufficient"),
        F.col("Matched_Keywords").alias("matched_keywords"), F.col("Matched_Sequences").alias("matched_sequences"),
    )


@query
def sufficiency_summary(spark, sf):
    return matching.sufficiency_summary(check_sufficiency(spark, sf))


def _by_category(spark, sf, match: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """What ``match`` finds with the keywords and sequences of each category's network; category comes first."""
    net = network(spark, sf)
    found = None
    for category in readers.CATEGORIES:
        chosen = F.col("category") == category
        one = match(net.keyword_rows().filter(chosen), net.sequences.filter(chosen))
        one = one.select(F.lit(category).alias("category"), "*")
        found = one if found is None else found.unionByName(one)
    return found


def _networks(spark, sf) -> list[tuple[DataFrame, DataFrame]]:
    """Keywords and sequences of the network of each category, in the order of the categories."""
    net = network(spark, sf)
    return [(net.keyword_rows().filter(F.col("category") == c), net.sequences.filter(F.col("category") == c)) for c in readers.CATEGORIES]


def _with_category(found: DataFrame) -> DataFrame:
    category = F.get(F.array(*[F.lit(c) for c in readers.CATEGORIES]), F.col("net"))
    return found.select(category.alias("category"), *[c for c in found.columns if c != "net"])


def _texts(spark, sf) -> DataFrame:
    """Both text columns of the scoring table, one row each."""
    rows = spread(table(spark, sf, "documents").select("doc_id", "text")).select(
        F.col("doc_id").alias("row_id"), first_line(F.col("text")).alias("short_description"), F.col("text").alias("description")
    )
    return rows.unpivot("row_id", ["short_description", "description"], "field", "text")


KEY = ["row_id", "field"]


@query
def match_substrings(spark, sf):
    """Network keywords are runs of letters and digits, so what the runs of the texts hold is all there is."""
    lists = text_blocks.run_lists(_texts(spark, sf), KEY)
    hits = matching.substring_hits(lists, [keywords for keywords, _ in _networks(spark, sf)], KEY)
    return _with_category(hits.select("net", *KEY, F.explode("pos").alias("pos")))


@query
def match_sequences_ordered(spark, sf):
    texts = _texts(spark, sf)
    return _by_category(spark, sf, lambda _, sequences: matching.match_sequences_ordered(texts, sequences, KEY))


@query
def match_counts(spark, sf):
    texts, networks = _texts(spark, sf), _networks(spark, sf)
    lists = text_blocks.run_lists(texts, KEY)
    hits = matching.substring_hits(lists, [keywords for keywords, _ in networks], KEY, listed=False)
    return _with_category(matching.network_counts(hits, texts, networks, KEY, lists))


@query
def pattern_similarity(spark, sf):
    terms = scoring.text_terms(_texts(spark, sf), KEY)
    found = _by_category(spark, sf, lambda keywords, sequences: scoring.pattern_similarity(terms, scoring.patterns_of(keywords, sequences), KEY))
    return found.select("category", *KEY, "kind", "pos", "is_sufficient", text_of(F.col("sim")).alias("sim"))


def _scored(spark, sf, **options) -> DataFrame:
    return _with_category(scoring.score_networks(_texts(spark, sf), _networks(spark, sf), KEY, **options))


@query
def score_description(spark, sf):
    return _scored(spark, sf)


@query
def score_description_enhanced(spark, sf):
    return _scored(spark, sf, enhance=True, failing_label="insufficient")


@query
def row_report(spark, sf):
    rows = table(spark, sf, "documents").select(
        F.col("doc_id").alias("row_id"), first_line(F.col("text")).alias("short"), F.col("text").alias("description")
    )
    value = F.struct("label", "percentage")
    scored = _scored(spark, sf).groupBy("category", "row_id").agg(
        F.max(F.when(F.col("field") == "short_description", value)).alias("s"),
        F.max(F.when(F.col("field") == "description", value)).alias("d"),
    )
    report = records.score_report(F.col("row_id"), [
        ("Short description", F.col("short"), F.col("s.label"), F.col("s.percentage")),
        ("Description", F.col("description"), F.col("d.label"), F.col("d.percentage")),
    ])
    return rows.join(scored, "row_id").select("category", "row_id", report.alias("report"))


@query
def result_table(spark, sf):
    """The checked rows with their input columns, written and read back."""
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), "lang", "source", "n_chars")
    path = new_path(spark, "results")
    writers.write_results(rows, check_sufficiency(spark, sf), ["row_id"], path)
    return spark.read.parquet(path)


# --- annotations and labels --------------------------------------------------------------------------


def annotations(spark, sf) -> DataFrame:
    """Stand-in for a tagger: capitalised words as ORG, pairs of words as NOUN_CHUNK, spans in words."""
    words = F.split("text", r"\s+")
    docs = spread(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", once(words).alias("w"))
    orgs = docs.select("doc_id", F.posexplode("w").alias("i", "text")).filter(F.col("text").rlike("^[A-Z]")).select(
        "doc_id", F.col("i").alias("pos"), F.col("i").alias("start"), (F.col("i") + 1).alias("end"), "text",
        F.lit("ORG").alias("type"),
    )
    firsts = F.sequence(F.lit(0), F.size("w") - 2, F.lit(2))
    pairs = docs.filter(F.size("w") >= 2).select("doc_id", "w", F.explode(firsts).alias("i")).select(
        "doc_id", F.col("i").alias("pos"), F.col("i").alias("start"), (F.col("i") + 2).alias("end"),
        F.concat(F.get("w", F.col("i")), F.lit(" "), F.get("w", F.col("i") + 1)).alias("text"),
        F.lit("NOUN_CHUNK").alias("type"),
    )
    return orgs.unionByName(pairs)


@query
def annotation_merge(spark, sf):
    return documents.merge_annotations(annotations(spark, sf)).select(
        "doc_id", F.col("grp").cast("bigint").alias("grp"), F.col("pos").cast("bigint").alias("pos"), "text", "type"
    )


@query
def annotation_sufficiency(spark, sf):
    described = table(spark, sf, "documents").select("doc_id", F.col("text").alias("description"))
    return documents.annotation_sufficiency(described, annotations(spark, sf))


@query
def sentiment_label(spark, sf):
    lexicon = spark.createDataFrame(list(POLARITY), "term string, polarity int")
    words = F.split(F.lower("text"), r"[^\p{L}\p{N}_]+")
    tokens = table(spark, sf, "conversations").select("conv_id", "turn", once(words).alias("tokens"))
    return documents.sentiment_labels(tokens, lexicon, ["conv_id", "turn"])


# --- vectors -----------------------------------------------------------------------------------------


def _document_vectors(spark, sf) -> DataFrame:
    docs = spread(table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "text"))
    return vectors.embed_rows(docs.select("vec_id", "text", once(clean_tokens(F.col("text"))).alias("tokens")), DIM)


def _questions(spark, sf) -> DataFrame:
    """User turns as queries; the reference word of a query is its longest word."""
    longest = F.array_max(F.transform("tokens", lambda t: F.struct(F.length(t).alias("n"), t.alias("t"))))["t"]
    return table(spark, sf, "conversations").filter(F.col("role") == "user").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), F.col("text").alias("query"), once(clean_tokens(F.col("text"))).alias("tokens")
    ).withColumn("reference", longest)


def _asked(questions: DataFrame) -> DataFrame:
    return vectors.embed_rows(questions, DIM)


@query
def hash_embed(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text")).select(
        "doc_id", once(clean_tokens(F.col("text"))).alias("tokens")
    )
    long = vectors.hash_embed(docs, "doc_id", DIM).select("doc_id", F.posexplode("embedding").alias("dim_no", "value"))
    return long.select("doc_id", F.col("dim_no").cast("bigint").alias("dim_no"), text_of(F.col("value").cast("double"), 5).alias("value"))


@query
def embed_gate(spark, sf):
    rows = table(spark, sf, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 5 == 0, "").when(F.col("doc_id") % 5 == 1, F.concat(F.lit("An ERROR: "), "text"))
        .otherwise(F.col("text")).alias("content"),
        F.when(F.col("doc_id") % 3 == 0, "failed").alias("error_message"),
    )
    return vectors.embed_gate(rows).select("doc_id", "by_text", "by_metrics")


@query
def vector_append(spark, sf):
    path = new_path(spark, "vector-store")
    rows = table(spark, sf, "embeddings").join(
        table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "text"), "vec_id", "left"
    ).select(
        "vec_id", F.coalesce("text", F.lit("")).alias("text"), "embedding", "label",
        F.current_timestamp().alias("ingested_at"), F.md5(F.coalesce("text", F.lit(""))).alias("content_hash"),
    )
    for part in (F.col("label") % 2 == 0, F.col("label") % 2 != 0):
        vectors.append_vectors(rows.filter(part).drop("label"), path, DIM)
    stored = vectors.read_store(spark, path)
    return stored.select(
        "vec_id", "text", F.size("embedding").cast("bigint").alias("n_dims"), F.col("version").cast("bigint").alias("version")
    )


@query
def knn_search(spark, sf):
    rows = table(spark, sf, "embeddings")
    found = vectors.knn(rows.select(F.col("vec_id").alias("query_id"), "embedding"), rows, dim=DIM)
    return found.select("query_id", "rank", "vec_id", "l2")


def _hits(spark, sf, by_reference: bool = False) -> tuple[DataFrame, DataFrame]:
    questions = _questions(spark, sf)
    store = stage(_document_vectors(spark, sf), "store")
    hits = vectors.knn(_asked(questions), store, by_reference=by_reference)
    return questions, vectors.hit_texts(hits, store)


@query
def knn_with_reference(spark, sf):
    return _hits(spark, sf, True)[1].select("query_id", "rank", "vec_id", "mentions")


def _records(spark, sf) -> DataFrame:
    questions, hits = _hits(spark, sf)
    return vectors.retrieval_records(questions.select("query_id", "query"), hits)


@query
def retrieval_record(spark, sf):
    return _records(spark, sf)


@query
def retrieval_report(spark, sf):
    questions, hits = _hits(spark, sf)
    found = vectors.retrieval_records(questions.select("query_id", "query"), hits)
    report = records.retrieval_report(F.col("query"), F.col("results"), F.col("num_retrieved"), F.col("error_message"))
    return questions.join(found, "query_id").select("query_id", report.alias("report"))


@query
def query_prompts(spark, sf):
    questions, hits = _hits(spark, sf)
    return vectors.query_prompts(questions.select("query_id", "query"), hits)


# --- records -----------------------------------------------------------------------------------------


def raw_records(spark, sf) -> DataFrame:
    """Agent replies around document texts: plain and fenced JSON, plain words, a missing part."""
    docs = table(spark, sf, "documents")
    full = F.to_json(F.struct(
        F.col("text").alias("content"), F.col("text").alias("results"),
        F.struct(
            F.lit("DOCX").alias("file_type"), F.col("n_chars").alias("file_size"),
            (F.col("n_chars") / 1000).alias("parse_time"), F.lit("2025-05-27T06:51:20Z").alias("parse_start"),
            F.col("n_chars").alias("original_length"), (F.col("n_chars") - F.col("n_chars") % 97).alias("cleaned_length"),
            (F.col("n_chars") % 7).alias("num_retrieved"),
            F.when(F.col("doc_id") % 3 == 0, "partial read").alias("error_message"),
        ).alias("metrics"),
    ))
    fence = F.lit("```")
    forms = F.array(
        full, F.concat(fence, F.lit("json\n"), full, F.lit("\n"), fence), F.concat(fence, full, fence),
        F.col("text"), F.to_json(F.struct(F.col("text").alias("content"))),
    )
    return docs.select("doc_id", F.get(forms, (F.col("doc_id") % 5).cast("int")).alias("raw"))


@query
def parse_records(spark, sf):
    rows = records.parse_retrieval(raw_records(spark, sf))
    return rows.select("doc_id", "results", F.col("num_retrieved").cast("bigint").alias("num_retrieved"), "error_message")


@query
def parse_document_records(spark, sf):
    rows = records.parse_documents(raw_records(spark, sf))
    return rows.select("doc_id", "content", "metrics.file_type", "metrics.file_size", "metrics.original_length", "metrics.error_message")


@query
def parse_assignments(spark, sf):
    path = F.concat(F.lit("/assets/"), "source", F.lit("/"), F.col("doc_id").cast("string"))
    double = F.concat(F.lit('[{"agent": "Email Agent", "path": "'), path, F.lit('"}, {"agent": "Transcript Agent", "path": "'), path, F.lit('"}]'))
    single = F.concat(F.lit("[{'agent': 'Email Agent', 'path': '"), path, F.lit("'}]"))
    forms = F.array(double, single, F.concat(F.lit("```json\n"), double, F.lit("\n```")), F.lit("no list"))
    rows = table(spark, sf, "documents").select("doc_id", F.get(forms, (F.col("doc_id") % 4).cast("int")).alias("raw"))
    return rows_of(rows, ["doc_id"], records.parse_assignments(F.col("raw")), "a").select("doc_id", "a.agent", "a.path")


@query
def document_report(spark, sf):
    rows = records.parse_documents(raw_records(spark, sf))
    report = records.document_report(F.col("content"), F.col("metrics"), F.lit("2025-05-27T06:51:20Z"), records.utc_text(F.lit(REPORTED).cast("timestamp")))
    return rows.select("doc_id", report.alias("report"))


@query
def image_report(spark, sf):
    rows = records.parse_documents(raw_records(spark, sf))
    report = records.image_report(F.col("content"), F.col("metrics"), F.lit("2025-05-27T06:51:20Z"))
    return rows.select("doc_id", report.alias("report"))


@query
def email_fields(spark, sf):
    mail = F.concat(
        F.lit("From: desk@host.example\nTo: "), "source", F.lit("@host.example\nSubject: "), first_line(F.col("text")),
        F.lit("\n\n"), "text",
    )
    rows = table(spark, sf, "documents").select("doc_id", mail.alias("mail"))
    parts = records.email_fields(F.col("mail"))
    return rows.select("doc_id", *[c.alias(n) for n, c in parts.items()])


@query
def rows_as_json(spark, sf):
    return table(spark, sf, "labels").select("doc_id", F.to_json(F.struct("*")).alias("row_json"))


# --- routing, sections, versions ---------------------------------------------------------------------


@query
def route_documents(spark, sf):
    rows = derived_paths(spark, sf).select("path", "has_images")
    first = routing.route(rows).withColumn("rules", F.lit("with_site"))
    second = routing.route(rows, routing.RULES_WITH_MAIL_IMAGES, None).withColumn("rules", F.lit("with_mail_images"))
    return first.unionByName(second)


@query
def routing_summary(spark, sf):
    rows = derived_paths(spark, sf).select("path", "has_images")
    return routing.routing_summary(routing.mark_processed(routing.route(rows)))


@query
def compose_sections(spark, sf):
    docs = table(spark, sf, "documents")
    template = docs.select(F.col("source").alias("section")).distinct().select(
        "section", F.regexp_extract("section", r"(\d+)$", 1).cast("bigint").alias("pos"),
        F.concat(F.lit("## "), "section").alias("heading"),
    )
    from_docs = docs.select(F.col("source").alias("section"), F.lit("documents").alias("source"), F.col("doc_id").alias("item"), "text")
    talks = table(spark, sf, "conversations").select(
        F.concat(F.lit("src"), (F.col("conv_id") % 20).cast("string")).alias("section"), F.lit("conversations").alias("source"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("item"), "text",
    )
    return documents.compose_sections(template, [from_docs, talks]).withColumn("part", F.col("part").cast("bigint"))


@query
def version_history(spark, sf):
    return ranking.versions(table(spark, sf, "conversations"), "conv_id", ["turn"], "text")
