"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.bpe_encode import bpe_digests
from wordloom.llm.collocations import collocations
from wordloom.llm.fingerprint import fingerprints
from wordloom.llm.html_text import extract_text
from wordloom.llm.jaccard_join import jaccard_components
from wordloom.llm.langid import predict_languages, train_identifier
from wordloom.llm.lm_score import ctw_scores
from wordloom.llm.packing import pack_documents
from wordloom.llm.quality import quality_scores
from wordloom.llm.quality_rules import rule_verdicts
from wordloom.llm.spelling import spelling_variants
from wordloom.llm.token_count import token_counts
from wordloom.llm.topk import exact_top_k


def op1_lm_score(spark: SparkSession, sf: str) -> DataFrame:
    """log10 probability of every document by context-tree weighting, beside the word-unigram base."""
    return ctw_scores(spark.read.parquet(f"{sf}/documents.parquet"))


def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document by rank-order profiles."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return predict_languages(docs, train_identifier(docs))


def op3_bpe_codec(spark: SparkSession, sf: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return bpe_digests(spark.read.parquet(f"{sf}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))


def op4_token_count(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it exceeds 512 tokens."""
    return token_counts(spark.read.parquet(f"{sf}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    """Bottom-k sketches of every document and of its edited text."""
    return fingerprints(spark.read.parquet(f"{sf}/documents.parquet"))


def op6_html_text(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of every page."""
    return extract_text(spark.read.parquet(f"{sf}/pages.parquet"))


def op7_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Calibrated quality of every document, learned from the labels."""
    return quality_scores(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))


def op8_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's tokens in sequences of the permitted lengths."""
    counts = token_counts(spark.read.parquet(f"{sf}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
    return pack_documents(counts, length="n_tokens")


def op9_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles are alike by 0.9 or more."""
    return jaccard_components(spark.read.parquet(f"{sf}/documents.parquet"), words=3, over=9, under=10)


def op10_top_k(spark: SparkSession, sf: str) -> DataFrame:
    """The five best inner products of every fiftieth vector with all others."""
    return exact_top_k(spark.read.parquet(f"{sf}/embeddings.parquet"), F.col("id") % 50 == 0)


def op11_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Measurements of every document, the mask of rules that it fails, and the verdict of the current policy."""
    return rule_verdicts(spark.read.parquet(f"{sf}/documents.parquet"))


def op12_collocations(spark: SparkSession, sf: str) -> DataFrame:
    """The best two- and three-word phrases of each language."""
    return collocations(spark.read.parquet(f"{sf}/documents.parquet"))


def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Every word of the corpus with the more frequent word that it is a variant of."""
    return spelling_variants(spark.read.parquet(f"{sf}/documents.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_score": op1_lm_score,
    "op2_language_id": op2_language_id,
    "op3_bpe_codec": op3_bpe_codec,
    "op4_token_count": op4_token_count,
    "op5_fingerprint": op5_fingerprint,
    "op6_html_text": op6_html_text,
    "op7_quality": op7_quality,
    "op8_packing": op8_packing,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_top_k": op10_top_k,
    "op11_quality_rules": op11_quality_rules,
    "op12_collocations": op12_collocations,
    "op13_spelling_variants": op13_spelling_variants,
}

#: SQL twins, where SQL can express the operator. The other operators rest on hashes, vocabularies, trained models or
#: packing searches that SQL lacks; their tests hold them against brute force or the tokenizers library.
ORACLES: dict[str, str] = {
    "op9_jaccard_join": r"""
        WITH RECURSIVE words AS MATERIALIZED (
            SELECT doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'
            ), lambda w: w <> '') AS w FROM documents
        ), shingles AS MATERIALIZED (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s FROM words
        ), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        pairs AS MATERIALIZED (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
        ), links AS MATERIALIZED (
            SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)
        ), ways AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reach AS (SELECT x AS a, x AS b FROM ways UNION SELECT r.a, w.y FROM reach r JOIN ways w ON w.x = r.b)
        SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id FROM documents d
        LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) m ON m.a = d.doc_id
    """,
    "op10_top_k": """
        WITH whole AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        ), scored AS MATERIALIZED (
            SELECT q.vec_id AS query_id, c.vec_id,
                CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM scored QUALIFY rank <= 5
    """,
    "op11_quality_rules": r"""
        WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS entry, doc_id, coalesce(text, '') AS text FROM documents),
        split AS MATERIALIZED (
            SELECT entry, doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
                list_filter(string_split(text, chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines FROM texts
        ), windows AS MATERIALIZED (
            SELECT entry, place, count(*) OVER (PARTITION BY entry, run) AS times FROM (
                SELECT entry, place, array_to_string(w[place:place + 2], ' ') AS run FROM (SELECT entry, w, unnest(range(1, len(w) - 1)) AS place FROM split))
        ), repeats AS MATERIALIZED (
            SELECT entry, count(DISTINCT place + step) AS n FROM windows, (SELECT unnest([0, 1, 2]) AS step) WHERE times > 1 GROUP BY entry
        ), measured AS MATERIALIZED (
            SELECT s.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
                CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
                CAST(len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) AS BIGINT) AS n_alpha_words,
                CAST(len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS BIGINT) AS n_bullet_lines,
                CAST(len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS BIGINT) AS n_cut_lines
            FROM split s LEFT JOIN repeats r ON r.entry = s.entry
        ), noted AS MATERIALIZED (
            SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (n_words > 100000)::INT + 8 * (word_chars < 3 * n_words)::INT
                + 16 * (word_chars > 10 * n_words)::INT + 32 * (10 * n_symbols > n_words)::INT + 64 * (100 * n_dup_lines > 30 * n_lines)::INT
                + 128 * (100 * n_alpha_words < 80 * n_words)::INT + 256 * (100 * n_bullet_lines > 90 * n_lines)::INT + 512 * (100 * n_cut_lines > 30 * n_lines)::INT AS BIGINT) AS failed FROM measured
        )
        SELECT *, failed & 3 <> 0 AS base_failed, failed & 1019 = 0 AS kept FROM noted
    """,
    "op12_collocations": r"""
        WITH pieces AS MATERIALIZED (
            SELECT lang, row_number() OVER () AS piece, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM (
                SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
        ), totals AS MATERIALIZED (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
        found AS MATERIALIZED (
            SELECT lang, size, w, array_to_string(w, ' ') AS phrase, count(*) AS f FROM (
                SELECT lang, size, w[i:i + size - 1] AS w FROM (
                    SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM pieces, (SELECT unnest([1, 2, 3]) AS size))
            ) GROUP BY lang, size, w HAVING count(*) >= 10
        ), inside AS MATERIALIZED (
            SELECT lang, phrase, max(f) AS longer FROM (SELECT lang, f, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM found WHERE size = 3) GROUP BY ALL
        ), cuts AS MATERIALIZED (
            SELECT c.lang, c.phrase, c.f AS a, c.k, x.f AS l, y.f AS r, CAST((1000000 * CAST(c.f AS HUGEINT) * c.f) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score FROM (
                SELECT *, unnest(range(1, size)) AS k FROM found WHERE size >= 2) c
            JOIN found x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
            JOIN found y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')
        ), best AS MATERIALIZED (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
        SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank, b.phrase, b.a, b.l, b.r, t.n, b.score, b.k AS cut
        FROM best b JOIN totals t ON t.lang = b.lang LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
        WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a QUALIFY rank <= 2000
    """,
    "op13_spelling_variants": r"""
        WITH RECURSIVE crc AS MATERIALIZED (
            SELECT list(list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)
        ), runs AS MATERIALIZED (
            SELECT doc_id, run, count(*) AS times FROM (
                SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents
            ) GROUP BY ALL
        ), points AS MATERIALIZED (
            SELECT run, times, list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda x: CAST(unicode(x) AS BIGINT)) AS p FROM runs
        ), hashed AS MATERIALIZED (
            SELECT run, times, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(p, lambda c: CASE WHEN c < 128 THEN [c] ELSE [192 + (c >> 6), 128 + (c & 63)] END))),
                lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1])), 4294967295) AS h FROM points, crc
        ), words AS MATERIALIZED (
            SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
                SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM hashed
            ) WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
        ), holes AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
        near AS MATERIALIZED (
            SELECT x.word, y.word AS other, y.n FROM holes x JOIN holes y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
            UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON w.word = h.a || h.b
            UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON w.word = h.a || h.b
        ), best AS MATERIALIZED (SELECT word, count(*) AS n_near, arg_min(other, {'less': -n, 'other': other}) AS other, max(n) AS most FROM near GROUP BY word),
        forms AS MATERIALIZED (
            SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.most >= 2 * w.n THEN b.other END AS form, CASE WHEN b.most >= 2 * w.n THEN b.most END AS form_n
            FROM words w LEFT JOIN best b ON b.word = w.word
        ), chain AS (
            SELECT word, word AS stop, 0 AS step FROM forms UNION ALL SELECT c.word, f.form, c.step + 1 FROM chain c JOIN forms f ON f.word = c.stop WHERE f.form IS NOT NULL
        )
        SELECT f.word, f.n, f.form, f.form_n, f.n_near, c.root FROM forms f JOIN (SELECT word, arg_max(stop, step) AS root FROM chain GROUP BY word) c ON c.word = f.word
    """,
}
