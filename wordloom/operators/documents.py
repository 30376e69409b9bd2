"""Documents: elements of pages, paths, sections, annotations, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.functions.text import SPACES

# Markup patterns of the element splitter, shared with the SQL check.
HIDDEN = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
BLOCK = (
    r"(?i)</?(address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h1|h2|h3|h4|h5|h6|head|header"
    r"|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|th|thead|title|tr|ul)(\s[^>]*)?/?>"
)
TAG = r"<[^>]*>"
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def page_elements(html: Column) -> Column:
    """Texts of the blocks of an HTML page, trimmed, without empty ones."""
    text = F.regexp_replace(F.regexp_replace(html, HIDDEN, " "), SPACES, " ")
    text = F.regexp_replace(F.regexp_replace(text, BLOCK, "\n"), TAG, "")
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def text_elements(text: Column) -> Column:
    """Paragraphs of plain text: parts between blank lines, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(text, r"\n\s*\n"), lambda x: F.trim(x)), lambda x: x != "")


def file_type(path: Column) -> Column:
    """Upper-case extension of the last path part, empty if it has none."""
    return F.upper(F.regexp_extract(path, r"[^/]\.([^./]*)$", 1))


def normal_path(path: Column) -> Column:
    """The path without empty, "." and "x/.." parts; a trailing slash is dropped."""
    absolute = path.startswith("/")

    def step(parts: Column, part: Column) -> Column:
        can_drop = (F.size(parts) > 0) & (F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit("")) != "..")
        return (
            F.when(part.isin("", "."), parts)
            .when((part == "..") & can_drop, F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))))
            .when((part == "..") & absolute, parts)
            .otherwise(F.array_append(parts, part))
        )

    parts = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step)
    joined = F.array_join(parts, "/")
    return F.when(absolute, F.concat(F.lit("/"), joined)).when(joined == "", ".").otherwise(joined)


def path_guard(rows: DataFrame) -> DataFrame:
    """Adds ``error`` to ``rows(expected, actual)``: null when both name the same file."""
    want, have = normal_path(F.col("expected")), normal_path(F.col("actual"))
    text = F.concat(F.lit("Path mismatch: expected "), want, F.lit(", got "), have)
    return rows.withColumn("error", F.when(~want.eqNullSafe(have), F.coalesce(text, F.lit("Path missing"))))


def resolve_paths(requests: DataFrame, manifest: DataFrame, root: str, assets: str) -> DataFrame:
    """(request_id, file_name, path, status) for ``requests(request_id, file_name)``.

    ``manifest(full_path)`` stands for the file system. Each name gives a main and
    a fallback candidate; both meet the manifest in one join.
    """
    name = F.col("file_name")
    valid = (F.coalesce(F.trim(name), F.lit("")) != "") & ~name.startswith("{{")
    main = (
        F.when(name.startswith("assets/"), normal_path(F.concat(F.lit(root + "/"), name)))
        .when(name.startswith("/"), name)
        .otherwise(F.concat(F.lit(assets + "/"), name))
    )
    fallback = F.concat(F.lit(assets + "/"), F.substring_index(name, "/", -1))
    tries = F.array(
        F.struct(F.lit(1).alias("turn"), main.alias("full_path")),
        F.struct(F.lit(2).alias("turn"), fallback.alias("full_path")),
    )
    found = (
        requests.filter(valid)
        .select("request_id", F.explode(tries).alias("t"))
        .select("request_id", "t.*")
        .join(manifest.select("full_path"), "full_path", "left_semi")
        .groupBy("request_id")
        .agg(F.min(F.struct("turn", "full_path")).alias("best"))
    )
    return requests.join(found, "request_id", "left").select(
        "request_id", "file_name", F.col("best.full_path").alias("path"),
        F.when(~F.coalesce(valid, F.lit(False)), "invalid").when(F.col("best").isNull(), "not found")
        .when(F.col("best.turn") == 1, "found").otherwise("fallback").alias("status"),
    )


def compose_sections(template: DataFrame, contents: list[DataFrame]) -> DataFrame:
    """Lines of a document in template order: (pos, part, source, item, section, line).

    Outputs of several extractors ``(section, source, item, text)`` are united and
    put under their headings. A section may hold any amount of text, so the
    document is a sorted set of lines and not one value; order by the first four. Text of a
    section that the template lacks has no ``pos``; order it last.
    """
    content = contents[0]
    for other in contents[1:]:
        content = content.unionByName(other, allowMissingColumns=True)
    heads = template.select(
        "pos", F.lit(0).alias("part"), F.lit("").alias("source"), F.lit(0).cast("bigint").alias("item"),
        "section", F.col("heading").alias("line"),
    )
    lines = content.join(template.select("section", "pos"), "section", "left").select(
        "pos", F.lit(1).alias("part"), "source", "item", "section", F.col("text").alias("line")
    )
    return heads.unionByName(lines)


ENTITY_TYPES = ("ORG", "GPE", "PRODUCT")
CHUNK = "NOUN_CHUNK"
MIN_DESCRIPTION = 20


def merge_annotations(annotations: DataFrame) -> DataFrame:
    """Entities, then the noun chunks that touch none: (doc_id, grp, pos, text, type).

    ``annotations(doc_id, pos, start, end, text, type)``, spans half open. Of the
    entities that begin no later, the furthest end decides; of those that begin no
    earlier, the nearest begin. Two ordered windows replace a span join; each frame only grows, so both are linear.
    """
    entity = F.col("type").isin(*ENTITY_TYPES)
    spans = annotations.filter(entity | (F.col("type") == CHUNK))
    by_start = Window.partitionBy("doc_id").orderBy("start")
    reach = F.max(F.when(entity, F.col("end"))).over(by_start.rangeBetween(Window.unboundedPreceding, 0))
    from_end = Window.partitionBy("doc_id").orderBy(F.desc("start"))
    next_up = F.min(F.when(entity, F.col("start"))).over(from_end.rangeBetween(Window.unboundedPreceding, 0))
    touched = F.coalesce(reach > F.col("start"), F.lit(False)) | F.coalesce(next_up < F.col("end"), F.lit(False))
    return spans.withColumn("_touched", touched).filter(entity | ~F.col("_touched")).select(
        "doc_id", F.when(entity, 0).otherwise(1).alias("grp"), "pos", F.lower("text").alias("text"), "type"
    )


def annotation_sufficiency(descriptions: DataFrame, annotations: DataFrame, min_length: int = MIN_DESCRIPTION) -> DataFrame:
    """(doc_id, sufficient, n_entities, n_chunks, keywords) for ``descriptions(doc_id, description)``."""
    label = F.struct("grp", "pos", "text")
    found = merge_annotations(annotations).groupBy("doc_id").agg(
        F.count_if(F.col("grp") == 0).alias("e"), F.count_if(F.col("grp") == 1).alias("c"),
        F.sort_array(F.collect_list(label)).alias("k"),
    )
    long_enough = F.coalesce(F.length(F.trim("description")) >= min_length, F.lit(False))
    # The texts stay where they are: the join takes only whether they are long enough.
    told = descriptions.select("doc_id", long_enough.alias("long_enough"))
    long_enough, e, c = F.col("long_enough"), F.coalesce("e", F.lit(0)), F.coalesce("c", F.lit(0))
    return told.join(found, "doc_id", "left").select(
        "doc_id",
        (long_enough & ((e > 0) | (c > 2))).alias("sufficient"),
        F.when(long_enough, e).otherwise(0).cast("bigint").alias("n_entities"),
        F.when(long_enough, c).otherwise(0).cast("bigint").alias("n_chunks"),
        F.when(long_enough & F.col("k").isNotNull(),
               F.array_join(F.transform("k", lambda x: x["text"]), ", ")).otherwise("").alias("keywords"),
    )


def sentiment_labels(tokens: DataFrame, lexicon: DataFrame, key: list[str]) -> DataFrame:
    """(key, polarity, label) with the label one of positive, negative, neutral."""
    met = (
        tokens.select(*key, F.explode("tokens").alias("term"))
        .join(lexicon, "term")
        .groupBy(*key)
        .agg(F.sum("polarity").alias("polarity"))
    )
    total = F.coalesce("polarity", F.lit(0))
    return tokens.select(*key).join(met, key, "left").select(
        *key, total.cast("bigint").alias("polarity"),
        F.when(total > 0, "positive").when(total < 0, "negative").otherwise("neutral").alias("label"),
    )
