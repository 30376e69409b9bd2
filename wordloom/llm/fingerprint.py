"""Bottom-k sketches of word shingles, as column expressions only.

A sketch is the ascending list of the k least 63-bit hashes of a text's distinct shingles;
with fewer than k shingles it holds them all and every estimate is exact. Sketches of
parts merge into the sketch of the whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import pick
from wordloom.session import stage

SIZE = 64
SHINGLE = 5
LARGEST = float(1 << 63)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def least(hashes: Column, k: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = SIZE, shingle: int = SHINGLE) -> Column:
    """The sketch of a text's runs of ``shingle`` words; a shorter text is one shingle, an empty one has none."""
    words = F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), "")

    def runs(hashed: Column) -> Column:
        n = F.size(hashed)
        starts = F.sequence(F.lit(0), F.greatest(n - shingle, F.lit(0)))
        run = F.transform(
            starts, lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(hashed, i + step) for step in range(shingle)]), 1)
        )
        return F.when(n > 0, least(run, k)).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), runs)


def merge(a: Column, b: Column, k: int = SIZE) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = SIZE) -> Column:
    """Estimated Jaccard likeness: the share of the merged sketch that both hold; two empty ones are alike."""
    both = let(merge(a, b, k), lambda m: F.size(F.array_intersect(F.array_intersect(m, a), b)) / F.greatest(F.size(m), F.lit(1)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both)


def distinct_shingles(a: Column, k: int = SIZE) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * LARGEST / F.element_at(a, -1))


def containment(a: Column, b: Column, k: int = SIZE) -> Column:
    """Estimated share of a's shingles that b holds too; an empty a is contained."""
    shared = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """Sixteen hexadecimal digits for each hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def next_keys(ids: DataFrame) -> DataFrame:
    """(key, next_key) in ascending order of distinct ids, null first; after the last comes the first."""
    placed = stage(ids.orderBy(F.asc_nulls_first("id")).select("key", F.monotonically_increasing_id().alias("at")), "ids")
    placed = placed.withColumn("slice", F.shiftright("at", 33))
    slices = placed.groupBy("slice").agg(F.min(F.struct("at", "key")).alias("head"))  # one row per range partition
    over_all = Window.orderBy("slice")
    after = slices.select("slice", F.coalesce(F.lead("head").over(over_all), F.first("head").over(over_all)).alias("head"))
    following = F.lead(F.struct("at", "key")).over(Window.partitionBy("slice").orderBy("at"))
    linked = placed.withColumn("following", following)
    return linked.join(F.broadcast(after), "slice").select("key", F.coalesce("following", "head")["key"].alias("next_key"))


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = SIZE, shingle: int = SHINGLE) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how like they and the next text's are.

    The edited text has its last half (rounded down) replaced by as many code points of the next document,
    in ascending order of ids, or all it has; after the last comes the first. Returns doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, distinct_shingles, next_doc_id.

    Null texts are empty, with an empty fingerprint; two empty ones have likeness 1. Null ids sort first, as one id. Of
    several rows with one id the least text stands for the id as a next document; each row is
    returned. A table of one id is its own next; an empty table gives no rows.

    Whole texts cross the network once, by id; both uses of them read the same exchange, so sketches are made after it.
    """
    rows = pick(docs, id, text).toDF("id", "text").select(
        "id", F.coalesce(F.col("id").cast("string"), F.lit("")).alias("key"), F.coalesce("text", F.lit("")).alias("text")
    )
    links = stage(next_keys(rows.select("id", "key").distinct()), "next_keys")
    need = rows.groupBy("key").agg(F.max(F.floor(F.char_length("text") / 2)).cast("int").alias("need"))
    wanted = links.join(need, "key").select(F.col("key").alias("owner"), "next_key", "need")
    first_of_id = F.lag(F.lit(1)).over(Window.partitionBy("key").orderBy("text")).isNull()
    heads = rows.withColumn("first", first_of_id).filter("first").join(wanted, F.col("key") == F.col("next_key"))
    heads = heads.select(
        F.col("owner").alias("key"), F.substring("text", F.lit(1), F.col("need")).alias("start"),
        sketch(F.col("text"), k, shingle).alias("next_sketch"), F.col("id").alias("next_id"),
    )
    met = rows.join(heads, "key").withColumn("sketch", sketch(F.col("text"), k, shingle))
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = met.select(
        "id", "next_id", F.char_length("text").cast("long").alias("n_chars"), "sketch", "next_sketch",
        F.concat(F.substring("text", F.lit(1), F.char_length("text") - half), F.substring("start", F.lit(1), half)).alias("edited"),
    )
    made = edited.select("id", "next_id", "n_chars", "sketch", "next_sketch", F.sha2("edited", 256).alias("edited_sha256"), sketch(F.col("edited"), k, shingle).alias("edited_sketch"))
    return made.select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"), resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"), distinct_shingles(F.col("sketch"), k).alias("distinct_shingles"),
        F.col("next_id").alias("next_doc_id"),
    )
