"""Readers. Schemas are explicit; nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.operators.documents import file_type

KEYWORD = "struct<keyword: string, nested_keywords: array<struct<keyword: string, weight: double>>, is_sufficient: boolean>"
SEQUENCE = "struct<sequence: array<string>, nested_sequences: array<array<string>>, is_sufficient: boolean>"
#: A row holds one keyword or one sequence at its place, or all of a category.
NETWORK_SCHEMA = (
    f"Category string, pos bigint, Keyword {KEYWORD}, Sequence {SEQUENCE}, Keywords array<{KEYWORD}>, Sequences array<{SEQUENCE}>"
)

#: The two categories that a label tells apart (fixed values).
CATEGORIES = ("automatable", "non_automatable")


def scan_corpus(
    spark: SparkSession, paths: dict[str, str], text_column: str = "text", id_column: str = "doc_id",
    schema: str | None = None, format: str = "parquet", **options: str,
) -> DataFrame:
    """Tables of several categories, one path each, as (doc_id, category, text).

    CSV (``format="csv"``, header first unless told otherwise) needs a schema; Parquet takes that of its files without one.
    """
    if schema is None and format != "parquet":
        raise ValueError(f"{format} needs a schema")
    options = {"header": "true", "multiLine": "true", "escape": '"'} | options if format == "csv" else options
    out = None
    for category, path in paths.items():
        reader = spark.read.format(format).options(**options)
        part = (reader.schema(schema) if schema else reader).load(path).select(
            F.col(id_column).cast("bigint").alias("doc_id"), F.lit(category).alias("category"),
            F.col(text_column).alias("text"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def labelled_corpus(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, category, text) with the category read from a label; no label counts as not automatable."""
    return documents.select("doc_id", "text").join(labels.select("doc_id", "quality"), "doc_id", "left").select(
        "doc_id", category_of(F.when(F.col("quality") == 1, "Automatable")).alias("category"), "text"
    )


def category_of(label: Column) -> Column:
    return F.when(F.lower(label) == CATEGORIES[0], CATEGORIES[0]).otherwise(CATEGORIES[1])


def stage_parquet(df: DataFrame, path: str, append: bool = False) -> DataFrame:
    """Write unless already there (or append a later batch), and read back."""
    df.write.mode("append" if append else "ignore").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _windows_characters() -> tuple[str, str, str]:
    """Code points 128-159: those windows-1252 gives a meaning, their meanings, and the rest."""
    given, meant, undefined = [], [], []
    for code in range(0x80, 0xA0):
        try:
            meant.append(bytes([code]).decode("cp1252"))
            given.append(chr(code))
        except UnicodeDecodeError:
            undefined.append(chr(code))
    return "".join(given), "".join(meant), "".join(undefined)


def read_windows_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV in windows-1252; a file that holds a byte undefined there is read as latin-1 throughout."""
    given, meant, undefined = _windows_characters()
    raw = (
        spark.read.schema(schema)
        .options(header=True, encoding="ISO-8859-1", multiLine=True, escape='"')
        .csv(path)
        .select("*", F.col("_metadata.file_path").alias("_file"))
    )
    texts = [f.name for f in raw.schema if f.dataType.simpleString() == "string" and f.name != "_file"]
    odd = F.concat_ws("", *[F.col(f"`{c}`") for c in texts]).rlike(f"[{undefined}]")
    latin = raw.groupBy("_file").agg(F.bool_or(odd).alias("_latin"))
    fixed = {c: F.when(F.col("_latin"), F.col(f"`{c}`")).otherwise(F.translate(F.col(f"`{c}`"), given, meant)) for c in texts}
    return raw.join(latin, "_file").withColumns(fixed).drop("_file", "_latin")


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}; required: {list(names)}")
    return df


def trim_column_names(df: DataFrame) -> DataFrame:
    """Names without outer spaces; Spark resolves them in any case."""
    return df.toDF(*[c.strip() for c in df.columns])


def numbered_descriptions(df: DataFrame) -> DataFrame:
    """(no, description) from a table whose headers may differ in case and outer spaces."""
    tidy = trim_column_names(df)
    require_columns(tidy.toDF(*[c.lower() for c in tidy.columns]), ["no", "description"])
    return tidy.select(F.col("no").cast("string").alias("no"), F.coalesce("description", F.lit("")).alias("description"))


def read_network(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    """Network rows or whole documents, one per line, or (``lines=False``) one JSON array per file."""
    return spark.read.schema(NETWORK_SCHEMA).option("multiLine", not lines).json(path)


def network_entries(network: DataFrame, one: str, all: str) -> DataFrame:
    """(category, pos, entry) of the rows that hold one entry and of the lists that hold all of a category."""
    alone = F.array(F.struct(F.col("pos"), F.col(one).alias("entry")))
    listed = F.transform(all, lambda x, i: F.struct(i.cast("bigint").alias("pos"), x.alias("entry")))
    rows = network.select(F.col("Category").alias("category"), F.explode(F.when(F.col(one).isNotNull(), alone).otherwise(listed)).alias("e"))
    return rows.select("category", "e.pos", "e.entry")


def network_keywords(network: DataFrame) -> DataFrame:
    """(category, pos, keyword, nested array<string>, is_sufficient)."""
    return network_entries(network, "Keyword", "Keywords").select(
        "category", "pos", "entry.keyword", F.col("entry.nested_keywords.keyword").alias("nested"), "entry.is_sufficient"
    )


def network_sequences(network: DataFrame) -> DataFrame:
    """(category, pos, sequence, nested_sequences, is_sufficient)."""
    return network_entries(network, "Sequence", "Sequences").select(
        "category", "pos", "entry.sequence", "entry.nested_sequences", "entry.is_sufficient"
    )


def scan_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content, file_size, file_type) of the text files of a folder."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        .select("path", F.decode("content", "UTF-8").alias("content"), F.col("length").alias("file_size"),
                file_type(F.col("path")).alias("file_type"))
    )


def scan_table(spark: SparkSession, table: str, app_name: str | None = None, **options: str) -> DataFrame:
    """A database table over JDBC, columns as they are; the predicate is pushed to the database.

    Connection options come from the caller's configuration, never from code.
    """
    rows = spark.read.format("jdbc").options(dbtable=table, **options).load()
    return rows if app_name is None else rows.filter(F.col("app_name") == app_name)
