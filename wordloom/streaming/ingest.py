"""Watching a folder for new documents and adding their vectors to the store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wordloom.functions.text import clean_transcript
from wordloom.operators.vectors import append_vectors, embed_rows, read_store

INPUT_SCHEMA = "doc_id bigint, text string"


def new_vectors(batch: DataFrame, store: DataFrame | None, dim: int) -> DataFrame:
    """Vectors of the documents of a batch that the store lacks, one per document and content."""
    cleaned = batch.select("doc_id", "text", clean_transcript(F.col("text")).alias("clean"))
    hashed = cleaned.filter(F.col("clean") != "").withColumn("content_hash", F.sha2("text", 256))
    if store is not None:
        held = store.select(F.col("vec_id").alias("doc_id"), "content_hash")
        hashed = hashed.join(held, ["doc_id", "content_hash"], "left_anti")
    one = hashed.groupBy("doc_id", "content_hash").agg(F.min(F.struct("text", "clean")).alias("d"))
    tokens = one.select("doc_id", "content_hash", "d.text", F.split("d.clean", " ").alias("tokens"))
    return embed_rows(tokens, dim).select(
        F.col("doc_id").alias("vec_id"), "text", "embedding",
        F.current_timestamp().alias("ingested_at"), "content_hash",
    )


def ingest(batch: DataFrame, store_path: str, dim: int = 64) -> None:
    """Add one batch. Running the same batch again adds nothing: its contents are in the store."""
    rows = new_vectors(batch, read_store(batch.sparkSession, store_path), dim)
    append_vectors(rows, store_path, dim)


def watch(spark: SparkSession, folder: str, store_path: str, checkpoint: str, dim: int = 64) -> StreamingQuery:
    """Ingest every file of the folder not seen before, then stop."""
    stream = spark.readStream.schema(INPUT_SCHEMA).parquet(folder)
    return (
        stream.writeStream.foreachBatch(lambda batch, _: ingest(batch, store_path, dim))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
