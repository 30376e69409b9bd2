"""Row numbers without sending a group through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.session import stage


def number_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Adds the position (from 1) of each row within its group, by a total order.

    A group may hold most of the rows, so the rows are range-partitioned by
    (group, order) and staged; a position is the place in the slice plus the
    sizes of the slices before it. One number per slice is summed in one place,
    the rest stays distributed.
    """
    placed = stage(
        df.orderBy(*by, *order).withColumn("_at", F.monotonically_increasing_id()), "ordered"
    ).withColumn("_slice", F.shiftright("_at", 33))
    sizes = placed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.select(
        "_slice", (F.sum("_size").over(Window.orderBy("_slice")) - F.col("_size")).alias("_before")
    )
    placed = placed.join(before, "_slice").withColumn(
        "_pos", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    )
    first = placed.groupBy(*by).agg(F.min("_pos").alias("_first"))
    return placed.join(first, list(by)).select(*df.columns, (F.col("_pos") - F.col("_first") + 1).alias(name))


def running_total(df: DataFrame, by: Sequence[str], order: Sequence[Column], value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` over the rows before each row of its group, by a total order.

    As ``number_rows``: slices by range, sums within each, and the totals of the slices before, less what precedes the group.
    """
    placed = stage(df.orderBy(*by, *order).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    placed = placed.withColumn("_slice", F.shiftright("_at", 33))
    totals = placed.groupBy("_slice").agg(F.sum(value).alias("_total"))
    before = totals.select("_slice", (F.sum("_total").over(Window.orderBy("_slice")) - F.col("_total")).alias("_before"))
    here = F.sum(value).over(Window.partitionBy("_slice").orderBy("_at"))
    summed = placed.withColumn("_sum", here - F.col(value)).join(before, "_slice").withColumn("_sum", F.col("_sum") + F.col("_before"))
    first = summed.groupBy(*by).agg(F.min("_sum").alias("_first"))
    return summed.join(first, list(by)).select(*df.columns, (F.col("_sum") - F.col("_first")).alias(name))


def versions(history: DataFrame, doc: str, at: Sequence[str], content: str) -> DataFrame:
    """Version number of each state of a document, and whether it differs from the one before."""
    hashed = history.select(doc, *at, F.md5(content).alias("content_hash"))
    numbered = stage(number_rows(hashed, [doc], [F.asc(c) for c in at], "version"), "versions")
    earlier = numbered.select(
        doc, (F.col("version") + 1).alias("version"), F.col("content_hash").alias("_old")
    )
    return numbered.join(earlier, [doc, "version"], "left").select(
        doc, *at, "version", "content_hash", (~F.col("_old").eqNullSafe(F.col("content_hash"))).alias("changed")
    )
