"""How much to fetch ahead: chunk totals, completeness, and a budgeted prefix."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import between, gigabytes


def chunk_totals(files: DataFrame) -> DataFrame:
    """(chunk, size, files) from (chunk, size) rows."""
    return files.groupBy("chunk").agg(F.sum("size").alias("size"), F.count("*").alias("files"))


def rounded_totals(files: DataFrame) -> DataFrame:
    """The totals as they are published: chunks as text, so in text order, and gigabytes to three places."""
    names = files.select(between("file").alias("chunk_index"), "size")
    totals = names.groupBy("chunk_index").agg(F.sum("size").alias("total_size_bytes"), F.count("*").alias("file_count"))
    return totals.select("chunk_index", "total_size_bytes", gigabytes("total_size_bytes").alias("total_size_gb"), "file_count")


def completeness(expected: DataFrame, local: DataFrame) -> DataFrame:
    """(chunk, expected, found, bytes, complete, any_local): one aggregate a side and one join, in place of a function a chunk."""
    want = expected.groupBy("chunk").agg(F.count("*").alias("expected"))
    have = local.groupBy("chunk").agg(F.count("*").alias("found"), F.sum("size").alias("bytes"))
    zero = F.lit(0).cast("long")
    joined = want.join(have, "chunk", "left").select("chunk", "expected", F.coalesce("found", zero).alias("found"), F.coalesce("bytes", zero).alias("bytes"))
    return joined.withColumns({"complete": F.col("found") >= F.col("expected"), "any_local": F.col("found") > 0})


def prefetch(totals: DataFrame, current: int, ahead: int, budget: int, complete: DataFrame | None = None) -> DataFrame:
    """(chunk, size, running): of the next ``ahead`` chunks those not complete, as long as their sum fits the budget.

    The order matters: the head is taken before complete chunks are dropped. The window isn't partitioned, but it
    holds ``ahead`` rows at most.
    """
    head = totals.where(F.col("chunk") > current).orderBy("chunk").limit(ahead)
    if complete is not None:
        head = head.join(complete.select("chunk"), "chunk", "left_anti")
    running = F.sum("size").over(Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0))
    return head.select("chunk", "size", running.alias("running")).where(F.col("running") <= budget)


def remaining(totals: DataFrame, budget: int) -> DataFrame:
    """(chunk, size, left): what each chunk alone would leave of the budget, never less than nothing."""
    return totals.select("chunk", "size", F.greatest(F.lit(budget) - F.col("size"), F.lit(0)).alias("left"))
