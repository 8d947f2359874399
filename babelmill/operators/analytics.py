"""Distributions, shares, percentiles and inequality of sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("rows"))


def top(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values, ties by value: a partial sort in each task, never a full one."""
    return distribution(df, column).orderBy(F.desc("rows"), column).limit(k)


def share(df: DataFrame, column: str) -> DataFrame:
    """Percent of rows by value. The total is an aggregate of the counts, broadcast as one row."""
    counts = distribution(df, column)
    total = counts.agg(F.sum("rows").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(column, "rows", (F.col("rows") * 100.0 / F.col("total")).alias("percent"))


def summary(df: DataFrame, column: str) -> DataFrame:
    c = F.col(column)
    return df.agg(
        F.count(c).alias("n"), F.min(c).alias("low"), F.max(c).alias("high"), F.sum(c).alias("total"),
        F.avg(c).alias("mean"), F.median(c).alias("median"), F.stddev_samp(c).alias("std"), F.count_if(c.isNull()).alias("nulls"),
    )


def percentiles(df: DataFrame, column: str, shares: tuple[float, ...] = (0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)) -> DataFrame:
    """One row (share, value) for each exact percentile, interpolated; the aggregate holds value counts, not rows."""
    found = df.agg(F.percentile(column, F.array(*map(F.lit, shares))).alias("p"))
    names = F.array(*map(F.lit, shares))
    return found.select(F.explode(F.arrays_zip(names.alias("share"), F.col("p").alias("value"))).alias("z")).select("z.share", "z.value")


def peak(df: DataFrame, value: str, order: str) -> DataFrame:
    """The row with the largest value, the first by ``order`` among equals; one aggregate, no sort."""
    best = F.max_by(F.struct("*"), F.struct(F.col(value), -F.col(order)))
    return df.agg(best.alias("r")).select("r.*")


def elapsed(df: DataFrame, time: str) -> DataFrame:
    """Minutes since the first row. The first time is an aggregate, so nothing is sorted."""
    first = df.agg(F.min(time).alias("_first"))
    minutes = (F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(F.col("_first").cast("timestamp"))) / 60e6
    return df.crossJoin(F.broadcast(first)).withColumn("minutes", minutes).drop("_first")


def counted(df: DataFrame, column: str) -> DataFrame:
    """(value, n): how often each value occurs; NULLs are left out. Combined before its exchange, so ties cost nothing."""
    return df.select(F.col(column).alias("value")).where("value is not null").groupBy("value").agg(F.count("*").alias("n"))


def cumulative(df: DataFrame, column: str, partitions: int | None = None) -> DataFrame:
    """(value, n, rank, running) of each distinct value in ascending order: how often it occurs, how many rows come before
    its first, and their sum; without a one-task window over the rows.

    Values are counted first, range-partitioned, and each partition's count and sum become offsets (one row a
    partition, broadcast); windows run within partitions only.
    """
    wide = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(counted(df, column).repartitionByRange(wide, "value").select("value", "n", F.spark_partition_id().alias("_part")))
    totals = placed.groupBy("_part").agg(F.sum(F.col("value") * F.col("n")).alias("_sum"), F.sum("n").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    offsets = totals.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_seen"))
    own = Window.partitionBy("_part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    rank = F.col("_seen") + F.coalesce(F.sum("n").over(own), F.lit(0))
    running = F.col("_base") + F.coalesce(F.sum(F.col("value") * F.col("n")).over(own), F.lit(0))
    return placed.join(F.broadcast(offsets), "_part").select("value", "n", rank.alias("rank"), running.alias("running"))


def gini(df: DataFrame, column: str) -> DataFrame:
    """(n, total, gini) by the trapezoids under the Lorenz curve, from the origin on (so that equal values give 0).

    Trapezoids that begin at the first value instead give a figure that is larger by about its share over n. The sum
    only needs each value's ranks: n equal values after rank r have ranks r + 1 to r + n.
    """
    ranked = cumulative(df, column)
    ranks = F.col("n") * F.col("rank") + F.col("n") * (F.col("n") + 1) / 2
    sums = ranked.agg(F.sum("n").alias("n"), F.sum(F.col("value") * F.col("n")).alias("total"), F.sum(F.col("value") * ranks).alias("weighted"))
    gini_ = 2.0 * F.col("weighted") / (F.col("n").cast("double") * F.col("total")) - (F.col("n") + 1.0) / F.col("n")
    return sums.select("n", "total", gini_.alias("gini"))


def share_count(df: DataFrame, column: str, percent: int = 80) -> DataFrame:
    """(files, value, running): how many of the smallest rows reach the given percent of the total, and the last of them."""
    ranked = cumulative(df, column)
    total = ranked.agg(F.sum(F.col("value") * F.col("n")).alias("_total"))
    end = F.col("running") + F.col("value") * F.col("n")
    reached = ranked.crossJoin(F.broadcast(total)).where(end * 100 >= F.col("_total") * percent)
    first = reached.agg(F.min(F.struct("value", "rank", "running", "_total")).alias("r")).select("r.*")
    lacking = F.col("_total") * percent - F.col("running") * 100  # of the first value that reaches it, how many it takes
    taken = F.when(F.col("value") == 0, 1).otherwise(F.greatest(F.ceil(lacking / (F.col("value") * 100)), F.lit(1))).cast("long")
    return first.select((F.col("rank") + taken).alias("files"), "value", (F.col("running") + taken * F.col("value")).alias("running"))


def numbered(df: DataFrame, order: str, name: str = "row") -> DataFrame:
    """The rows with their number in ascending order of a column without ties, from 0: range partitions and offsets."""
    placed = cut(df.orderBy(order).withColumn("_part", F.spark_partition_id()))
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_seen"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    return placed.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_seen") + own).drop("_part", "_seen")
