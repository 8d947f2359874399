"""Checks that stop a run: ids kept, outputs present, sizes equal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_preservation(before: DataFrame, after: DataFrame) -> DataFrame:
    """(ids_before, ids_after, lost): distinct ids on either side and how many of the first the second lacks."""
    a, b = before.select("id").distinct(), after.select("id").distinct()
    lost = a.join(b, "id", "left_anti").agg(F.count("*").alias("lost"))
    counts = a.agg(F.count("*").alias("ids_before")).crossJoin(b.agg(F.count("*").alias("ids_after")))
    return counts.crossJoin(lost)


def missing_outputs(files: DataFrame, tables: list[str], present: DataFrame) -> DataFrame:
    """(table, file) pairs that aren't in ``present``."""
    names = F.explode(F.array(*map(F.lit, tables))).alias("table")
    return files.select(names, "file").join(present, ["table", "file"], "left_anti")


def verify_sizes(expected: DataFrame, found: DataFrame) -> DataFrame:
    """(file, size, found_size, ok): whether each expected file is there with its size. No function per row, one join."""
    there = found.select("file", F.col("size").alias("found_size"))
    joined = expected.select("file", "size").join(there, "file", "left")
    return joined.withColumn("ok", F.coalesce(F.col("size") == F.col("found_size"), F.lit(False)))


def present_in_all(files: DataFrame, presence: dict[str, DataFrame]) -> DataFrame:
    """A boolean for each table and whether all hold. Presence is made distinct first, as it has a row a language."""
    tagged = [df.select("file", F.lit(name).alias("table")).distinct() for name, df in presence.items()]
    seen = reduce(DataFrame.unionAll, tagged).groupBy("file").pivot("table", list(presence)).agg(F.lit(True))
    joined = files.select("file").join(seen, "file", "left")
    flags = {name: F.coalesce(F.col(name), F.lit(False)) for name in presence}
    return joined.withColumns(flags).withColumn("already_pushed", reduce(lambda a, b: a & b, [F.col(n) for n in presence]))
