"""Scans: entity files, listings, ledgers and size tables, each with a declared schema."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import basename, chunk, chunk_glob, gigabytes, part
from ..functions.schemas import ENTITY

STRIDE = 611_953
LISTING = "file string, size long, size_gb double"


def exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path or glob names anything, on whichever file system it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def entities(spark: SparkSession, folder: str, index: int | None = None) -> DataFrame:
    """Entity records of one chunk's files (or all), with file, chunk and part of each row."""
    rows = spark.read.schema(ENTITY).option("pathGlobFilter", chunk_glob(index)).parquet(folder)
    file = F.col("_metadata.file_name")
    return rows.select("*", file.alias("file"), chunk(file).alias("chunk"), part(file).alias("part"))


def tree(spark: SparkSession, folder: str) -> DataFrame:
    """All parquet files under a folder, whatever its sub-folders are called."""
    return spark.read.option("recursiveFileLookup", "true").parquet(folder)


def listing(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """Names and sizes of the files below a folder; no content is read."""
    if not exists(spark, folder):
        return spark.createDataFrame([], LISTING)
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return found.select(basename("path").alias("file"), F.col("length").alias("size"), gigabytes("length").alias("size_gb"))


def paths(spark: SparkSession, folder: str) -> DataFrame:
    """(name, size) of the data files below a folder, names from the folder on; no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toString()
    # paths come as the file system spells them; what follows the folder's own name is the file's
    return found.select(F.expr(f"substr(path, instr(path, '{root.split(':', 1)[-1].lstrip('/')}') + {len(root.split(':', 1)[-1].lstrip('/'))} + 1)").alias("name"), F.col("length").alias("size"))


def states(spark: SparkSession, pattern: str) -> DataFrame:
    """(file, step) of a folder of JSON-lines ledgers; a typed empty frame where there are none."""
    if not exists(spark, pattern):
        return spark.createDataFrame([], "file string, step long")
    return spark.read.schema("step long").json(pattern).select(F.col("_metadata.file_name").alias("file"), "step")


def size_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema="file string, size long, size_gb double")


#: Languages of the demonstration rows by their thousandths of all; English takes what is left over.
DEMO = {
    **{10: "en el th id ms vi", 80: "zh es", 60: "fr de", 40: "ja ru ar", 30: "pt it", 25: "ko hi nl", 20: "pl tr sv da no"},
    **{15: "fi he cs hu", 5: "uk ca sk hr bg lt lv et sl mk"},
}
DEMO_SHARES = {language: thousandths / 1000 for thousandths, group in DEMO.items() for language in group.split()}


def stride(rows: int) -> int:
    """A step that has no factor in common with the number of rows."""
    step = STRIDE
    while math.gcd(step, max(rows, 1)) > 1:
        step += 2
    return step


def demo_rows(spark: SparkSession, rows: int = 9_000_000, shares: dict[str, float] = DEMO_SHARES, chunks: int = 9, filler: str = "en") -> DataFrame:
    """Synthetic (id, text, language, chunk) rows in exact shares, shuffled and cut into chunks of equal size.

    Each language has int(rows * share) rows, what is left is the filler's. The shuffle is a permutation by arithmetic:
    place n holds the row n * stride modulo the number of rows, so
    nothing is sorted and every place is computed by itself.
    """
    bounds, total = [], 0
    for language, share in shares.items():
        total += int(rows * share + 1e-9)
        bounds.append((language, total))
    per_chunk = -(-rows // chunks)
    at = (F.col("id") * F.lit(stride(rows))) % F.lit(max(rows, 1))
    language = F.lit(filler)
    for name, bound in reversed(bounds):
        language = F.when(at < bound, name).otherwise(language)
    chunk_, place = F.floor(F.col("id") / per_chunk), F.col("id") % per_chunk
    placed = spark.range(0, rows, 1, chunks).select(chunk_.alias("chunk"), place.alias("place"), language.alias("language"))
    name = F.concat(F.lit("Q"), "chunk", F.lpad(F.col("place").cast("string"), 6, "0"))
    text = F.concat(F.lit("Sample claim "), "place", F.lit(" in "), "language")
    return placed.select(name.alias("id"), text.alias("text"), "language", "chunk")


def write_demo(rows: DataFrame, folder: str, chunks: int) -> None:
    """One data file a chunk, named as entity files are (``chunk_0-00000-of-00009.parquet``), each by a task of its own."""
    spark = rows.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    rows.withColumn("part", F.col("chunk")).repartitionByRange(chunks, "chunk").write.mode("overwrite").partitionBy("part").parquet(f"{folder}/_made")
    system = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for index in range(chunks):
        for found in system.globStatus(path(f"{folder}/_made/part={index}/*.parquet")) or ():
            name = path(f"{folder}/chunk_{index}-{index:05d}-of-{chunks:05d}.parquet")
            system.delete(name, False)
            system.rename(found.getPath(), name)
    system.delete(path(f"{folder}/_made"), True)
