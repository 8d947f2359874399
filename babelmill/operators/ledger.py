"""The ledger of source files: appended steps, the current state, and what to do next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import chunk, part, to_parquet
from ..functions.schemas import Step
from ..sources.files import exists


def append(spark: SparkSession, path: str, files: list[str], step: Step, seq: int | None = None) -> None:
    """Adds one row a file; nothing is overwritten, so a lost job leaves the ledger as it was.

    seq orders the rows of a file; without it the ledger's next number is taken, so later runs come after earlier ones.
    """
    if not files:
        return
    if seq is None:
        seq = (history(spark, path).agg(F.max("seq")).first()[0] or 0) + 1
    rows = [(f, int(step), seq) for f in files]
    spark.createDataFrame(rows, "file string, step long, seq long").coalesce(1).write.mode("append").parquet(path)


def history(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], "file string, step long, seq long")
    return spark.read.schema("file string, step long, seq long").parquet(path)


def state(appended: DataFrame) -> DataFrame:
    """(file, chunk, part, step): the step that was appended last for each file, the later step of equal numbers."""
    now = appended.groupBy("file").agg(F.max_by("step", F.struct("seq", "step")).alias("step"))
    return now.select("file", chunk("file").alias("chunk"), part("file").alias("part"), "step")


def seed(spark: SparkSession, path: str, files: list[str]) -> list[str]:
    """Enters the files that the ledger doesn't know at INIT; returns them. Files that it knows keep their step."""
    listed = spark.createDataFrame([(f,) for f in files], "file string").distinct()
    new = sorted(r["file"] for r in unknown(listed, state(history(spark, path))).collect())
    append(spark, path, new, Step.INIT)
    return new


def unknown(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """The files that the ledger has no row of."""
    return files.select("file").join(ledger.select("file"), "file", "left_anti")


def to_jsonl(column: str) -> Column:
    """The ledger file of a data file."""
    return F.regexp_replace(column, r"\.parquet$", ".jsonl")


def step_of(ledger: DataFrame, asked: DataFrame, least: Step | None = None) -> DataFrame:
    """(file, step, reached) of the files asked for, by the name of either file: absent ones have a NULL step and aren't
    at ``least`` (COMPLETE if none is given) or past it."""
    known = ledger.select(F.col("file").alias("_file"), "step")
    found = asked.join(known, to_jsonl("file") == to_jsonl("_file"), "left")
    at = F.lit(int(Step.COMPLETE if least is None else least))
    return found.select("file", "step", F.coalesce(F.col("step") >= at, F.lit(False)).alias("reached"))


def next_chunk(ledger: DataFrame) -> DataFrame:
    """The smallest chunk with a file that isn't complete; NULL where all are."""
    return ledger.where(F.col("step") < int(Step.COMPLETE)).agg(F.min("chunk").alias("chunk"))


def files_to_pull(ledger: DataFrame, index: int) -> DataFrame:
    """Data files of a chunk at PULL or before; PULL is set before a download, so it is repeated."""
    return ledger.where((F.col("chunk") == index) & (F.col("step") <= int(Step.PULL))).select(to_parquet("file").alias("file"))


def at_or_past(ledger: DataFrame, step: Step) -> DataFrame:
    return ledger.where(F.col("step") >= int(step))


def with_sizes(ledger: DataFrame, sizes: DataFrame) -> DataFrame:
    return ledger.join(sizes.select("file", "size"), "file", "left")


def without_size(ledger: DataFrame, sizes: DataFrame) -> DataFrame:
    return ledger.join(sizes.select("file"), "file", "left_anti")


def pull_plan(files: DataFrame) -> DataFrame:
    """A plan column over (already_pushed, local_ok, step): each file gets exactly one of skip, keep, mark and download."""
    plan = (
        F.when(F.col("already_pushed"), "already_pushed")
        .when(F.col("local_ok") & (F.col("step") == int(Step.INIT)), "mark_pulled")
        .when(F.col("local_ok"), "local_ok")
        .otherwise("need_download")
    )
    return files.withColumn("plan", plan)


def gates(ledger: DataFrame) -> DataFrame:
    """(chunk, least, partitioned, complete): how far the slowest file of each chunk is."""
    least = ledger.groupBy("chunk").agg(F.min("step").alias("least"))
    return least.select("chunk", "least", (F.col("least") >= int(Step.PARTITION)).alias("partitioned"), (F.col("least") == int(Step.COMPLETE)).alias("complete"))


def inferred(files: DataFrame, pulled: DataFrame, processed: DataFrame, partitioned: DataFrame) -> DataFrame:
    """(file, step) from what lies on disk, for ledgers that were lost: the furthest step whose output is there."""
    out = files.select("file")
    for name, found, step in (("_a", pulled, Step.PULL), ("_b", processed, Step.PROCESS), ("_c", partitioned, Step.PARTITION)):
        out = out.join(found.select("file").distinct().withColumn(name, F.lit(int(step)).cast("long")), "file", "left")
    return out.select("file", F.coalesce(F.greatest("_a", "_b", "_c"), F.lit(int(Step.INIT)).cast("long")).alias("step"))
