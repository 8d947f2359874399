"""Keyed partition sink, audit sidecars, size tables, and publishing."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .flatten import quarantine

KEY_COLUMNS = ("language", "site", "source_file")


class AuditError(RuntimeError):
    """What was written or published isn't what was meant to be."""


def write_partitions(df: DataFrame, key: str, target: str, source_file: str | None = None, max_records: int = 5_000_000) -> None:
    """Writes ``target/key=.../source_file=.../``, replacing just the partitions that df has.

    A rebalance on the key gives each partition few files, and AQE splits the keys that are large; so a re-run for one
    source file is idempotent and small keys don't leave a file for every task.
    """
    rows = df if source_file is None else df.withColumn("source_file", F.lit(source_file))
    usable, _ = quarantine(rows, key)
    writer = usable.hint("rebalance", F.col(key)).write.option("maxRecordsPerFile", max_records).option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite").partitionBy(key, "source_file").parquet(target)


def remove_files(spark: SparkSession, target: str, files: list[str]) -> None:
    """Removes every partition of the source files, so that one that a new run no longer yields doesn't survive it."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    if not files:
        return
    system = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    wanted = {f"source_file={spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(f)}" for f in files}
    for found in system.globStatus(path(f"{target}/*/source_file=*")) or ():
        if found.getPath().getName() in wanted:
            system.delete(found.getPath(), True)


def write_audited(df: DataFrame, table: str, key: str, target: str, files: list[str], schema: T.StructType | None = None) -> tuple[DataFrame, int]:
    """Writes the partitions of some source files in place of those they had; returns the sidecar and the rows quarantined.

    Rows are counted as they pass to the writer, the sidecar is read back, and the two must agree. A stage that is run
    again for a lost executor may count rows twice, so a difference is settled by a count of its own before it is an
    error. A file without usable rows has one sidecar row with a NULL key and no rows.
    """
    spark = df.sparkSession
    remove_files(spark, target, files)
    seen = Observation(f"{table} rows")
    good = F.coalesce(F.length(key) > 0, F.lit(False))
    write_partitions(df.observe(seen, F.count_if(good).alias("good"), F.count_if(~good).alias("bad")), key, target)
    counts = seen.get
    none = spark.createDataFrame([(f,) for f in files], "source_file string")
    there = read_partitions(spark, target, schema).where(F.col("source_file").isin(files))
    found = sidecar(there, table, key)
    missing = none.join(found.select("source_file").distinct(), "source_file", "left_anti")
    empty = missing.select("source_file", F.lit(table).alias("table"), F.lit(None).cast("string").alias("key"), F.lit(0).cast("long").alias("rows"), *(F.lit(None).cast("string").alias(c) for c in ("min_id", "max_id")))
    out = found.unionByName(empty)
    if out.agg(F.sum("rows")).first()[0] != counts["good"]:
        real = df.agg(F.count_if(good), F.count_if(~good)).first()
        counts = {"good": real[0], "bad": real[1]}
        if out.agg(F.sum("rows")).first()[0] != counts["good"]:
            raise AuditError(f"{table}: {counts['good']} rows were to be written to {target}, others are there")
    return out, counts["bad"]


def read_partitions(spark: SparkSession, target: str, schema: T.StructType | None = None) -> DataFrame:
    """The partitioned table; keys are text, whatever they look like (``01`` stays ``01``).

    schema: the table's columns, keys among them; without it the files are asked for the others first.
    """
    if schema is None:
        found = spark.read.parquet(target).schema
        schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name in KEY_COLUMNS else f for f in found.fields])
    return spark.read.schema(schema).parquet(target)


def sidecar(df: DataFrame, table: str, key: str, source_file: str = "source_file") -> DataFrame:
    """(source_file, table, key, rows, min_id, max_id): one hash aggregate that combines before its exchange."""
    groups = df.groupBy(F.col(source_file).alias("source_file"), F.col(key).alias("key"))
    counted = groups.agg(F.count("*").alias("rows"), F.min("id").alias("min_id"), F.max("id").alias("max_id"))
    return counted.select("source_file", F.lit(table).alias("table"), "key", "rows", "min_id", "max_id")


def post_check(before: DataFrame, after: DataFrame) -> DataFrame:
    """Partitions whose rows or id bounds differ between the audit of what was written and of what is there."""
    names = ("source_file", "table", "key")
    a, b = before.where("rows > 0").alias("a"), after.where("rows > 0").alias("b")
    joined = a.join(b, [F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}")) for n in names], "full")
    same = [F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}")) for n in ("rows", "min_id", "max_id")]
    out = [F.coalesce(f"a.{n}", f"b.{n}").alias(n) for n in names]
    return joined.where(~(same[0] & same[1] & same[2])).select(*out, F.col("a.rows").alias("rows_before"), F.col("b.rows").alias("rows_after"))


def footer_bounds(spark: SparkSession, path: str, column: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, rows, low, high) of a numeric column, by partition keys: the aggregates are pushed to the file footers.

    Parquet pushes aggregates on its second-generation source only, so the two settings hold while this is planned and
    run; the result has a row a partition.
    """
    from ..session import cut

    wanted = {"spark.sql.sources.useV1SourceList": "csv,json,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        rows = spark.read.parquet(path)
        return cut(rows.groupBy(*keys).agg(F.count("*").alias("rows"), F.min(column).alias("low"), F.max(column).alias("high")))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write_sizes(sizes: DataFrame, target: str) -> None:
    """A size table as CSV with a header, replaced as a whole."""
    sizes.write.mode("overwrite").csv(target, header=True)


def _copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies (name, source folder, target folder) files and returns (name, size) of what is there then."""
    from pyarrow import fs

    for batch in batches:
        done = []
        for name, source, target in zip(*(c.to_pylist() for c in batch.columns)):
            (a, x), (b, y) = fs.FileSystem.from_uri(source), fs.FileSystem.from_uri(target)
            x, y = f"{x}/{name}", f"{y}/{name}"  # names aren't parts of an address: what is escaped in them stays so
            b.create_dir(os.path.dirname(y), recursive=True)
            with a.open_input_stream(x) as read, b.open_output_stream(y) as write:
                while block := read.read(8 << 20):
                    write.write(block)
            done.append((name, b.get_file_info(y).size))
        names, sizes = zip(*done) if done else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], names=["name", "found"])


def publish(spark: SparkSession, source: str, target: str, files_per_task: int = 16) -> int:
    """Makes a target folder hold the data files of a written table and no others; returns how many files it copied.

    Tasks copy the files that the target lacks (names of data files are unique to the job that wrote them). Only once
    all are there with their sizes are the target's other files removed, so a copy that fails leaves what was there, and
    the next call takes it up. Schemes are those that Arrow's file systems know (local, HDFS, S3, GCS).
    """
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    roots = []
    for place in (source, target):
        system = path(place).getFileSystem(conf)
        if place == target:
            system.mkdirs(path(place))
        address = system.makeQualified(path(place)).toUri().toString().rstrip("/")
        roots.append(address if "://" in address else address.replace(":/", ":///", 1))
    from ..sources.files import paths

    here, there = (paths(spark, place).where("name rlike '[.]parquet$'") for place in (source, target))
    lacking = here.join(there.withColumnRenamed("size", "held"), "name", "left").where("held is null or held <> size")
    todo = lacking.select("name", F.lit(roots[0]).alias("source"), F.lit(roots[1]).alias("target"), "size")
    count = todo.count()
    if count:
        copied = todo.select("name", "source", "target").repartition(-(-count // files_per_task)).mapInArrow(_copy, "name string, found long")
        wrong = todo.join(copied, "name", "left").where("found is null or found <> size")
        if not wrong.isEmpty():
            raise AuditError(f"not all files of {source} reached {target}")
    stale = there.join(here.select("name"), "name", "left_anti").select("name")
    system = path(target).getFileSystem(conf)
    for row in stale.toLocalIterator():
        system.delete(path(f"{target}/{row['name']}"), False)
    return count
