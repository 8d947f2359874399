"""Chunks from entity files to audited, published partitions, and the ledger that says how far each file is.

A file goes from INIT over PULL (it is there with its size), PROCESS (its records fit the declared schemas), PARTITION
(all tables hold it and agree with what was counted), PUSH (the target has the files) and POST_CHECK (the target's rows
are those of the sidecars) to COMPLETE. Every step is entered only after its check; a run that ends anywhere is taken up
from the ledger, file by file.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import drift
from ..functions.names import chunk, to_parquet
from ..functions.normalise import processed
from ..functions.schemas import KEYS, NESTED, PARSED_CLAIMS, SITES, TERM_LISTS, TERMS, Step
from ..operators import audit
from ..operators import ledger as states
from ..operators.flatten import flatten
from ..operators.sink import AuditError, post_check, publish, read_partitions, sidecar, write_audited
from ..sources.files import entities, exists, listing

DECLARED = {"labels": TERMS, "descriptions": TERMS, "aliases": TERM_LISTS, "sitelinks": SITES, "claims": PARSED_CLAIMS}
AUDIT = "source_file string, `table` string, key string, rows long, min_id string, max_id string"
#: Fields of records that the flat tables leave out on purpose.
DROPPED = {"sitelinks": ("badges", "url")}


def flat(rows: DataFrame, table: str) -> DataFrame:
    """The flat frame of one table from entity records, with the file that each row came from."""
    named = rows.withColumn("id", F.struct("id", "file"))
    out = flatten(processed(named, NESTED[table]), table)
    return out.select(F.col("id.file").alias("source_file"), F.col("id.id").alias("id"), *[f"`{c}`" for c in out.columns if c != "id"])


def flat_schema(spark: SparkSession, table: str) -> T.StructType:
    """The declared columns of a flat table; nothing is read."""
    none = spark.createDataFrame([], "id string, labels string, descriptions string, aliases string, sitelinks string, claims string, file string")
    return flat(none, table).schema


def misfits(rows: DataFrame) -> DataFrame:
    """(column, misfit) of the fields of entity records that the declared schemas have no place for: one aggregate."""
    found = drift.observed_schemas(rows, [c for c in DECLARED if c in rows.columns])
    bad = [(c, m) for c, seen in found.items() for m in drift.misfits(drift._parse(seen)[0], T._parse_datatype_string(DECLARED[c])) if not m.startswith("$") or m.partition(":")[0].rpartition(".")[2] not in DROPPED.get(c, ())]
    return rows.sparkSession.createDataFrame(bad, "column string, misfit string")


def stop_on_drift(rows: DataFrame) -> None:
    """Raises SchemaDriftError if a record holds what the declared schemas would drop in silence."""
    found = misfits(rows).limit(20).collect()
    if found:
        raise drift.SchemaDriftError("; ".join(f"{r['column']} {r['misfit']}" for r in found))


def sidecars(spark: SparkSession, target: str, table: str, index: int) -> DataFrame:
    """The audits of a chunk's files."""
    return spark.read.schema(AUDIT).parquet(f"{target}/audit/{table}/chunk={index}")


def missing_outputs(spark: SparkSession, target: str, index: int, files: list[str]) -> DataFrame:
    """(table, file) of the chunk that have no sidecar."""
    tables = [str(t) for t in KEYS]
    there = [sidecars(spark, target, t, index).select("table", F.col("source_file").alias("file")) for t in tables if exists(spark, f"{target}/audit/{t}/chunk={index}")]
    none = spark.createDataFrame([], "table string, file string")
    return audit.missing_outputs(spark.createDataFrame([(f,) for f in files], "file string"), tables, reduce(DataFrame.unionAll, there, none).distinct())


def run_chunk(spark: SparkSession, source: str, target: str, index: int, files: list[str] | None = None) -> dict[str, int]:
    """Partitions, sidecars and ledger rows of a chunk's files (all, or those named); returns the rows that were quarantined, by table.

    One job checks the records against the declared schemas, then each table is one job whose only shuffle is the
    rebalance to its keys. Running files again replaces all of their partitions. Sidecars of the chunk's other files stay.
    """
    own = sorted(r["file"] for r in listing(spark, source).where(chunk("file") == index).select("file").collect())
    todo = own if files is None else files
    records = entities(spark, source, index)
    rows = records if set(todo) == set(own) else records.where(F.col("file").isin(todo))
    stop_on_drift(rows)
    states.append(spark, f"{target}/ledger", todo, Step.PROCESS)
    bad: dict[str, int] = {}
    for table, key in KEYS.items():
        found, bad[table] = write_audited(flat(rows, table), table, key, f"{target}/flat/{table}", todo, flat_schema(spark, table))
        writer = found.coalesce(1).withColumn("chunk", F.lit(index)).write.option("partitionOverwriteMode", "dynamic")
        writer.mode("overwrite").partitionBy("chunk", "source_file").parquet(f"{target}/audit/{table}")
    lacking = [tuple(r) for r in missing_outputs(spark, target, index, todo).limit(20).collect()]
    if lacking:
        raise AuditError(f"chunk {index} lacks {lacking}")
    states.append(spark, f"{target}/ledger", todo, Step.PARTITION)
    return bad


def check_chunk(spark: SparkSession, target: str, index: int, flat_folder: str | None = None) -> DataFrame:
    """Partitions whose content doesn't agree with their sidecars, in the target or another folder that holds its tables."""
    out = []
    for table, key in KEYS.items():
        before = sidecars(spark, target, table, index)
        files = [r["source_file"] for r in before.select("source_file").distinct().collect()]
        there = read_partitions(spark, f"{flat_folder or target + '/flat'}/{table}", flat_schema(spark, table))
        out.append(post_check(before, sidecar(there.where(F.col("source_file").isin(files)), table, key)))
    return reduce(DataFrame.unionByName, out)


def push_chunk(spark: SparkSession, target: str, remote: str, index: int, files: list[str]) -> None:
    """Copies the tables to the remote folder and recounts them there; the files are COMPLETE if all agrees, else it raises."""
    states.append(spark, f"{target}/ledger", files, Step.PUSH)
    for table in KEYS:
        publish(spark, f"{target}/flat/{table}", f"{remote}/{table}")
    states.append(spark, f"{target}/ledger", files, Step.POST_CHECK)
    wrong = check_chunk(spark, target, index, remote).limit(20).collect()
    if wrong:
        raise AuditError(f"chunk {index} differs from its sidecars at {remote}: {[tuple(r) for r in wrong]}")
    states.append(spark, f"{target}/ledger", files, Step.COMPLETE)


def run_all(spark: SparkSession, source: str, target: str, remote: str | None = None, sizes: DataFrame | None = None) -> list[int]:
    """Brings every file of the source as far as it can get; returns the chunks that had work, in order.

    New files are entered at INIT. A chunk's files before PARTITION are processed, the others are left as they are; with a
    remote folder the chunk is pushed and checked until it is COMPLETE. sizes: (file, size) that the files must have.
    """
    there = listing(spark, source).where(chunk("file").isNotNull())
    states.seed(spark, f"{target}/ledger", [r["file"] for r in there.select("file").collect()])
    end = Step.PARTITION if remote is None else Step.COMPLETE
    worked = []
    now = states.state(states.history(spark, f"{target}/ledger"))
    open_ = now.where(F.col("step") < int(end)).select("chunk").distinct()
    for index in sorted(r["chunk"] for r in open_.collect()):
        now = states.state(states.history(spark, f"{target}/ledger")).where(F.col("chunk") == index)
        pulled = [r["file"] for r in states.files_to_pull(now, index).collect()]
        expected = there if sizes is None else sizes
        found = audit.verify_sizes(expected.where(F.col("file").isin(pulled)), there).where("not ok").limit(20).collect()
        if found:
            raise AuditError(f"chunk {index}: files that aren't there with their size: {[tuple(r) for r in found]}")
        states.append(spark, f"{target}/ledger", pulled, Step.PULL)
        todo = [r["file"] for r in now.where(F.col("step") < int(Step.PARTITION)).select(to_parquet("file").alias("file")).orderBy("file").collect()]
        if todo:
            run_chunk(spark, source, target, index, todo)
        if remote is not None:
            push_chunk(spark, target, remote, index, sorted(r["file"] for r in now.select("file").collect()))
        worked.append(index)
    return worked
