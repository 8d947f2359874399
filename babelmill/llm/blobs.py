"""Shuffles of packed arrays: many small records travel as a few binary rows, one for each bucket and batch.

A row-per-record exchange costs the JVM a row object, a sort entry and a serialised row for every record. Here a
task sorts a batch's records by bucket in numpy and sends one binary value a column and bucket; the receiver joins
the values of its buckets. A bucket is handled in one piece, so ``count`` follows spark.sql.shuffle.partitions, the
setting by which a cluster fits partitions to memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import ship

BATCH_ROWS = 2000


def tune(spark: SparkSession) -> int:
    """Ships the package to the workers and bounds the rows of an Arrow batch, so that long texts fit a worker; returns
    the number of shuffle partitions."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(df: DataFrame, name: str) -> str:
    """A column name that df has in no spelling."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = "_" + name
    return name


def named(df: DataFrame, name: str) -> int | None:
    """The place of a column by its name, in whichever spelling; None where there is none."""
    return next((i for i, c in enumerate(df.columns) if c.lower() == name.lower()), None)


def schema(fields: dict[str, str]) -> str:
    return "bucket int, " + ", ".join(f"{name} binary" for name in fields)


def pack(keys: np.ndarray, count: int, arrays: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row for each bucket that occurs; the bucket is the high part of the key, scaled to ``count``."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    ordered = bucket[order]
    first = np.flatnonzero(np.concatenate([[len(ordered) > 0], ordered[1:] != ordered[:-1]])[: len(ordered)])
    bounds = np.append(first, len(ordered)).astype(np.int64)
    columns = [pa.array(ordered[first], pa.int32())]
    for values in arrays.values():
        sorted_ = np.ascontiguousarray(values[order])
        offsets = pa.py_buffer((bounds * sorted_.dtype.itemsize).astype(np.int32).tobytes())
        columns.append(pa.Array.from_buffers(pa.binary(), len(first), [None, offsets, pa.py_buffer(sorted_.tobytes())]))
    return pa.RecordBatch.from_arrays(columns, names=["bucket", *arrays])


def exchange(df: DataFrame, partitions: int) -> DataFrame:
    """Brings the rows of each bucket together, next to each other."""
    return df.repartition(partitions, "bucket").sortWithinPartitions("bucket")


def unpack(batches: Iterator[pa.RecordBatch], fields: dict[str, str]) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """The records of one bucket after another, from rows that are sorted by bucket."""
    held: dict[str, list] = {name: [] for name in fields}
    current = None

    def done() -> tuple[int, dict[str, np.ndarray]]:
        return current, {name: np.frombuffer(b"".join(held[name]), dtype) for name, dtype in fields.items()}

    for batch in batches:
        ids = batch.column("bucket").to_pylist()
        columns = {name: batch.column(name) for name in fields}
        for i, bucket in enumerate(ids):
            if bucket != current:
                if current is not None:
                    yield done()
                current = bucket
                held = {name: [] for name in fields}
            for name, column in columns.items():
                held[name].append(column[i].as_buffer())
    if current is not None:
        yield done()


def by_text(work: Callable[[list, list[str]], Iterator[pa.RecordBatch]], limit: int | None = None) -> Callable:
    """A mapInArrow function over (id, text) rows that calls ``work`` with the ids and texts of one chunk at a time.

    Rows whose id or text is NULL aren't passed on.
    """
    from .text import CHUNK, chunks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            known = [i for i, (a, b) in enumerate(zip(ids, texts)) if a is not None and b is not None]
            ids, texts = [ids[i] for i in known], [texts[i] for i in known]
            for low, high in chunks(texts, limit or CHUNK):
                yield from work(ids[low:high], texts[low:high])

    return run
