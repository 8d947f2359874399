"""Entity files as a stream: new files are flattened and partitioned as they come, resumed from a checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.schemas import ENTITY, KEYS
from ..operators.sink import write_partitions
from ..plans.run import flat


def follow(spark: SparkSession, source: str, target: str, table: str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Processes the files that are there and stops; run again, it takes up those that came since.

    A batch is a set of whole files and each file is its own partition level, so a batch that is replayed after a
    failure replaces what it wrote.
    """
    rows = spark.readStream.schema(ENTITY).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    rows = rows.withColumn("file", F.col("_metadata.file_name"))

    def write(batch: DataFrame, _: int) -> None:
        write_partitions(flat(batch, table), KEYS[table], f"{target}/flat/{table}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
