"""Session settings that the library expects, and where lineage may be cut."""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(cpus: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("babelmill")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", partitions).config("spark.driver.memory", memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Gives the Python workers of this session the package, wherever they run; once a session."""
    context = spark.sparkContext
    if getattr(context, "_babelmill_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(context._temp_dir, "babelmill.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    context._babelmill_shipped = True


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the cluster's shared checkpoint folder.

    The folder is the one in ``spark.checkpoint.dir``, so a lost executor never takes the rows with it. Where the
    session names none, one is made for a local master and removed when Python ends; on a cluster that is an error.
    """
    shared(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files and checkpoints that nothing refers to any more.

    Spark does so when the driver collects its garbage, which a driver with little to do may put off until the disks are full.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shared(spark: SparkSession) -> str:
    """The checkpoint folder of the session, which every executor reaches; it is set if it wasn't."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = context.getConf().get("spark.checkpoint.dir", "")
        if not named:
            if not context.master.startswith("local[") and context.master != "local":
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            named = tempfile.mkdtemp(prefix="babelmill-checkpoints-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        context.setCheckpointDir(named)
    return context._jsc.sc().getCheckpointDir().get()


def scratch(spark: SparkSession) -> str:
    """A new folder beside the checkpoints, for tables that a query writes and reads again."""
    return f"{shared(spark)}/table-{uuid.uuid4().hex}"
