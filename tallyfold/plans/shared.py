"""The folder that driver and executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.  Where it is unset, a local master (one machine) gets a temporary
    one; on a cluster that is an error, because executors would not see each other's files."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named:
            if sc.master != "local" and not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            named = tempfile.mkdtemp(prefix="checkpoint-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle and checkpoint files of finished steps now.

    It follows the garbage collection of the driver's heap, which may be far off while an iteration piles up files of
    many small steps.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
