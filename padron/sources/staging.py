"""Cut lineage by writing an intermediate table to the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used by a local session that names no folder of its own.
LOCAL_ROOT = "/tmp/checkpoints"


def checkpoint_root(spark: SparkSession) -> str:
    """Folder for this application's tables, below the shared folder of ``spark.checkpoint.dir``.

    On a cluster a machine-local folder would be lost with its executor, so a missing
    setting is an error there.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(LOCAL_ROOT)
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/{context.applicationId}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet and hand back its scan.

    Used where a plan reads one intermediate several times. The scan carries file
    sizes, so later join strategies are chosen from a measured size, and a lost
    executor costs only the tasks it was running.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Delete every table this application has staged; none of their scans can be read again."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(checkpoint_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
