"""Session settings the operators are designed for, and where to cut lineage."""

import gc
import tempfile
import warnings
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes reduce partitions, picks broadcast joins from measured sizes and splits
# skewed join partitions. The first three are Spark defaults, stated because plans rely on them.
# Sizes measured at run time may be broadcast up to 64 MB; estimates keep the default 10 MB.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
}


def use_checkpoint_dir(spark: SparkSession) -> str | None:
    """Point checkpoints at the shared folder the session names in ``spark.checkpoint.dir``.

    A session without one gets none: iterative fits then keep their full lineage, with a warning.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if sc.getCheckpointDir() is None:
            warnings.warn("spark.checkpoint.dir is not set: lineage is not cut", stacklevel=2)
        return sc.getCheckpointDir()
    sc.setCheckpointDir(folder)
    return folder


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once, kept in the checkpoint folder with its lineage cut.

    A local session without ``spark.checkpoint.dir`` gets a temporary folder; on a cluster, where
    executors would not share it, that is an error.
    """
    sc = df.sparkSession.sparkContext
    if df.sparkSession.conf.get("spark.checkpoint.dir", None) is not None:
        use_checkpoint_dir(df.sparkSession)
    elif sc.getCheckpointDir() is None:
        if sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint()


@contextmanager
def held(df: DataFrame):
    """``df`` computed once while several jobs read it, on the executors, spilling to their disks."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def release_shuffles(spark: SparkSession) -> None:
    """Let executors delete the shuffle files of what the program no longer holds.

    Spark does so when the driver collects garbage, which a driver that only coordinates rarely
    does by itself, so the files of many fits in a row would pile up.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
