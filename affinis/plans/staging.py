"""Write a shared intermediate once, read it several times."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Removes a query's shuffle files when it ends; otherwise they stay until the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, or the one set on the context."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return folder


def stage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back.

    Cuts lineage, so a lost executor costs no recomputation, and gives later
    scans column pruning and true file sizes for the choice of join.  The shuffle
    files of the write are removed at its end, so a chain of stages needs the disk
    of one; the session's own setting is put back.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    own = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.set(CLEANUP, own)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out over all cores where a scan has fewer partitions than there are cores.

    For costly per-row work on few or unsplittable files; a scan of many
    partitions is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
