"""Stage boundaries: written Parquet tables in the folder shared by the cluster.

A stage table cuts the lineage, survives the loss of executors, is read with column pruning, and tells Spark
its true size, by which Spark itself decides between broadcast and shuffle joins. Nothing here or elsewhere in
the package hints a broadcast.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a temporary folder only for a local master without one."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="deadhead-")
    return _local_dirs[app]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under a fresh path of the shared folder and return it as read back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/deadhead/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
