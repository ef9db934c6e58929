"""Tables that a job writes on its way: below the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession) -> str:
    """A new path below spark.checkpoint.dir or the checkpoint folder that was set. Where neither is, a session of one
    machine has a temporary folder; on a cluster, whose machines share none, that is an error."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="tideline-")
    return f"{shared.rstrip('/')}/tick-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """df, written and read back: its lineage ends there, and what it drew or numbered stays as it is."""
    path = path or new_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
