"""Tables and folders that the driver and all executors share.

``spark.checkpoint.dir`` names the place. What is written there survives lost executors and cuts the
lineage; it stays until the folder is cleared, as returned frames read it."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_base(spark: SparkSession) -> str:
    """The shared folder as a URL. On a cluster the session has to name one; on one machine (a
    ``local`` master) a temporary folder is set where it names none."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="recount-shared-")
        spark.sparkContext.setCheckpointDir(base)
    if "://" not in base and not base.startswith("file:"):
        base = "file://" + os.path.abspath(base)
    return base.rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder (not yet made) below the shared one."""
    return f"{shared_base(spark)}/recount-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
