"""A local session for tests and tools. On a cluster the session comes from the caller."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings a local run needs; on a cluster these come from the deployment.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", app: str = "recount", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in {**LOCAL_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
