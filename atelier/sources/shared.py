"""Storage that driver and executors share, for intermediate tables and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; on one machine (as in tests), where it is unset, one below the warehouse. On a cluster it must be set."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "local")
        if master != "local" and not master.startswith("local["):
            raise ValueError("name a folder that driver and executors share in spark.checkpoint.dir")
        found = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return found.rstrip("/")


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """The same rows, read back from a table in the shared folder: what several plans or outputs use is computed once, and lost executors lose nothing."""
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
