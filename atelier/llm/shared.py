"""What the operators have in common: shared scratch storage and table access."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; on one machine (as in tests), where it is unset, one below the warehouse."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "local")
        if master != "local" and not master.startswith("local["):
            raise ValueError("name a folder that driver and executors share in spark.checkpoint.dir")
        found = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return found.rstrip("/")


def written(df: DataFrame, what: str) -> DataFrame:
    """The same rows, read back from a Parquet table in the shared folder: lineage ends there, and lost executors lose nothing."""
    path = f"{shared_dir(df.sparkSession)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
