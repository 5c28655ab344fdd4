"""A keyed table in buckets, into which batches are merged.

Below the table's folder, data/batch=N/bucket=K holds the rows of bucket K after batch N, and manifest/batch=N names the batch that
holds each bucket's rows. A batch reads and rewrites only the buckets that its keys fall into; its manifest is written last, so readers
see a batch wholly or not at all. A repeated batch starts from the manifest before it and writes the same rows to the same places.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atelier.operators.tables import record_key, upsert_by_key

BUCKETS = 256
_MANIFEST = "bucket int, batch long, buckets int"


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _manifest(spark: SparkSession, target: str, batch_id: int) -> dict[int, int]:
    """The batch that holds each bucket, as of a batch: at most as many rows as there are buckets."""
    return {r.bucket: r.batch for r in spark.read.schema(_MANIFEST).parquet(f"{target}/manifest/batch={batch_id}").collect() if r.bucket >= 0}


def _rows(spark: SparkSession, target: str, schema: T.StructType, places: dict[int, int]) -> DataFrame:
    paths = [f"{target}/data/batch={batch}/bucket={bucket}" for bucket, batch in sorted(places.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def merge(batch: DataFrame, batch_id: int, target: str, *, update_cols: Sequence[str], order: Sequence[Column], key: Column | None = None, buckets: int = BUCKETS) -> None:
    """Merges a batch, as upsert_by_key does, into the table as of the batch before; batch 0 starts from nothing, any other needs the manifest before it."""
    spark, key = batch.sparkSession, record_key() if key is None else key
    places = _manifest(spark, target, batch_id - 1) if batch_id else {}
    if batch_id and (other := spark.read.schema(_MANIFEST).parquet(f"{target}/manifest/batch={batch_id - 1}").select("buckets").head()) and other[0] != buckets:
        raise ValueError(f"the table has {other[0]} buckets, not {buckets}")
    touched = {r[0] for r in batch.select(_bucket(key, buckets)).distinct().collect()}
    base = _rows(spark, target, batch.schema, {b: n for b, n in places.items() if b in touched})
    after = upsert_by_key(base, batch, update_cols=update_cols, order=order, key=key).withColumns({"bucket": _bucket(key, buckets), "_key": key})
    dealt = after.repartition("bucket").sortWithinPartitions("bucket", "_key").drop("_key")
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/data/batch={batch_id}")
    now = places | dict.fromkeys(touched, batch_id)
    # a row of bucket -1 keeps the number of buckets where nothing has come yet
    rows = [(b, n, buckets) for b, n in sorted(now.items())] or [(-1, batch_id, buckets)]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{target}/manifest/batch={batch_id}")


def _fs(spark: SparkSession, target: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _batches(spark: SparkSession, folder: str) -> list[int]:
    fs, path = _fs(spark, folder), spark._jvm.org.apache.hadoop.fs.Path(folder)
    return sorted(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(path) if s.getPath().getName().startswith("batch=")) if fs.exists(path) else []


def current(spark: SparkSession, target: str, schema: T.StructType, *, batch_id: int | None = None) -> DataFrame:
    """The table as of a batch, by default the last that has its manifest; without one, no rows."""
    done = _batches(spark, f"{target}/manifest") if batch_id is None else [batch_id]
    return _rows(spark, target, schema, _manifest(spark, target, done[-1]) if done else {})


def vacuum(spark: SparkSession, target: str, *, keep: int = 2) -> int:
    """Removes what the last `keep` manifests don't name, older manifests included; how many folders went. keep is at least 2: a repeated batch needs the one before."""
    done = _batches(spark, f"{target}/manifest")
    kept = done[-max(2, keep) :]
    named = {place for n in kept for place in _manifest(spark, target, n).items()}
    fs, at, gone = _fs(spark, target), spark._jvm.org.apache.hadoop.fs.Path, 0
    for n in (x for x in done if x not in kept):
        gone += fs.delete(at(f"{target}/manifest/batch={n}"), True)
    for n in _batches(spark, f"{target}/data"):
        if n > done[-1]:
            continue  # a batch that is being written
        for s in fs.listStatus(at(f"{target}/data/batch={n}")):
            name = s.getPath().getName()
            if name.startswith("bucket=") and (int(name[7:]), n) not in named:
                gone += fs.delete(s.getPath(), True)
        if not any(b == n for _, b in named):
            gone += fs.delete(at(f"{target}/data/batch={n}"), True)
    return gone
