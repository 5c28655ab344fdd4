"""Keyed rows: latest, first, merge, routing, contracts, paging."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """One row a key, the first in the given order; end the order with a unique column."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


first_per_key = latest_per_key


#: Parts in which a key's rows are cut down before they meet.
SALTS = 32


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], most: int, *, salts: int = SALTS) -> DataFrame:
    """Each key's first `most` rows, with their place in _n; end the order with a unique column.

    Rows are cut to `most` in each of `salts` parts of a key, and then among what is left: a key with many rows is spread, and no task sorts more
    than `most` * `salts` rows of it.
    """
    part = Window.partitionBy(*keys, "_part").orderBy(*order)
    spread = df.withColumn("_part", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    few = spread.withColumn("_n", F.row_number().over(part)).where(F.col("_n") <= most).drop("_part", "_n")
    return few.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= most)


def record_key(domain: str = "source_domain", record: str = "source_record_id", url: str = "source_url") -> Column:
    """What identifies a record: domain with record id, or with URL where there is no id."""
    has = F.coalesce(F.col(record), F.lit("")) != ""
    return F.concat_ws("\x1f", F.when(has, "id").otherwise("url"), F.coalesce(F.col(domain), F.lit("")), F.when(has, F.col(record)).otherwise(F.coalesce(F.col(url), F.lit(""))))


def upsert_by_key(base: DataFrame, incoming: DataFrame, *, update_cols: Sequence[str], order: Sequence[Column], key: Column | None = None) -> DataFrame:
    """base with the latest incoming row of each key: update_cols take its values, other columns keep their first value."""
    key = record_key() if key is None else key
    new = latest_per_key(incoming.withColumn("_k", key), ["_k"], order)
    old = base.withColumn("_k", key)
    there, came = F.col("o._in_base").isNotNull(), F.col("i._in_new").isNotNull()
    pairs = old.withColumn("_in_base", F.lit(1)).alias("o").join(new.withColumn("_in_new", F.lit(1)).alias("i"), "_k", "full_outer")
    pick = lambda c: F.when(~there, F.col(f"i.{c}")).when(came & F.lit(c in update_cols), F.col(f"i.{c}")).otherwise(F.col(f"o.{c}"))
    return pairs.select(*(pick(c).alias(c) for c in base.columns))


def replace_children(children: DataFrame, incoming: DataFrame, *, fk: str) -> DataFrame:
    """children without those of the parents that incoming has rows for, and incoming."""
    return children.join(incoming.select(fk).distinct(), fk, "left_anti").select(*children.columns).unionByName(incoming, allowMissingColumns=True)


def route_class(columns: Iterable[str]) -> Column:
    """Which table an item belongs to, by the fields that it has; rejected without URL and domain or without known shape."""
    have = set(columns)
    is_set = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) != "" if c in have else F.lit(False)
    return (
        F.when(is_set("event_id") & is_set("artist_name"), "event_artist")
        .when(is_set("event_id") & is_set("image_url"), "image")
        .when(~(is_set("source_url") & is_set("source_domain")), "rejected")
        .when(is_set("event_title") | is_set("venue_name"), "event")
        .when(is_set("artwork_title"), "artwork")
        .when(is_set("gallery_name"), "gallery")
        .when(is_set("artist_name"), "artist")
        .otherwise("rejected")
    )


#: The tables that items go to.
CLASSES = ["artwork", "event", "artist", "event_artist", "image", "gallery"]


def route_items(items: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """({class: its items}, the rejected items with the reason). Items are rows of one wide table, null where their kind has no such field."""
    routed = items.withColumn("class", route_class(items.columns))
    have = set(items.columns)
    blank = [F.coalesce(F.col(c).cast("string"), F.lit("")) == "" if c in have else F.lit(True) for c in ("source_url", "source_domain")]
    why = F.when(blank[0], "no source_url").when(blank[1], "no source_domain").otherwise("no known shape")
    return {c: routed.where(F.col("class") == c) for c in CLASSES}, routed.where("class = 'rejected'").withColumn("reason", why)


def select_with_fallback(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Each alias from the column of its name, else from its fallback, else null."""
    have = set(df.columns)
    return df.select(*(F.col(a) if a in have else F.col(f).alias(a) if f in have else F.lit(None).alias(a) for a, f in pairs))


def schema_contract(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """(column_name) of the required columns that df lacks."""
    return df.sparkSession.createDataFrame([(c,) for c in required if c not in df.columns], "column_name string")


def schema_tolerant(df: DataFrame, target: Sequence[str]) -> DataFrame:
    return df.select(*(c for c in target if c in df.columns))


def empty_relation(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def overlay(df: DataFrame, overrides: DataFrame, on: str, fields: dict[str, str]) -> DataFrame:
    """df with each field's override, {field: override column}, over its own value; the originals stay as original_<field>."""
    marked = overrides.select(on, *(F.col(o).alias(f"_o_{f}") for f, o in fields.items()))
    joined = df.join(marked, on, "left")
    return joined.select(*df.columns, *(F.col(f).alias(f"original_{f}") for f in fields), *(F.col(f"_o_{f}") for f in fields)).withColumns({f: F.coalesce(F.col(f"_o_{f}"), F.col(f)) for f in fields}).drop(*(f"_o_{f}" for f in fields))


def paged(df: DataFrame, order: Sequence[Column], *, limit: int = 50, offset: int = 0) -> DataFrame:
    """A page of 1 to 500 rows; end the order with a unique column."""
    return df.orderBy(*order).offset(max(0, offset)).limit(max(1, min(limit, 500)))


def top_k(df: DataFrame, key: Column, k: int) -> DataFrame:
    return df.groupBy(key.alias("key")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_last("key")).limit(k)


def histogram(df: DataFrame, value: Column, width: int) -> DataFrame:
    return df.groupBy((F.floor(value / width) * width).alias("bucket")).agg(F.count("*").alias("n"))


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(Column.__and__, conditions, F.lit(True))


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(Column.__or__, conditions, F.lit(False))


def count_flags(conditions: dict[str, Column]) -> list[Column]:
    return [F.count_if(c).alias(n) for n, c in conditions.items()]
