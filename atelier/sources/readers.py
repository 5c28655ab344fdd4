"""Reading raw tables, seeds and JSON records, and writing marts and reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEXTS = {
    "artworks": "id source_id crawl_run_id source_name source_domain source_url source_record_id artist_name artwork_title artwork_date_text medium_text dimensions_text price_text currency_text gallery_name institution_name department_name image_url thumbnail_url description raw_payload content_hash",
    "artists": "id source_id crawl_run_id source_url source_domain source_record_id artist_name birth_year_text death_year_text nationality_text biography image_url raw_payload content_hash",
    "galleries": "id source_domain source_url source_record_id gallery_name address city region country phone email website_url instagram_url facebook_url contact_person description raw_payload",
    "events": "id crawl_run_id source_name source_domain source_url source_record_id event_type event_title venue_name venue_address city country description image_url raw_payload content_hash",
    "event_artists": "id event_id artist_name artist_name_normalized artist_profile_url match_type",
    "event_images": "id event_id image_url image_caption image_type content_hash",
    "sources": "id source_name source_domain base_url source_type risk_level",
    "crawl_runs": "id source_id source_name spider_name run_status error_message",
    "crawl_errors": "id crawl_run_id source_id spider_name source_url error_type error_message raw_context",
}
_MORE = {
    "artworks": "crawl_timestamp timestamp, created_at timestamp, updated_at timestamp",
    "artists": "crawl_timestamp timestamp, created_at timestamp, updated_at timestamp",
    "galleries": "crawl_timestamp timestamp, created_at timestamp",
    "events": "start_date date, end_date date, opening_datetime timestamp, crawl_timestamp timestamp, created_at timestamp, updated_at timestamp",
    "sources": "is_active boolean, created_at timestamp, updated_at timestamp",
    "crawl_runs": "started_at timestamp, finished_at timestamp, records_found int, records_inserted int, records_updated int, records_failed int, created_at timestamp",
    "crawl_errors": "http_status int, retry_count int, created_at timestamp",
}


def schema(name: str) -> str:
    """DDL of a raw table."""
    return ", ".join([f"{c} string" for c in _TEXTS[name].split()] + [_MORE[name]] * (name in _MORE))


def scan_raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(schema(name)).parquet(f"{folder}/{name}")


def load_seed(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A small CSV dimension with a header."""
    return spark.read.option("header", True).schema(ddl).csv(path)


def read_records_json(spark: SparkSession, path: str, *, ddl: str, require: str) -> DataFrame:
    """Records of a JSON array or of JSON lines, told apart by the first sign; records without the required field are left out.

    Another JSON document raises ValueError.
    """
    head = spark.read.text(path).where(F.trim("value") != "").select(F.substring(F.trim("value"), 1, 1).alias("c"), F.trim("value").alias("v")).first()
    if head is None:
        return spark.createDataFrame([], ddl)
    if head["c"] not in "[{" or head["v"] == "{":
        raise ValueError("neither a JSON array nor JSON lines")
    rows = spark.read.schema(ddl).option("multiLine", head["c"] == "[").json(path)
    return rows.where(F.coalesce(F.col(require), F.lit("")) != "")


_OBJECT = "objectID long, title string, artistDisplayName string, objectDate string, medium string, dimensions string, creditLine string, objectName string, primaryImage string, objectURL string, department string, repository string"


def map_object_json(payload: Column, *, domain: str) -> Column:
    """struct of an artwork row from a museum's object document; the URL falls back on the object's number."""
    o = F.from_json(payload, _OBJECT)
    text = lambda name: F.nullif(o[name], F.lit(""))
    url = F.coalesce(text("objectURL"), F.concat(F.lit(f"https://{domain}/object/"), o["objectID"].cast("string")))
    parts = [text(n) for n in ("title", "artistDisplayName", "objectDate", "medium", "dimensions", "primaryImage")]
    return F.struct(
        F.lit(domain).alias("source_domain"), url.alias("source_url"), o["objectID"].cast("string").alias("source_record_id"), text("artistDisplayName").alias("artist_name"), text("title").alias("artwork_title"),
        text("objectDate").alias("artwork_date_text"), text("medium").alias("medium_text"), text("dimensions").alias("dimensions_text"), text("primaryImage").alias("image_url"),
        F.coalesce(text("creditLine"), text("objectName")).alias("description"), F.sha2(F.array_join(F.array(*(F.coalesce(p, F.lit("")) for p in parts)), "|"), 256).alias("content_hash"),
    )


def map_search_hits(df: DataFrame, payload: str, *, host: str) -> DataFrame:
    """(artist_name, source_url) of each hit of a search answer: the first name and the first URL on the host."""
    hits = F.from_json(F.col(payload), "hits array<struct<title: string, name: string, artist_name: string, slug: string, url: string, permalink: string, link: string>>")
    h = df.select(F.explode(hits["hits"]).alias("h"))
    first = lambda names: F.coalesce(*(F.nullif(F.trim(F.col(f"h.{n}")), F.lit("")) for n in names))
    urls = F.filter(F.array(*(F.col(f"h.{n}") for n in ("url", "permalink", "link"))), lambda u: u.rlike(rf"^https?://(?:www\.)?\Q{host}\E/"))
    return h.select(first(["title", "name", "artist_name", "slug"]).alias("artist_name"), F.try_element_at(urls, F.lit(1)).alias("source_url")).where("source_url is not null")


def materialize(df: DataFrame, path: str, *, partition_by: Sequence[str] = ()) -> DataFrame:
    """A mart as a table, rebuilt in full; read it from the result, never from df."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_report(parts: dict[str, DataFrame], path: str) -> None:
    """JSON lines {part, row}, a line for each row of each part; parts are aggregates."""
    lines = [df.select(F.lit(name).alias("part"), F.to_json(F.struct("*")).alias("row")) for name, df in parts.items()]
    reduce(DataFrame.unionByName, lines).write.mode("overwrite").json(path)


def empty_like(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], T.StructType.fromDDL(schema(name)))
