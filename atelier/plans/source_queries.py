"""Readers, writers and payload mappings over rows of the tables: what was written or packed must be what is read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atelier.operators import tables as O
from atelier.plans import queries as Q
from atelier.plans.queries import MART, query
from atelier.sources import readers as R
from atelier.sources.shared import scratch


@query("SELECT id, source_domain, source_url, artwork_title, price_text, NULL::varchar AS institution_name, crawl_timestamp FROM a_artworks")
def scan_raw(t):
    """Rows written without some declared columns come back with the whole schema."""
    rows = t["a_artworks"]
    path = scratch(t.spark, "raw")
    R.materialize(rows, f"{path}/artworks")
    return R.scan_raw(t.spark, path, "artworks").select("id", "source_domain", "source_url", "artwork_title", "price_text", "institution_name", "crawl_timestamp")


@query(f"WITH {MART} SELECT source_domain, medium_category, count(*) AS n FROM mart GROUP BY 1, 2")
def materialize(t):
    rows = Q.mart(t).select("source_domain", "medium_category", "raw_artwork_id")
    return R.materialize(rows, scratch(t.spark, "mart"), partition_by=["medium_category"]).groupBy("source_domain", "medium_category").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT p_type AS keyword, p_brand AS category FROM part")
def load_seed(t):
    rows = t["part"].select(F.col("p_type").alias("keyword"), F.col("p_brand").alias("category")).distinct()
    path = scratch(t.spark, "seed")
    rows.write.option("header", True).csv(path)
    return R.load_seed(t.spark, path, "keyword string, category string")


@query("SELECT id, artwork_title, artist_name FROM a_artworks WHERE coalesce(artwork_title, '') <> ''")
def read_records_json(t):
    rows = t["a_artworks"].select("id", "artwork_title", "artist_name")
    path = scratch(t.spark, "records")
    rows.write.json(path)
    return R.read_records_json(t.spark, path, ddl="id string, artwork_title string, artist_name string", require="artwork_title")


@query("SELECT l_orderkey::varchar || '-' || l_linenumber::varchar AS id, coalesce(CASE WHEN l_tax > 0.04 THEN 'https://m.example/' || l_orderkey END, 'https://museum.example/object/' || l_partkey) AS source_url, l_partkey::varchar AS source_record_id, p_name AS artwork_title, CASE WHEN l_discount > 0.05 THEN 'Gift of ' || p_brand ELSE p_type END AS description FROM lineitem JOIN part ON l_partkey = p_partkey")
def map_museum_json(t):
    o = t["lineitem"].join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
    payload = F.to_json(
        F.struct(
            F.col("l_partkey").alias("objectID"), F.col("p_name").alias("title"), F.when(F.col("l_tax") > 0.04, F.concat(F.lit("https://m.example/"), F.col("l_orderkey").cast("string"))).otherwise("").alias("objectURL"),
            F.when(F.col("l_discount") > 0.05, F.concat(F.lit("Gift of "), "p_brand")).alias("creditLine"), F.col("p_type").alias("objectName"),
        )
    )
    row = R.map_object_json(payload, domain="museum.example")
    made = o.select(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"), row.alias("r"))
    return made.select("id", "r.source_url", "r.source_record_id", "r.artwork_title", "r.description")


@query("SELECT s_name AS artist_name, 'https://index.example/artist/' || s_suppkey AS source_url FROM supplier WHERE s_acctbal > 0")
def map_search_hits(t):
    """One answer a nation; suppliers in debt have only a URL of another host."""
    host = F.when(F.col("s_acctbal") > 0, "https://index.example/artist/").otherwise("https://other.example/")
    url = F.concat(host, F.col("s_suppkey").cast("string"))
    hit = F.struct(F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).alias("title"), F.when(F.col("s_suppkey") % 2 == 1, F.col("s_name")).alias("slug"), F.when(F.col("s_suppkey") % 3 == 0, F.lit("https://cdn.example/x")).otherwise(url).alias("url"), url.alias("link"))
    answers = t["supplier"].groupBy("s_nationkey").agg(F.to_json(F.struct(F.collect_list(hit).alias("hits"))).alias("payload"))
    return R.map_search_hits(answers, "payload", host="index.example")


@query("SELECT id, artwork_title, NULL::varchar AS currency_text FROM a_artworks WHERE source_url IS NULL")
def empty_relation(t):
    """A view that is not built yet stands in by its schema, and takes rows by name."""
    rows = t["a_artworks"].where("source_url is null").select("id", "artwork_title")
    return O.empty_relation(t.spark, R.schema("artworks")).unionByName(rows, allowMissingColumns=True).select("id", "artwork_title", "currency_text")


@query("SELECT 'sources' AS part, count(*) AS lines FROM nation UNION ALL SELECT 'orders', 1")
def write_report(t):
    nations, orders = t["nation"].select("n_name"), t["orders"].agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    path = scratch(t.spark, "report")
    R.write_report({"sources": nations, "orders": orders}, path)
    return t.spark.read.schema("part string, row string").json(path).groupBy("part").agg(F.count("*").alias("lines"))
