"""Readers, JSON mapping and streams."""

import json

import pytest
from pyspark.sql import functions as F

from atelier.operators import tables as O
from atelier.sources import readers as R
from atelier.streaming import buckets as B
from atelier.streaming import jobs as S


def test_json_records(spark, tmp_path):
    rows = [{"artwork_title": "A"}, {"artist_name": "x"}, {"artwork_title": "B"}]
    (tmp_path / "array.json").write_text(json.dumps(rows, indent=1))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, rows)))
    (tmp_path / "bad.json").write_text('"text"')
    for name in ("array.json", "lines.json"):
        got = R.read_records_json(spark, str(tmp_path / name), ddl="artwork_title string, artist_name string", require="artwork_title")
        assert [r.artwork_title for r in got.collect()] == ["A", "B"]
    with pytest.raises(ValueError):
        R.read_records_json(spark, str(tmp_path / "bad.json"), ddl="artwork_title string", require="artwork_title")


def test_json_mapping(spark):
    df = spark.createDataFrame([(json.dumps({"objectID": 7, "title": "T", "creditLine": "", "objectName": "Vase"}),)], "p string")
    x = df.select(R.map_object_json(F.col("p"), domain="m.example").alias("x")).first()["x"]
    assert (x.source_url, x.artwork_title, x.description, x.source_record_id) == ("https://m.example/object/7", "T", "Vase", "7")
    hits = spark.createDataFrame([(json.dumps({"hits": [{"name": "N", "url": "https://other.example/a", "link": "https://h.example/b"}, {"slug": "s"}]}),)], "p string")
    assert [tuple(r) for r in R.map_search_hits(hits, "p", host="h.example").collect()] == [("N", "https://h.example/b")]


def test_contracts_and_empty_tables(spark):
    df = R.empty_like(spark, "events")
    assert df.count() == 0 and df.schema["start_date"].dataType.simpleString() == "date"
    assert [r.column_name for r in O.schema_contract(df, ["id", "nope"]).collect()] == ["nope"]
    assert O.select_with_fallback(df, [("id", "x"), ("y", "city"), ("z", "q")]).columns == ["id", "y", "z"]
    assert O.schema_tolerant(df, ["id", "nope"]).columns == ["id"]


def test_streams(spark, tmp_path):
    schema = "id string, source_domain string, source_record_id string, source_url string, title string, ts timestamp"
    source = str(tmp_path / "in")
    for i, title in enumerate(["old", "new"]):
        spark.createDataFrame([(str(i), "d", "r", "u", title, None)], schema).withColumn("ts", F.lit(f"2024-01-0{i + 1}").cast("timestamp")).coalesce(1).write.mode("append").parquet(source)
        S.stream_upsert(spark.readStream.schema(schema).parquet(source), str(tmp_path / "out"), str(tmp_path / "ck"), update_cols=["title"], order=[F.desc("ts")]).awaitTermination()
    assert [(r.id, r.title) for r in B.current(spark, str(tmp_path / "out"), spark.read.parquet(source).schema).collect()] == [("0", "new")]
    query = S.stream_first_seen(spark.readStream.schema(schema).parquet(source), ["source_record_id"], ts="ts", within="30 days").writeStream.format("memory").queryName("seen").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("seen").count() == 1
    query = S.windowed_counts(spark.readStream.schema(schema).parquet(source), "source_domain", ts="ts", size="10 days", late="1 day").writeStream.outputMode("complete").format("memory").queryName("counts").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("counts").agg(F.sum("n")).first()[0] == 2
