"""Every query against its oracle on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from atelier.plans import registry
from atelier.sources.adapters import BASE

SMALL = "/root/testdata/sf0.001"


def rows(cells, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in cells)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in BASE:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    df = registry.queries()[name](spark, SMALL)
    found = duck.execute(registry.oracle_sql()[name])
    columns = [x[0] for x in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.collect(), df.columns) == rows(found.fetchall(), columns)


def test_queries_without_oracle_run(spark):
    for name in sorted(set(registry.queries()) - set(registry.oracle_sql())):
        assert registry.queries()[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert registry.entry(spark, SMALL).count() > 0


@pytest.mark.parametrize("name", ["check_artist_linking", "apply_artwork_reviews", "queue_summary", "moderation_summary", "event_records_full", "gallery_records", "gallery_enrichment", "event_bundle", "mart_galleries", "crawl_quality_full", "json_ld_artwork"])
def test_plans_read_each_stage_few_times(spark, name):
    plan = registry.queries()[name](spark, SMALL)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") <= 15 and plan.count("MapInArrow") <= 1 and "CartesianProduct" not in plan


def test_titles_and_many_rules_need_no_python_and_no_nested_loop(spark):
    for name in ("title_similarity", "auto_apply_suggestions", "learned_rule_match_by_grams"):
        plan = registry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan


def test_the_stream_holds_only_what_is_asked_of_it(spark):
    """A batch shuffles and rewrites whole rows of the table: no descriptions, names or addresses among them."""
    from atelier.sources.shared import shared_dir

    registry.queries()["stream_upsert"](spark, SMALL)
    tables = sorted(Path(shared_dir(spark)).glob("stream-*/table/data"), key=lambda p: p.stat().st_mtime)
    assert sorted(spark.read.parquet(str(tables[-1])).columns) == sorted(["id", "artwork_title", "crawl_timestamp", "price_text", "key", "batch", "bucket"])


def test_galleries_are_made_in_as_many_parts_as_cores(spark):
    from atelier.sources.adapters import Tables

    assert Tables(spark, SMALL)["a_galleries"].rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("name", ["queue_summary", "artist_works_bundle", "moderation_summary", "candidate_union"])
def test_summaries_of_works_write_no_whole_records(spark, name):
    """Works, their mart and their records are carried in the columns in use, and only what is asked of them is written."""
    from atelier.sources.shared import shared_dir

    before = set(Path(shared_dir(spark)).glob("*"))
    registry.queries()[name](spark, SMALL).collect()
    made = set(Path(shared_dir(spark)).glob("*")) - before
    assert made and not [p for p in made if p.name.split("-")[0] in ("mart", "records", "mart_events")]
    for p in made:
        if p.name.split("-")[0] in ("works", "rollup", "counts"):
            assert not {"description", "image_url", "medium_text", "artwork_title"} & set(spark.read.parquet(str(p)).columns)
