"""Queries and oracle SQL by operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from atelier.plans import queries as Q
from atelier.plans import merge_queries, page_queries, record_queries, review_queries, section_queries, source_queries, text_queries  # noqa: F401  (they register their queries)
from atelier.sources.adapters import Tables, oracle


def _run(f: Callable[[Tables], DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    return f(Tables(spark, sf_dir))


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(Q.mart_crawl_quality, spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: partial(_run, f) for name, (f, _) in Q.FOUND.items()}


def oracle_sql() -> dict[str, str]:
    return {name: oracle(sql) for name, (_, sql) in Q.FOUND.items() if sql}
