"""The queries of this subpackage, for __spark_entry__.py."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = ["binarycodes", "compression", "decontaminate", "htmltext", "licences", "neardup", "negatives", "orchard", "packing", "perplexity", "privacy", "substrings", "warc"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for m in MODULES for k, v in import_module(f"atelier.llm.{m}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in import_module(f"atelier.llm.{m}").ORACLE.items()}
