"""Summaries, overlays of human edits, filters of lists, and bundles for many entities at once."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atelier.functions import text as X
from atelier.operators.tables import all_of, first_rows, latest_per_key
from atelier.sources.shared import written


def enrichment_overlay(df: DataFrame, edits: DataFrame, *, key: str, fields: Sequence[str]) -> DataFrame:
    """Each field's latest human value over its own; the source values stay as source_<field>. edits: key, field, value, edited_at, id."""
    last = latest_per_key(edits.where(F.col("field").isin(list(fields))), [key, "field"], [F.desc("edited_at"), F.desc("id")])
    wide = last.groupBy(key).pivot("field", list(fields)).agg(F.first("value"))
    joined = df.withColumnsRenamed({f: f"source_{f}" for f in fields}).join(wide, key, "left")
    return joined.withColumns({f: F.coalesce(f, f"source_{f}") for f in fields})


def public_visibility(artworks: DataFrame, flags: DataFrame) -> DataFrame:
    """Approved, attributed and linked works without an open flag (artwork_id)."""
    shown = artworks.where("review_status = 'approved' and artist_name is not null and source_url is not null")
    return shown.join(flags.select("raw_artwork_id").distinct(), "raw_artwork_id", "left_anti")


def duplicate_resolution(groups: DataFrame, decisions: DataFrame) -> DataFrame:
    """canonical_id of each work: where the decisions (duplicate_id, canonical_id) that start from it end, else its own."""
    ends = decision_ends(decisions).withColumnsRenamed({"id": "raw_artwork_id", "end": "_c"})
    return groups.join(ends, "raw_artwork_id", "left").withColumn("canonical_id", F.coalesce("_c", "raw_artwork_id")).drop("_c")


def decision_ends(decisions: DataFrame) -> DataFrame:
    """(id, end) of each duplicate_id: the last of the chain of decisions (duplicate_id, canonical_id), or the least id of the cycle that it runs into.

    Of several decisions about one id the least canonical_id counts; nulls decide nothing. Steps are doubled, so the rounds are no more than the
    logarithm of the decisions; `low` is the least id on the way, which on a cycle, once around, is the cycle's. Hubs that many chains end in
    are one row each, joined to all of them, and such a join is split where it is skewed.
    """
    first = decisions.where("duplicate_id is not null and canonical_id is not null").groupBy(F.col("duplicate_id").alias("id")).agg(F.min("canonical_id").alias("next"))
    at = written(first.select("id", "next", F.col("id").alias("low")), "steps")
    most = max(1, at.count().bit_length())
    for _ in range(most):
        ahead = at.select(F.col("id").alias("next"), F.col("next").alias("then"), F.col("low").alias("_low"))
        moved = at.join(ahead, "next", "left").select("id", F.coalesce("then", "next").alias("next"), F.least("low", F.coalesce("_low", "low")).alias("low"), F.coalesce(F.col("then") != F.col("next"), F.lit(False)).alias("moved"))
        moved = written(moved, "steps")
        at = moved.drop("moved")
        if moved.where("moved").isEmpty():
            break
    # whoever is still followed by a decision is on a cycle
    ring = at.select(F.col("id").alias("next"), F.col("low").alias("ring"))
    return at.join(ring, "next", "left").select("id", F.coalesce("ring", "next").alias("end"))


def review_order(groups: DataFrame, reviews: DataFrame) -> DataFrame:
    """Works in the order of review: the priority (least number of the work's reviews (artwork_id, priority), none last), possible duplicates, low scores, new ones."""
    first = reviews.groupBy("artwork_id").agg(F.min("priority").alias("priority"))
    order = [F.desc_nulls_last("priority"), F.desc("is_duplicate_candidate"), F.asc("quality_score"), F.desc("crawl_timestamp"), F.asc("raw_artwork_id")]
    return groups.join(first, "artwork_id", "left").orderBy(*order)


def domain_candidates(profiles: DataFrame, records: DataFrame, raw: DataFrame, *, site: str) -> DataFrame:
    """(artist_name, source_domain, last_seen): the domains of each artist in the profiles, in the records (by their original name) and in the raw works, the newest time of each; rows without domain are the site's."""
    newest = lambda df, name: df.groupBy(F.col(name).alias("artist_name"), F.coalesce("source_domain", F.lit(site)).alias("source_domain")).agg(F.max("crawl_timestamp").alias("last_seen"))
    three = profiles.select("artist_name", "source_domain", "last_seen").unionByName(newest(records, "original_artist_name")).unionByName(newest(raw, "artist_name"))
    return three.where("artist_name is not null").groupBy("artist_name", "source_domain").agg(F.max("last_seen").alias("last_seen"))


def best_domain(candidates: DataFrame) -> DataFrame:
    """The newest domain of each artist (artist_name, source_domain, last_seen)."""
    return latest_per_key(candidates, ["artist_name"], [F.desc_nulls_last("last_seen"), F.asc("source_domain")]).select("artist_name", "source_domain")


def filtered_list(df: DataFrame, *, search: dict[str, str] | None = None, equal: dict[str, object] | None = None, missing: Sequence[str] = ()) -> DataFrame:
    """Rows whose columns contain, equal or lack what is asked for."""
    parts: list[Column] = [F.col(c).ilike(f"%{s}%") for c, s in (search or {}).items()]
    parts += [F.col(c) == v for c, v in (equal or {}).items()] + [X.blank(F.col(c)) for c in missing]
    return df.where(all_of(parts))


#: Weight of a word that a field holds.
FIELDS = {"artwork_title": 3, "artist_name": 3, "medium_text": 1, "description": 1, "source_name": 1}


def record_search(df: DataFrame, query: str, *, weights: dict[str, int] | None = None, exact: int = 10) -> DataFrame:
    """Rows that hold a word of the query, with a score: the weight of each field for each word that it holds, and `exact` for a title or artist that is the query."""
    words = [w for w in sorted(set(query.lower().split())) if re.fullmatch("[a-z0-9#]+", w)]  # no field holds a word of other characters

    whole = rf"(?<![a-z0-9#])(?:{'|'.join(map(re.escape, words)) or '(?!)'})(?![a-z0-9#])"
    held = lambda c: F.size(F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit(whole), F.lit(0))))
    total = F.lit(0)
    for c, w in (weights or FIELDS).items():
        if w:
            total = total + held(c) * w
    for c in ("artwork_title", "artist_name"):
        total = total + F.when(F.lower(F.trim(c)) == " ".join(query.lower().split()), exact).otherwise(0)
    return df.withColumn("score", total).where("score > 0")


def quality_summary(df: DataFrame, keys: Sequence[str], score: Column, flags: dict[str, Column]) -> DataFrame:
    """By keys: rows, how many carry each flag, the mean score and the newest crawl."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), *(F.count_if(c).alias(n) for n, c in flags.items()), F.round(F.avg(score), 2).alias("avg_score"), F.max("crawl_timestamp").alias("last_crawl"))


def bundle(parents: DataFrame, key: str | list[str], parts: dict[str, DataFrame], *, most: int = 500, kept: bool = False) -> DataFrame:
    """Each parent with an array of its `most` newest rows of every part (key, turn, item), and n_<part>, how many there are; the parts themselves hold all. kept: the parts are tables already."""
    out, keys = parents, [key] if isinstance(key, str) else key
    for name, df in parts.items():
        rows = df.select(*keys, "turn", "item")
        rows = rows if kept else written(rows, name)
        first = first_rows(rows, keys, [F.desc_nulls_last("turn"), F.asc("item")], most)
        cut = first.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_n", "item"))).alias(name)).select(*keys, F.transform(name, lambda x: x["item"]).alias(name))
        out = out.join(cut, keys, "left").join(rows.groupBy(*keys).agg(F.count("*").alias(f"n_{name}")), keys, "left")
        out = out.withColumns({name: F.coalesce(name, F.expr("cast(array() as array<string>)")), f"n_{name}": F.coalesce(f"n_{name}", F.lit(0).cast("long"))})
    return out


def whole_bundle(parents: DataFrame, key: str, parts: dict[str, DataFrame]) -> DataFrame:
    """Each parent with an array of all its rows of every part (key, turn, item), by turn and item, and n_<part>, how many there are."""
    out = parents
    for name, df in parts.items():
        every = F.array_sort(F.collect_list(F.struct("turn", "item")))
        held = df.groupBy(key).agg(F.transform(every, lambda x: x["item"]).alias(name), F.count("*").alias(f"n_{name}"))
        out = out.join(held, key, "left").withColumns({name: F.coalesce(name, F.expr("cast(array() as array<string>)")), f"n_{name}": F.coalesce(f"n_{name}", F.lit(0).cast("long"))})
    return out
