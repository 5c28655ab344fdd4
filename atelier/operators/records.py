"""Record views with all human overlays, and the dimensions and summaries of sources and artists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atelier.functions import text as X
from atelier.operators import marts as M
from atelier.operators.tables import first_rows, latest_per_key
from atelier.sources.shared import written


def cleaned(df: DataFrame, columns: str, *, keep: str = "") -> DataFrame:
    """The columns (new=old renames) with clean text, and those in keep as they are."""
    pairs = [c.split("=") if "=" in c else [c, c] for c in columns.split()]
    return df.select(*(X.clean_text(F.col(old)).alias(new) for new, old in pairs), *keep.split())


def stg_event_artists(raw: DataFrame) -> DataFrame:
    return cleaned(raw, "artist_name artist_name_normalized artist_profile_url match_type", keep="id event_id").withColumnRenamed("id", "raw_event_artist_id")


def stg_sources(raw: DataFrame) -> DataFrame:
    return cleaned(raw, "source_name source_domain base_url source_type risk_level", keep="id is_active").withColumnRenamed("id", "source_id")


def stg_crawl_runs(raw: DataFrame) -> DataFrame:
    return cleaned(raw, "spider_name run_status", keep="source_id started_at finished_at records_found records_inserted records_updated records_failed id").withColumnRenamed("id", "crawl_run_id")


def stg_crawl_errors(raw: DataFrame) -> DataFrame:
    return cleaned(raw, "error_type error_message", keep="source_id http_status created_at id").withColumnRenamed("id", "crawl_error_id")


def latest_approvals(approvals: DataFrame) -> DataFrame:
    return latest_per_key(approvals, ["artwork_id"], [F.desc_nulls_last("approved_at"), F.desc("id")])


def raw_provenance(marts: DataFrame, raw: DataFrame, columns: list[str]) -> DataFrame:
    """marts with columns of the raw rows that they were made from, as raw_<column>."""
    return marts.join(raw.select(F.col("id").alias("raw_artwork_id"), *(F.col(c).alias(f"raw_{c}") for c in columns)), "raw_artwork_id", "left")


def artwork_records(artworks: DataFrame, overrides: DataFrame, reviews: DataFrame, approvals: DataFrame) -> DataFrame:
    """Latest artworks with the artist's override, the latest review and the latest approval.

    Reviews and approvals name the artwork's id. A row without a review is pending; without an approval it is not public.
    """
    artist = overrides.select("artist_name", "source_domain", F.col("is_hidden").alias("artist_is_hidden"), "canonical_artist_name", F.col("reason").alias("artist_moderation_reason"))
    review = M.latest_reviews(reviews).select("artwork_id", "review_status", "reviewed_at")
    approval = latest_approvals(approvals).select("artwork_id", "public_visibility", "approved_at", "approved_by")
    joined = M.latest_artworks(artworks).join(artist, ["artist_name", "source_domain"], "left").join(review, "artwork_id", "left").join(approval, "artwork_id", "left")
    return joined.withColumn("original_artist_name", F.col("artist_name")).withColumns(
        {
            "artist_name": F.coalesce("canonical_artist_name", "artist_name"), "artist_is_hidden": F.coalesce("artist_is_hidden", F.lit(False)),
            "public_visibility": F.coalesce("public_visibility", F.lit(False)), "review_status": F.coalesce("review_status", F.lit("pending")),
        }
    )


def public_records(records: DataFrame, flags: DataFrame) -> DataFrame:
    """Approved and public works with a source and an artist, and without an open flag (artwork_id)."""
    shown = records.where("review_status = 'approved' and public_visibility and not artist_is_hidden and source_name is not null and source_url is not null and artist_name is not null")
    return shown.join(flags.select("artwork_id").distinct(), "artwork_id", "left_anti")


# ---- galleries


_GALLERY = "gallery_id gallery_name original_gallery_name gallery_address city country source_domain source_url gallery_record_type phone email website_url instagram_url facebook_url raw_payload crawl_timestamp".split()
#: What a reviewer may say about a gallery.
CANONICAL = [f"canonical_{c}" for c in "gallery_name gallery_type address city country phone email website_url instagram_url facebook_url".split()]
GALLERY_DECISIONS = ["is_hidden", "is_approved", *CANONICAL, "moderation_reason", "moderator_notes"]


def galleries_union(scraped: DataFrame, inferred: DataFrame) -> DataFrame:
    """Galleries that were scraped, and those that events name; columns that a side lacks are null."""
    one = scraped.withColumn("gallery_address", F.col("address")).withColumn("gallery_record_type", F.lit("scraped"))
    both = one.unionByName(inferred, allowMissingColumns=True)
    return (both if "raw_payload" in both.columns else both.withColumn("raw_payload", F.lit(None).cast("string"))).select(*_GALLERY)


def _firsts(rows: DataFrame, item: str, name: str) -> DataFrame:
    """(gallery_id, name, n): each gallery's first M.LINKS items, and how many there are."""
    rows = written(rows.select("gallery_id", item), name)
    held = first_rows(rows, ["gallery_id"], [F.asc(item)], M.LINKS).groupBy("gallery_id").agg(F.array_sort(F.collect_list(item)).alias(name))
    return rows.groupBy("gallery_id").agg(F.count("*").alias(f"n_{name.removeprefix('linked_')}")).join(held, "gallery_id")


def gallery_records(galleries: DataFrame, links: DataFrame, overrides: DataFrame, works: DataFrame | None = None) -> DataFrame:
    """The union with its events (and works, where given), the artists of its payload, missing_* flags and the whole override, whose fields stand beside the gallery's own.

    links: (gallery_id, event_id), distinct; works: (gallery_id, raw_artwork_id), distinct. Arrays hold the first M.LINKS, n_events and n_artworks count all.
    """
    said = [c for c in (*GALLERY_DECISIONS, "updated_at") if c in overrides.columns]
    state = overrides.select("gallery_id", *said, F.lit(True).alias("moderation_override_exists"))
    out = linked_artists_from_payload(galleries, "raw_payload", "$.represented_artists").join(_firsts(links, "event_id", "linked_events"), "gallery_id", "left").join(state, "gallery_id", "left")
    arrays = ["linked_events"]
    if works is not None:
        out, arrays = out.join(_firsts(works, "raw_artwork_id", "linked_artworks"), "gallery_id", "left"), ["linked_events", "linked_artworks"]
        out = out.withColumn("n_artworks", F.coalesce("n_artworks", F.lit(0).cast("long")))
    out = out.withColumns({c: F.coalesce(c, F.expr("cast(array() as array<string>)")) for c in arrays})
    none = {c: F.coalesce(c, F.lit(False)) for c in ("is_hidden", "is_approved", "moderation_override_exists")}
    return out.withColumns({**none, "n_events": F.coalesce("n_events", F.lit(0).cast("long"))}).withColumns(
        {
            "normalized_gallery_name": X.norm_key(F.col("gallery_name")), "missing_address": X.blank(F.col("gallery_address")), "missing_city": X.blank(F.col("city")), "missing_country": X.blank(F.col("country")),
            "missing_website": X.blank(F.col("website_url")), "missing_phone": X.blank(F.col("phone")), "missing_email": X.blank(F.col("email")),
            "missing_social": X.blank(F.col("instagram_url")) & X.blank(F.col("facebook_url")), "missing_linked_events": F.col("n_events") == 0,
        }
    )


MISSING = [f"missing_{x}" for x in "address city country website phone email social linked_events".split()]


def gallery_enrichment(records: DataFrame) -> DataFrame:
    """quality_flags, and quality_score of nine points; the source URL stands in for a website."""
    r = records.withColumn("missing_website", X.blank(F.col("website_url")) & X.blank(F.col("source_url")))
    there = [~X.blank(F.col("gallery_name"))] + [~F.col(c) for c in MISSING]
    return r.withColumns({"quality_score": sum((c.cast("int") for c in there), F.lit(0)), "quality_flags": X.flag_array({c: F.col(c) for c in MISSING})})


GALLERY_QUEUES = {
    "all": lambda: F.lit(True), "needs_review": lambda: ~F.col("is_approved") & ~F.col("is_hidden"), "low_quality": lambda: F.col("quality_score") <= 3, "approved": lambda: F.col("is_approved"),
    "hidden": lambda: F.col("is_hidden"), "edited": lambda: F.col("moderation_override_exists"),
}


def admin_galleries(df: DataFrame, *, queue: str = "all", as_of: str | None = None, missing: list[str] | None = None, kind: str | None = None, search: str | None = None, duplicates: bool = False) -> DataFrame:
    """A queue of enriched galleries, narrowed by missing fields, type, a search in name and city, or to names that repeat in a city."""
    state = F.col("crawl_timestamp") >= F.lit(as_of).cast("timestamp") - F.expr("INTERVAL '7' DAY") if queue == "recent" else GALLERY_QUEUES[queue]()
    out = df.where(state)
    for m in missing or []:
        out = out.where(F.col(f"missing_{m}"))
    if kind:
        out = out.where(F.coalesce("canonical_gallery_type", "gallery_record_type") == kind)
    if search:
        out = out.where(F.col("gallery_name").ilike(f"%{search}%") | F.col("city").ilike(f"%{search}%"))
    if duplicates:
        same = df.groupBy("normalized_gallery_name", F.lower("city").alias("_city")).agg(F.count("*").alias("_n")).where("_n > 1 and normalized_gallery_name <> ''")
        out = out.withColumn("_city", F.lower("city")).join(same, ["normalized_gallery_name", "_city"], "left_semi").drop("_city")
    return out


def linked_artists_from_payload(df: DataFrame, payload: str, path: str) -> DataFrame:
    """df with linked_artists: distinct (name, profile_url) of the objects at path in a JSON payload; nothing there gives an empty array."""
    items = F.from_json(F.get_json_object(payload, path), "array<struct<name: string, profile_url: string>>")
    named = F.filter(items, lambda x: ~X.blank(x["name"]))
    return df.withColumn("linked_artists", F.coalesce(F.array_sort(F.array_distinct(named)), F.expr("cast(array() as array<struct<name: string, profile_url: string>>)")))


# ---- artists


def artist_records(artists: DataFrame, overrides: DataFrame) -> DataFrame:
    """The artist dimension with how many sources hide the artist, and the newest canonical name."""
    o = overrides.withColumn("artist_key", X.slugify(F.col("artist_name")))
    turn = F.struct(F.col("updated_at") if "updated_at" in overrides.columns else F.lit(None).cast("timestamp"), F.col("canonical_artist_name"))
    named = F.max_by("canonical_artist_name", F.when(F.col("canonical_artist_name").isNotNull(), turn))
    state = o.groupBy("artist_key").agg(F.count_if("is_hidden").alias("hidden_in"), named.alias("canonical_artist_name"))
    return artists.join(state, "artist_key", "left").withColumn("hidden_in", F.coalesce("hidden_in", F.lit(0).cast("long")))


def confidence(name: Column, birth: Column, death: Column) -> Column:
    """1 with both years, 0.8 with one, 0.6 by name alone, 0.2 for names that are not a person's."""
    return F.when(M.ambiguous(name), 0.2).when(birth.isNotNull() & death.isNotNull(), 1.0).when(birth.isNotNull() | death.isNotNull(), 0.8).otherwise(0.6)


# ---- sources


def _rate(condition: Column) -> Column:
    return F.round(F.try_divide(F.count_if(condition), F.count("*")), 4)


def source_summary(sources: DataFrame, runs: DataFrame, errors: DataFrame, artworks: DataFrame) -> DataFrame:
    """By source: last successful run, runs, records, errors, missing and duplicate rates, score. Aggregates are joined, never rows."""
    r = runs.groupBy("source_id").agg(F.max(F.when(F.col("run_status") == "success", F.col("finished_at"))).alias("last_successful_crawl_at"), F.count("*").alias("total_crawl_runs"))
    e = errors.groupBy("source_id").agg(F.count("*").alias("total_errors"))
    a = artworks.groupBy("source_domain").agg(
        F.count("*").alias("total_records"), _rate(F.col("artist_name").isNull() | F.col("artwork_title").isNull()).alias("missing_required_field_rate"), _rate(F.col("is_duplicate_candidate")).alias("duplicate_rate"),
        F.round(F.avg("quality_score"), 2).alias("avg_quality_score"),
    )
    out = sources.join(r, "source_id", "left").join(e, "source_id", "left").join(a, "source_domain", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("total_crawl_runs", "total_errors", "total_records")})


def source_records(summary: DataFrame, *, as_of: str, warn: int = 7, error: int = 30) -> DataFrame:
    """The summary with the error rate a record, and how fresh the source is."""
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date("last_successful_crawl_at"))
    return summary.withColumns(
        {"error_rate": F.round(F.try_divide("total_errors", F.col("total_records") + F.col("total_errors")), 4), "freshness": F.when(age.isNull(), "never").when(age > error, "error").when(age > warn, "warn").otherwise("fresh")}
    )


def crawl_quality_full(sources: DataFrame, runs: DataFrame, errors: DataFrame, artworks: DataFrame) -> DataFrame:
    """By source and day: what the runs report, the errors, and what the records lack; days with any of the three."""
    r = runs.groupBy("source_id", F.to_date("started_at").alias("crawl_date")).agg(*(F.sum(c).alias(c) for c in ("records_inserted", "records_failed")))
    e = errors.groupBy("source_id", F.to_date("created_at").alias("crawl_date")).agg(F.count("*").alias("error_count"))
    ids = sources.select("source_id", "source_domain")
    a = artworks.groupBy("source_domain", F.to_date("crawl_timestamp").alias("crawl_date")).agg(
        F.count("*").alias("records_found"), F.count_if(F.col("artist_name").isNull()).alias("missing_artist_count"), F.count_if(F.col("artwork_title").isNull()).alias("missing_title_count"),
        F.count_if(F.col("image_url").isNull()).alias("missing_image_count"), F.count_if("is_duplicate_candidate").alias("duplicate_candidate_count"), F.avg("quality_score").alias("avg_quality_score"),
    )
    out = r.join(e, ["source_id", "crawl_date"], "full_outer").join(ids, "source_id").join(a, ["source_domain", "crawl_date"], "full_outer")
    counts = "records_inserted records_failed error_count records_found missing_artist_count missing_title_count missing_image_count duplicate_candidate_count".split()
    return out.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in counts})


def rate_metrics(quality: DataFrame, keys: list[str]) -> DataFrame:
    """By keys, of crawl_quality_full's rows: failed records a record found, and the missing and duplicate rates; null where no record was found."""
    counts = "records_found records_failed missing_artist_count missing_title_count missing_image_count duplicate_candidate_count".split()
    total = quality.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in counts))
    rate = lambda c: F.round(F.try_divide(c, "records_found"), 4)
    names = ["error_rate", "missing_artist_rate", "missing_title_rate", "missing_image_rate", "duplicate_rate"]
    return total.select(*keys, "records_found", *(rate(c).alias(n) for c, n in zip(counts[1:], names)))
