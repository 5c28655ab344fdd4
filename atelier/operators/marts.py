"""Staging, linking, marts and record views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atelier.functions import parse as P
from atelier.functions import text as X
from atelier.operators.tables import latest_per_key, overlay
from atelier.sources.shared import written

#: Medium category by keyword, in order.
MEDIUMS = [
    ("oil", "painting"), ("canvas", "painting"), ("watercolor", "painting"), ("bronze", "sculpture"), ("marble", "sculpture"),
    ("silver print", "photography"), ("photograph", "photography"), ("ink", "drawing"), ("paper", "drawing"), ("ceramic", "ceramics"),
]
SCORE = {"artist_name": 20, "artwork_title": 20, "year_start": 10, "medium_text": 10, "dimensions_text": 10, "image_url": 10, "source_url": 10, "description": 10}


def staged(df: DataFrame, id_to: str, cleaned: Sequence[str]) -> DataFrame:
    """id renamed, the given columns cleaned."""
    return df.withColumnRenamed("id", id_to).withColumns({c: X.clean_text(F.col(c)) for c in cleaned if c in df.columns})


ARTWORK_TEXT = "source_domain source_name source_url source_record_id artist_name artwork_title artwork_date_text medium_text dimensions_text price_text gallery_name image_url description".split()
EVENT_TEXT = "source_domain source_name source_url source_record_id event_type event_title venue_name venue_address city country description image_url".split()
GALLERY_TEXT = "source_domain source_url source_record_id gallery_name address city region country phone email website_url instagram_url facebook_url".split()


def stg_artworks(raw: DataFrame) -> DataFrame:
    return staged(raw, "raw_artwork_id", ARTWORK_TEXT)


def stg_events(raw: DataFrame) -> DataFrame:
    return staged(raw, "event_id", EVENT_TEXT)


def stg_galleries(raw: DataFrame) -> DataFrame:
    return staged(raw, "raw_gallery_id", GALLERY_TEXT).withColumn("email", F.lower("email"))


def keyword_category(df: DataFrame, text_col: str, *, mode: str = "first", default: str = "unknown", seed: Sequence[tuple[str, str]] = MEDIUMS) -> DataFrame:
    """medium_category by the keywords that the text contains: the first in seed order, or (mode all) one row for each."""
    low = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    if mode == "first":
        return df.withColumn("medium_category", F.coalesce(*(F.when(F.contains(low, F.lit(k)), F.lit(c)) for k, c in seed), F.lit(default)))
    keys = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(c).alias("c")) for k, c in seed))
    return df.withColumn("_hit", F.explode_outer(F.filter(keys, lambda s: F.contains(low, s["k"])))).withColumn("medium_category", F.coalesce("_hit.c", F.lit(default))).drop("_hit")


def int_artworks(stg: DataFrame, *, mode: str = "first") -> DataFrame:
    """Parsed years, category, a key that survives rebuilds, and the quality score."""
    year = P.year_parse(F.col("artwork_date_text"))
    df = keyword_category(stg, "medium_text", mode=mode).withColumns({"year_start": year["year_start"], "year_end": year["year_end"], "date_parse_status": year["status"], "price_parse_status": P.price_status(F.col("price_text"))})
    key = F.col("raw_artwork_id") if mode == "first" else F.concat_ws("|", "raw_artwork_id", "medium_category")
    return df.withColumns({"artwork_id": X.md5_uuid(key), "quality_score": X.presence_score(SCORE)})


def parsed_attributes(artworks: DataFrame) -> DataFrame:
    """The values of the three parsers as columns: years, price with currency, and centimetres. One row in, one row out, so no join."""
    one = artworks.withColumns({"_y": P.date_parse_full(F.col("artwork_date_text")), "_p": P.price_parse(F.col("price_text")), "_s": P.dimension_parse(F.col("dimensions_text"))})
    return one.withColumns(
        {
            "year_start": F.col("_y.year_start"), "year_end": F.col("_y.year_end"), "date_parse_status": F.col("_y.status"), "price_numeric": F.col("_p.price_min"), "currency_code": F.col("_p.currency"), "price_parse_status": F.col("_p.status"),
            "height_cm": F.col("_s.height_cm"), "width_cm": F.col("_s.width_cm"), "depth_cm": F.col("_s.depth_cm"), "dimension_parse_status": F.col("_s.status"),
        }
    ).drop("_y", "_p", "_s")


def source_linkage(domain: str) -> Column:
    """With a URL, or from the one site whose records may lack it: with an id or image, and a title or artist."""
    other = (F.col("source_domain") == domain) & F.coalesce("source_record_id", "image_url").isNotNull() & F.coalesce("artwork_title", "artist_name").isNotNull()
    return F.col("source_url").isNotNull() | F.coalesce(other, F.lit(False))


def mart_artworks(raw: DataFrame, *, domain: str = "", mode: str = "first") -> DataFrame:
    return int_artworks(stg_artworks(raw), mode=mode).where(source_linkage(domain))


def crawl_quality(artworks: DataFrame) -> DataFrame:
    return artworks.groupBy("source_domain", "source_name", F.to_date("crawl_timestamp").alias("crawl_date")).agg(
        F.count("*").alias("records_found"),
        F.count_if(F.col("artwork_title").isNull()).alias("missing_title_count"),
        F.count_if(F.col("artist_name").isNull()).alias("missing_artist_count"),
        F.count_if(F.col("image_url").isNull()).alias("missing_image_count"),
        F.avg("quality_score").alias("avg_quality_score"),
    )


def int_artists(raw: DataFrame) -> DataFrame:
    cleaned = raw.select(F.col("id").alias("artist_id"), X.clean_text(F.col("source_domain")).alias("source_domain"), X.clean_text(F.col("artist_name")).alias("artist_name"))
    return cleaned.withColumn("normalized_artist_name", X.normalize_person_name(F.col("artist_name"))).where("normalized_artist_name is not null")


def mentions(events: DataFrame, cols: Sequence[str] = ("event_title", "description"), *, split_on_and: bool = False, payload: str | None = None) -> DataFrame:
    """Distinct (event_id, candidate, normalized) of the given text columns, and of the people that a payload names, in one pass."""
    parts = [X.tokenize_mentions(F.col(c), split_on_and=split_on_and) for c in cols]
    if payload:
        parts.append(F.flatten(F.transform(X.payload_texts(F.col(payload)), lambda x: X.tokenize_mentions(x, split_on_and=split_on_and))))
    tokens = F.explode(F.flatten(F.array(*parts)))
    found = events.select("event_id", tokens.alias("candidate_artist_name")).withColumn("normalized_candidate_artist_name", X.normalize_person_name(F.col("candidate_artist_name")))
    return found.where("normalized_candidate_artist_name is not null").distinct()


def event_artists(found: DataFrame, artists: DataFrame) -> DataFrame:
    """One row an (event, artist) of equal normalised names. Mentions are distinct by name first: a hot name joins once an event."""
    names = found.select("event_id", F.col("normalized_candidate_artist_name").alias("normalized_artist_name")).distinct()
    return names.join(artists, "normalized_artist_name").select("event_id", "artist_id", "artist_name", "source_domain", F.lit("exact_name").alias("match_type")).dropDuplicates(["event_id", "artist_id"])


def mart_events(events: DataFrame, links: DataFrame) -> DataFrame:
    counts = links.groupBy("event_id").agg(F.countDistinct("artist_id").cast("int").alias("artist_count"), F.array_sort(F.collect_set("artist_name")).alias("linked_artists"))
    joined = events.join(counts, "event_id", "left")
    return joined.withColumns({"artist_count": F.coalesce("artist_count", F.lit(0)), "linked_artists": F.coalesce("linked_artists", F.expr("cast(array() as array<string>)"))})


def artist_event_links(links: DataFrame, events: DataFrame) -> DataFrame:
    own = links.select("event_id", "artist_id", "artist_name", "match_type")
    keyed = own.withColumns({"artist_activity_id": X.md5_uuid(F.concat_ws(":", "event_id", "artist_id")), "artist_name_normalized": X.normalize_person_name(F.col("artist_name"))})
    return keyed.join(events.select("event_id", "event_type", "event_title", "city", "country", "start_date", "end_date", "source_domain", "source_url", "crawl_timestamp"), "event_id")


def int_galleries(stg: DataFrame, *, site: str, label: str, own: str) -> DataFrame:
    g = stg.withColumns(
        {
            "original_gallery_name": F.col("gallery_name"),
            "gallery_name": X.gallery_name_clean(F.col("gallery_name"), F.col("source_domain"), site=site, label=label),
            "phone": X.phone_normalize(F.col("phone")),
            "website_url": X.website_normalize(F.col("website_url")),
            "instagram_url": X.social_normalize(F.col("instagram_url"), "instagram.com", own=own),
            "facebook_url": X.social_normalize(F.col("facebook_url"), "facebook.com", own=own),
        }
    )
    g = g.withColumns({f"n_{c}": X.norm_key(F.col(c)) for c in ("gallery_name", "city", "country")})
    social = X.blank(F.col("instagram_url")) & X.blank(F.col("facebook_url"))
    there = [~X.blank(F.col(c)) for c in ("gallery_name", "address", "city", "country", "phone", "email", "website_url")] + [~social]
    return g.withColumns(
        {
            "normalized_gallery_key": F.concat_ws("|", "n_gallery_name", "n_city", "n_country", F.coalesce("source_domain", F.lit(""))),
            "contact_quality_score": sum((c.cast("int") for c in there), F.lit(0)),
            "quality_flags": X.flag_array({"missing_email": X.blank(F.col("email")), "missing_phone": X.blank(F.col("phone")), "missing_website": X.blank(F.col("website_url")), "missing_social": social}),
        }
    )


def latest_galleries(galleries: DataFrame) -> DataFrame:
    key = F.coalesce(F.nullif("source_record_id", F.lit("")), F.nullif("source_url", F.lit("")), F.col("normalized_gallery_key"))
    return latest_per_key(galleries, ["source_domain", key], [F.desc_nulls_last("crawl_timestamp"), F.desc_nulls_last("created_at"), F.desc("raw_gallery_id")])


def _event_keys(events: DataFrame) -> DataFrame:
    return events.withColumns({"n_gallery_name": X.norm_key(F.col("venue_name")), "n_city": X.norm_key(F.col("city")), "n_country": X.norm_key(F.col("country"))})


LINK = ["n_gallery_name", "n_city", "n_country", "source_domain"]


def gallery_event_links(galleries: DataFrame, events: DataFrame) -> DataFrame:
    """(raw_gallery_id, event_id, event_title) of the events at each gallery's venue, as rows; a venue or gallery without a name has none."""
    there = _event_keys(events).where("n_gallery_name <> ''").select(*LINK, "event_id", "event_title")
    return galleries.where("n_gallery_name <> ''").select("raw_gallery_id", *LINK).join(there, LINK).select("raw_gallery_id", "event_id", "event_title").distinct()


def gallery_artwork_links(galleries: DataFrame, artworks: DataFrame) -> DataFrame:
    """(raw_gallery_id, raw_artwork_id, artwork_title), as rows; names that are blank link nothing."""
    there = artworks.select(X.norm_key(F.col("gallery_name")).alias("n_gallery_name"), "source_domain", "raw_artwork_id", "artwork_title").where("n_gallery_name <> ''")
    met = galleries.select("raw_gallery_id", "n_gallery_name", "source_domain").join(there, ["n_gallery_name", "source_domain"])
    return met.groupBy("raw_gallery_id", "raw_artwork_id").agg(F.min("artwork_title").alias("artwork_title"))


#: Links of a gallery that an array of gallery_records holds, at most; the mart and the row forms hold all of them.
LINKS = 1000


def _held(links: DataFrame, item: Sequence[str], name: str) -> DataFrame:
    """(raw_gallery_id, name, n_<name>): all of each gallery's items in order, and how many there are."""
    return links.groupBy("raw_gallery_id").agg(F.array_sort(F.collect_list(F.struct(*item))).alias(name), F.count("*").alias(f"n_{name}"))


def mart_galleries(galleries: DataFrame, events: DataFrame, artworks: DataFrame) -> DataFrame:
    kept = written(latest_galleries(galleries), "galleries")
    out = kept.withColumn("gallery_id", X.md5_uuid(F.col("normalized_gallery_key")))
    for links, item, name in ((gallery_event_links(kept, events), ("event_id", "event_title"), "linked_events"), (gallery_artwork_links(kept, artworks), ("raw_artwork_id", "artwork_title"), "linked_artworks")):
        none = F.expr(f"cast(array() as array<struct<{item[0]}: string, {item[1]}: string>>)")
        out = out.join(_held(links, item, name), "raw_gallery_id", "left").withColumns({name: F.coalesce(name, none), f"n_{name}": F.coalesce(f"n_{name}", F.lit(0).cast("long"))})
    return out


#: Names that are site chrome.
CALLS = r"(?i)(list your gallery|list your art exhibition|submit your gallery|advertise|login|register|sign up)"
GENERIC = ["home", "gallery", "galleries", "events", "art in south africa"]


INFERRED = ["k_name", "k_city", "k_country", "k_domain"]


def inferred_events(events: DataFrame, galleries: DataFrame, *, site: str, label: str) -> DataFrame:
    """Events whose venue matches no gallery, with the cleaned venue and the keys of the gallery that it stands for."""
    named = _event_keys(events.where(~X.blank(F.col("venue_name")))).join(galleries.select(*LINK).distinct(), LINK, "left_anti")
    name = X.venue_name_clean(F.col("venue_name"), F.col("source_domain"), site=site, label=label)
    trimmed = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    return named.withColumns(
        {
            "original_gallery_name": F.trim("venue_name"), "cleaned": name, "k_name": X.norm_key(F.trim(name)), "k_city": X.norm_key(trimmed("city"), default="unknown-city"),
            "k_country": X.norm_key(trimmed("country"), default="unknown-country"), "k_domain": X.norm_key(trimmed("source_domain"), default="unknown-source"),
        }
    )


def inferred_galleries(events: DataFrame, galleries: DataFrame, *, site: str, label: str) -> DataFrame:
    """Galleries of the venues that match none; groups of the listing site that are site chrome are left out."""
    trimmed = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    both = F.concat_ws("\n", "cleaned", "original_gallery_name")
    grouped = inferred_events(events, galleries, site=site, label=label).groupBy(*INFERRED).agg(
        F.min(F.nullif("cleaned", F.lit(""))).alias("gallery_name"), F.min("original_gallery_name").alias("original_gallery_name"), F.min(trimmed("venue_address")).alias("gallery_address"),
        F.min(trimmed("city")).alias("city"), F.min(trimmed("country")).alias("country"), F.min(trimmed("source_domain")).alias("source_domain"), F.min(trimmed("source_url")).alias("source_url"),
        F.countDistinct("event_id").alias("n_linked_events"), F.max("crawl_timestamp").alias("crawl_timestamp"),
        F.bool_or(F.contains("cleaned", F.lit("|")) | F.contains(F.lower("cleaned"), F.lit(label.lower()))).alias("noisy"),
        F.bool_or(both.rlike(CALLS) | (F.contains(F.lower(both), F.lit("art in south africa")) & F.contains(F.lower(both), F.lit(label.lower())))).alias("chrome"),
    )
    bare = F.coalesce("gallery_name", F.lit(""))
    out = F.coalesce(F.col("source_domain") == site, F.lit(False)) & (F.col("chrome") | (F.length(F.trim(bare)) <= 3) | F.lower(bare).isin(GENERIC))
    return grouped.where(~out).withColumns(
        {"gallery_id": X.md5_uuid(F.concat_ws("|", *INFERRED)), "gallery_record_type": F.lit("inferred_from_event"), "quality_flags": X.flag_array({"noisy_inferred_name": F.col("noisy")})}
    ).drop("noisy", "chrome")


#: What tells rows of one id apart; not all columns, so that a query need not carry those that it leaves out.
TELLING = ["source_record_id", "source_url", "artist_name", "artwork_title", "image_url"]


def _telling(rows: DataFrame) -> Column:
    """The end of an order whose id may repeat: the choice doesn't depend on how rows are dealt."""
    return F.xxhash64(*(c for c in TELLING if c in rows.columns))


def latest_artworks(raw: DataFrame) -> DataFrame:
    key = F.coalesce("source_record_id", "raw_artwork_id")
    return latest_per_key(raw, ["source_domain", key], [F.desc_nulls_last("crawl_timestamp"), F.desc("raw_artwork_id"), F.desc(_telling(raw))])


def latest_reviews(reviews: DataFrame) -> DataFrame:
    return latest_per_key(reviews, ["artwork_id"], [F.desc_nulls_last("reviewed_at"), F.desc("created_at"), F.desc("id")])


def artwork_records(artworks: DataFrame, reviews: DataFrame) -> DataFrame:
    """Latest artworks with their latest review."""
    status = latest_reviews(reviews).select("artwork_id", "review_status", "reviewed_at")
    return latest_artworks(artworks).join(status, "artwork_id", "left").withColumn("review_status", F.coalesce("review_status", F.lit("pending")))


def event_records(events: DataFrame, overrides: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """Events with their override: what it says goes before the event's own title and type, and stands beside them as canonical_*, with its notes and time where it has them.

    Given the raw events (id, payload), each event has its raw_payload as well. Events without an override are neither hidden nor approved.
    """
    over = overlay(events, overrides, "event_id", {"event_title": "canonical_event_title", "event_type": "event_type"})
    said = [c for c in ("moderation_reason", "moderator_notes", "updated_at") if c in overrides.columns]
    state = overrides.select("event_id", "is_hidden", "is_approved", "canonical_event_title", F.col("event_type").alias("canonical_event_type"), *said, F.lit(True).alias("_there"))
    if raw is not None:
        over = over.join(raw.select(F.col("id").alias("event_id"), F.col("payload").alias("raw_payload")), "event_id", "left")
    return over.join(state, "event_id", "left").withColumns(
        {"is_hidden": F.coalesce("is_hidden", F.lit(False)), "is_approved": F.coalesce("is_approved", F.lit(False)), "moderation_override_exists": F.coalesce("_there", F.lit(False))}
    ).drop("_there")


def artist_rollup(records: DataFrame, **counts: Column) -> DataFrame:
    """A row for each (artist, domain), with its number of works, newest crawl and best row, and for works without artist; counts: how many rows hold for each condition."""
    rated = F.struct(F.col("source_url").isNotNull() & F.col("description").isNotNull(), F.coalesce("crawl_timestamp", F.lit("1900-01-01").cast("timestamp")), "raw_artwork_id", _telling(records))
    return records.groupBy("artist_name", "source_domain").agg(
        F.count("*").alias("artwork_count"), F.max("crawl_timestamp").alias("last_seen"), F.max_by(F.struct("source_url", "description"), rated).alias("best"), *(F.count_if(c).alias(n) for n, c in counts.items())
    )


def artist_profiles(records: DataFrame, edits: DataFrame | None = None, overrides: DataFrame | None = None) -> DataFrame:
    """Roll-up of each (artist, domain) with its best row's biography, cleaned, deduplicated and scored; an edit goes first. Given overrides, what they say of the artist stands beside it."""
    return rolled_profiles(artist_rollup(records.where("artist_name is not null")), edits, overrides)


def rolled_profiles(rollup: DataFrame, edits: DataFrame | None = None, overrides: DataFrame | None = None) -> DataFrame:
    """artist_profiles from its roll-up."""
    rollup = rollup.where("artist_name is not null")
    bio = X.bio_clean(F.col("best.description"))
    out = rollup.withColumn("_bio", bio).withColumns({"profile_url": F.col("best.source_url"), "original_artist_bio": F.col("best.description"), "cleaned_artist_bio": F.col("_bio.cleaned"), "bio_quality_score": X.bio_score(F.col("_bio")), "bio_quality_flags": X.bio_flags(F.col("_bio"))})
    if edits is not None:
        last = latest_per_key(edits, ["artist_name", "source_domain"], [F.desc("created_at"), F.desc("id")]).select("artist_name", "source_domain", "edited_bio")
        out = out.join(last, ["artist_name", "source_domain"], "left")
    else:
        out = out.withColumn("edited_bio", F.lit(None).cast("string"))
    if overrides is not None:
        said = overrides.select("artist_name", "source_domain", "is_hidden", "canonical_artist_name", F.col("reason").alias("moderation_reason"))
        out = out.join(said, ["artist_name", "source_domain"], "left").withColumn("is_hidden", F.coalesce("is_hidden", F.lit(False)))
    return out.withColumn("artist_bio", F.coalesce("edited_bio", "cleaned_artist_bio", "original_artist_bio")).drop("best", "_bio")


def ambiguous(name: Column) -> Column:
    """Names that are not one person's."""
    return F.lower(name).rlike(r"^(unknown|unidentified artist|workshop of|after|attributed to)\b")


def artist_dedupe(artworks: DataFrame) -> DataFrame:
    """Artists by slug, with birth and death years where the table has them; ambiguous names are never merged."""
    slug = X.slugify(F.col("artist_name"))
    years = [F.col(c).cast("string") if c in artworks.columns else F.lit(None).cast("string") for c in ("birth_year", "death_year")]
    one = F.concat_ws(":", slug, "raw_artwork_id")
    keyed = artworks.where("artist_name is not null").withColumn("artist_key", F.when(ambiguous(F.col("artist_name")), one).otherwise(F.concat_ws("-", slug, *years)))
    sure = F.when(ambiguous(F.col("artist_name")), 0.2).when(years[0].isNotNull() & years[1].isNotNull(), 1.0).when(years[0].isNotNull() | years[1].isNotNull(), 0.8).otherwise(0.6)
    return keyed.groupBy("artist_key").agg(
        F.min("artist_name").alias("artist_name"), F.countDistinct("source_domain").alias("source_count"), F.count("*").alias("artwork_count"), F.min("crawl_timestamp").alias("first_seen"), F.max("crawl_timestamp").alias("last_seen"),
        F.max(sure).alias("artist_confidence_score"), F.min(years[0]).alias("birth_year"), F.min(years[1]).alias("death_year"),
    )


def duplicate_groups(artworks: DataFrame) -> DataFrame:
    """duplicate_group_key (artist, title and, where known, year), its count, and whether it is shared. Rows without a key stay out of the shuffle."""
    key = F.concat_ws("|", X.slugify(F.col("artist_name")), X.slugify(F.col("artwork_title")), F.col("year_start").cast("string"))
    keyed = artworks.withColumn("duplicate_group_key", F.when(F.col("artist_name").isNotNull() & F.col("artwork_title").isNotNull(), key))
    spread = F.coalesce("duplicate_group_key", F.concat(F.lit("\x1f"), "raw_artwork_id"))  # rows without a key are groups of one
    n = F.when(F.col("duplicate_group_key").isNull(), F.lit(1).cast("long")).otherwise(F.count("*").over(Window.partitionBy(spread)))
    return keyed.withColumn("duplicate_group_count", n).withColumn("is_duplicate_candidate", F.col("duplicate_group_count") > 1)


def quality_score_full(artworks: DataFrame) -> DataFrame:
    price, size = P.price_parse(F.col("price_text"))["status"], P.dimension_parse(F.col("dimensions_text"))["status"]
    lost = F.when(F.col("is_duplicate_candidate"), 20).otherwise(0) + F.when(price == "failed", 10).otherwise(0) + F.when(size == "failed", 10).otherwise(0)
    return artworks.withColumn("quality_score_full", F.greatest(F.lit(0), F.least(F.lit(100), F.col("quality_score") - lost)))
