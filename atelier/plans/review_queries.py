"""Queries over records of all kinds: routing, years of artists, events with all that was said of them, suspect names, rates, and the summary of moderation."""

from __future__ import annotations

from pyspark.sql import functions as F

from atelier.functions import parse as P
from atelier.operators import audit as A
from atelier.operators import marts as M
from atelier.operators import moderation as D
from atelier.operators import records as R
from atelier.operators import tables as O
from atelier.plans import queries as Q
from atelier.plans import record_queries as RQ
from atelier.plans.queries import EVENTS, MART, query, slug
from atelier.plans.record_queries import FULL, UNION
from atelier.sources.shared import written

_SET = lambda c: f"coalesce({c}, '') <> ''"


@query(f"""SELECT 'artwork' AS kind, id, CASE WHEN NOT {_SET('source_url')} THEN 'rejected' WHEN {_SET('artwork_title')} THEN 'artwork' WHEN {_SET('gallery_name')} THEN 'gallery' ELSE 'rejected' END AS class, CASE WHEN NOT {_SET('source_url')} THEN 'no source_url' END AS reason FROM a_artworks
UNION ALL SELECT 'event', id, 'event', NULL FROM a_events WHERE {_SET('venue_name')} OR {_SET('event_title')} UNION ALL SELECT 'gallery', id, 'gallery', NULL FROM a_galleries
UNION ALL SELECT 'artist', id, CASE WHEN id::bigint % 5 = 0 THEN 'rejected' ELSE 'artist' END, CASE WHEN id::bigint % 5 = 0 THEN 'no source_domain' END FROM a_artists
UNION ALL SELECT 'event_artist', id, 'event_artist', NULL FROM a_event_artists
UNION ALL SELECT 'image', id, CASE WHEN image_url IS NULL THEN 'rejected' ELSE 'image' END, CASE WHEN image_url IS NULL THEN CASE WHEN id::bigint % 2 = 0 THEN 'no known shape' ELSE 'no source_url' END END FROM a_events""")
def route_items_of_all_kinds(t):
    """Items of every table in one relation, each with the fields of its kind."""
    page = F.concat(F.lit("https://"), "source_domain", F.lit("/artists/"), "id")
    of = {
        "artwork": t["a_artworks"].select("id", "source_url", "source_domain", "artwork_title", "gallery_name"), "event": t["a_events"].select("id", "source_url", "source_domain", "event_title", "venue_name"),
        "gallery": t["a_galleries"].select("id", "source_url", "source_domain", "gallery_name"), "artist": t["a_artists"].select("id", page.alias("source_url"), F.when(F.col("id").cast("long") % 5 != 0, F.col("source_domain")).alias("source_domain"), "artist_name"),
        "event_artist": t["a_event_artists"].select("id", "event_id", "artist_name"), "image": t["a_events"].select("id", F.col("id").alias("event_id"), "image_url", F.when(F.col("id").cast("long") % 2 == 0, F.col("source_url")).alias("source_url"), "source_domain"),
    }
    items = None
    for kind, df in of.items():
        one = df.withColumn("kind", F.lit(kind))
        items = one if items is None else items.unionByName(one, allowMissingColumns=True)
    routed, rejected = O.route_items(items)
    out = rejected.select("kind", "id", "class", "reason")
    for df in routed.values():
        out = out.unionByName(df.select("kind", "id", "class", F.lit(None).cast("string").alias("reason")))
    return out


_YEARS = "y AS (SELECT id AS o, CASE WHEN k % 7 <> 0 AND k % 5 <> 0 AND y >= 1500 THEN y::varchar END AS birth_year, CASE WHEN k % 7 = 1 THEN (y + 60)::varchar END AS death_year FROM a_phrases)"


@query(f"""WITH {MART}, {_YEARS}, n AS (SELECT CASE WHEN split_part(raw_artwork_id, '-', 1)::bigint % 10 = 3 THEN 'Workshop of ' || artist_name ELSE artist_name END AS artist_name, raw_artwork_id, source_domain, crawl_timestamp, birth_year, death_year FROM mart LEFT JOIN y ON o = split_part(raw_artwork_id, '-', 1) WHERE artist_name IS NOT NULL),
k AS (SELECT *, {slug('artist_name')} AS s, artist_name LIKE 'Workshop of %' AS unsure FROM n)
SELECT CASE WHEN unsure THEN s || ':' || raw_artwork_id ELSE concat_ws('-', s, birth_year, death_year) END AS artist_key, min(artist_name) AS artist_name, min(birth_year) AS birth_year, min(death_year) AS death_year, count(DISTINCT source_domain) AS source_count, count(*) AS artwork_count,
 min(crawl_timestamp) AS first_seen, max(crawl_timestamp) AS last_seen, max(CASE WHEN unsure THEN 0.2 WHEN birth_year IS NOT NULL AND death_year IS NOT NULL THEN 1.0 WHEN coalesce(birth_year, death_year) IS NOT NULL THEN 0.8 ELSE 0.6 END)::double AS artist_confidence_score FROM k GROUP BY 1""")
def artist_dedupe_by_years(t):
    """Works whose texts tell when the artist was born or died; those of workshops are merged with nothing."""
    said = t["a_phrases"].select("k", F.col("id").alias("o"), F.split("life", " and ").alias("life"))
    years = said.select("o", F.when(F.col("k") % 7 != 0, P.lifespan_year(F.col("life")[0])).alias("birth_year"), F.when(F.col("k") % 7 == 1, P.lifespan_year(F.col("life")[1])).alias("death_year"))
    order = F.split_part("raw_artwork_id", F.lit("-"), F.lit(1))
    works = Q.mart(t).withColumn("o", order).join(years, "o", "left")
    named = works.withColumn("artist_name", F.when(F.col("o").cast("long") % 10 == 3, F.concat(F.lit("Workshop of "), "artist_name")).otherwise(F.col("artist_name")))
    return M.artist_dedupe(named)


@query(f"""WITH {EVENTS} SELECT mev.event_id, coalesce(o.canonical_event_title, mev.event_title) AS event_title, mev.event_title AS original_event_title, o.canonical_event_title, coalesce(o.event_type, mev.event_type) AS event_type, mev.event_type AS original_event_type, o.event_type AS canonical_event_type,
 p.payload AS raw_payload, array_to_string(linked_artists, ',') AS linked_artists, artist_count, coalesce(o.is_hidden, false) AS is_hidden, coalesce(o.is_approved, false) AS is_approved, o.event_id IS NOT NULL AS moderation_override_exists, o.moderation_reason, o.moderator_notes, o.updated_at
FROM mev LEFT JOIN a_event_overrides o ON o.event_id = mev.event_id LEFT JOIN a_event_payloads p ON p.id = mev.event_id""", staged=True)
def event_records_full(t):
    e = M.event_records(Q.mart_ev(t), t["a_event_overrides"], t["a_event_payloads"])
    return e.select(
        "event_id", "event_title", "original_event_title", "canonical_event_title", "event_type", "original_event_type", "canonical_event_type", "raw_payload", F.array_join("linked_artists", ",").alias("linked_artists"), "artist_count",
        "is_hidden", "is_approved", "moderation_override_exists", "moderation_reason", "moderator_notes", "updated_at",
    )


@query("""SELECT id, CASE k % 6 WHEN 0 THEN 'denylist' WHEN 1 THEN 'colon' WHEN 2 THEN 'too_long' ELSE 'single_token' END AS reason,
 CASE k % 4 WHEN 0 THEN 'Anna Van ' || split_part('Alpha,Beta,Gamma,Delta', ',', (1 + k % 4)::int) WHEN 2 THEN 'The Workshop' ELSE '' END AS suggested_artist_name FROM a_phrases WHERE k % 6 IN (0, 1, 2) OR (k % 6 = 3 AND k % 4 IN (0, 2))""")
def suspect_name_suggestions(t):
    """Headings, shows, long texts, single names and whole ones, by pages some of whose slugs spell a name."""
    k = F.col("k") % 6
    name = F.when(k == 0, "  Selected  Works ").when(k == 1, F.concat("c_name", F.lit(": paintings"))).when(k == 2, F.concat_ws(" ", "c_name", F.repeat(F.col("n_name"), 9))).when(k == 3, "Anna").otherwise(F.concat_ws(" ", F.lit("Anna"), "c_name"))
    rows = t["a_phrases"].withColumn("artist_name", name)
    return A.suspect_names(rows, url="url", overrides={"workshop-for-all": "The Workshop"}).select("id", "reason", "suggested_artist_name")


@query(f"""WITH {Q.DUP}, {RQ.SRC}, f AS (SELECT source_domain, sum(records_failed) AS failed FROM a_runs r JOIN src USING (source_id) GROUP BY 1),
q AS (SELECT source_domain, count(*) AS n, count(*) FILTER (artist_name IS NULL) AS a, count(*) FILTER (artwork_title IS NULL) AS b, count(*) FILTER (image_url IS NULL) AS i, count(*) FILTER (c > 1) AS d FROM dup GROUP BY 1)
SELECT source_domain, coalesce(n, 0)::bigint AS records_found, round(coalesce(failed, 0) / n, 4) AS error_rate, round(a / n, 4) AS missing_artist_rate, round(b / n, 4) AS missing_title_rate, round(i / n, 4) AS missing_image_rate, round(d / n, 4) AS duplicate_rate
FROM q FULL JOIN (SELECT source_domain, failed FROM src LEFT JOIN f USING (source_domain) WHERE source_id IN (SELECT source_id FROM a_runs UNION SELECT source_id FROM a_errors)) g USING (source_domain)""")
def rate_metrics_by_source(t):
    """Rates of the runs and records of each source."""
    quality = R.crawl_quality_full(R.stg_sources(t["a_sources"]), t["a_runs"], t["a_errors"], M.duplicate_groups(Q.mart(t)))
    return R.rate_metrics(quality, ["source_domain"])


@query(f"""WITH {FULL}, {UNION}, es AS (SELECT coalesce(is_hidden, false) AS h, coalesce(is_approved, false) AS a FROM mev LEFT JOIN a_event_overrides o ON o.event_id = mev.event_id),
ap AS (SELECT coalesce(o.is_hidden, false) AS h, coalesce(trim(o.canonical_artist_name), '') <> '' AS a FROM (SELECT DISTINCT original_artist_name AS artist_name, source_domain FROM full_ WHERE original_artist_name IS NOT NULL) p LEFT JOIN a_artist_overrides o USING (artist_name, source_domain))
SELECT 'artists' AS entity_type, count(*) AS total, count(*) FILTER (NOT h AND a) AS approved, count(*) FILTER (h) AS hidden, count(*) FILTER (NOT h AND NOT a) AS needs_review FROM ap
UNION ALL SELECT 'artworks', count(*), count(*) FILTER (public_visibility), count(*) FILTER (artist_is_hidden), count(*) FILTER (review_status IN ('pending', 'unreviewed') AND NOT public_visibility) FROM full_
UNION ALL SELECT 'events', count(*), count(*) FILTER (a), count(*) FILTER (h), count(*) FILTER (NOT a AND NOT h) FROM es
UNION ALL SELECT 'galleries', count(*), count(*) FILTER (is_approved), count(*) FILTER (is_hidden), count(*) FILTER (NOT is_approved AND NOT is_hidden) FROM gr""", staged=True)
def moderation_summary(t):
    works = written(D.moderation_counts(RQ.full_once(t), "original_artist_name", "source_domain"), "counts")  # a row for each artist and domain
    people = works.where("original_artist_name is not null").select(F.col("original_artist_name").alias("artist_name"), "source_domain")
    profiles = people.join(t["a_artist_overrides"], ["artist_name", "source_domain"], "left")
    state = lambda rows, said, key: rows.select(key).join(said.select(key, "is_hidden", "is_approved"), key, "left")
    return D.moderation_summary(profiles, works, state(Q.venue_ev(t), t["a_event_overrides"], "event_id"), state(RQ.union(t), t["a_gallery_overrides"], "gallery_id"))
