"""Queries over the record views with all overlays, sources and runs, decisions, and checks, each with the SQL of an independent oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from atelier.functions import parse as P
from atelier.functions import text as X
from atelier.operators import audit as A
from atelier.operators import marts as M
from atelier.operators import moderation as D
from atelier.operators import records as R
from atelier.operators import summaries as S
from atelier.operators import tables as O
from atelier.plans import queries as Q
from atelier.plans.queries import DUP, EQ, EVENTS, GAL, INFERRED, LATEST, MART, ct, key, query, slug, uuid
from atelier.sources.shared import written

AS_OF = "1998-08-01"


def _list(columns: str) -> str:
    return ", ".join(f"{ct(c)} AS {c}" for c in columns.split())


# ---- staging


@query(f"SELECT id AS raw_event_artist_id, event_id, {_list('artist_name artist_name_normalized artist_profile_url match_type')} FROM a_event_artists")
def stg_event_artists(t):
    return R.stg_event_artists(t["a_event_artists"])


SRC = f"src AS (SELECT id AS source_id, is_active, {_list('source_name source_domain base_url source_type risk_level')} FROM a_sources)"


@query(f"WITH {SRC} SELECT * FROM src")
def stg_sources(t):
    return R.stg_sources(t["a_sources"])


@query(f"SELECT id AS crawl_run_id, source_id, started_at, finished_at, records_found, records_inserted, records_updated, records_failed, {_list('spider_name run_status')} FROM a_runs")
def stg_crawl_runs(t):
    return R.stg_crawl_runs(t["a_runs"])


@query(f"SELECT id AS crawl_error_id, source_id, http_status, created_at, {_list('error_type error_message')} FROM a_errors")
def stg_crawl_errors(t):
    return R.stg_crawl_errors(t["a_errors"])


# ---- artworks with all overlays


APPROVED = "app AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY artwork_id ORDER BY approved_at DESC NULLS LAST, id DESC) AS n FROM a_approvals) WHERE n = 1)"
FULL = f"""{LATEST}, {APPROVED}, rev AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY artwork_id ORDER BY reviewed_at DESC NULLS LAST, created_at DESC, id DESC) AS n FROM a_reviews) WHERE n = 1),
full_ AS (SELECT l.* REPLACE (coalesce(o.canonical_artist_name, l.artist_name) AS artist_name), l.artist_name AS original_artist_name, coalesce(o.is_hidden, false) AS artist_is_hidden, coalesce(rev.review_status, 'pending') AS review_status,
 coalesce(app.public_visibility, false) AS public_visibility, app.approved_at, rev.reviewed_at
 FROM latest l LEFT JOIN a_artist_overrides o ON o.artist_name = l.artist_name AND o.source_domain = l.source_domain LEFT JOIN rev ON rev.artwork_id = l.artwork_id LEFT JOIN app ON app.artwork_id = l.artwork_id)"""


def full(t):
    return t.once("records", lambda: R.artwork_records(Q.mart(t), t["a_artist_overrides"], t["a_reviews"], t["a_approvals"]))


def full_once(t):
    """full for a plan that reads it once: neither it nor the mart is written, so only the columns in use are carried."""
    return R.artwork_records(M.mart_artworks(t["a_artworks"], domain=Q.SITE), t["a_artist_overrides"], t["a_reviews"], t["a_approvals"])


@query(f"WITH {APPROVED} SELECT id, artwork_id, public_visibility FROM app")
def latest_approval(t):
    return R.latest_approvals(t["a_approvals"]).select("id", "artwork_id", "public_visibility")


@query(f"WITH {FULL} SELECT raw_artwork_id, artist_name, original_artist_name, artist_is_hidden, review_status, public_visibility, approved_at FROM full_")
def artwork_records_full(t):
    return full(t).select("raw_artwork_id", "artist_name", "original_artist_name", "artist_is_hidden", "review_status", "public_visibility", "approved_at")


@query(f"WITH {FULL} SELECT raw_artwork_id FROM full_ WHERE review_status = 'approved' AND public_visibility AND NOT artist_is_hidden AND source_name IS NOT NULL AND source_url IS NOT NULL AND artist_name IS NOT NULL AND artwork_id NOT IN (SELECT artwork_id FROM a_rejections WHERE rejection_reason = 'toxic')")
def public_records(t):
    return R.public_records(full(t), t["a_rejections"].where("rejection_reason = 'toxic'")).select("raw_artwork_id")


@query(f"WITH {MART} SELECT raw_artwork_id, mart.source_record_id, a.source_url AS raw_source_url, a.crawl_run_id AS raw_crawl_run_id FROM mart LEFT JOIN a_artworks a ON a.id = mart.raw_artwork_id")
def raw_provenance_join(t):
    return R.raw_provenance(Q.mart(t), t["a_artworks"], ["source_url", "crawl_run_id"]).select("raw_artwork_id", "source_record_id", "raw_source_url", "raw_crawl_run_id")


@query(f"WITH {FULL} SELECT raw_artwork_id, artwork_title, artist_name, review_status, quality_score, crawl_timestamp FROM full_ ORDER BY crawl_timestamp DESC NULLS LAST, raw_artwork_id LIMIT 100")
def review_table(t):
    return O.paged(full(t), [F.desc_nulls_last("crawl_timestamp"), F.asc("raw_artwork_id")], limit=100).select("raw_artwork_id", "artwork_title", "artist_name", "review_status", "quality_score", "crawl_timestamp")


@query(f"WITH {FULL} SELECT raw_artwork_id FROM full_ ORDER BY quality_score DESC NULLS LAST, raw_artwork_id LIMIT 50 OFFSET 100")
def paged_list(t):
    return O.paged(full(t), [F.desc_nulls_last("quality_score"), F.asc("raw_artwork_id")], limit=50, offset=100).select("raw_artwork_id")


@query(f"WITH {MART} SELECT source_domain AS key, count(*) AS n FROM mart GROUP BY 1")
def artworks_by_source(t):
    return Q.mart(t).groupBy(F.col("source_domain").alias("key")).agg(F.count("*").alias("n"))


@query(f"WITH {MART}, k AS (SELECT r.*, row_number() OVER (PARTITION BY source_domain, coalesce(source_record_id, raw_artwork_id) ORDER BY crawl_timestamp DESC NULLS LAST, raw_artwork_id DESC) AS n FROM mart r) SELECT raw_artwork_id FROM k WHERE n = 1 AND raw_artwork_id NOT IN (SELECT raw_artwork_id FROM k WHERE n = 1 AND source_domain <> '{Q.SITE}')")
def raw_ranked_check(t):
    """Rows that rank first, missed by a table that lost a source: the check finds each of them."""
    m = Q.mart(t)
    kept = M.latest_artworks(m).where(F.col("source_domain") != Q.SITE)
    return A.raw_ranked_check(kept, m, ["source_domain", F.coalesce("source_record_id", "raw_artwork_id")], [F.desc_nulls_last("crawl_timestamp"), F.desc("raw_artwork_id")], "raw_artwork_id")


# ---- artists and sources


ARTISTS = f"""{MART}, ad AS (SELECT {slug('artist_name')} AS artist_key, min(artist_name) AS artist_name, count(DISTINCT source_domain) AS source_count, count(*) AS artwork_count FROM mart WHERE artist_name IS NOT NULL GROUP BY 1),
ho AS (SELECT {slug('artist_name')} AS artist_key, count(*) FILTER (is_hidden) AS hidden_in, max(canonical_artist_name) AS canonical_artist_name FROM a_artist_overrides GROUP BY 1)"""


@query(f"WITH {ARTISTS} SELECT ad.*, coalesce(hidden_in, 0) AS hidden_in, canonical_artist_name FROM ad LEFT JOIN ho USING (artist_key)")
def artist_records(t):
    return R.artist_records(M.artist_dedupe(Q.mart(t)), t["a_artist_overrides"]).select("artist_key", "artist_name", "source_count", "artwork_count", "hidden_in", "canonical_artist_name")


SOURCES = f"""{DUP}, {SRC}, sr AS (SELECT source_id, max(finished_at) FILTER (run_status = 'success') AS last_successful_crawl_at, count(*) AS runs FROM a_runs GROUP BY 1), se AS (SELECT source_id, count(*) AS errors FROM a_errors GROUP BY 1),
sa AS (SELECT source_domain, count(*) AS records, round(count(*) FILTER (artist_name IS NULL OR artwork_title IS NULL) / count(*), 4) AS missing_required_field_rate, round(count(*) FILTER (c > 1) / count(*), 4) AS duplicate_rate, round(avg(quality_score), 2) AS avg_quality_score FROM dup GROUP BY 1),
ms AS (SELECT source_id, src.source_domain, source_type, last_successful_crawl_at, coalesce(runs, 0) AS total_crawl_runs, coalesce(errors, 0) AS total_errors, coalesce(records, 0) AS total_records, missing_required_field_rate, duplicate_rate, avg_quality_score
 FROM src LEFT JOIN sr USING (source_id) LEFT JOIN se USING (source_id) LEFT JOIN sa USING (source_domain))"""
_MS = "source_id source_domain source_type last_successful_crawl_at total_crawl_runs total_errors total_records missing_required_field_rate duplicate_rate avg_quality_score".split()


def sources(t):
    return R.source_summary(R.stg_sources(t["a_sources"]), R.stg_crawl_runs(t["a_runs"]), R.stg_crawl_errors(t["a_errors"]), M.duplicate_groups(Q.mart(t)))


@query(f"WITH {SOURCES} SELECT * FROM ms")
def mart_sources(t):
    return sources(t).select(*_MS)


@query(f"WITH {SOURCES} SELECT source_id, total_records, round(total_errors / nullif(total_records + total_errors, 0), 4) AS error_rate, CASE WHEN last_successful_crawl_at IS NULL THEN 'never' WHEN date '{AS_OF}' - cast(last_successful_crawl_at AS date) > 30 THEN 'error' WHEN date '{AS_OF}' - cast(last_successful_crawl_at AS date) > 7 THEN 'warn' ELSE 'fresh' END AS freshness FROM ms")
def source_records(t):
    return R.source_records(sources(t), as_of=AS_OF).select("source_id", "total_records", "error_rate", "freshness")


@query(f"""WITH {DUP}, {SRC}, r AS (SELECT source_id, cast(started_at AS date) AS crawl_date, sum(records_inserted)::bigint AS records_inserted, sum(records_failed)::bigint AS records_failed FROM a_runs GROUP BY 1, 2),
e AS (SELECT source_id, cast(created_at AS date) AS crawl_date, count(*) AS error_count FROM a_errors GROUP BY 1, 2), re AS (SELECT * FROM r FULL JOIN e USING (source_id, crawl_date)),
red AS (SELECT src.source_domain, re.* FROM re JOIN src USING (source_id)),
q AS (SELECT source_domain, cast(crawl_timestamp AS date) AS crawl_date, count(*) AS records_found, count(*) FILTER (artist_name IS NULL) AS missing_artist_count, count(*) FILTER (c > 1) AS duplicate_candidate_count, avg(quality_score) AS avg_quality_score FROM dup GROUP BY 1, 2)
SELECT source_domain, crawl_date, coalesce(records_inserted, 0) AS records_inserted, coalesce(records_failed, 0) AS records_failed, coalesce(error_count, 0) AS error_count, coalesce(records_found, 0) AS records_found, coalesce(missing_artist_count, 0) AS missing_artist_count,
 coalesce(duplicate_candidate_count, 0) AS duplicate_candidate_count, avg_quality_score FROM red FULL JOIN q USING (source_domain, crawl_date)""")
def crawl_quality_full(t):
    out = R.crawl_quality_full(R.stg_sources(t["a_sources"]), t["a_runs"], t["a_errors"], M.duplicate_groups(Q.mart(t)))
    return out.select("source_domain", "crawl_date", "records_inserted", "records_failed", "error_count", "records_found", "missing_artist_count", "duplicate_candidate_count", "avg_quality_score")


# ---- galleries


UNION = f"""{INFERRED}, gu AS (SELECT {uuid('normalized_gallery_key')} AS gallery_id, gallery_name, address AS gallery_address, city, country, source_domain, source_url, 'scraped' AS gallery_record_type, phone, email, website_url, instagram_url, facebook_url, crawl_timestamp FROM gl
 UNION ALL SELECT gallery_id, gallery_name, gallery_address, city, country, source_domain, source_url, 'inferred_from_event', NULL, NULL, NULL, NULL, NULL, crawl_timestamp FROM inf),
gev AS (SELECT DISTINCT {uuid('normalized_gallery_key')} AS gallery_id, event_id FROM gl JOIN ek USING (n_gallery_name, n_city, n_country, source_domain) UNION SELECT DISTINCT {uuid('lower(cleaned) || chr(124) || n_city || chr(124) || n_country || chr(124) || source_domain')}, event_id FROM iu),
gr AS (SELECT gu.*, coalesce(o.is_hidden, false) AS is_hidden, coalesce(o.is_approved, false) AS is_approved, o.canonical_gallery_name, o.canonical_gallery_type, o.gallery_id IS NOT NULL AS moderation_override_exists, coalesce(n, 0) AS n_events FROM gu
 LEFT JOIN (SELECT gallery_id, count(*) AS n FROM gev GROUP BY 1) e USING (gallery_id) LEFT JOIN a_gallery_overrides o USING (gallery_id))"""
_N = lambda c: f"coalesce(trim({c}), '') = ''"
ENRICHED = f"""{UNION}, ge AS (SELECT *, {_N('gallery_address')} AS missing_address, {_N('city')} AS missing_city, {_N('country')} AS missing_country, {_N('website_url')} AND {_N('source_url')} AS missing_website, {_N('phone')} AS missing_phone, {_N('email')} AS missing_email,
 {_N('instagram_url')} AND {_N('facebook_url')} AS missing_social, n_events = 0 AS missing_linked_events FROM gr),
gq AS (SELECT *, (NOT {_N('gallery_name')})::int + (NOT missing_address)::int + (NOT missing_city)::int + (NOT missing_country)::int + (NOT missing_website)::int + (NOT missing_phone)::int + (NOT missing_email)::int + (NOT missing_social)::int + (NOT missing_linked_events)::int AS quality_score FROM ge)"""


def kept_galleries(t):
    return t.once("kept_galleries", lambda: M.latest_galleries(Q.gal(t)).withColumn("gallery_id", X.md5_uuid(F.col("normalized_gallery_key"))))


def union(t):
    return t.once("union", lambda: R.galleries_union(kept_galleries(t), Q.inferred(t)))


def gallery_links(t):
    kept, events = kept_galleries(t), Q.venue_ev(t)
    ids = kept.select("raw_gallery_id", "gallery_id")
    scraped = M.gallery_event_links(kept, events).join(ids, "raw_gallery_id").select("gallery_id", "event_id")
    named = M.inferred_events(events, kept, site=Q.SITE, label=Q.LABEL).select(X.md5_uuid(F.concat_ws("|", *M.INFERRED)).alias("gallery_id"), "event_id")
    return scraped.unionByName(named).distinct()


def gallery_works(t):
    ids = kept_galleries(t).select("raw_gallery_id", "gallery_id")
    return M.gallery_artwork_links(kept_galleries(t), Q.stg(t)).join(ids, "raw_gallery_id").select("gallery_id", "raw_artwork_id")


def galleries(t):
    return R.gallery_enrichment(R.gallery_records(union(t), gallery_links(t), t["a_gallery_overrides"]))


@query(f"WITH {UNION} SELECT gallery_record_type, source_domain, count(*) AS n, count(phone) AS phones FROM gu GROUP BY 1, 2", staged=True)
def galleries_union(t):
    return union(t).groupBy("gallery_record_type", "source_domain").agg(F.count("*").alias("n"), F.count("phone").alias("phones"))


_SAID = ", ".join(f"o.{c}" for c in (*R.CANONICAL[2:], "moderation_reason", "moderator_notes", "updated_at"))


@query(f"""WITH {UNION}, pl AS (SELECT {uuid('gl.normalized_gallery_key')} AS gallery_id, raw_payload, raw_gallery_id, n_gallery_name, gl.source_domain FROM gl JOIN a_galleries g ON g.id = gl.raw_gallery_id),
le AS (SELECT gallery_id, string_agg(event_id, ',' ORDER BY event_id) AS linked_events FROM (SELECT *, row_number() OVER (PARTITION BY gallery_id ORDER BY event_id) AS n FROM gev) WHERE n <= 1000 GROUP BY 1),
la AS (SELECT gallery_id, count(DISTINCT a.id) AS n_artworks FROM pl JOIN a_artworks a ON {key('a.gallery_name')} = n_gallery_name AND a.source_domain = pl.source_domain GROUP BY 1)
SELECT gr.gallery_id, gallery_name, gallery_record_type, gr.is_hidden, gr.is_approved, gr.canonical_gallery_name, gr.canonical_gallery_type, {_SAID}, n_events, coalesce(linked_events, '') AS linked_events, coalesce(n_artworks, 0) AS n_artworks,
 CASE WHEN raw_payload LIKE '%"name"%' THEN raw_payload->>'$.represented_artists[0].name' || '@,Jo Bee@https://x.example/jo' ELSE '' END AS linked_artists, raw_payload, {key('gallery_name')} AS normalized_gallery_name
FROM gr LEFT JOIN pl ON pl.gallery_id = gr.gallery_id AND gallery_record_type = 'scraped' LEFT JOIN le ON le.gallery_id = gr.gallery_id LEFT JOIN la ON la.gallery_id = gr.gallery_id LEFT JOIN a_gallery_overrides o ON o.gallery_id = gr.gallery_id""", staged=True)
def gallery_records(t):
    g = R.gallery_records(union(t), gallery_links(t), t["a_gallery_overrides"], gallery_works(t))
    people = F.array_join(F.transform("linked_artists", lambda a: F.concat_ws("@", a["name"], F.coalesce(a["profile_url"], F.lit("")))), ",")
    return g.select("gallery_id", "gallery_name", "gallery_record_type", "is_hidden", "is_approved", *R.CANONICAL, "moderation_reason", "moderator_notes", "updated_at", "n_events", F.array_join("linked_events", ",").alias("linked_events"), "n_artworks", people.alias("linked_artists"), "raw_payload", "normalized_gallery_name")


@query(f"WITH {ENRICHED} SELECT gallery_id, quality_score, array_to_string(list_filter([{', '.join(f'''CASE WHEN {c} THEN '{c}' END''' for c in R.MISSING)}], lambda x: x IS NOT NULL), ',') AS flags FROM gq", staged=True)
def gallery_enrichment(t):
    return galleries(t).select("gallery_id", "quality_score", F.array_join("quality_flags", ",").alias("flags"))


@query(f"WITH {ENRICHED} SELECT gallery_id, quality_score FROM gq WHERE NOT is_approved AND NOT is_hidden AND missing_email AND gallery_name ILIKE '%customer%'", staged=True)
def admin_galleries_queue(t):
    return R.admin_galleries(galleries(t), queue="needs_review", missing=["email"], search="customer").select("gallery_id", "quality_score")


@query(f"WITH {ENRICHED} SELECT count(*) AS total, count(*) FILTER (is_approved) AS approved, count(*) FILTER (is_hidden) AS hidden, count(*) FILTER (NOT is_approved AND NOT is_hidden) AS unmoderated, {', '.join(f'count(*) FILTER ({c}) AS {c}' for c in R.MISSING if c not in ('missing_website', 'missing_linked_events'))}, count(*) FILTER (quality_score <= 3) AS low_quality, count(*) FILTER (crawl_timestamp >= timestamp '2024-02-03' - INTERVAL 7 DAY) AS recently_crawled FROM gq", staged=True)
def gallery_metrics(t):
    recent = F.col("crawl_timestamp") >= F.lit("2024-02-03").cast("timestamp") - F.expr("INTERVAL '7' DAY")
    flags = {"approved": F.col("is_approved"), "hidden": F.col("is_hidden"), "unmoderated": ~F.col("is_approved") & ~F.col("is_hidden"), **{c: F.col(c) for c in R.MISSING if c not in ("missing_website", "missing_linked_events")}, "low_quality": F.col("quality_score") <= 3, "recently_crawled": recent}
    return galleries(t).agg(F.count("*").alias("total"), *O.count_flags(flags))


@query(f"WITH {EQ} SELECT count(*) AS total, count(*) FILTER (is_approved) AS approved, count(*) FILTER (is_hidden) AS hidden, count(*) FILTER (NOT is_approved AND NOT is_hidden) AS unmoderated, count(*) FILTER (missing_date) AS missing_date, count(*) FILTER (missing_venue) AS missing_venue, count(*) FILTER (quality_score <= 2) AS low_quality, count(*) FILTER (crawl_timestamp >= timestamp '{AS_OF}' - INTERVAL 7 DAY) AS recently_crawled FROM es")
def event_metrics(t):
    recent = F.col("crawl_timestamp") >= F.lit(AS_OF).cast("timestamp") - F.expr("INTERVAL '7' DAY")
    flags = {"approved": F.col("is_approved"), "hidden": F.col("is_hidden"), "unmoderated": ~F.col("is_approved") & ~F.col("is_hidden"), "missing_date": F.col("missing_date"), "missing_venue": F.col("missing_venue"), "low_quality": F.col("quality_score") <= 2, "recently_crawled": recent}
    return D.event_quality(Q.er(t)).agg(F.count("*").alias("total"), *O.count_flags(flags))


@query("SELECT s_suppkey, array_to_string(list_sort(list(DISTINCT c_name || '@' || coalesce(nullif(cast(c_nationkey AS varchar), '7'), ''))), ',') AS artists FROM supplier JOIN customer ON c_custkey % (SELECT count(*) FROM supplier) = s_suppkey GROUP BY 1")
def linked_artists_from_payload(t):
    """Payloads made of the customers of a supplier, each twice, some without a profile."""
    url = F.when(F.col("c_nationkey") != 7, F.col("c_nationkey").cast("string"))
    n = F.broadcast(t["supplier"].agg(F.count("*").alias("_all")))  # one row
    people = t["supplier"].join(t["customer"].join(n), F.col("c_custkey") % F.col("_all") == F.col("s_suppkey")).select("s_suppkey", F.struct(F.col("c_name").alias("name"), url.alias("profile_url")).alias("p"))
    made = people.unionByName(people).groupBy("s_suppkey").agg(F.to_json(F.struct(F.collect_list("p").alias("represented_artists"))).alias("payload"))
    out = R.linked_artists_from_payload(made, "payload", "$.represented_artists")
    return out.select("s_suppkey", F.array_join(F.array_sort(F.transform("linked_artists", lambda a: F.concat_ws("@", a["name"], F.coalesce(a["profile_url"], F.lit(""))))), ",").alias("artists"))


# ---- decisions


_TEXTS = R.GALLERY_DECISIONS[2:]
_AFTER = ", ".join([f"coalesce(l.{c}, o.{c}) AS {c}" for c in R.GALLERY_DECISIONS[:2]] + [f"CASE WHEN l.{c} IS NOT NULL THEN nullif(l.{c}, '') ELSE o.{c} END AS {c}" for c in _TEXTS])


@query(f"""WITH {UNION}, d AS (SELECT * FROM a_gallery_decisions WHERE gallery_id IN (SELECT gallery_id FROM gu)), l AS (SELECT gallery_id, {', '.join(f'arg_max({c}, struct_pack(a := decided_at, b := id)) FILTER ({c} IS NOT NULL) AS {c}' for c in R.GALLERY_DECISIONS)} FROM d GROUP BY 1)
SELECT coalesce(o.gallery_id, l.gallery_id) AS gallery_id, {_AFTER} FROM a_gallery_overrides o FULL JOIN l ON o.gallery_id = l.gallery_id""", staged=True)
def apply_gallery_decisions(t):
    after, _ = D.apply_decisions(t["a_gallery_overrides"], t["a_gallery_decisions"], union(t), key="gallery_id", fields=R.GALLERY_DECISIONS, order=[F.col("decided_at"), F.col("id")])
    return after


@query(f"WITH {UNION} SELECT id, gallery_id FROM a_gallery_decisions WHERE gallery_id NOT IN (SELECT gallery_id FROM gu)")
def failed_gallery_decisions(t):
    return D.apply_decisions(t["a_gallery_overrides"], t["a_gallery_decisions"], union(t), key="gallery_id", fields=["is_hidden"], order=[F.col("decided_at"), F.col("id")])[1].select("id", "gallery_id")


@query(f"""WITH {MART}, n AS (SELECT artist_name, source_domain FROM (SELECT artist_name, source_domain, row_number() OVER (PARTITION BY artist_name ORDER BY max(crawl_timestamp) DESC NULLS LAST, source_domain) AS k FROM mart WHERE artist_name IS NOT NULL GROUP BY 1, 2) WHERE k = 1),
d AS (SELECT n.artist_name, n.source_domain, is_hidden, nullif(trim(canonical_artist_name), '') AS canonical_artist_name, reason, row_number() OVER (PARTITION BY n.artist_name, n.source_domain ORDER BY decided_at DESC, id DESC) AS k FROM a_artist_decisions a JOIN n ON n.artist_name = a.artist_name)
SELECT artist_name, source_domain, is_hidden, canonical_artist_name, reason FROM d WHERE k = 1 UNION ALL SELECT artist_name, source_domain, is_hidden, canonical_artist_name, reason FROM a_artist_overrides o WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.artist_name = o.artist_name AND d.source_domain = o.source_domain)""")
def apply_artist_decisions(t):
    seen = Q.mart(t).where("artist_name is not null").groupBy("artist_name", "source_domain").agg(F.max("crawl_timestamp").alias("last_seen"))
    return D.apply_artist_decisions(t["a_artist_overrides"], t["a_artist_decisions"], seen, [F.desc("decided_at"), F.desc("id")])[0]


REVIEWS = f"""{MART}, d AS (SELECT * FROM a_review_decisions WHERE artwork_id IN (SELECT artwork_id FROM mart)), dl AS (SELECT artwork_id, arg_max(action, struct_pack(a := decided_at, b := id)) AS action FROM d GROUP BY 1)"""


def reviews(t):
    return D.apply_artwork_reviews(t["a_reviews"], t["a_approvals"], t["a_rejections"], t["a_review_decisions"], Q.mart(t), [F.desc("decided_at"), F.desc("id")])


@query(f"""WITH {REVIEWS} SELECT 'review' AS kind, id, artwork_id, review_status AS value FROM a_reviews UNION ALL SELECT 'review', id, artwork_id, CASE action WHEN 'approve' THEN 'approved' ELSE 'rejected' END FROM d
UNION ALL SELECT 'approval', id, artwork_id, public_visibility::varchar FROM a_approvals WHERE artwork_id NOT IN (SELECT artwork_id FROM dl WHERE action = 'reject') UNION ALL SELECT 'approval', id, artwork_id, public_visibility::varchar FROM d WHERE action = 'approve' AND artwork_id NOT IN (SELECT artwork_id FROM dl WHERE action = 'reject')
UNION ALL SELECT 'rejection', id, artwork_id, rejection_reason FROM a_rejections WHERE artwork_id NOT IN (SELECT artwork_id FROM dl WHERE action = 'approve') UNION ALL SELECT 'rejection', id, artwork_id, coalesce(rejection_reason, 'Rejected by reviewer') FROM d WHERE action = 'reject' AND artwork_id NOT IN (SELECT artwork_id FROM dl WHERE action = 'approve')""")
def apply_artwork_reviews(t):
    r, a, x = reviews(t)
    one = lambda df, kind, value: df.select(F.lit(kind).alias("kind"), "id", "artwork_id", F.col(value).cast("string").alias("value"))
    return one(r, "review", "review_status").unionByName(one(a, "approval", "public_visibility")).unionByName(one(x, "rejection", "rejection_reason"))


EDITS = f"{MART}, prof AS (SELECT DISTINCT artist_name, source_domain FROM mart WHERE artist_name IS NOT NULL)"


@query(f"WITH {EDITS} SELECT id, artist_name, source_domain, md5(trim(edited_bio)) AS bio FROM a_bio_edits b WHERE trim(edited_bio) <> '' AND EXISTS (SELECT 1 FROM prof WHERE prof.artist_name = b.artist_name AND prof.source_domain = b.source_domain)")
def append_bio_edits(t):
    edits = t["a_bio_edits"]
    return D.append_bio_edits(edits.limit(0), edits, Q.mart(t)).select("id", "artist_name", "source_domain", F.md5("edited_bio").alias("bio"))


@query("SELECT id, artist_name, source_domain FROM (SELECT *, row_number() OVER (PARTITION BY artist_name, source_domain ORDER BY created_at DESC, id DESC) AS n FROM a_bio_edits) WHERE n = 1")
def latest_bio_edit(t):
    return O.latest_per_key(t["a_bio_edits"], ["artist_name", "source_domain"], [F.desc("created_at"), F.desc("id")]).select("id", "artist_name", "source_domain")


@query(f"""WITH {FULL}, {Q.bio_sql('bio', """SELECT artist_name, source_domain, artwork_count, last_seen, best.u AS profile_url, best.d AS raw_bio FROM (SELECT artist_name, source_domain, count(*) AS artwork_count, max(crawl_timestamp) AS last_seen,
 arg_max(struct_pack(u := source_url, d := description), struct_pack(a := source_url IS NOT NULL AND description IS NOT NULL, b := coalesce(crawl_timestamp, timestamp '1900-01-01'), c := raw_artwork_id)) AS best FROM full_ WHERE artist_name IS NOT NULL GROUP BY 1, 2)""")},
be AS (SELECT artist_name, source_domain, edited_bio FROM a_bio_edits QUALIFY row_number() OVER (PARTITION BY artist_name, source_domain ORDER BY created_at DESC, id DESC) = 1)
SELECT b.artist_name, b.source_domain, artwork_count, last_seen, profile_url, coalesce(e.edited_bio, cleaned, raw_bio) AS artist_bio, raw_bio AS original_artist_bio, cleaned AS cleaned_artist_bio, score AS bio_quality_score, flags AS bio_quality_flags, e.edited_bio,
 coalesce(o.is_hidden, false) AS is_hidden, o.canonical_artist_name, o.reason AS moderation_reason
FROM bio b LEFT JOIN be e ON e.artist_name = b.artist_name AND e.source_domain = b.source_domain LEFT JOIN a_artist_overrides o ON o.artist_name = b.artist_name AND o.source_domain = b.source_domain""")
def artist_profiles(t):
    """Over the records with all overlays: roll-up, best row, edits, the biography cleaned and scored, and what reviewers say of the artist."""
    p = M.artist_profiles(full(t), t["a_bio_edits"], t["a_artist_overrides"])
    return p.select(
        "artist_name", "source_domain", "artwork_count", "last_seen", "profile_url", "artist_bio", "original_artist_bio", "cleaned_artist_bio", "bio_quality_score", F.array_join("bio_quality_flags", ",").alias("bio_quality_flags"), "edited_bio",
        "is_hidden", "canonical_artist_name", "moderation_reason",
    )


@query(f"""WITH {FULL}, be AS (SELECT artist_name, source_domain, edited_bio FROM (SELECT *, row_number() OVER (PARTITION BY artist_name, source_domain ORDER BY created_at DESC, id DESC) AS n FROM a_bio_edits) WHERE n = 1)
SELECT f.artist_name, f.source_domain, any_value(be.edited_bio) IS NOT NULL AS edited, md5(any_value(be.edited_bio)) AS bio FROM full_ f LEFT JOIN be ON be.artist_name = f.artist_name AND be.source_domain = f.source_domain WHERE f.artist_name IS NOT NULL GROUP BY 1, 2""")
def artist_profiles_edited(t):
    p = M.artist_profiles(full(t), t["a_bio_edits"])
    return p.select("artist_name", "source_domain", F.col("edited_bio").isNotNull().alias("edited"), F.md5(F.when(F.col("edited_bio").isNotNull(), F.col("artist_bio"))).alias("bio"))


_BIO = "coalesce(e.edited_bio, bio.cleaned, bio.raw_bio)"


@query(f"""WITH {FULL}, {EVENTS}, {Q.bio_sql('bio', Q.best_bios('full_'))}, be AS (SELECT artist_name, source_domain, edited_bio FROM a_bio_edits QUALIFY row_number() OVER (PARTITION BY artist_name, source_domain ORDER BY created_at DESC, id DESC) = 1),
p AS (SELECT bio.artist_name, e.edited_bio, score, {_BIO} AS artist_bio FROM bio LEFT JOIN be e ON e.artist_name = bio.artist_name AND e.source_domain = bio.source_domain)
SELECT (SELECT count(*) FROM full_ WHERE review_status = 'pending') AS artworks_pending_review, (SELECT count(*) FROM full_ WHERE coalesce(trim(image_url), '') = '') AS broken_or_missing_images, count(*) FILTER (coalesce(trim(artist_bio), '') = '') AS artists_missing_bio,
 count(*) FILTER (trim(artist_bio) <> '' AND length(trim(artist_bio)) < 120) AS artists_short_bio, count(*) FILTER (coalesce(score, 100) < 60) AS artists_poor_bio, count(*) FILTER (regexp_matches(artist_name, '(?i)selected works|latest work|artworks|paintings|prints|about the artist')) AS artists_suspect_name,
 count(edited_bio) AS artists_with_manual_bio, count(*) FILTER (artist_name NOT IN (SELECT artist_name FROM links)) AS artists_without_events FROM p""", staged=True)
def queue_summary(t):
    rollup = written(M.artist_rollup(full_once(t), **{n: D.QUEUES[n]() for n in D.OF_WORKS}), "rollup")
    return D.queue_summary(rollup, M.rolled_profiles(rollup, t["a_bio_edits"]), Q.links(t))


FLAGGED = "fa AS (SELECT s_name || ' Studio' AS artist_name, CASE WHEN l_linestatus = 'O' THEN 'artists_with_manual_bio' ELSE 'artists_missing_bio' END AS issue_type, CASE WHEN s_acctbal < 4000 THEN 'resolved' WHEN l_returnflag = 'R' THEN 'open' ELSE 'closed' END AS status FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"


def flags(t):
    rows = t["lineitem"].join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
    issue = F.when(F.col("l_linestatus") == "O", "artists_with_manual_bio").otherwise("artists_missing_bio")
    status = F.when(F.col("s_acctbal") < 4000, "resolved").when(F.col("l_returnflag") == "R", "open").otherwise("closed")
    return rows.select(F.concat("s_name", F.lit(" Studio")).alias("artist_name"), issue.alias("issue_type"), status.alias("status"))


_QUEUE = """WITH {FULL}, {FLAGGED}, p AS (SELECT DISTINCT artist_name, source_domain FROM full_ WHERE artist_name IS NOT NULL), q AS (SELECT p.* FROM p JOIN (SELECT DISTINCT artist_name, source_domain FROM a_bio_edits) USING (artist_name, source_domain))
SELECT artist_name, source_domain, (SELECT count(*) FROM fa WHERE fa.artist_name = q.artist_name AND issue_type = 'artists_with_manual_bio' AND status = 'open') AS open_flags_count FROM q WHERE {not_} EXISTS (SELECT 1 FROM fa WHERE fa.artist_name = q.artist_name AND issue_type = 'artists_with_manual_bio' AND status = 'resolved')"""


def _manual(t, status):
    return D.moderation_queue(M.artist_profiles(full(t), t["a_bio_edits"]), "artists_with_manual_bio", status=status, flags=flags(t)).select("artist_name", "source_domain", "open_flags_count")


@query(_QUEUE.format(FULL=FULL, FLAGGED=FLAGGED, not_="NOT"))
def queue_manual_bio_open(t):
    return _manual(t, "open")


@query(_QUEUE.format(FULL=FULL, FLAGGED=FLAGGED, not_=""))
def queue_manual_bio_resolved(t):
    return _manual(t, "resolved")


@query("""WITH f AS (SELECT id, event_id, 'canonical_event_title' AS field_name, canonical_event_title AS v, decided_at FROM a_decisions WHERE canonical_event_title IS NOT NULL UNION ALL SELECT id, event_id, 'is_hidden', cast(is_hidden AS varchar), decided_at FROM a_decisions WHERE is_hidden IS NOT NULL),
g AS (SELECT *, lag(v) OVER (PARTITION BY event_id, field_name ORDER BY decided_at, id) AS o FROM f) SELECT id, event_id, field_name, o AS original_value, v AS final_value FROM g WHERE nullif(o, '') IS DISTINCT FROM nullif(v, '')""")
def corrections(t):
    return D.corrections(t["a_decisions"], key="event_id", fields=["canonical_event_title", "is_hidden"], order=[F.col("decided_at"), F.col("id")]).select("id", "event_id", "field_name", "original_value", "final_value")


# ---- bundles, activity, series


@query(f"""WITH {EVENTS}, {Q.EK}, {GAL}, n AS (SELECT event_id, artist_name, row_number() OVER (PARTITION BY event_id ORDER BY artist_name, artist_id) AS k FROM links), a AS (SELECT event_id, string_agg(artist_name, ',' ORDER BY k) AS artists FROM n GROUP BY 1),
g AS (SELECT e.event_id, arg_max(gl.gallery_name, struct_pack(a := gl.crawl_timestamp, b := gl.raw_gallery_id)) AS gallery_name FROM ek e JOIN gl USING (n_gallery_name, n_city, n_country, source_domain) GROUP BY 1)
SELECT mev.event_id, event_title, coalesce(artists, '') AS artists, gallery_name FROM mev LEFT JOIN a USING (event_id) LEFT JOIN g USING (event_id)""", staged=True)
def event_bundle(t):
    events, kept = Q.ev(t), M.latest_galleries(Q.gal(t))
    parts = {"artists": Q.links(t).select("event_id", F.struct("artist_name", "artist_id").alias("turn"), F.col("artist_name").alias("item"))}
    venue = M.gallery_event_links(kept, events).join(kept.select("raw_gallery_id", "gallery_name", "crawl_timestamp"), "raw_gallery_id")
    venue = venue.groupBy("event_id").agg(F.max_by("gallery_name", F.struct("crawl_timestamp", "raw_gallery_id")).alias("gallery_name"))
    out = S.whole_bundle(events.select("event_id", "event_title"), "event_id", parts).join(venue, "event_id", "left")
    return out.select("event_id", "event_title", F.array_join("artists", ",").alias("artists"), "gallery_name")


@query(f"""WITH {FULL}, p AS (SELECT DISTINCT artist_name, source_domain FROM full_ WHERE artist_name IS NOT NULL), n AS (SELECT artist_name, source_domain, raw_artwork_id, row_number() OVER (PARTITION BY artist_name, source_domain ORDER BY crawl_timestamp DESC NULLS LAST, raw_artwork_id) AS k FROM full_ WHERE artist_name IS NOT NULL)
SELECT p.artist_name, p.source_domain, string_agg(raw_artwork_id, ',' ORDER BY k) FILTER (k <= 500) AS works, count(*) AS n_works FROM p JOIN n USING (artist_name, source_domain) GROUP BY 1, 2""", staged=True)
def artist_works_bundle(t):
    rows = full_once(t).where("artist_name is not null").select("artist_name", "source_domain", F.col("crawl_timestamp").alias("turn"), F.col("raw_artwork_id").alias("item"))
    works = written(rows, "works")
    people = works.select("artist_name", "source_domain").distinct()
    return S.bundle(people, ["artist_name", "source_domain"], {"works": works}, kept=True).select("artist_name", "source_domain", F.array_join("works", ",").alias("works"), "n_works")


ACTIVITY = f"{EVENTS}, act AS (SELECT l.event_id, l.artist_id, l.artist_name, mev.city, mev.start_date, mev.event_title FROM links l JOIN mev USING (event_id))"


def activity(t):
    return M.artist_event_links(Q.links(t), Q.mart_ev(t))


@query(f"WITH {ACTIVITY} SELECT artist_name AS key, count(*) AS n FROM act GROUP BY 1 ORDER BY n DESC, key LIMIT 25")
def most_active_artists(t):
    return O.top_k(activity(t), F.col("artist_name"), 25)


@query(f"WITH {EVENTS} SELECT coalesce(city, 'unknown') AS key, count(*) AS n FROM mev GROUP BY 1")
def events_by_city(t):
    return Q.mart_ev(t).groupBy(F.coalesce("city", F.lit("unknown")).alias("key")).agg(F.count("*").alias("n"))


@query(f"WITH {ACTIVITY} SELECT event_id, artist_id, artist_name, start_date FROM act ORDER BY start_date DESC NULLS LAST, event_id, artist_id LIMIT 200")
def activity_table(t):
    return O.paged(activity(t), [F.desc_nulls_last("start_date"), F.asc("event_id"), F.asc("artist_id")], limit=200).select("event_id", "artist_id", "artist_name", "start_date")


_MONTH = "date_trunc('month', crawl_timestamp)::date"


@query(f"WITH {DUP} SELECT {_MONTH} AS month, round(count(*) FILTER (artist_name IS NULL) / count(*), 4) AS missing_rate, round(count(*) FILTER (c > 1) / count(*), 4) AS duplicate_rate FROM dup GROUP BY 1")
def series_missing_and_duplicates(t):
    share = lambda c: F.round(F.try_divide(F.count_if(c), F.count("*")), 4)
    return M.duplicate_groups(Q.mart(t)).groupBy(F.date_trunc("month", "crawl_timestamp").cast("date").alias("month")).agg(share(F.col("artist_name").isNull()).alias("missing_rate"), share(F.col("is_duplicate_candidate")).alias("duplicate_rate"))


@query(f"WITH {MART} SELECT year_start, count(*) AS n FROM mart WHERE year_start IS NOT NULL GROUP BY 1")
def series_by_year(t):
    return Q.mart(t).where("year_start is not null").groupBy("year_start").agg(F.count("*").alias("n"))


@query(f"WITH {MART}, f AS (SELECT artist_name, min(crawl_timestamp) AS t FROM mart WHERE artist_name IS NOT NULL GROUP BY 1) SELECT date_trunc('month', t)::date AS month, count(*) AS new_artists FROM f GROUP BY 1")
def series_new_artists(t):
    first = Q.mart(t).where("artist_name is not null").groupBy("artist_name").agg(F.min("crawl_timestamp").alias("t"))
    return first.groupBy(F.date_trunc("month", "t").cast("date").alias("month")).agg(F.count("*").alias("new_artists"))


@query(f"WITH {DUP} SELECT k AS key, count(*) AS n FROM dup WHERE c > 1 GROUP BY 1 ORDER BY n DESC, key LIMIT 20")
def top_duplicate_groups(t):
    return O.top_k(M.duplicate_groups(Q.mart(t)).where("is_duplicate_candidate"), F.col("duplicate_group_key"), 20)


@query("SELECT (floor(cast(price_text[2:] AS double) / 10000) * 10000)::bigint AS bucket, count(*) AS n FROM a_artworks WHERE price_text LIKE '$%' GROUP BY 1")
def price_histogram(t):
    prices = t["a_artworks"].where("price_text like '$%'").select(P.price_parse(F.col("price_text"))["price_min"].cast("double").alias("p"))
    return O.histogram(prices, F.col("p"), 10000)


# ---- checks


@query(f"WITH {MART} SELECT raw_artwork_id FROM mart WHERE year_start > 1995 AND year_start IS NOT NULL")
def check_year_range(t):
    """Rows whose end lies before their start, in a table whose ends are cut to 1995."""
    cut = Q.mart(t).withColumn("year_end", F.least("year_end", F.lit(1995)))
    return A.breaking(cut, A.year_range()).select("raw_artwork_id")


@query(f"WITH {Q.SCORED} SELECT raw_artwork_id FROM scored WHERE NOT (source_url IS NOT NULL OR (source_domain = '{Q.SITE}' AND coalesce(source_record_id, image_url) IS NOT NULL AND coalesce(artwork_title, artist_name) IS NOT NULL))")
def check_source_linkage(t):
    return A.breaking(M.int_artworks(Q.stg(t)), M.source_linkage(Q.SITE)).select("raw_artwork_id")


@query(f"WITH {EVENTS}, twice AS (SELECT event_id, artist_id FROM links UNION ALL SELECT l.event_id, l.artist_id FROM links l JOIN a_events e ON e.id = l.event_id WHERE e.event_type = 'exhibition') SELECT 'duplicate_event_artist_links' AS failure, count(*) AS n FROM (SELECT event_id, artist_id FROM twice GROUP BY 1, 2 HAVING count(*) > 1) HAVING count(*) > 0", staged=True)
def check_artist_linking(t):
    """Failures of links that hold those of exhibitions twice."""
    links = Q.links(t)
    shows = Q.ev(t).where("event_type = 'exhibition'").select("event_id")
    return A.artist_linking_failures(links.unionByName(links.join(shows, "event_id", "left_semi")), Q.found(t), M.int_artists(t["a_artists"]))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_extendedprice - 20000 < 0")
def no_negative_prices(t):
    rows = t["lineitem"].select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") - 20000).alias("price_min"))
    return A.breaking(rows, A.no_negative("price_min")).select("l_orderkey", "l_linenumber")


@query("SELECT id FROM a_reviews WHERE review_status NOT IN ('approved', 'pending')")
def accepted_values(t):
    return A.breaking(t["a_reviews"], A.accepted_values("review_status", ["approved", "pending"])).select("id")


# ---- searches, filters and summaries over the views


_WORDS = "['steel', 'oil', 'supplier#000000003', 'studio']"
_HELD = lambda c, w: f"len(list_intersect(list_distinct(regexp_split_to_array(lower(coalesce({c}, '')), '[^a-z0-9#]+')), {_WORDS})) * {w}"


@query(f"WITH {MART}, s AS (SELECT raw_artwork_id, {' + '.join(_HELD(c, w) for c, w in S.FIELDS.items())} + CASE WHEN lower(artist_name) = 'oil steel studio supplier#000000003' THEN 10 ELSE 0 END AS score FROM mart) SELECT raw_artwork_id, score::int AS score FROM s WHERE score > 0")
def record_search(t):
    return S.record_search(Q.mart(t), "Oil steel Studio Supplier#000000003").select("raw_artwork_id", "score")


@query(f"WITH {MART} SELECT raw_artwork_id, 10::int AS score FROM mart WHERE artist_name = 'Supplier#000000003 Studio'")
def record_search_exact(t):
    """With all weights at nothing, only the exact names count."""
    return S.record_search(Q.mart(t), "supplier#000000003  STUDIO", weights={"source_name": 0}).select("raw_artwork_id", "score")


@query(f"WITH {EQ} SELECT event_id FROM es WHERE NOT is_approved AND NOT is_hidden AND missing_description = false AND city IN ('NATION_1') AND start_date BETWEEN date '1996-01-01' AND date '1999-12-31' AND len(linked_artists) > 0 AND event_type = 'exhibition' AND source_domain = 'nation_1.example'")
def admin_events_predicates(t):
    return D.admin_events(D.event_quality(Q.er(t)), queue="needs_review", as_of=AS_OF, city="NATION_1", domain="nation_1.example", kind="exhibition", start_from="1996-01-01", start_until="1999-12-31", linked=True).where("not missing_description").select("event_id")


@query(f"WITH {EQ} SELECT event_id FROM es WHERE moderation_override_exists AND missing_venue = false AND quality_score >= 0 AND missing_artists")
def admin_events_edited(t):
    return D.admin_events(D.event_quality(Q.er(t)), queue="edited", as_of=AS_OF, missing=["artists"], linked=False).where("not missing_venue").select("event_id")


@query(f"WITH {ENRICHED} SELECT source_domain, coalesce(canonical_gallery_type, gallery_record_type) AS kind, count(*) AS n, count(*) FILTER (is_approved) AS approved, count(*) FILTER (is_hidden) AS hidden, count(*) FILTER (missing_email) AS missing_email, round(avg(quality_score), 2) AS avg_score, max(crawl_timestamp) AS last_crawl FROM gq GROUP BY 1, 2", staged=True)
def gallery_quality_by_type(t):
    g = galleries(t).withColumn("kind", F.coalesce("canonical_gallery_type", "gallery_record_type"))
    return S.quality_summary(g, ["source_domain", "kind"], F.col("quality_score"), {"approved": F.col("is_approved"), "hidden": F.col("is_hidden"), "missing_email": F.col("missing_email")})


@query(f"WITH {EQ} SELECT source_domain, event_type, count(*) AS n, count(*) FILTER (is_approved) AS approved, count(*) FILTER (missing_date) AS missing_date, round(avg(try_cast(payload_score AS double)), 2) AS avg_score, max(crawl_timestamp) AS last_crawl FROM es GROUP BY 1, 2")
def event_quality_by_payload(t):
    """The mean is that of the payloads' own scores."""
    return S.quality_summary(D.event_quality(Q.er(t)), ["source_domain", "event_type"], F.col("payload_score").try_cast("double"), {"approved": F.col("is_approved"), "missing_date": F.col("missing_date")})


@query("SELECT id FROM (SELECT id, CASE WHEN action = 'open' THEN entity_type ELSE 'page' END AS e, issue_type FROM a_flags) WHERE e = 'artist' AND issue_type <> 'duplicate'")
def valid_flags(t):
    rows = t["a_flags"].withColumn("entity_type", F.when(F.col("action") == "open", F.col("entity_type")).otherwise("page")).withColumn("issue_type", F.when(F.col("issue_type") != "duplicate", F.col("issue_type")).otherwise("  "))
    return D.valid_flags(rows)[0].select("id")


@query(f"""WITH {Q.STG}, p AS (SELECT raw_artwork_id, list_transform(regexp_extract_all(price_text, '[0-9][0-9,]*(?:\\.[0-9]+)?'), lambda x: replace(x, ',', '')::double) AS v, price_text, dimensions_text FROM stg)
SELECT raw_artwork_id, v[1] AS price, CASE WHEN price_text LIKE '$%' THEN 'USD' WHEN price_text LIKE '€%' THEN 'EUR' WHEN price_text LIKE 'GBP%' THEN 'GBP' END AS currency, CASE WHEN dimensions_text LIKE '% in' THEN 26.67 ELSE try_cast(split_part(dimensions_text, ' x ', 1) AS double) END AS height FROM p""")
def join_parsed_attributes(t):
    p = M.parsed_attributes(Q.stg(t))
    return p.select("raw_artwork_id", F.col("price_numeric").cast("double").alias("price"), F.col("currency_code").alias("currency"), F.col("height_cm").cast("double").alias("height"))
