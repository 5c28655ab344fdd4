"""Profiles and venues from pages of two kinds, people that payloads name, domains of artists, records matched level by level, and the gate of cities."""

from __future__ import annotations

from pyspark.sql import functions as F

from atelier.functions import text as X
from atelier.operators import audit as A
from atelier.operators import extract as E
from atelier.operators import marts as M
from atelier.operators import sections as S
from atelier.operators import summaries as U
from atelier.plans import queries as Q
from atelier.plans.page_queries import DATES, HOST
from atelier.plans.queries import EV, STOP, person, query
from atelier.plans.record_queries import FULL, full_once
from atelier.sources.shared import written

SITE = "Guide"


def profiles(t):
    return E.page_elements(t["a_profile_pages"], tree=True, only=["title", "tree"])


def images(t):
    """Scoped images need no tree."""
    return S.scoped_artworks(E.page_elements(t["a_profile_pages"], only=["images"]))


def venues(t):
    return S.venue_event(E.page_elements(t["a_venue_pages"], tree=True, only=["title", "links", "images", "meta", "tree"]), country="Land")


@query("""SELECT id::bigint AS page_id, CASE WHEN k % 3 = 2 THEN '' ELSE 'Painter from ' || n_name || ' whose canvases of ' || y::varchar || ' layer memory and migration.' || CASE WHEN k % 3 = 1 THEN ' Born on the coast. Lives inland.' ELSE '' END END AS biography,
  CASE WHEN k % 3 = 2 THEN 0 ELSE 1 END AS candidates, k % 3 = 2 AS fallback_used FROM a_phrases""")
def artist_bio_sections(t):
    return S.biography(profiles(t))


@query("SELECT id::bigint AS page_id, c_name AS artist_name FROM a_phrases")
def artist_label_tests(t):
    return S.artist(profiles(t), site=SITE)


@query(f"""SELECT id::bigint AS page_id, CASE WHEN f = 5 THEN 'https://cdn.example/artist-' || id || '/far.jpg' ELSE {HOST} || CASE f WHEN 1 THEN '/artist-' || id || '/one.jpg' WHEN 2 THEN '/artist-' || id || '/studio.jpg' WHEN 3 THEN '/img/free.jpg' ELSE '/img/logo.png' END END AS image_url,
  CASE f WHEN 1 THEN 'One ' || id WHEN 2 THEN 'Studio' WHEN 3 THEN 'Free' WHEN 4 THEN 'Logo' ELSE 'Far' END AS artwork_title, CASE f WHEN 1 THEN 'kept' WHEN 2 THEN 'not_a_work' WHEN 3 THEN 'out_of_scope' WHEN 4 THEN 'chrome' ELSE 'other_host' END AS reason
FROM a_phrases, unnest([1, 2, 3, 4, 5]) AS u(f)""")
def image_filters(t):
    return images(t).select("page_id", "image_url", "artwork_title", "reason")


@query("SELECT 'artist-' || id AS slug, r AS reason, 1::bigint AS n FROM a_phrases, unnest(['kept', 'not_a_work', 'out_of_scope', 'chrome', 'other_host']) AS u(r)")
def extraction_stats_by_artist(t):
    return E.extraction_stats(images(t), F.col("reason"), by=["slug"])


@query(f"""SELECT id::bigint AS page_id, lower(n_name) || '.example:event:show-' || id AS source_record_id, CASE WHEN k % 3 = 2 THEN 'Show ' ELSE 'Night ' END || id AS event_title, 'Solo Show' AS event_type, CASE k % 3 WHEN 0 THEN 'Hall ' || id WHEN 1 THEN 'Room ' || id ELSE n_name || ' Hall' END AS venue_name,
  CASE k % 3 WHEN 0 THEN id || ' Way' WHEN 1 THEN id || ' Main Road' END AS venue_address, CASE WHEN k % 3 = 2 THEN 'Town ' || y::varchar ELSE n_name END AS city, 'Land' AS country, d.start_date, d.end_date,
  CASE WHEN k % 3 = 1 THEN 'https://room' || id || '.example/' END AS website_url, CASE WHEN k % 3 = 1 THEN 'https://instagram.com/room' || id END AS instagram_url, NULL::varchar AS facebook_url FROM a_phrases JOIN {DATES} d USING (id)""")
def event_page_venue_block(t):
    return venues(t).select("page_id", "source_record_id", "event_title", "event_type", "venue_name", "venue_address", "city", "country", "start_date", "end_date", "website_url", "instagram_url", "facebook_url")


@query("""WITH v AS (SELECT id::bigint AS page_id, lower(n_name) || '.example' AS source_domain, CASE k % 3 WHEN 0 THEN 'Hall ' || id WHEN 1 THEN 'Room ' || id ELSE n_name || ' Hall' END AS gallery_name, CASE k % 3 WHEN 0 THEN id || ' Way' WHEN 1 THEN id || ' Main Road' END AS address, CASE WHEN k % 3 = 2 THEN 'Town ' || y::varchar ELSE n_name END AS city,
  CASE WHEN k % 3 = 1 THEN 'https://room' || id || '.example/' END AS website_url, 'https://www.' || lower(n_name) || '.example/events/show-' || id AS page FROM a_phrases)
SELECT source_domain, source_domain || ':gallery:' || trim(lower(regexp_replace(gallery_name || '-' || city || '-Land', '[^a-zA-Z0-9]+', '-', 'g')), '-') AS source_record_id, coalesce(website_url, page) AS source_url, gallery_name, address, city FROM v QUALIFY row_number() OVER (PARTITION BY source_domain, gallery_name, city ORDER BY page_id) = 1""")
def event_page_venue_galleries(t):
    return S.venue_galleries(venues(t)).select("source_domain", "source_record_id", "source_url", "gallery_name", "address", "city")


@query(rf"""WITH {EV}, p AS (SELECT id AS event_id, unnest(CASE o % 9 WHEN 0 THEN [c || ' & Jo Bee, Tickets'] WHEN 1 THEN [c, 'Ann Lee'] WHEN 2 THEN [c, 'Sam Ray'] WHEN 3 THEN [c] WHEN 4 THEN [c] ELSE [] END) AS t FROM (SELECT o_orderkey::varchar AS id, o_orderkey AS o, c_name AS c FROM orders JOIN customer ON o_custkey = c_custkey)),
tok AS (SELECT event_id, trim(unnest(regexp_split_to_array(t, '\s*[,&]\s*'))) AS name FROM (SELECT event_id, unnest([coalesce(event_title, ''), coalesce(description, '')]) AS t FROM ev UNION ALL SELECT * FROM p))
SELECT DISTINCT event_id, name AS candidate_artist_name, {person('name')} AS normalized_candidate_artist_name FROM tok
WHERE length(name) > 3 AND regexp_matches(name, '[A-Za-z]') AND lower(name) NOT IN ({STOP}) AND NOT contains(lower(name), 'gallery') AND {person('name')} IS NOT NULL""")
def event_text_union(t):
    """Mentions in titles, descriptions and payloads of every shape."""
    events = Q.ev(t).join(t["a_event_payloads"].withColumnRenamed("id", "event_id"), "event_id")
    return M.mentions(events, payload="payload")


@query(f"""WITH {FULL}, c AS (SELECT artist_name, source_domain, max(crawl_timestamp) AS m FROM full_ GROUP BY 1, 2 UNION ALL SELECT original_artist_name, coalesce(source_domain, '{SITE}'), max(crawl_timestamp) FROM full_ GROUP BY 1, 2
  UNION ALL SELECT artist_name, coalesce(source_domain, '{SITE}'), max(crawl_timestamp) FROM a_artworks GROUP BY 1, 2) SELECT artist_name, source_domain, max(m) AS last_seen FROM c WHERE artist_name IS NOT NULL GROUP BY 1, 2""")
def candidate_union(t):
    names = ["artist_name", "original_artist_name", "source_domain"]
    works = written(full_once(t).groupBy(*names).agg(F.max("crawl_timestamp").alias("crawl_timestamp")), "works")  # all that is asked of the works
    profiles = works.where("artist_name is not null").groupBy("artist_name", "source_domain").agg(F.max("crawl_timestamp").alias("last_seen"))
    return U.domain_candidates(profiles, works, t["a_artworks"], site=SITE)


def _levels():
    both = lambda *cs: F.concat_ws("|", *cs)
    known = lambda c: ~X.blank(F.col(c))
    return [F.when(known("source_record_id"), both("source_domain", "source_record_id")), F.when(known("source_url") & known("artwork_title"), both("source_url", F.lower("artwork_title"))), F.when(known("artwork_title"), both("artwork_title", F.col("n_chars").cast("string")))]


_KEYS = "CASE WHEN coalesce(trim(source_record_id), '') <> '' THEN source_domain || '|' || source_record_id END AS k0, CASE WHEN coalesce(trim(artwork_title), '') <> '' THEN source_url || '|' || lower(artwork_title) END AS k1, CASE WHEN coalesce(trim(artwork_title), '') <> '' THEN artwork_title || '|' || n_chars END AS k2"
_PAIRS = lambda i, b, a: f"m{i} AS (SELECT b.doc_id AS b, a.doc_id AS a FROM (SELECT *, row_number() OVER (PARTITION BY k{i} ORDER BY doc_id) AS n FROM {b} WHERE k{i} IS NOT NULL) b JOIN (SELECT *, row_number() OVER (PARTITION BY k{i} ORDER BY doc_id) AS n FROM {a} WHERE k{i} IS NOT NULL) a ON b.k{i} = a.k{i} AND b.n = a.n)"
_LEFT = lambda i: f"b{i + 1} AS (SELECT * FROM b{i} WHERE doc_id NOT IN (SELECT b FROM m{i})), a{i + 1} AS (SELECT * FROM a{i} WHERE doc_id NOT IN (SELECT a FROM m{i}))"


@query(f"""WITH b0 AS (SELECT doc_id, {_KEYS} FROM a_before), a0 AS (SELECT doc_id, {_KEYS} FROM a_after), {", ".join(x for i in range(3) for x in (_PAIRS(i, f"b{i}", f"a{i}"), _LEFT(i)))}
SELECT b AS b_doc_id, a AS a_doc_id, 0 AS level FROM m0 UNION ALL SELECT b, a, 1 FROM m1 UNION ALL SELECT b, a, 2 FROM m2 UNION ALL SELECT doc_id, NULL, -1 FROM b3 UNION ALL SELECT NULL, doc_id, -1 FROM a3""")
def stable_record_match(t):
    """By record, then by URL and title, then by title and length: each level takes what the one before left."""
    return A.residual_match(t["a_before"], t["a_after"], _levels(), on="doc_id", order=["doc_id"]).withColumn("level", F.coalesce("level", F.lit(-1)))


@query("""WITH e AS (SELECT * FROM a_events WHERE source_domain = 'nation_3.example' AND lower(city) IN ('nation_3', 'nation_4')), g AS (SELECT count(*) FILTER (crawl_timestamp >= timestamp '2000-01-01') AS s, count(*) FILTER (crawl_timestamp >= timestamp '1998-12-02') AS r FROM a_galleries WHERE source_domain = 'nation_3.example' AND lower(city) IN ('nation_3', 'nation_4')),
n AS (SELECT count(*) FILTER (crawl_timestamp >= timestamp '2000-01-01') AS s, count(*) FILTER (crawl_timestamp >= timestamp '1998-12-02') AS r, count(DISTINCT CASE WHEN crawl_timestamp >= timestamp '1998-12-02' THEN lower(city) END) AS c FROM e)
SELECT CASE WHEN n.s > 0 THEN n.s ELSE n.r END AS records, c AS cities_with_records, CASE WHEN g.s > 0 THEN g.s ELSE g.r END AS galleries, n.r > 0 AND g.r > 0 AS passed, CASE WHEN n.s > 0 THEN 'run' ELSE 'recent' END AS reason FROM n, g""")
def ingest_gate_of_cities(t):
    """No event since the run began: those of the last month count."""
    return A.city_gate(t["a_events"], domain="nation_3.example", since="2000-01-01", as_of="1999-01-01", recent="30 DAY", cities=["NATION_3", "Nation_4"], galleries=t["a_galleries"])
