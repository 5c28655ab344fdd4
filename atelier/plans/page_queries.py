"""Extraction from pages that are made of the tables: what the pages were made from is what must come out."""

from __future__ import annotations

from pyspark.sql import functions as F

from atelier.functions import text as X
from atelier.operators import extract as E
from atelier.plans.queries import query
from atelier.plans.text_queries import CITIES

HOST = "'https://www.' || lower(n_name) || '.example'"
URL = f"{HOST} || '/exhibitions/show-' || id || '?utm_source=q'"
RECORD = "lower(n_name) || '.example:event:show-' || id"
DATES = r"(SELECT id, v[1] AS start_date, v[-1] AS end_date FROM (SELECT id, list_transform(regexp_extract_all(shown, '[0-9]{1,2} [A-Za-z]+ [0-9]{4}'), lambda x: coalesce(try_strptime(x, '%d %B %Y'), try_strptime(x, '%d %b %Y'))::date) AS v FROM a_phrases))"
CITY = "CASE " + " ".join(f"WHEN contains(lower(seo || ' ' || c_name || ' ' || byline || ' ' || {URL}), lower('{c}')) THEN '{c}'" for c in CITIES) + " END"
TITLE = "trim(regexp_replace(seo, '\\s+', ' ', 'g'))"


def elements(t):
    return E.page_elements(t["a_pages"])


def events(t):
    return E.event_page(elements(t), cities=CITIES)


@query(f"""SELECT id::bigint AS page_id, {RECORD} AS source_record_id, {TITLE} AS event_title, 'exhibition' AS event_type, c_name || ' Hall' AS venue_name, id || ' Main Road' AS venue_address, {CITY} AS city, d.start_date, d.end_date, {HOST} || '/img/' || id || '.jpg' AS image_url
FROM a_phrases JOIN {DATES} d USING (id)""")
def event_page_extract(t):
    return events(t).select("page_id", "source_record_id", "event_title", "event_type", "venue_name", "venue_address", "city", "start_date", "end_date", "image_url")


@query(f"SELECT {RECORD} AS source_record_id, unnest(['Anna Bee', 'Carl Dee']) AS artist_name, unnest(['anna bee', 'carl dee']) AS artist_name_normalized, unnest([{HOST} || '/artists/anna-bee/', NULL]) AS artist_profile_url FROM a_phrases")
def event_page_artists(t):
    return E.event_page_artists(events(t)).select("source_record_id", "artist_name", "artist_name_normalized", "artist_profile_url")


@query(f"SELECT {RECORD} AS source_record_id, {HOST} || '/img/' || id || '.jpg' AS image_url, 'primary' AS image_type, sha256({URL} || '|' || {HOST} || '/img/' || id || '.jpg|' || {TITLE}) AS content_hash FROM a_phrases")
def event_page_images(t):
    return E.event_page_images(events(t)).select("source_record_id", "image_url", "image_type", "content_hash")


@query(f"WITH g AS (SELECT lower(n_name) || '.example' AS source_domain, c_name || ' Hall' AS gallery_name, {CITY} AS city, id::bigint AS k, id || ' Main Road' AS address, lower('Hall' || id || '@x.example') AS email FROM a_phrases) SELECT source_domain, gallery_name, city, arg_min(address, k) AS address, arg_min(email, k) AS email FROM g GROUP BY 1, 2, 3")
def event_page_galleries(t):
    return E.event_page_galleries(events(t)).select("source_domain", "gallery_name", "city", "address", "email")


@query(f"SELECT id::bigint AS page_id, {URL} AS source_url, 'Work ' || id AS artwork_title, c_name AS artist_name, y::varchar AS artwork_date_text, {HOST} || '/img/red-sea-' || id || '.jpg' AS image_url, n_name AS city FROM a_phrases")
def json_ld_artwork(t):
    return E.json_ld_artworks(elements(t)).select("page_id", "source_url", "artwork_title", "artist_name", "artwork_date_text", "image_url", "city")


@query("SELECT n_name AS name, n_name AS city, count(*) AS n_artworks FROM a_phrases GROUP BY 1, 2")
def json_ld_flatten(t):
    return E.json_ld_collections(elements(t))


@query(f"SELECT id::bigint AS page_id, {HOST} || unnest(['/img/red-sea-' || id || '.jpg', '/img/' || id || '.png']) AS image_url, unnest(['Red Sea ' || id, 'Blue ' || id]) AS artwork_title FROM a_phrases")
def artworks_extract(t):
    return E.artworks(elements(t)).select("page_id", "image_url", "artwork_title")


@query(f"SELECT id::bigint AS page_id, d.start_date, d.end_date, 'Shown' AS title FROM a_phrases JOIN {DATES} d USING (id)")
def events_extract(t):
    """The blocks with dates that say what is shown; those about the opening are another kind."""
    return E.events(elements(t)).where("title = 'Shown'").select("page_id", "start_date", "end_date", "title")


@query(f"SELECT id::bigint AS page_id, CASE WHEN length({TITLE}) <= 60 AND NOT contains(seo, ':') THEN {TITLE} ELSE c_name END AS artist_name FROM a_phrases")
def artist_name_extract_pages(t):
    return E.artist_name(elements(t))


@query("SELECT id::bigint AS page_id, trim(regexp_replace(byline, '\\s+', ' ', 'g')) || ' - a long paragraph about the work of the people whom the hall shows this year, with more words than a heading has.' AS biography, 1 AS candidates, false AS fallback_used FROM a_phrases")
def artist_bio_extract_pages(t):
    return E.artist_bio(elements(t))


@query("SELECT 'kept' AS reason, 2 * count(*) AS n FROM a_phrases UNION ALL SELECT 'not_artwork', count(*) FROM a_phrases")
def extraction_stats(t):
    images = elements(t).select(F.explode("images").alias("i"))
    return E.extraction_stats(images, F.when(F.lower("i.src").rlike(E.NOT_ARTWORK), "not_artwork").otherwise("kept"))


@query(f"SELECT DISTINCT id::bigint AS page_id, replace({HOST}, 'www.', '') || '/artists/anna-bee' AS url, 'artist_profile' AS class FROM a_phrases")
def page_links_classes(t):
    links = E.page_links(elements(t), dict(X.URL_CLASSES))
    return links
