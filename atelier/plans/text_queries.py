"""Parsers and text functions over phrases made from the tables; the oracles parse on their own, with other regular expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from atelier.functions import parse as P
from atelier.functions import text as X
from atelier.operators import extract as E
from atelier.operators import tables as O
from atelier.plans.queries import ct, query, title_case

CITIES = ["NATION_11", "NATION_1", "NATION_2", "NATION_3"]


def phrases(t):
    return t["a_phrases"]


@query(r"""WITH p AS (SELECT id, lower(price) AS t, list_transform(regexp_extract_all(price, '[0-9][0-9,]*(?:\.[0-9]+)?'), lambda x: replace(x, ',', '')::double) AS v FROM a_phrases),
s AS (SELECT *, CASE WHEN contains(t, 'on request') THEN 'price_on_request' WHEN contains(t, 'sold') OR contains(t, 'not for sale') THEN 'not_available' WHEN len(v) = 2 THEN 'range_parsed' WHEN len(v) = 1 THEN 'parsed' ELSE 'failed' END AS status FROM p)
SELECT id, status, CASE WHEN status LIKE '%parsed' THEN v[1] END AS lo, CASE WHEN status LIKE '%parsed' THEN v[-1] END AS hi, CASE WHEN status LIKE '%parsed' THEN CASE WHEN contains(t, 'usd') OR contains(t, '$') THEN 'USD' WHEN contains(t, 'zar') THEN 'ZAR' WHEN contains(t, '£') THEN 'GBP' WHEN contains(t, '€') THEN 'EUR' WHEN contains(t, '¥') THEN 'JPY' END END AS currency FROM s""")
def price_parse_phrases(t):
    p = P.price_parse(F.col("price"))
    return phrases(t).select("id", p["status"].alias("status"), p["price_min"].cast("double").alias("lo"), p["price_max"].cast("double").alias("hi"), p["currency"].alias("currency"))


@query(r"""WITH p AS (SELECT id, lower(dims) AS t, CASE WHEN contains(lower(dims), 'in') AND NOT contains(lower(dims), 'dimensions') THEN 2.54 ELSE 1 END AS f, list_transform(string_split(regexp_replace(lower(trim(dims)), '\s*(cm|inches|in)$', ''), CASE WHEN contains(dims, '×') THEN '×' ELSE 'x' END), lambda x: trim(x)) AS parts FROM a_phrases),
n AS (SELECT *, list_transform(parts, lambda x: CASE WHEN regexp_full_match(x, '[0-9.]+( [0-9]+/[0-9]+)?') THEN split_part(x, ' ', 1)::double + CASE WHEN contains(x, '/') THEN split_part(split_part(x, ' ', 2), '/', 1)::double / split_part(split_part(x, ' ', 2), '/', 2)::double ELSE 0 END END) AS v FROM p)
SELECT id, CASE WHEN v[1] IS NULL THEN 'failed' WHEN v[2] IS NULL THEN 'partial' ELSE 'parsed' END AS status, round(cast(v[1] * f AS decimal(18,4)), 2)::double AS h, round(cast(v[2] * f AS decimal(18,4)), 2)::double AS w, round(cast(v[3] * f AS decimal(18,4)), 2)::double AS d FROM n""")
def dimension_parse_phrases(t):
    p = P.dimension_parse(F.col("dims"))
    return phrases(t).select("id", p["status"].alias("status"), *(p[f"{n}_cm"].cast("double").alias(a) for n, a in (("height", "h"), ("width", "w"), ("depth", "d"))))


@query(r"""WITH p AS (SELECT id, lower(dated) AS t, list_transform(regexp_extract_all(dated, '[0-9]+'), lambda x: x::int) AS v FROM a_phrases),
c AS (SELECT *, contains(t, 'century') AS century, CASE WHEN contains(t, 'early') THEN 0 WHEN contains(t, 'mid') THEN 34 WHEN contains(t, 'late') THEN 67 ELSE 0 END AS lo, CASE WHEN contains(t, 'early') THEN 33 WHEN contains(t, 'mid') THEN 66 ELSE 99 END AS hi FROM p)
SELECT id, CASE WHEN len(v) = 0 THEN 'failed' WHEN century THEN 'century_parsed' WHEN len(v) = 2 THEN 'range_parsed' ELSE 'parsed' END AS status, CASE WHEN century THEN (v[1] - 1) * 100 + lo ELSE v[1] END AS year_start, CASE WHEN century THEN (v[1] - 1) * 100 + hi ELSE v[-1] END AS year_end FROM c""")
def date_parse_phrases(t):
    d = P.date_parse_full(F.col("dated"))
    return phrases(t).select("id", d["status"].alias("status"), d["year_start"].alias("year_start"), d["year_end"].alias("year_end"))


@query(r"""WITH p AS (SELECT id, regexp_extract_all(shown, '[0-9]{1,2} [A-Za-z]+ [0-9]{4}') AS v FROM a_phrases), d AS (SELECT id, list_transform(v, lambda x: coalesce(try_strptime(x, '%d %B %Y'), try_strptime(x, '%d %b %Y'))::date) AS v FROM p) SELECT id, v[1] AS start_date, v[-1] AS end_date FROM d""")
def date_range_parse(t):
    d = P.date_range_parse(F.col("shown"))
    return phrases(t).select("id", d["start_date"].alias("start_date"), d["end_date"].alias("end_date"))


@query(r"""WITH p AS (SELECT id, k, strptime(regexp_extract(opening, '[0-9]{1,2} [A-Za-z]+ [0-9]{4}'), '%d %B %Y') AS d FROM a_phrases)
SELECT id, CASE k % 4 WHEN 0 THEN d + to_minutes(30 + 60 * (12 + (1 + k % 11) % 12)) WHEN 1 THEN d + to_minutes(15 + 60 * (k % 24)) WHEN 2 THEN d END AS opening_datetime FROM p""")
def opening_datetime_parse(t):
    return phrases(t).select("id", P.opening_datetime_parse(F.col("opening")).alias("opening_datetime"))


@query("SELECT id, CASE WHEN k % 5 = 0 AND y + 60 NOT BETWEEN 1500 AND 2099 THEN NULL WHEN k % 5 = 0 THEN (y + 60)::int ELSE y::int END AS year FROM a_phrases")
def lifespan_year(t):
    return phrases(t).select("id", P.lifespan_year(F.col("life")).alias("year"))


@query("SELECT id, CASE WHEN contains(seo, ' - ') THEN split_part(seo, ' - ', 1) END AS title, CASE WHEN contains(seo, ' - ') THEN 'Solo Show' END AS type, CASE WHEN contains(seo, ' - ') THEN n_name || ' Hall' END AS venue, CASE WHEN contains(seo, ' - ') THEN split_part(seo, ' in ', 2) END AS city FROM a_phrases")
def seo_title_parse(t):
    s = X.seo_title_parse(F.col("seo"))
    return phrases(t).select("id", *(s[n].alias(n) for n in ("title", "type", "venue", "city")))


@query(r"""WITH p AS (SELECT id, unnest(regexp_split_to_array(regexp_replace(byline, '^.*(Artists:|by)', ''), ',|;|&|\band\b')) AS n FROM a_phrases) SELECT id, string_agg(trim(n), '+' ORDER BY trim(n)) AS names FROM p WHERE length(trim(n)) >= 3 AND NOT regexp_matches(n, '[0-9]') GROUP BY 1""")
def split_artist_names(t):
    out = phrases(t).select("id", F.array_join(F.array_sort(X.split_artist_names(F.col("byline"))), "+").alias("names"))
    return out.where("names <> ''")


@query("SELECT id, c_name AS venue, cast(k AS varchar) || ' Main Road' AS address FROM a_phrases")
def label_value(t):
    return phrases(t).select("id", X.label_value(F.col("labelled"), ["venue"]).alias("venue"), X.label_value(F.col("labelled"), ["address"]).alias("address"))


@query("SELECT id, " + "CASE " + " ".join(f"WHEN contains(lower(contact), lower('{c}')) THEN '{c}'" for c in CITIES) + " END AS city FROM a_phrases")
def city_gazetteer(t):
    return phrases(t).select("id", X.city_gazetteer(F.col("contact"), CITIES).alias("city"))


@query("SELECT id, CASE WHEN k % 3 = 0 THEN 'info@' || replace(lower(n_name), '_', '') || '.example' WHEN k % 2 = 0 THEN 'a@b.example' END AS email, CASE WHEN k % 3 = 0 THEN '+27 21 555 ' || cast(1000 + k % 9000 AS varchar) END AS phone, 'https://x.example/' || id AS website, CASE WHEN k % 2 = 0 THEN 'https://www.instagram.com/' || id END AS instagram, NULL::varchar AS facebook FROM a_phrases".replace("CASE WHEN k % 3 = 0 THEN 'info@' || replace(lower(n_name), '_', '') || '.example' WHEN k % 2 = 0 THEN 'a@b.example' END", "CASE WHEN k % 2 = 0 THEN 'a@b.example' WHEN k % 3 = 0 THEN 'info@' || replace(lower(n_name), '_', '') || '.example' END"))
def contact_extract(t):
    """The links of half of the rows hold an address and an account; the text is looked at after them."""
    even = F.col("k") % 2 == 0
    links = F.array_compact(F.array(F.when(even, F.lit("mailto:A@b.example?subject=x")), F.when(even, F.concat(F.lit("https://www.instagram.com/"), "id")), F.concat(F.lit("https://x.example/"), "id")))
    c = X.contact_extract(F.col("contact"), links)
    return phrases(t).select("id", *(c[n].alias(n) for n in ("email", "phone", "website", "instagram", "facebook")))


@query(f"SELECT id, coalesce({ct('payload')}, {ct('seo')}) AS title FROM a_phrases")
def title_infer(t):
    return phrases(t).select("id", X.title_infer(F.col("payload"), F.lit("  "), F.col("seo")).alias("title"))


@query("SELECT id, coalesce(nullif(json_extract_string(payload, '$.artists'), ''), nullif(json_extract_string(payload, '$.artist'), ''), nullif(json_extract_string(payload, '$.participants'), ''), nullif(json_extract_string(payload, '$.performers'), ''), '[]') AS people FROM a_phrases")
def json_get(t):
    return phrases(t).select("id", E.json_get(F.col("payload"), ["artists", "artist", "participants", "performers"]).alias("people"))


@query(f"SELECT id, CASE k % 4 WHEN 0 THEN CASE WHEN contains(url, 'anna-van-alpha') THEN 'Anna A.' ELSE {title_case('replace(regexp_extract(url, chr(47) || $$([a-z-]+)/$$ || chr(36), 1), chr(45), chr(32))')} END WHEN 2 THEN 'Workshop For All' END AS name FROM a_phrases".replace("chr(47) || $$([a-z-]+)/$$ || chr(36)", "'/([a-z-]+)/$'"))
def artist_name_from_slug(t):
    return phrases(t).select("id", X.artist_name_from_slug(F.col("url"), overrides={"anna-van-alpha": "Anna A."}).alias("name"))


@query("SELECT id, n_name || ':event:' || CASE k % 4 WHEN 1 THEN regexp_extract(url, 'nom=([a-z]+)', 1) WHEN 0 THEN regexp_extract(url, 'artists/([a-z-]+)/', 1) WHEN 2 THEN 'workshop-for-all' ELSE trim(lower(regexp_replace(seo, '[^A-Za-z0-9]+', '-', 'g')), '-') END AS record FROM a_phrases")
def source_record_id(t):
    return phrases(t).select("id", X.source_record_id("event", F.col("n_name"), F.col("url"), F.col("seo")).alias("record"))


@query("SELECT id, CASE WHEN contains(lower(url || ' ' || seo), 'workshop') THEN 'workshop' WHEN contains(lower(url || ' ' || seo), 'exhibition') OR contains(lower(seo), 'solo show') THEN 'exhibition' END AS type FROM a_phrases")
def event_type_from_url_text(t):
    return phrases(t).select("id", X.event_type_from_url_text(F.col("url"), F.col("seo")).alias("type"))


@query("SELECT id, n_name || coalesce(payload, '') || '/' || c_name AS joined FROM a_phrases")
def null_safe_concat(t):
    return phrases(t).select("id", F.concat_ws("", "n_name", "payload", F.lit("/"), "c_name").alias("joined"))


@query("SELECT id, seo AS title, NULL::varchar AS missing, url FROM a_phrases")
def select_with_fallback(t):
    out = O.select_with_fallback(phrases(t), [("id", "x"), ("title", "seo"), ("missing", "absent"), ("url", "seo")])
    return out.withColumn("missing", F.col("missing").cast("string"))


@query("SELECT 'colour' AS column_name UNION ALL SELECT 'size'")
def schema_contract(t):
    return O.schema_contract(phrases(t), ["id", "colour", "seo", "size"])


@query("SELECT id, seo FROM a_phrases")
def schema_tolerant_write(t):
    """What is written is the target's columns that there are."""
    return O.schema_tolerant(phrases(t), ["id", "absent", "seo"])


_KIND = r"""CASE WHEN length(u) > 200 THEN 'invalid' WHEN regexp_matches(u, '[<>"@\s]') THEN 'invalid' WHEN len(regexp_extract_all(u, 'https?://')) <> 1 THEN 'invalid' WHEN regexp_matches(u, '/artists?/[a-z-]+/?$') THEN 'artist_profile' WHEN regexp_matches(u, '/(exhibitions|events?)/[^/?]+') THEN 'event_detail' WHEN regexp_matches(u, '/work/[0-9]+') THEN 'artwork_detail'
 WHEN regexp_matches(u, '/collections?/') THEN 'collection' WHEN regexp_matches(u, '/directory/') THEN 'directory_profile' WHEN regexp_matches(u, '[?&]page=[0-9]+') OR regexp_matches(u, '/(list|listing|show)') THEN 'listing' ELSE 'other' END"""


@query(f"WITH x AS (SELECT id, CASE k % 7 WHEN 5 THEN url || 'collection/' || id WHEN 6 THEN 'http://a.example/http://b.example' ELSE url END AS u FROM a_phrases UNION ALL SELECT id, source_url FROM a_artworks WHERE source_url IS NOT NULL) SELECT id, u, {_KIND} AS class FROM x")
def url_classes(t):
    k = F.col("k") % 7
    made = phrases(t).select("id", F.when(k == 5, F.concat("url", F.lit("collection/"), "id")).when(k == 6, F.lit("http://a.example/http://b.example")).otherwise(F.col("url")).alias("u"))
    rows = made.unionByName(t["a_artworks"].where("source_url is not null").select("id", F.col("source_url").alias("u")))
    return rows.select("id", "u", X.url_class(F.col("u"))["class"].alias("class"))
