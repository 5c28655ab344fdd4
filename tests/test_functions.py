"""Truth tables of the column functions."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from atelier.functions import parse as P
from atelier.functions import text as X
from atelier.operators import marts as M
from atelier.operators import moderation as D
from atelier.operators import tables as O

SITE, LABEL = "list.example", "List.example"


def one(spark, column, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(column(*(F.col(f"c{i}") for i in range(len(values)))).alias("x")).first()["x"]


@pytest.mark.parametrize(("given", "lo", "hi", "status"), [("1998", 1998, 1998, "parsed"), ("c. 1920", 1920, 1920, "parsed"), ("1920-1925", 1920, 1925, "range_parsed"), ("19th century", 1800, 1899, "century_parsed"), ("late 19th century", 1867, 1899, "century_parsed"), ("undated", None, None, "failed"), (None, None, None, "missing")])
def test_dates(spark, given, lo, hi, status):
    assert tuple(one(spark, P.date_parse_full, given)) == (lo, hi, status)


@pytest.mark.parametrize(
    ("given", "lo", "hi", "currency", "status"),
    [("$1,200", "1200.00", "1200.00", "USD", "parsed"), ("€1,250 - €2,500", "1250.00", "2500.00", "EUR", "range_parsed"), ("GBP 3,400.50", "3400.50", "3400.50", "GBP", "parsed"), ("Price on request", None, None, None, "price_on_request"), ("SOLD", None, None, None, "not_available"), ("ask", None, None, None, "failed"), (None, None, None, None, "missing")],
)
def test_prices(spark, given, lo, hi, currency, status):
    x = one(spark, P.price_parse, given)
    assert (x.price_min, x.price_max, x.currency, x.status) == (lo and Decimal(lo), hi and Decimal(hi), currency, status)


@pytest.mark.parametrize(("given", "h", "w", "d", "status"), [("30 x 20 cm", "30.00", "20.00", None, "parsed"), ("10 1/2 × 8 in", "26.67", "20.32", None, "parsed"), ("30 x 20 x 4.5 cm", "30.00", "20.00", "4.50", "parsed"), ("variable", None, None, None, "failed"), (None, None, None, None, "missing")])
def test_dimensions(spark, given, h, w, d, status):
    x = one(spark, P.dimension_parse, given)
    assert (x.height_cm, x.width_cm, x.depth_cm, x.status) == (*(v and Decimal(v) for v in (h, w, d)), status)


def test_date_ranges_and_openings(spark):
    assert tuple(one(spark, P.date_range_parse, "12 March  2024 - 3 May 2024")) == (dt.date(2024, 3, 12), dt.date(2024, 5, 3))
    assert tuple(one(spark, P.date_range_parse, "from 1 Jan 2024")) == (dt.date(2024, 1, 1), dt.date(2024, 1, 1))
    assert one(spark, P.opening_datetime_parse, "Opening: 12 March 2024 at 6:30 pm") == dt.datetime(2024, 3, 12, 18, 30)
    assert one(spark, P.opening_datetime_parse, "opening 12 March 2024") == dt.datetime(2024, 3, 12)
    assert one(spark, P.opening_datetime_parse, "closed") is None


@pytest.mark.parametrize(
    ("given", "name"),
    [("Show at The Vault | List.example Art Exhibition Listings", "The Vault"), ("The Vault | List.example Art Gallery Listings", "The Vault"), ("The Vault | List.example", "The Vault"), ("The  Vault", "The Vault"), ("A at B | List.example Art Training", "A at B")],
)
def test_venue_names(spark, given, name):
    assert one(spark, lambda c, d: X.venue_name_clean(c, d, site=SITE, label=LABEL), given, SITE) == name


def test_gallery_columns(spark):
    assert one(spark, lambda c, d: X.gallery_name_clean(c, d, site=SITE, label=LABEL), " o'neil art | List.example Art Gallery Listings ", SITE) == "O'Neil Art"
    assert one(spark, X.website_normalize, "WWW.A.example/x?utm_source=1&id=2&UTM_term=3&b=4") == "https://www.a.example/x?id=2&b=4"
    assert one(spark, X.website_normalize, "") is None
    assert one(spark, lambda c: X.social_normalize(c, "instagram.com", own="us"), "http://www.instagram.com/us/") is None
    assert one(spark, lambda c: X.social_normalize(c, "instagram.com", own="us"), "http://www.Instagram.com/Them") == "https://instagram.com/them"
    assert one(spark, X.phone_normalize, "(012) 34/5") == "012 34 5"


def test_names_and_mentions(spark):
    assert one(spark, X.normalize_person_name, "  José's  Studio ") == "jos s"
    assert one(spark, X.tokenize_mentions, "Ann Lee, Bob & Carl Ray and friends, Opening, The Gallery, 1234") == ["Ann Lee", "Carl Ray and friends"]
    assert one(spark, lambda c: X.tokenize_mentions(c, split_on_and=True), "Ann Lee and Carl Ray") == ["Ann Lee", "Carl Ray"]
    assert one(spark, X.split_artist_names, "An evening featuring Ann Lee; Bob Ray & 2 more") == ["Ann Lee", "Bob Ray"]
    assert one(spark, X.artist_name_from_slug, "https://a.example/artists/ann-lee/?x=1") == "Ann Lee"
    assert one(spark, lambda u, d, t: X.source_record_id("event", d, u, t), "https://a.example/e?nom=abc", "a.example", "T") == "a.example:event:abc"


def test_titles(spark):
    for given, value, confidence in [("  A ", "A", 0.99), ("A  b", "A b", 0.99), ("A!!!", "A!", 0.95), ("BIG SHOW", "Big Show", 0.90), ("Fine", None, None), (None, None, None)]:
        x = one(spark, X.title_suggestion, given)
        assert (x and x.value, x and x.confidence) == (value, confidence)


def test_biographies(spark):
    b = one(spark, X.bio_clean, "About the artist\n\nBorn here. Born here. Write to a@b.example now.\n\nborn here. born here. write to a@b.example now.")
    assert b.cleaned == "Born here. Write to now" and b.contains_email and b.navigation_noise and b.duplicate_content and not b.contains_phone


def test_urls(spark):
    assert one(spark, lambda c: X.url_canonicalize(c, mode="sorted"), "HTTPS://WWW.A.example/x/?b=1&utm_source=q&a=2#top") == "https://a.example/x?a=2&b=1"
    assert one(spark, lambda c: X.url_canonicalize(c, mode="page"), "https://a.example/x/?b=1&page=3") == "https://a.example/x?page=3"
    assert one(spark, X.url_canonicalize, "no url") is None
    assert one(spark, X.page_number, "https://a.example/?page=x") == 1


def test_contacts(spark):
    df = spark.createDataFrame([("call +27 11 555 1234", ["mailto:A@b.example?x=1", "https://instagram.com/q", "https://site.example"])], "t string, l array<string>")
    x = df.select(X.contact_extract(F.col("t"), F.col("l")).alias("x")).first()["x"]
    assert (x.email, x.phone, x.website, x.instagram, x.facebook) == ("a@b.example", "+27 11 555 1234", "https://site.example", "https://instagram.com/q", None)


def test_correction_actions(spark):
    for old, new, suggested, reason, action in [("a", None, None, None, "reverted"), (None, "b", "b", None, "accepted"), (None, "c", "b", None, "manually_edited"), (None, None, "b", None, "rejected"), ("x", "y", None, "auto_applied: z", "rejected"), ("x", "", None, "auto_applied", "reverted")]:
        assert one(spark, D.correction_action, old, new, suggested, reason) == action


def test_keyword_modes(spark):
    df = spark.createDataFrame([("Oil on canvas",), (None,)], "medium_text string")
    assert [r.medium_category for r in M.keyword_category(df, "medium_text").collect()] == ["painting", "unknown"]
    assert M.keyword_category(df, "medium_text", mode="all").count() == 3


def test_upsert_keeps_first_values(spark):
    schema = "id string, source_domain string, source_record_id string, source_url string, title string, price string, ts int"
    base = spark.createDataFrame([("1", "d", "r", "u", "old", "p", 1), ("2", "d", None, "u2", "x", "p", 1)], schema)
    new = spark.createDataFrame([("3", "d", "r", "u9", "new", "q", 3), ("4", "d", "r", "u9", "mid", "q", 2), ("5", "d", "", "u2", "y", "q", 2), ("6", "e", "r", "u", "z", "q", 2)], schema)
    got = {r.id: (r.title, r.price) for r in O.upsert_by_key(base, new, update_cols=["title"], order=[F.desc("ts")]).collect()}
    assert got == {"1": ("new", "p"), "2": ("y", "p"), "6": ("z", "q")}


def test_inferred_galleries_leave_out_chrome(spark):
    events = spark.createDataFrame([(str(i), v, "Town", "Land", SITE) for i, v in enumerate(["List your gallery", "abc", "The Vault | List.example Art Gallery Listings", "Home", "The Vault"])], "event_id string, venue_name string, city string, country string, source_domain string")
    events = events.withColumns({"venue_address": F.lit(None).cast("string"), "source_url": F.lit("u"), "event_title": F.lit("t"), "crawl_timestamp": F.lit("2024-01-01").cast("timestamp")})
    none = spark.createDataFrame([], "n_gallery_name string, n_city string, n_country string, source_domain string")
    got = M.inferred_galleries(events, none, site=SITE, label=LABEL).collect()
    assert [(r.gallery_name, r.n_linked_events) for r in got] == [("The Vault", 2)]


def test_dates_are_looked_up_without_formats(spark, capsys):
    days = {"12 March 2024": dt.date(2024, 3, 12), "1 SEP 2024": dt.date(2024, 9, 1), "31 February 2024": None, "0 May 2024": None, "3 Foo 2024": None}
    rows = spark.createDataFrame([(d,) for d in days], "d string").select("d", P.date_range_parse(F.col("d")).alias("x"))
    assert {r.d: r.x.start_date for r in rows.collect()} == days
    assert tuple(one(spark, P.date_range_parse, "40 May 2024 - 2 June 2024, and 1 May 2024")) == (None, dt.date(2024, 6, 2))
    rows.explain()
    assert "gettimestamp" not in capsys.readouterr().out.lower()


def test_dimensions_are_looked_for_once(spark):
    """Every use of a measure had searched the text anew: the code was too long to be compiled."""
    rows = spark.createDataFrame([("10 1/2 x 8 in",), ("5/6 x 3 × 1.5 cm",), ("7 cm",), ("5/0 x 2 cm",), (None,)], "c string")
    parsed = rows.select(P.dimension_parse(rows["c"]).alias("x"))
    assert [tuple(map(str, r.x)) for r in parsed.collect()] == [("26.67", "20.32", "None", "in", "parsed"), ("0.83", "3.00", "1.50", "cm", "parsed"), ("7.00", "None", "None", "cm", "partial"), ("None", "None", "None", "cm", "failed"), ("None", "None", "None", "None", "missing")]
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract(") <= 50
