"""Truth tables and small cases of the record views, decisions, audits and checks."""

import pytest
from pyspark.sql import functions as F

from atelier.functions import text as X
from atelier.operators import audit as A
from atelier.operators import marts as M
from atelier.operators import moderation as D
from atelier.operators import records as R
from atelier.operators import summaries as S

SITE, LABEL = "list.example", "List.example"


@pytest.mark.parametrize(
    ("old", "new", "suggested", "reason", "override", "action"),
    [
        ("a", None, None, None, None, "reverted"),
        ("a", "  ", "s", None, None, "reverted"),
        (None, None, "s", None, None, "rejected"),
        ("a", "s", " s ", None, None, "accepted"),
        ("a", "b", "s", None, None, "manually_edited"),
        ("a", "b", None, None, None, "manually_edited"),
        (None, None, None, None, None, "manually_edited"),
        ("a", None, "s", "auto_applied: title", None, "reverted"),
        ("a", "s", "s", "auto_applied", None, "rejected"),
        ("a", "b", "s", "auto_applied", "bulk", "bulk"),
    ],
)
def test_correction_table(spark, old, new, suggested, reason, override, action):
    df = spark.createDataFrame([(old, new, suggested, reason, override)], "o string, n string, s string, r string, v string")
    assert df.select(D.correction_action(*(F.col(c) for c in "onsrv")).alias("a")).first().a == action


@pytest.mark.parametrize(
    ("venue", "left_out"),
    [(f"List Your Gallery on {LABEL} | Art in South Africa", True), (f"List Your Art Exhibition on {LABEL} | Art in South Africa", True), (f"Slow Tiger at Rose Hall Town | {LABEL} Art Exhibition Listings", False), ("Home", True), ("ab", True), ("Sign up", True), ("Rose Hall", False)],
)
def test_site_chrome(spark, venue, left_out):
    df = spark.createDataFrame([("1", venue, "Town", "Land", SITE, None, "u", "t")], "event_id string, venue_name string, city string, country string, source_domain string, venue_address string, source_url string, event_title string").withColumn("crawl_timestamp", F.current_timestamp())
    none = spark.createDataFrame([], "n_gallery_name string, n_city string, n_country string, source_domain string")
    assert (M.inferred_galleries(df, none, site=SITE, label=LABEL).count() == 0) == left_out
    assert M.inferred_galleries(df.withColumn("source_domain", F.lit("other.example")), none, site=SITE, label=LABEL).count() == 1


@pytest.mark.parametrize(
    ("url", "kind", "reason"),
    [("https://a.example/artists/ann-lee/", "artist_profile", None), ("https://a.example/exhibitions/x", "event_detail", None), ("https://a.example/collection/9", "collection", None), ("https://a.example/?page=2", "listing", None), ("https://a.example/about", "other", None),
     ("https://a.example/" + "x" * 200, "invalid", "too_long"), ("https://a.example/<b>", "invalid", "markup"), ("https://a@b.example/", "invalid", "address"), ("https://a.example/https://b.example", "invalid", "not_one_host"), ("a.example", "invalid", "not_one_host"), (None, "invalid", "empty")],
)
def test_url_classes(spark, url, kind, reason):
    c = spark.createDataFrame([(url,)], "u string").select(X.url_class(F.col("u")).alias("c")).first().c
    assert (c["class"], c["reject_reason"]) == (kind, reason)


def test_matching_and_backfill(spark):
    schema = "doc_id int, source_domain string, source_record_id string, source_url string, artist_name string"
    before = spark.createDataFrame([(1, "d", "r", "u1", "Old"), (2, "d", "r", "u2", "Old"), (3, "d", None, "u3", "X"), (4, "d", "q", "u4", "Same"), (5, "d", "z", "u5", "Gone")], schema)
    after = spark.createDataFrame([(11, "d", "r", "u9", "New"), (12, "d", "", "u3", "Y"), (13, "d", "q", "u4", "Same"), (14, "d", "n", "u7", "More")], schema)
    keys = [F.when(~X.blank(F.col("source_record_id")), F.concat_ws("|", "source_domain", "source_record_id")), F.col("source_url")]
    m = A.stable_match(before, after, keys, ["doc_id"])
    assert {(r.b_doc_id, r.a_doc_id) for r in m.collect()} == {(1, 11), (2, None), (3, 12), (4, 13), (5, None), (None, 14)}
    plan = A.backfill_plan(m, field="artist_name")
    assert {r.b_doc_id: r.action for r in plan.collect()} == {1: "apply", 2: "unmatched", 3: "no_record_id", 4: "unchanged", 5: "unmatched", None: "unmatched"}
    done = A.backfill_apply(before, plan.withColumnsRenamed({"b_source_domain": "source_domain", "b_source_record_id": "source_record_id"}), field="artist_name")
    assert {r.doc_id: r.artist_name for r in done.collect()} == {1: "New", 2: "New", 3: "X", 4: "Same", 5: "Gone"}


def test_reviews_end_in_one_table(spark):
    d = spark.createDataFrame([("1", "a", "approve", True, None, 1), ("2", "a", "reject", None, None, 2), ("3", "b", "approve", False, None, 1), ("4", "zz", "approve", True, None, 1)], "id string, artwork_id string, action string, public_visibility boolean, rejection_reason string, decided_at int")
    reviews = spark.createDataFrame([("0", "a", "pending", 0, 0)], "id string, artwork_id string, review_status string, reviewed_at int, created_at int")
    approvals = spark.createDataFrame([("p", "a", True, 0)], "id string, artwork_id string, public_visibility boolean, approved_at int")
    rejections = spark.createDataFrame([("x", "b", "poor", 0)], "id string, artwork_id string, rejection_reason string, rejected_at int")
    known = spark.createDataFrame([("a",), ("b",)], "artwork_id string")
    r, a, x = D.apply_artwork_reviews(reviews, approvals, rejections, d, known, [F.desc("decided_at"), F.desc("id")])
    assert sorted((y.id, y.review_status) for y in r.collect()) == [("0", "pending"), ("1", "approved"), ("2", "rejected"), ("3", "approved")]
    assert [y.id for y in a.collect()] == ["3"] and [(y.id, y.rejection_reason) for y in x.collect()] == [("2", "Rejected by reviewer")]


def test_possible_duplicates_and_confidence(spark):
    g = spark.createDataFrame([("1", "hall", "Town"), ("2", "hall", "town"), ("3", "hall", "City"), ("4", "", "Town"), ("5", "", "Town")], "gallery_id string, normalized_gallery_name string, city string")
    assert {r.gallery_id for r in R.admin_galleries(g, duplicates=True).collect()} == {"1", "2"}
    c = spark.createDataFrame([("Ann", 1900, 1950), ("Ann", 1900, None), ("Ann", None, None), ("After Ann", 1900, 1950)], "n string, b int, d int").select(R.confidence(F.col("n"), F.col("b"), F.col("d")).alias("c"))
    assert [r.c for r in c.collect()] == [1.0, 0.8, 0.6, 0.2]


def test_first_by_key_of_long_arrays(spark):
    items = [f"Line {i % 7000}" for i in range(40_000)]
    got = spark.createDataFrame([("\n".join(items),)], "t string").select(X.ordered_dedupe_join(F.col("t"), split="\n", join="\n").alias("t")).first().t
    assert got.split("\n") == [f"Line {i}" for i in range(7000)]


def test_stream_needs_its_base(spark, tmp_path):
    from atelier.streaming import jobs as S

    schema = "id string, source_domain string, source_record_id string, source_url string, title string, ts int"
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    run = lambda: S.stream_upsert(spark.readStream.schema(schema).parquet(source), out, str(tmp_path / "ck"), update_cols=["title"], order=[F.desc("ts")]).awaitTermination()
    spark.createDataFrame([("1", "d", "r", "u", "a", 1)], schema).write.parquet(source)
    run()
    (tmp_path / "out/manifest/batch=0").rename(tmp_path / "moved")
    spark.createDataFrame([("2", "d", "q", "u", "b", 2)], schema).write.mode("append").parquet(source)
    with pytest.raises(Exception, match="(?i)path|exist"):
        run()


def test_decisions_in_chains_and_cycles(spark):
    pairs = [("b", "a"), ("c", "b"), ("d", "c"), ("x", "y"), ("y", "z"), ("z", "x"), ("t", "u"), ("u", "x"), ("s", "s"), ("r", "s"), ("m", "q"), ("m", "n"), ("n", "m"), (None, "a"), ("k", None)]
    pairs += [(f"p{i:04}", f"p{i - 1:04}") for i in range(1, 700)] + [(f"q{i:03}", f"q{(i + 1) % 37:03}") for i in range(37)]
    got = {r.id: r.end for r in S.decision_ends(spark.createDataFrame(pairs, "duplicate_id string, canonical_id string")).collect()}
    want = {"b": "a", "c": "a", "d": "a", "x": "x", "y": "x", "z": "x", "t": "x", "u": "x", "s": "s", "r": "s", "m": "m", "n": "m"}
    assert got == want | {f"p{i:04}": "p0000" for i in range(1, 700)} | {f"q{i:03}": "q000" for i in range(37)}
    works = spark.createDataFrame([("d",), ("free",)], "raw_artwork_id string")
    assert {(r.raw_artwork_id, r.canonical_id) for r in S.duplicate_resolution(works, spark.createDataFrame(pairs, "duplicate_id string, canonical_id string")).collect()} == {("d", "a"), ("free", "free")}
    assert S.decision_ends(spark.createDataFrame([], "duplicate_id string, canonical_id string")).count() == 0


def test_rules_by_grams_equal_the_nested_loop(spark):
    rng = __import__("random").Random(4)
    words = ["show", "hall", "Night", "éa", "a", "of light", "sho", "ow h", "zz", "night show", "  trimmed ", "", "日本の"]
    events = [(str(i), rng.choice(["d", "e"]), rng.choice([None, "Night Show"]), " ".join(rng.choice(words) for _ in range(rng.randint(0, 6)))) for i in range(300)]
    rules = [("event_type", p, f"v{i}", rng.choice([None, "", "d"]), round(rng.random(), 4), i, True, i) for i, p in enumerate(words * 3)] + [("other", "a", "no", None, 0.99, 1, True, 1), ("event_type", "a", "off", None, 0.99, 1, False, 1), ("event_type", None, "null", None, 0.99, 1, True, 1)]
    e = spark.createDataFrame(events, "event_id string, source_domain string, event_title string, description string")
    r = spark.createDataFrame(rules, "field_name string, pattern string, suggested_value string, source_domain string, confidence double, support_count int, is_active boolean, updated_at int")
    loop, grams = D.rule_match(e, r), D.rule_match(e, r, few=0)
    assert "BroadcastNestedLoop" in loop._jdf.queryExecution().toString() and "NestedLoop" not in grams._jdf.queryExecution().toString() and "Cartesian" not in grams._jdf.queryExecution().toString()
    assert sorted(map(tuple, loop.collect())) == sorted(map(tuple, grams.collect())) != []
    assert D.rule_match(e, r.limit(0), few=0).count() == 0


def test_batches_rewrite_only_the_buckets_they_touch(spark, tmp_path):
    from atelier.streaming import buckets as B

    schema = "id string, source_domain string, source_record_id string, source_url string, title string, price string, ts int"
    target, kept = str(tmp_path / "t"), dict(update_cols=["title", "ts"], order=[F.desc("ts"), F.desc("id")], buckets=16)
    batch = lambda *rows: spark.createDataFrame(rows, schema)
    first = batch(*[(str(i), "d", f"r{i}", None, "old", f"p{i}", 1) for i in range(200)])
    B.merge(first, 0, target, **kept)
    second = batch(("900", "d", "r7", "u", "new", "later", 3), ("901", "d", "r7", "u", "older", "x", 2), ("902", "d", None, "https://a", "added", "y", 2), ("903", None, None, None, "no key", None, 2))
    before = {p.name for p in (tmp_path / "t/data/batch=0").iterdir() if p.name.startswith("bucket=")}
    B.merge(second, 1, target, **kept)
    files = lambda: {p.relative_to(tmp_path): p.stat().st_mtime_ns for p in (tmp_path / "t/data/batch=0").rglob("*.parquet")}
    old, touched = files(), {p.name for p in (tmp_path / "t/data/batch=1").iterdir() if p.name.startswith("bucket=")}
    assert len(before) == 16 and 1 <= len(touched) <= 3
    rows = lambda n=None: sorted(map(tuple, B.current(spark, target, first.schema, batch_id=n).collect()), key=str)
    want = rows()
    assert len(want) == 202 and ("7", "d", "r7", None, "new", "p7", 3) in want and len(rows(0)) == 200
    content = lambda: {p.parent.name: spark.read.parquet(str(p)).collect() for p in (tmp_path / "t/data/batch=1").rglob("*.parquet")}
    once = content()
    B.merge(second, 1, target, **kept)  # a repeated batch
    assert content() == once and rows() == want and files() == old
    B.merge(batch(), 2, target, **kept)
    B.merge(batch(("7", "d", "r7", None, "last", None, 4)), 3, target, **kept)
    want = rows()
    assert ("7", "d", "r7", None, "last", "p7", 4) in want
    assert B.vacuum(spark, target) > 0 and rows() == want and len(rows(2)) == 202
    with pytest.raises(Exception, match="(?i)path|exist"):
        rows(0)
    with pytest.raises(ValueError, match="buckets"):
        B.merge(second, 4, target, **(kept | {"buckets": 8}))
    assert B.current(spark, str(tmp_path / "none"), first.schema).count() == 0


def test_moderation_summary_of_four_kinds(spark):
    people = spark.createDataFrame([(None, None), (False, " "), (False, "A"), (True, "B"), (None, "C")], "is_hidden boolean, canonical_artist_name string")
    works = spark.createDataFrame([(True, False, "approved"), (None, None, None), (False, True, "unreviewed"), (False, False, "rejected")], "public_visibility boolean, artist_is_hidden boolean, review_status string")
    events = spark.createDataFrame([(None, None), (True, False), (True, True), (False, True)], "is_approved boolean, is_hidden boolean")
    rows = {r[0]: tuple(r[1:]) for r in D.moderation_summary(people, works, events, events.limit(0)).collect()}
    assert rows == {"artists": (5, 2, 1, 2), "artworks": (4, 1, 1, 2), "events": (4, 2, 2, 1), "galleries": (0, 0, 0, 0)}


def test_artists_with_years_are_told_apart(spark):
    rows = [("Ann Lee", "1", "a", 1900, 1950), ("ann lee", "2", "b", 1900, 1950), ("Ann Lee", "3", "a", 1901, None), ("Ann Lee", "4", "a", None, None), ("Unknown", "5", "a", 1900, None), ("Unknown", "6", "a", 1900, None), (None, "7", "a", 1900, 1950)]
    works = spark.createDataFrame(rows, "artist_name string, raw_artwork_id string, source_domain string, birth_year int, death_year int").withColumn("crawl_timestamp", F.lit("2024-01-01").cast("timestamp"))
    got = {r["artist_key"]: (r["artwork_count"], r["source_count"], r["artist_confidence_score"], r["birth_year"]) for r in M.artist_dedupe(works).collect()}
    assert got == {"ann-lee-1900-1950": (2, 2, 1.0, "1900"), "ann-lee-1901": (1, 1, 0.8, "1901"), "ann-lee": (1, 1, 0.6, None), "unknown:5": (1, 1, 0.2, "1900"), "unknown:6": (1, 1, 0.2, "1900")}


def test_suspect_names_in_order(spark):
    url = "https://x.example/artists/anna-bee/"
    rows = [("Prints", url), ("prints: new", url), ("x" * 61, url), ("Anna", url), ("Anna", "https://x.example/"), ("Anna Bee", url), (" ", url), (None, url), ("Anna", None)]
    got = [tuple(r) for r in A.suspect_names(spark.createDataFrame(rows, "artist_name string, source_url string")).select("reason", "suggested_artist_name").collect()]
    assert got == [("denylist", "Anna Bee"), ("colon", "Anna Bee"), ("too_long", "Anna Bee"), ("single_token", "Anna Bee")]


def test_rates_without_records_are_null(spark):
    columns = "source_domain string, records_found long, records_failed long, missing_artist_count long, missing_title_count long, missing_image_count long, duplicate_candidate_count long"
    rows = [("a", 4, 1, 2, 0, 4, 1), ("a", 4, 0, 0, 0, 0, 1), ("b", 0, 3, 0, 0, 0, 0)]
    got = {r[0]: tuple(r[1:]) for r in R.rate_metrics(spark.createDataFrame(rows, columns), ["source_domain"]).collect()}
    assert got == {"a": (8, 0.125, 0.25, 0.0, 0.5, 0.25), "b": (0, None, None, None, None, None)}


def test_items_are_routed_or_rejected_with_a_reason(spark):
    from atelier.operators import tables as O

    rows = [("1", "u", "d", "t", None, None), ("2", "u", None, "t", None, None), ("3", None, "d", "t", None, None), ("4", None, None, None, "e", "n"), ("5", "u", "d", None, None, None), ("6", "u", "d", None, None, "n")]
    routed, rejected = O.route_items(spark.createDataFrame(rows, "id string, source_url string, source_domain string, artwork_title string, event_id string, artist_name string"))
    assert {c: [r["id"] for r in df.collect()] for c, df in routed.items()} == {"artwork": ["1"], "event": [], "artist": ["6"], "event_artist": ["4"], "image": [], "gallery": []}
    assert {r["id"]: r["reason"] for r in rejected.collect()} == {"2": "no source_domain", "3": "no source_url", "5": "no known shape"}


def test_repeated_ids_are_settled_by_the_row(spark):
    schema = "source_domain string, source_record_id string, raw_artwork_id string, crawl_timestamp timestamp, artist_name string, source_url string, description string"
    rows = [("d", None, "1-1", None, name, f"u{name}", "x") for name in "abcdef"]
    one = lambda rows: M.latest_artworks(spark.createDataFrame(rows, schema).coalesce(1)).first().artist_name
    assert one(rows) == one(rows[::-1])
    same = [("d", str(i), "1-1", None, "A", f"u{i}", "x") for i in range(6)]
    best = lambda rows: M.artist_profiles(spark.createDataFrame(rows, schema).coalesce(1)).first().profile_url
    assert best(same) == best(same[::-1])


def test_profiles_have_edits_cleaned_biographies_and_what_reviewers_say(spark):
    rows = [("a", "d", None, "u1", "Paints. Paints.", "1"), ("a", "d", None, "u2", None, "2"), ("b", "d", None, "u3", "Carves stone", "3")]
    records = spark.createDataFrame(rows, "artist_name string, source_domain string, crawl_timestamp timestamp, source_url string, description string, raw_artwork_id string")
    edits = spark.createDataFrame([("a", "d", "Edited", 1, "x"), ("a", "d", "Old", 0, "y"), ("b", "e", "Other", 1, "z")], "artist_name string, source_domain string, edited_bio string, created_at long, id string")
    said = spark.createDataFrame([("b", "d", True, "Bee", "twice"), ("a", "e", True, None, None)], "artist_name string, source_domain string, is_hidden boolean, canonical_artist_name string, reason string")
    got = M.artist_profiles(records, edits, said).orderBy("artist_name").select("artwork_count", "profile_url", "cleaned_artist_bio", "edited_bio", "artist_bio", "is_hidden", "canonical_artist_name", "moderation_reason").collect()
    assert [tuple(r) for r in got] == [(2, "u1", "Paints", "Edited", "Edited", False, None, None), (1, "u3", "Carves stone", None, "Carves stone", True, "Bee", "twice")]


def test_the_query_of_profiles_is_over_records_with_all_overlays(spark):
    from atelier.plans import registry

    got = registry.queries()["artist_profiles"](spark, "/root/testdata/sf0.001")
    assert {"artist_bio", "cleaned_artist_bio", "bio_quality_score", "edited_bio", "is_hidden", "canonical_artist_name"} <= set(got.columns)
    assert got.where("artist_name like 'The %'").count() > 0 and got.where("edited_bio is not null").count() > 0  # canonical names, edits


def test_the_mart_of_galleries_holds_all_links(spark):
    schema = "raw_gallery_id string, source_domain string, source_record_id string, source_url string, normalized_gallery_key string, crawl_timestamp timestamp, created_at timestamp, n_gallery_name string, n_city string, n_country string"
    halls = spark.createDataFrame([("g1", "d", "1", "u", "k1", None, None, "hall", "c", "x"), ("g2", "d", "2", "u", "k2", None, None, "room", "c", "x")], schema)
    events = spark.range(2500).selectExpr("cast(id AS string) AS event_id", "'t' AS event_title", "'Hall' AS venue_name", "'C' AS city", "'X' AS country", "'d' AS source_domain")
    works = spark.range(1500).selectExpr("cast(id AS string) AS raw_artwork_id", "'w' AS artwork_title", "'Room' AS gallery_name", "'d' AS source_domain")
    got = {r.raw_gallery_id: r for r in M.mart_galleries(halls, events, works).collect()}
    assert [e.event_id for e in got["g1"].linked_events] == sorted(map(str, range(2500))) and got["g1"].n_linked_events == 2500 and got["g1"].linked_artworks == []
    assert [w.raw_artwork_id for w in got["g2"].linked_artworks] == sorted(map(str, range(1500))) and got["g2"].n_linked_artworks == 1500 and got["g2"].n_linked_events == 0


def test_the_bundle_of_an_event_holds_all_its_artists(spark, monkeypatch):
    from atelier.plans import queries as Q
    from atelier.plans import record_queries as RQ
    from atelier.sources.adapters import Tables

    people = spark.range(1200).selectExpr("'0' AS event_id", "cast(id AS string) AS artist_id", "concat('A', cast(id % 600 AS string)) AS artist_name")
    monkeypatch.setattr(Q, "links", lambda t: people)
    t = Tables(spark, "/root/testdata/sf0.001")
    t.staged = True
    got = RQ.event_bundle(t).where("event_id = '0'").first().artists.split(",")
    assert got == sorted(f"A{i % 600}" for i in range(1200))


def test_galleries_make_no_mentions(spark, monkeypatch):
    from atelier.plans import queries as Q
    from atelier.plans import record_queries as RQ
    from atelier.sources.adapters import Tables

    monkeypatch.setattr(M, "mentions", lambda *a, **k: pytest.fail("galleries need no mentions"))
    t = Tables(spark, "/root/testdata/sf0.001")
    t.staged = True
    assert RQ.galleries(t).count() > 0 and Q.mart_galleries.__name__ == "mart_galleries" and Q.mart_galleries(t).count() > 0


def test_rules_of_one_pattern_and_domain_count_once(spark):
    """Of 300 rules with one pattern the surest alone meets the texts; long patterns are found by a part."""
    schema = "field_name string, pattern string, suggested_value string, source_domain string, is_active boolean, support_count long, updated_at long, confidence double"
    rules = [("event_type", " Ab", f"v{i}", None if i % 2 else "d", True, i, 0, 0.5) for i in range(300)] + [("event_type", "a long pattern", "long", None, True, 1000, 0, 0.5), ("event_type", "a long patterns", "no", None, True, 2000, 0, 0.9)]
    events = [(1, "d", "x ab", None), (2, "e", "AB", "y"), (3, "e", "Ab of", "A long pattern"), (4, "d", "", None), (5, "d", "long pattern", None)]
    e, r = spark.createDataFrame(events, "event_id long, source_domain string, event_title string, description string"), spark.createDataFrame(rules, schema)
    loop, grams = D.rule_match(e, r), D.rule_match(e, r, few=0)
    assert sorted(map(tuple, grams.collect())) == sorted(map(tuple, loop.collect())) == [(1, "v299", 0.5), (2, "v299", 0.5), (3, "long", 0.5)]
    assert "SortAggregate" not in grams._jdf.queryExecution().sparkPlan().toString()


def test_the_search_finds_whole_words_without_cutting_texts(spark):
    """Once for a field, however often it is there; texts are looked through and not cut into all their words."""
    rows = [("1", "Oil and OIL, steel", "an oil", None, None, None), ("2", "oils o'il", None, "Oil steel", None, "x"), ("3", "#oil oil#1", "OIL STEEL", "", None, "steel")]
    works = spark.createDataFrame(rows, "id string, artwork_title string, artist_name string, medium_text string, description string, source_name string")
    found = S.record_search(works, " Steel  oil ")
    assert {r.id: r.score for r in found.collect()} == {"1": 9, "2": 2, "3": 7} and S.record_search(works, "oil steel", exact=10).where("id = '3'").first().score == 17
    assert "split(" not in found._jdf.queryExecution().optimizedPlan().toString() and S.record_search(works, "o'il").count() == 0
