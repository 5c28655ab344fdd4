"""Rules about parts of a page: sections, containers and scopes, over the tree that page_elements(tree=True) gives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atelier.functions import text as X
from atelier.functions.parse import date_range_parse, opening_datetime_parse
from atelier.operators.extract import absolute

HEADINGS = ["h1", "h2", "h3", "h4"]
#: Containers of biographies, in order of preference: tag, attribute, value.
BIOGRAPHIES = [
    ("div", "class", "about"), ("div", "id", "about"), ("section", "class", "bio"), ("section", "id", "bio"), ("section", "class", "biography"), ("div", "class", "biography"),
    ("article", "class", "bio"), ("article", "class", "biography"),
]
#: Classes of biographies inside <main>.
MAIN_BIOGRAPHIES = ["bio", "about"]
#: Words of headings of biographies; words of blocks that are none.
BIOGRAPHY_HEADINGS = ["about", "biography", "artist statement", "bio"]
JUNK = ["about the artist", "artworks ▼", "follow", "facebook", "instagram", "twitter", "menu", "navigation", "contact", "copyright", "all rights reserved"]
#: Texts of buttons that stand where a title or a venue may.
BUTTONS = ["save event", "save this event", "saved", "share", "add to calendar", "login", "follow"]
#: Parts of image paths, and words of file names and titles, that aren't works.
CHROME_IMAGES = ["follow.png", "top-facebook.png", "facebook", "instagram", "twitter", "logo", "icon", "banner", "header", "footer", "nav"]
NOT_WORKS = ["artist photo", "studio", "cv", "biography", "bio", "portrait", "profile", "front001", "frontpage", "front page"]
SHORTEST, BROAD = 40, 80

Test = Callable[[Column], Column]


def has_class(n: Column, word: str) -> Column:
    return F.contains(n["classes"], F.lit(f" {word} "))


def texts_in(tree: Column, n: Column) -> Column:
    """The texts of a node's subtree, in order."""
    return F.filter(F.transform(F.slice(tree, n["at"], n["last"] - n["at"] + 1), lambda x: x["text"]), lambda x: x.isNotNull())


def text_of(tree: Column, n: Column) -> Column:
    return F.array_join(texts_in(tree, n), " ")


def inside(tree: Column, box: Test, node: Test) -> Column:
    """The nodes below a container: those that `node` accepts, in the subtree of one that `box` accepts."""
    return X.let(F.filter(tree, box), lambda boxes: F.filter(tree, lambda n: node(n) & F.exists(boxes, lambda b: (n["at"] > b["at"]) & (n["at"] <= b["last"]))))


def own_texts(tree: Column, nodes: Column, tags: list[str]) -> Column:
    """Of some text nodes, the texts that stand directly in an element of one of the tags."""
    return F.transform(F.filter(nodes, lambda n: F.coalesce(F.get(tree, n["up"] - 1)["tag"].isin(tags), F.lit(False))), lambda n: n["text"])


def is_text(n: Column) -> Column:
    return n["tag"] == "#text"


def after_heading(tree: Column, h: Column, most: int = 6) -> Column:
    """The heading's section: its next siblings, `most` of them, up to the next heading."""
    siblings = F.slice(F.filter(tree, lambda s: (s["up"] == h["up"]) & (s["at"] > h["at"]) & ~is_text(s)), 1, most)
    stop = lambda xs: F.array_position(F.transform(xs, lambda s: s["tag"].isin(HEADINGS)), F.lit(True)).cast("int")
    return X.let(siblings, lambda xs: F.slice(xs, F.lit(1), F.when(stop(xs) > 0, stop(xs) - 1).otherwise(F.size(xs))))


def _block(c: Column) -> Column:
    marked = F.regexp_replace(c, r"(?i)\s*artworks\s*[▼»]+\s*", " ")
    return F.trim(F.regexp_replace(X.contact_redact(marked), r"\s+", " "))


def _junk(c: Column) -> Column:
    return (F.length(c) < SHORTEST) | X.let(F.lower(c), lambda low: F.exists(F.array(*map(F.lit, JUNK)), lambda w: F.contains(low, w)))


def biography(elements: DataFrame, *, most: int = 3) -> DataFrame:
    """(page_id, biography, candidates, fallback_used): the first distinct blocks of containers, then of sections under a heading, that are about a person.

    Without any, long blocks of the page's body are looked at, and dropped again if all of those chosen are chrome.
    """
    tree = F.col("tree")
    of = lambda tag, kind, value: F.filter(tree, lambda n: (n["tag"] == tag) & (has_class(n, value) if kind == "class" else n["id"] == value))
    main = lambda word: inside(tree, lambda b: b["tag"] == "main", lambda n: has_class(n, word))
    boxes = F.flatten(F.array(*[of(*x) for x in BIOGRAPHIES], *[main(w) for w in MAIN_BIOGRAPHIES]))
    heads = F.filter(tree, lambda n: n["tag"].isin(HEADINGS) & F.lower(text_of(tree, n)).rlike("|".join(BIOGRAPHY_HEADINGS)))
    sections = F.transform(heads, lambda h: F.array_join(F.transform(after_heading(tree, h), lambda s: text_of(tree, s)), " "))
    found = F.filter(F.transform(F.concat(F.transform(boxes, lambda n: text_of(tree, n)), sections), _block), lambda b: ~_junk(b))
    body = inside(tree, lambda b: b["tag"] == "body", lambda n: n["tag"].isin("p", "div"))
    parts = inside(tree, lambda b: b["tag"] == "main", lambda n: n["tag"] == "section")
    broad = F.transform(F.array_sort(F.array_union(body, parts)), lambda n: _block(text_of(tree, n)))
    broad = F.filter(broad, lambda b: (F.length(b) > BROAD) & ~F.contains(F.lower(b), F.lit("artwork")))
    e = elements.withColumn("_found", F.array_distinct(found)).withColumn("_all", F.when(F.size("_found") > 0, F.col("_found")).otherwise(F.array_distinct(broad)))
    chosen = F.slice("_all", 1, most)
    return e.select("page_id", F.when(F.exists(chosen, lambda b: ~_junk(b)), F.array_join(chosen, "\n\n")).otherwise("").alias("biography"), F.size("_all").alias("candidates"), (F.size("_found") == 0).alias("fallback_used"))


def artist(elements: DataFrame, *, site: str, overrides: dict[str, str] | None = None) -> DataFrame:
    """(page_id, artist_name): the first heading that is no label, else the title without what the site adds, else the URL's slug; a name that is chrome is none.

    site names the site as titles do; overrides are names by slug.
    """
    tree = F.col("tree")
    first = lambda test: F.try_element_at(F.transform(F.filter(tree, lambda n: is_text(n) & F.coalesce(test(F.get(tree, n["up"] - 1)), F.lit(False))), lambda n: n["text"]), F.lit(1))
    heads = F.array(first(lambda p: p["tag"] == "h1"), first(lambda p: p["tag"] == "h2"), first(lambda p: has_class(p, "artist-name")), first(lambda p: has_class(p, "entry-title")))
    heading = F.try_element_at(F.filter(heads, lambda h: h.isNotNull() & ~X.artist_label(h)), F.lit(1))
    title = X.let(X.artist_title(F.col("title"), site=site), lambda t: F.when(~X.artist_label(t), t))
    slug = F.lower(F.regexp_extract("url", r"^[a-z]+://[^/?#]+/([^/?#]+)", 1))
    of_slug = F.coalesce(*(F.when(slug == k, F.lit(v)) for k, v in (overrides or {}).items()), F.when(slug.rlike("[-_]"), F.initcap(F.trim(F.regexp_replace(slug, "[-_]+", " ")))))
    name = X.artist_name_clean(F.coalesce(heading, title, of_slug), site=site)
    return elements.select("page_id", X.let(name, lambda n: F.when(X.artist_name_valid(n, site=site), n)).alias("artist_name"))


def scoped_artworks(elements: DataFrame) -> DataFrame:
    """(page_id, position, image_url, artwork_title, slug, reason) of each distinct image of a page, in order; works have the reason kept.

    A work lies on the page's host, below a folder of the page's own slug, and neither its path nor its file name or title says that it is something else.
    """
    host = lambda u: F.regexp_replace(F.lower(F.regexp_extract(u, "^[a-z]+://([^/?#]+)", 1)), r"^www\.", "")
    path = lambda u: F.lower(F.regexp_extract(u, "^[a-z]+://[^/?#]+([^?#]*)", 1))
    words = lambda c: F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    images = elements.select("page_id", "url", F.posexplode("images").alias("position", "i"))
    at = images.select("page_id", "position", "url", absolute(F.col("url"), F.col("i.src")).alias("image_url"), F.col("i.alt").alias("alt"), F.col("i.title").alias("hint"))
    file = F.regexp_extract(F.col("image_url"), r"/([^/?#]*)(?:[?#].*)?$", 1)
    name = F.initcap(F.regexp_replace(F.regexp_replace(file, r"\.[A-Za-z]{3,4}$", ""), "[-_]+", " "))
    rows = at.select("*", F.lower(F.regexp_extract("url", r"^[a-z]+://[^/?#]+/([^/?#]+)", 1)).alias("slug"), X.title_infer(F.col("alt"), F.col("hint"), F.nullif(name, F.lit(""))).alias("artwork_title"), file.alias("_file"))
    # what is searched is made once, not once a word
    other = lambda c: X.let(words(c), lambda held: F.exists(F.array(*map(F.lit, NOT_WORKS)), lambda w: F.contains(held, w)))
    of_chrome = X.let(path(F.col("image_url")), lambda p: F.exists(F.array(*map(F.lit, CHROME_IMAGES)), lambda w: F.contains(p, w)))
    reason = (
        F.when(F.col("image_url").isNull() | (host(F.col("image_url")) != host(F.col("url"))), "other_host")
        .when(of_chrome, "chrome")
        .when((F.col("slug") == "") | ~F.contains(path(F.col("image_url")), F.concat(F.lit("/"), F.col("slug"), F.lit("/"))), "out_of_scope")
        .when(other(F.col("_file")) | other(F.col("artwork_title")), "not_a_work")
        .otherwise("kept")
    )
    first = rows.withColumn("reason", reason).groupBy("page_id", "image_url").agg(F.min_by(F.struct("position", "artwork_title", "slug", "reason"), "position").alias("r"))
    return first.select("page_id", "r.position", "image_url", "r.artwork_title", "r.slug", "r.reason")


def venue_event(elements: DataFrame, *, city: str | None = None, country: str | None = None) -> DataFrame:
    """One row a page of an event whose venue has a block of its own: title, type, dates, venue with address, city, country, website and social links, description, image.

    Marked properties go before the venue's block, that before labelled lines, and those before the title that search engines see; texts of buttons count nowhere.
    Dates come from the page's own texts. city and country are what the listing was asked for.
    """
    tree = F.col("tree")
    plain = F.array_join(F.col("_texts"), "\n")
    # one after the other: what a page says first leaves the rest unread
    usable = lambda *cs: F.coalesce(*(X.let(F.trim(F.regexp_replace(c, r"\s+", " ")), lambda v: F.when((v != "") & ~F.lower(v).isin(BUTTONS), v)) for c in cs))
    prop = lambda name: F.try_element_at(F.filter("_marked", lambda n: F.contains(n["mark"], F.lit(f" itemprop={name} "))), F.lit(1))["text"]
    venue = lambda n: n["classes"].rlike("venue|location") | n["mark"].rlike("data-testid=[^ ]*venue")
    body = lambda n: n["tag"].isin("article", "main") | F.contains(n["classes"], F.lit("description"))
    first = lambda xs: F.try_element_at(xs, F.lit(1))
    meta = lambda name: first(F.transform(F.filter("meta", lambda m: m["name"] == name), lambda m: m["content"]))
    blocks = ["p", "li", "div", "span"]
    marks = F.transform(F.filter(tree, is_text), lambda n: F.struct(F.get(tree, n["up"] - 1)["mark"].alias("mark"), n["text"].alias("text")))
    e = elements.withColumns({
        "_marked": F.filter(marks, lambda n: F.contains(n["mark"], F.lit(" itemprop="))), "_texts": own_texts(tree, F.filter(tree, is_text), blocks), "_venue": own_texts(tree, inside(tree, venue, is_text), ["h2", "h3", "strong", "a"]),
        "_main": own_texts(tree, inside(tree, body, is_text), blocks), "_h1": own_texts(tree, F.filter(tree, is_text), ["h1"]), "_seo": X.let(X.seo_title_parse(F.coalesce("title", meta("og:title"))), lambda x: x),
        "_near": inside(tree, lambda n: venue(n) | n["tag"].isin("article", "main"), lambda n: n["tag"] == "a"), "_category": own_texts(tree, inside(tree, lambda n: F.contains(n["classes"], F.lit("category")), is_text), blocks),
    })
    host = lambda u: F.regexp_replace(F.lower(F.regexp_extract(u, "^[a-z]+://([^/?#]+)", 1)), r"^www\.", "")
    near = F.transform(F.filter("links", lambda x: F.exists("_near", lambda n: n["at"] == x["at"])), lambda x: absolute(F.col("url"), x["href"]))
    address = first(F.filter(F.col("_texts"), lambda x: F.lower(x).rlike(r"street|road|\brd\b|\bave\b|avenue|lane") & ~F.lower(x).isin(BUTTONS)))
    line = lambda labels: X.label_value(plain, labels)
    e = e.withColumn("_links", F.filter(near, lambda u: u.isNotNull())).withColumn("_d", X.let(date_range_parse(plain), lambda x: x))
    social = r"^(?:[a-z]+\.)?(?:instagram|facebook|twitter|linkedin|pinterest)\.com$"
    of = lambda name: first(F.filter("_links", lambda u: host(u) == name))
    kind = X.event_type_from_url_text(F.col("url"), F.concat_ws(" ", F.array_join("_category", " "), plain))
    image = F.coalesce(meta("og:image"), first(F.transform(F.filter("images", lambda i: F.exists(inside(tree, lambda n: n["tag"] == "article", lambda n: n["tag"] == "img"), lambda n: n["at"] == i["at"])), lambda i: i["src"])), F.get(F.col("images"), F.lit(0))["src"])
    domain = host(F.col("url"))
    title = usable(first(F.col("_h1")), F.col("_seo.title"))
    return e.select(
        "page_id", F.col("url").alias("source_url"), domain.alias("source_domain"), X.source_record_id("event", domain, F.col("url"), title).alias("source_record_id"), title.alias("event_title"),
        F.coalesce(kind, F.col("_seo.type"), F.lit("event")).alias("event_type"), usable(prop("name"), first(F.col("_venue")), line(["venue", "gallery"]), F.col("_seo.venue")).alias("venue_name"),
        usable(prop("streetAddress"), line(["address"]), address).alias("venue_address"), usable(prop("addressLocality"), line(["city"]), F.col("_seo.city"), F.lit(city)).alias("city"),
        usable(prop("addressCountry"), line(["country"]), F.lit(country)).alias("country"), F.col("_d.start_date").alias("start_date"), F.col("_d.end_date").alias("end_date"), opening_datetime_parse(plain).alias("opening_datetime"),
        F.coalesce(X.clean_text(meta("description")), F.nullif(F.array_join(F.slice("_main", 1, 8), "\n"), F.lit("")), F.nullif(F.left(plain, F.lit(2000)), F.lit(""))).alias("description"),
        absolute(F.col("url"), image).alias("image_url"), first(F.filter("_links", lambda u: (host(u) != domain) & ~host(u).rlike(social))).alias("website_url"), of("instagram.com").alias("instagram_url"), of("facebook.com").alias("facebook_url"),
    )


def venue_galleries(events: DataFrame) -> DataFrame:
    """The venues, one row each (domain, name, city, country) with the fields of its first page."""
    fields = ["page_id", "source_url", "venue_address", "website_url", "instagram_url", "facebook_url"]
    rows = events.where("venue_name is not null").groupBy("source_domain", F.col("venue_name").alias("gallery_name"), "city", "country").agg(F.min_by(F.struct(*fields), F.struct("page_id", "source_url")).alias("r"))
    key = X.slugify(F.concat_ws("-", "gallery_name", "city", "country"))
    return rows.select(
        "source_domain", F.concat_ws(":", "source_domain", F.lit("gallery"), key).alias("source_record_id"), F.coalesce("r.website_url", "r.source_url").alias("source_url"), "gallery_name", F.col("r.venue_address").alias("address"), "city", "country",
        "r.website_url", "r.instagram_url", "r.facebook_url",
    )
