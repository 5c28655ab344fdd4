"""Rows from web pages: one pass over the HTML gives elements, everything after is columns."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atelier.functions import text as X
from atelier.functions.parse import date_range_parse, opening_datetime_parse
from atelier.operators.tables import latest_per_key

_BLOCKS = frozenset("article blockquote body dd div dl dt figcaption footer h1 h2 h3 h4 h5 h6 header li main nav ol p section td th tr ul".split())
_ELEMENTS = ["page_id long", "url string", "title string", "headings array<string>", "blocks array<string>", "links array<struct<href: string, text: string>>", "images array<struct<src: string, alt: string, title: string>>", "meta array<struct<name: string, content: string>>", "json_ld array<string>"]


_TREE = "array<struct<at: int, last: int, up: int, tag: string, classes: string, id: string, mark: string, text: string>>"
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_UNREAD = frozenset(("script", "style", "noscript", "template"))
#: What stands between < and >: a tag whose attributes are quoted and free of references, an end tag, or the document type.
_PLAIN = re.compile(r'([a-zA-Z][a-zA-Z0-9]*+)((?:\s++[a-zA-Z][-a-zA-Z]*+="[^"&]*+")*+)\s*+(/?)|/([a-zA-Z][a-zA-Z0-9]*+)|![dD][oO][cC][tT][yY][pP][eE] html')
_ATTRIBUTE = re.compile(r'([a-zA-Z][-a-zA-Z]*+)="([^"&]*+)"')
#: Elements whose content HTMLParser reads in ways of its own.
_ODD = frozenset("iframe math noembed noframes noscript plaintext svg textarea xmp".split())
_SILENT = frozenset(("title", "script", "style", "json"))
_RAW = frozenset(("script", "style", "title"))
_HELD = frozenset(("title", "script", "style", "h1", "h2", "h3"))
#: Tags as they were read before, of those met first: most pages repeat them.
_TAGS: dict[str, tuple[str, list[tuple[str, str]], str] | None] = {}
_MOST_TAGS = 4096


def _tag(inner: str) -> tuple[str, list[tuple[str, str]], str] | None:
    """(name, attributes, kind) of what stands between < and >; kind is "" for a start, "/" for an element closed at once, "end" for an end and "type" for the document type. None: no plain tag."""
    if (m := _PLAIN.fullmatch(inner)) is None:
        found = None
    else:
        name, attributes, closed, end = m.groups()
        if name is None:
            found = (end.lower(), [], "end") if end else ("", [], "type")
        else:
            name = name.lower()
            found = None if name in _ODD else (name, [(k.lower(), v) for k, v in _ATTRIBUTE.findall(attributes)] if attributes else [], closed)
    if len(_TAGS) < _MOST_TAGS:
        _TAGS[inner] = found
    return found


#: Pages that are read before they become columns.
_ROWS = 1000


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title, self.headings, self.blocks, self.links, self.images, self.meta, self.json_ld = "", [], [], [], [], [], []
        self.text: list[str] = []
        self.inside = ""  # title, heading, script kind
        self.link: list | None = None
        self.part: list[str] = []

    def read(self, html: str) -> bool:
        """Reads a page of plain tags, giving the handlers what feed() and close() would, in a fraction of the time; False at anything else: such a page is fed."""
        parts = html.split("<")
        start, startend, end, data, tags = self.handle_starttag, self.handle_startendtag, self.handle_endtag, self.handle_data, _TAGS
        if parts[0]:
            data(unescape(parts[0]) if "&" in parts[0] else parts[0])
        at, size = 1, len(parts)
        while at < size:
            inner, closing, text = parts[at].partition(">")
            at += 1
            known = tags[inner] if inner in tags else _tag(inner)
            if known is None or not closing:
                return False
            tag, attrs, kind = known
            if kind == "end":
                end(tag)
            elif kind == "":
                if tag in _RAW:
                    stop = f"/{tag}>"
                    while at < size and not parts[at].startswith(stop):
                        text = f"{text}<{parts[at]}"
                        at += 1
                    held = text.lower()
                    if at == size or f"</{tag}" in held or "<!--" in held or (tag == "title" and "<" in held):
                        return False
                    start(tag, attrs)
                    if text:
                        data(unescape(text) if tag == "title" and "&" in text else text)
                    continue
                start(tag, attrs)
            elif kind == "/":
                if tag in _RAW:
                    return False
                startend(tag, attrs)
            if text:
                data(unescape(text) if "&" in text else text)
        return True

    def flush(self) -> None:
        block = " ".join("".join(self.text).split())
        if block:
            self.blocks.append(block)
        self.text = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _BLOCKS and self.text:
            self.flush()
        if not attrs and tag not in _HELD:
            return
        a = {k: v or "" for k, v in attrs}
        if tag in _HELD:
            self.inside, self.part = ("json" if tag == "script" and a.get("type") == "application/ld+json" else tag), []
        elif tag == "a" and a.get("href"):
            self.link = [a["href"], "", 0]  # href, text, at
            self.links.append(self.link)
        elif tag == "img" and a.get("src"):
            self.images.append([a["src"], a.get("alt"), a.get("title"), 0])  # the last: at
        elif tag == "meta" and (name := a.get("property") or a.get("name")):
            self.meta.append((name, a.get("content")))

    def handle_endtag(self, tag: str) -> None:
        if tag in _HELD:
            found = " ".join("".join(self.part).split())
            if self.inside == "title":
                self.title = found
            elif self.inside == "json":
                self.json_ld.append("".join(self.part))
            elif self.inside.startswith("h") and found:
                self.headings.append(found)
            self.inside = ""
        elif tag == "a":
            self.link = None
        if tag in _BLOCKS and self.text:
            self.flush()

    def handle_data(self, data: str) -> None:
        if self.inside:
            self.part.append(data)
        if self.inside not in _SILENT:
            self.text.append(data)
        if self.link is not None:
            self.link[1] = " ".join((self.link[1] + data).split())


class _Tree(_Page):
    """The page with its nodes in document order: an element's own place (from 1), its subtree's last place and its parent's place (0: none).

    Texts are nodes of tag #text. classes is the class words between blanks, mark the itemprop and data-testid, as name=value between blanks.
    An end tag closes what is open inside its element; one that closes nothing is left out. A block closes an open paragraph, a list item the one before it.
    """

    def __init__(self) -> None:
        super().__init__()
        self.tree: list[list] = []  # at, last, up, tag, classes, id, mark, text
        self.open: list[list] = []

    def _close(self, depth: int) -> None:
        last = len(self.tree)
        for node in self.open[depth:]:
            node[1] = last
        del self.open[depth:]

    def _innermost(self, tag: str, stop: tuple[str, ...] = ()) -> int | None:
        depth = len(self.open)
        for node in reversed(self.open):
            depth -= 1
            if node[3] == tag:
                return depth
            if node[3] in stop:
                return None
        return None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        links, images = len(self.links), len(self.images)
        super().handle_starttag(tag, attrs)
        closes = self._innermost("p", ("table", "td", "button")) if self.open and tag in _BLOCKS else None
        if closes is None and tag in ("li", "dt", "dd", "option"):
            closes = self._innermost(tag, ("ul", "ol", "dl", "select"))
        if closes is not None:
            self._close(closes)
        at = len(self.tree) + 1
        node = [at, at, self.open[-1][0] if self.open else 0, tag, "  ", "", "", None]
        if attrs:
            a = {k: v or "" for k, v in attrs}
            if "class" in a:
                node[4] = f" {' '.join(a['class'].split())} "
            node[5] = a.get("id", "")
            if "itemprop" in a or "data-testid" in a:
                node[6] = "".join(f" {k}={a[k].strip()} " for k in ("itemprop", "data-testid") if a.get(k))
            for found in (*self.links[links:], *self.images[images:]):
                found[-1] = at
        self.tree.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        super().handle_endtag(tag)
        if (depth := self._innermost(tag)) is not None:
            self._close(depth)

    def handle_data(self, data: str) -> None:
        super().handle_data(data)
        if not (self.open and self.open[-1][3] in _UNREAD) and (text := " ".join(data.split())):
            at = len(self.tree) + 1
            self.tree.append([at, at, self.open[-1][0] if self.open else 0, "#text", "", "", "", text])

    def close(self) -> None:
        super().close()
        self._close(0)


def _read(kind: type[_Page], html: str) -> _Page:
    page = kind()
    if not page.read(html):
        page = kind()
        page.feed(html)
    page.close()
    page.flush()
    return page


def page_elements(pages: DataFrame, *, tree: bool = False, only: Sequence[str] | None = None) -> DataFrame:
    """Title, headings, text blocks, links, images, meta fields and JSON-LD texts of each page, and on demand its tree; null html has none.

    only: the columns, beside page_id and url, that leave the reader; by default all.
    """
    kinds = {c.split(" ", 1)[0]: c for c in _ELEMENTS}
    if tree:
        kinds |= {"links": kinds["links"].replace("text: string", "text: string, at: int"), "images": kinds["images"].replace("title: string", "title: string, at: int"), "tree": f"tree {_TREE}"}
    names = [n for n in kinds if n not in ("page_id", "url") and (only is None or n in only)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = pa.list_(pa.string())
        at = ["at"] * tree

        def listed(rows: list[list], columns_of: str) -> pa.Array:
            """The pages' rows column by column: rows of tuples would be taken apart one field at a time."""
            fields = [(n, pa.int32() if n in ("at", "last", "up") else pa.string()) for n in columns_of.split()]
            columns = [*zip(*chain.from_iterable(rows))] or [()] * len(fields)
            held = pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])
            return pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, rows))], pa.int32()), held)

        for batch in (whole.slice(first, _ROWS) for whole in batches for first in range(0, whole.num_rows, _ROWS)):
            done = [_read(_Tree if tree else _Page, html or "") for html in batch.column("html").to_pylist()]
            made = {
                "title": lambda: pa.array([p.title or None for p in done], pa.string()), "headings": lambda: pa.array([p.headings for p in done], texts), "blocks": lambda: pa.array([p.blocks for p in done], texts),
                "links": lambda: listed([p.links for p in done], " ".join(["href text", *at])), "images": lambda: listed([p.images for p in done], " ".join(["src alt title", *at])), "meta": lambda: listed([p.meta for p in done], "name content"),
                "json_ld": lambda: pa.array([p.json_ld for p in done], texts), "tree": lambda: listed([p.tree for p in done], "at last up tag classes id mark text"),
            }
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), *(made[n]() for n in names)], names=["page_id", "url", *names])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, ", ".join(kinds[n] for n in ("page_id", "url", *names)))


def absolute(base: Column, href: Column) -> Column:
    """href against the page's URL: absolute, from the host, or beside the page."""
    host = F.regexp_extract(base, "^([a-z]+://[^/?#]+)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, "[?#].*$", ""), "[^/]*$", "")
    folder = F.when(F.length(folder) <= F.length(host) + 1, F.concat(host, F.lit("/"))).otherwise(folder)
    return F.when(href.rlike("^[a-z]+://"), href).when(href.startswith("//"), F.concat(F.lit("https:"), href)).when(href.startswith("/"), F.concat(host, href)).when(~href.rlike("^(?:#|mailto:|tel:|javascript:)"), F.concat(folder, href))


def page_links(elements: DataFrame, classes: dict[str, str]) -> DataFrame:
    """Distinct (page_id, url, class) of the absolute canonical links; class is the first whose pattern the URL matches, else other."""
    links = elements.select("page_id", F.col("url").alias("base"), F.explode("links").alias("l"))
    url = X.url_canonicalize(absolute(F.col("base"), F.col("l.href")))
    kind = F.coalesce(*(F.when(F.col("url").rlike(p), F.lit(k)) for k, p in classes.items()), F.lit("other"))
    return links.select("page_id", url.alias("url")).where("url is not null").distinct().withColumn("class", kind)


def json_ld(elements: DataFrame, kind: str, *, keep: list[str] | None = None) -> DataFrame:
    """(page_id, url, item) of the JSON-LD objects of a type: single documents, arrays and graphs; and the page's columns that are to be kept."""
    keep = keep or []
    docs = elements.select("page_id", "url", *keep, F.explode("json_ld").alias("j"))
    one = F.from_json("j", "`@type` string, `@graph` array<string>")
    many = F.from_json("j", "array<string>")
    items = F.when(F.ltrim("j").startswith("["), many).when(one["@graph"].isNotNull(), one["@graph"]).otherwise(F.array("j"))
    found = docs.select("page_id", "url", *keep, F.explode(items).alias("item"))
    return found.where(F.get_json_object("item", "$.@type") == kind)


def json_ld_artworks(elements: DataFrame) -> DataFrame:
    """Artwork rows of VisualArtwork objects; the creator may be a text, an object or a list. What JSON-LD lacks comes from the page: its image, its heading."""
    get = lambda path: F.nullif(F.trim(F.get_json_object("item", path)), F.lit(""))
    creator = F.coalesce(get("$.creator.name"), get("$.creator[0].name"), get("$.creator[0]"), F.when(~get("$.creator").rlike(r"^[\[{]"), get("$.creator")))
    creator = F.when(~creator.startswith("{"), creator)
    rows = json_ld(elements, "VisualArtwork", keep=["headings", "images"])
    image = absolute(F.col("url"), F.coalesce(get("$.image.url"), F.when(~get("$.image").rlike(r"^[\[{]"), get("$.image")), F.get(F.col("images"), F.lit(0))["src"]))
    place = F.coalesce(get("$.locationCreated.address.addressLocality"), get("$.locationCreated.name"))
    return rows.select(
        "page_id", F.coalesce(get("$.url"), F.col("url")).alias("source_url"), F.coalesce(get("$.name"), F.get("headings", F.lit(0))).alias("artwork_title"), creator.alias("artist_name"),
        get("$.dateCreated").alias("artwork_date_text"), get("$.artMedium").alias("medium_text"), image.alias("image_url"), place.alias("city"), get("$.isPartOf.name").alias("institution_name"),
    )


def json_ld_collections(elements: DataFrame) -> DataFrame:
    """Distinct (name, city) of the collections that artworks are part of, with how many works each has."""
    return json_ld_artworks(elements).where("institution_name is not null").groupBy(F.col("institution_name").alias("name"), "city").agg(F.count("*").alias("n_artworks"))


def json_get(payload: Column, keys: list[str], *, default: str = "[]") -> Column:
    """The first of the keys' values, as text, that a JSON object has; the default without any."""
    return F.coalesce(*(F.nullif(F.get_json_object(payload, f"$.{k}"), F.lit("")) for k in keys), F.lit(default))


#: Headings that name a section, not a person.
LABELS = ["about the artist", "artworks", "biography", "exhibitions", "contact", "home", "selected works", "latest work"]


def strict_references(html: Column) -> Column:
    """html whose references need their semicolon (&amp alone does without): a text that was cut inside one keeps its letters, as parsers would decode &quot but not &quo."""
    return F.regexp_replace(html, "&(?!amp)(?=[A-Za-z][A-Za-z0-9]*+(?!;))", "&amp;")


def artist_name(elements: DataFrame) -> DataFrame:
    """(page_id, artist_name): the first heading that is no section label, else the title before a bar or dash, else the URL's slug."""
    heading = F.try_element_at(F.filter("headings", lambda h: ~F.lower(h).isin(LABELS) & ~F.contains(h, F.lit(":")) & (F.length(h) <= 60)), F.lit(1))
    title = X.clean_text(F.regexp_extract("title", r"^(.+?)(?:\s+[|–-]\s+.*)?$", 1))
    return elements.select("page_id", F.coalesce(heading, F.when(F.length(title) <= 60, title), X.artist_name_from_slug(F.col("url"))).alias("artist_name"))


def artist_bio(elements: DataFrame, *, most: int = 3, shortest: int = 80) -> DataFrame:
    """(page_id, biography, candidates, fallback_used): the first distinct long blocks that are neither contacts nor navigation; else the longest of the shorter ones."""
    plain = F.filter("blocks", lambda b: ~X.contains_email(b) & ~F.contains(b, F.lit("|")) & ~F.lower(b).isin(LABELS))
    good = F.filter(plain, lambda b: F.length(b) >= shortest)
    first = F.array_join(F.slice(F.array_distinct(good), 1, most), "\n\n")
    longest = F.array_max(F.transform(F.filter(plain, lambda b: F.length(b) >= shortest // 2), lambda b: F.struct(F.length(b).alias("n"), b.alias("b"))))["b"]
    return elements.select("page_id", F.coalesce(F.nullif(first, F.lit("")), longest).alias("biography"), F.size(good).alias("candidates"), ((F.size(good) == 0) & longest.isNotNull()).alias("fallback_used"))


NOT_ARTWORK = "logo|icon|banner|avatar|sprite|placeholder|spacer|pixel"


def artworks(elements: DataFrame) -> DataFrame:
    """One row a distinct image that may be an artwork, in page order: title by alt, title or file name."""
    images = elements.select("page_id", F.col("url").alias("base"), F.posexplode("images").alias("position", "i"))
    url = absolute(F.col("base"), F.col("i.src"))
    name = F.initcap(F.regexp_replace(F.regexp_extract(url, r"/([^/?#]+)\.[A-Za-z]{3,4}(?:[?#].*)?$", 1), "[-_]+", " "))
    rows = images.select("page_id", "position", url.alias("image_url"), X.title_infer(F.col("i.alt"), F.col("i.title"), name).alias("artwork_title"))
    kept = rows.where(F.col("image_url").isNotNull() & ~F.lower(F.concat_ws(" ", "image_url", "artwork_title")).rlike(NOT_ARTWORK))
    return latest_per_key(kept, ["page_id", "image_url"], [F.asc("position")])


def events(elements: DataFrame) -> DataFrame:
    """(page_id, title, start_date, end_date, description) of the blocks that hold a date."""
    blocks = elements.select("page_id", F.posexplode("blocks").alias("position", "b"))
    d = date_range_parse(F.col("b"))
    return blocks.withColumn("d", d).where("d.start_date is not null").select("page_id", "position", F.trim(F.regexp_extract("b", r"^(.*?)\s*[0-9]{1,2} [A-Za-z]{3,9} [0-9]{4}", 1)).alias("title"), "d.start_date", "d.end_date", F.col("b").alias("description"))


def extraction_stats(rows: DataFrame, reason: Column, *, by: list[str] | None = None) -> DataFrame:
    """Rows by reason, and by the columns of `by` (as the artist) before it."""
    return rows.groupBy(*(by or []), reason.alias("reason")).agg(F.count("*").alias("n"))


def event_page(elements: DataFrame, *, cities: list[str]) -> DataFrame:
    """One row a page of an event: title, type, venue, address, city, dates, opening, image, artists (name, profile_url), contact, record id."""
    text = F.array_join("blocks", "\n")
    title = F.coalesce(F.try_element_at(F.filter("headings", lambda h: ~F.lower(h).isin(LABELS)), F.lit(1)), F.col("title"))
    dated = F.array_join(F.filter("blocks", lambda b: ~F.lower(b).rlike("opening|closing")), "\n")
    meta = F.try_element_at(F.filter("meta", lambda m: m["name"] == "og:image"), F.lit(1))["content"]
    profiles = F.transform(F.filter("links", lambda x: x["href"].rlike("/artists?/[^/?#]")), lambda x: F.struct(X.clean_text(x["text"]).alias("name"), x["href"].alias("href")))
    e = elements.withColumns({"_text": text, "_title": title, "_d": X.let(date_range_parse(dated), lambda d: d), "_profiles": profiles, "description": F.array_join(F.slice("blocks", 1, 8), "\n")})
    named = F.array_distinct(F.concat(F.coalesce(X.split_artist_names(X.label_value(F.col("_text"), ["artists?", "featuring"])), F.expr("cast(array() as array<string>)")), F.filter(F.transform("_profiles", lambda p: p["name"]), lambda n: n.isNotNull())))
    url = lambda n: F.try_element_at(F.filter("_profiles", lambda p: p["name"] == n), F.lit(1))["href"]
    e = e.withColumn("artists", F.transform(named, lambda n: F.struct(n.alias("name"), absolute(F.col("url"), url(n)).alias("profile_url"))))
    domain = F.regexp_replace(F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1), r"^www\.", "")
    return e.select(
        "page_id", F.col("url").alias("source_url"), domain.alias("source_domain"), X.source_record_id("event", domain, F.col("url"), F.col("_title")).alias("source_record_id"), F.col("_title").alias("event_title"),
        X.event_type_from_url_text(F.col("url"), F.col("_title")).alias("event_type"), X.label_value(F.col("_text"), ["venue"]).alias("venue_name"), X.label_value(F.col("_text"), ["address"]).alias("venue_address"),
        X.city_gazetteer(F.concat_ws(" ", "_text", "url"), cities).alias("city"), F.col("_d.start_date").alias("start_date"), F.col("_d.end_date").alias("end_date"), opening_datetime_parse(F.col("_text")).alias("opening_datetime"), "description",
        absolute(F.col("url"), F.coalesce(meta, F.get(F.col("images"), F.lit(0))["src"])).alias("image_url"), "artists", X.contact_extract(F.col("_text"), F.transform("links", lambda x: x["href"])).alias("contact"),
    )


def event_page_artists(events: DataFrame) -> DataFrame:
    return events.select("source_record_id", "source_url", F.explode("artists").alias("a")).select("source_record_id", "source_url", F.col("a.name").alias("artist_name"), X.normalize_person_name(F.col("a.name")).alias("artist_name_normalized"), F.col("a.profile_url").alias("artist_profile_url"), F.lit("parsed").alias("match_type"))


def event_page_images(events: DataFrame) -> DataFrame:
    return events.where("image_url is not null").select("source_record_id", "source_url", "image_url", F.lit("primary").alias("image_type"), X.content_hash(F.col("source_url"), F.col("image_url"), F.col("event_title")).alias("content_hash"))


def event_page_galleries(events: DataFrame) -> DataFrame:
    """The venues, one row each (domain, name, city), with the first contact that a page gives."""
    rows = events.where("venue_name is not null").select("source_domain", F.col("venue_name").alias("gallery_name"), F.col("venue_address").alias("address"), "city", F.col("contact.email").alias("email"), F.col("contact.phone").alias("phone"), "page_id")
    return latest_per_key(rows, ["source_domain", "gallery_name", "city"], [F.asc("page_id")])
