"""Extraction from pages."""

import datetime as dt
import json

import pytest

from atelier.operators import extract as E


@pytest.fixture(scope="module")
def elements(spark):
    ld = json.dumps({"@graph": [{"@type": "VisualArtwork", "name": "Sea", "creator": [{"name": "Ann Lee"}], "dateCreated": "1998"}, {"@type": "Person", "name": "x"}]})
    html = f"""<html><head><title>Ann Lee | Site</title><meta property="og:title" content="T"><script type="application/ld+json">{ld}</script><script>var a = "<h1>no</h1>";</script></head>
    <body><h1>About the artist</h1><h2>Ann Lee</h2><p>{"She paints the sea. " * 8}</p><p>{"She paints the sea. " * 8}</p><p>Write to a@b.example {"now " * 30}</p>
    <a href="/artists/ann-lee/?utm_source=q#x">Ann</a><a href="b/c">C</a><a href="mailto:q@b.example">M</a><a href="/artists/ann-lee">again</a>
    <img src="/img/red-sea.jpg"><img src="/img/logo.png" alt="Logo"><img src="/img/red-sea.jpg" alt="Twice"><p>Grand show 12 March 2024 - 3 May 2024 at noon</p></body></html>"""
    pages = spark.createDataFrame([(1, "https://www.site.example/list/page.html?x=1", html), (2, "https://site.example/artists/bob-ray/", "<p>nothing"), (3, None, None)], "page_id long, url string, html string")
    return E.page_elements(pages).cache()


def test_elements(elements):
    rows = {r.page_id: r for r in elements.collect()}
    assert rows[1].title == "Ann Lee | Site" and rows[1].headings == ["About the artist", "Ann Lee"] and rows[1].meta[0].content == "T"
    assert rows[2].blocks == ["nothing"] and rows[3].blocks == []


def test_links(elements):
    got = {(r.url, r["class"]) for r in E.page_links(elements, {"artist": "/artists/"}).collect()}
    assert got == {("https://site.example/artists/ann-lee", "artist"), ("https://site.example/list/b/c", "other")}


def test_names_and_biographies(elements):
    assert {r.page_id: r.artist_name for r in E.artist_name(elements).collect()} == {1: "Ann Lee", 2: "Bob Ray", 3: None}
    bio = {r.page_id: r for r in E.artist_bio(elements).collect()}
    assert bio[1].biography == ("She paints the sea. " * 8).strip() and bio[1].candidates == 2 and bio[2].biography is None


def test_names_that_were_cut_inside_a_reference_keep_its_letters(spark):
    heads = ["Or token = &quot", "A &amp B &quot;C&quot; &lt;", "D &am", "E &amp; &ltF", "G & H"]
    pages = spark.createDataFrame([(i, "u", f"<title>{h}</title><h1>{h}</h1>") for i, h in enumerate(heads)], "page_id long, url string, html string")
    names = E.artist_name(E.page_elements(pages.withColumn("html", E.strict_references(pages["html"]))))
    assert [r.artist_name for r in names.orderBy("page_id").collect()] == ["Or token = &quot", 'A & B "C" <', "D &am", "E & &ltF", "G & H"]


def test_artworks_and_events(elements):
    assert [(r.image_url, r.artwork_title) for r in E.artworks(elements).collect()] == [("https://www.site.example/img/red-sea.jpg", "Red Sea")]
    assert [(r.title, r.start_date, r.end_date) for r in E.events(elements).collect()] == [("Grand show", dt.date(2024, 3, 12), dt.date(2024, 5, 3))]
    assert [(r.artist_name, r.artwork_title) for r in E.json_ld_artworks(elements).collect()] == [("Ann Lee", "Sea")]


@pytest.mark.parametrize("kind", [E._Page, E._Tree])
def test_plain_pages_are_read_as_the_parser_reads_them(kind):
    plain = '<!DOCTYPE html><html><head><title>A &amp; b</title><script type="application/ld+json">{"a": "<b>"}</script></head><body><h1>H</h1><p class="x  y">one &lt;two<br/>three<img src="a.png" alt="A"><ul><li>l<li>m</ul><a href="/q">link</a></body></html>'
    odd = ["<p>a < b</p>", "<title>a<b>c</title>", "<script><!-- </script> --></script>", "<textarea><p></textarea>", '<a href="x?a=1&b=2">q</a>', "<p>open", "<!-- c -->x", "<script src='x'/>y"]
    assert kind().read(plain)  # by the short way
    for html in [plain, *odd]:
        fed = kind()
        fed.feed(html)
        fed.close()
        fed.flush()
        got = E._read(kind, html)
        assert [getattr(got, c, None) for c in ("title", "headings", "blocks", "links", "images", "meta", "json_ld", "tree")] == [getattr(fed, c, None) for c in ("title", "headings", "blocks", "links", "images", "meta", "json_ld", "tree")]


def test_the_reader_gives_only_the_columns_asked_for(spark):
    pages = spark.createDataFrame([(1, "u", '<title>T</title><p class="x" itemprop="name">a <img src="i.png"> b</p>'), (2, "v", None)], "page_id long, url string, html string")
    some, every = E.page_elements(pages, tree=True, only=["title", "images", "tree"]), E.page_elements(pages, tree=True)
    assert some.columns == ["page_id", "url", "title", "images", "tree"]
    assert some.orderBy("page_id").collect() == every.select(*some.columns).orderBy("page_id").collect()
    assert [(n.tag, n.up, n.classes, n.mark) for n in some.where("page_id = 1").first().tree][2:4] == [("p", 0, " x ", " itemprop=name "), ("#text", 3, "", "")]
