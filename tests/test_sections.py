"""Rules about parts of pages: biographies, names, scoped images and venues, on pages of two sites' kinds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from atelier.functions import text as X
from atelier.operators import extract as E
from atelier.operators import sections as S

SITE = "Site.example"
PROFILE = "https://www.site.example/ann-lee/"
BIOS = {
    "good": f"""<html><head><title>Ann Lee | {SITE}</title></head><body><header><nav>Home Artists Artworks ▼ Contact</nav></header><main><h1>Ann Lee</h1>
      <div id="about"><h2>About the work</h2><p>Ann Lee is a painter from the Karoo whose canvases layer memory and migration in oil and ash.</p><p>She shows in Lagos and Oslo.</p></div>
      <section class="artworks"><article><img src="/ann-lee/one.jpg" alt="One"><figcaption>One</figcaption></article></section></main><footer>Copyright</footer></body></html>""",
    "noisy": """<html><body><div class="sidebar">About the Artist Artworks ▼ Follow us on Facebook</div><section class="wide bio"><h2>Biography</h2>
      <p>Sam Ray is a mixed-media artist from Pretoria; the work explores urban rhythms and found paper.</p><p>Email: sam@ray.example Phone: +27 11 222 3333</p></section><ul><li>Artworks ▼</li><li>Untitled</li></ul></body></html>""",
    "heading": f"""<body><h1>Nadia</h1><div><h3>Artist statement</h3>stray<p>{'Etchings of botanical archives and time. ' * 2}</p><p>Drawn in Oslo.</p><h3>Shows</h3><p>{'Not this part at all, it is about shows. ' * 2}</p></div></body>""",
    "many": "<body><h2>About</h2>" + "".join(f"<p>Part {i} of a text that is long enough.</p>" for i in range(9)) + "</body>",
    "none": '<body><h1>No Bio</h1><div class="gallery"><article><img src="/n/a.jpg"></article></div><nav>About the Artist Artworks ▼</nav></body>',
    "broad": f"<body><main><section><p>{'Works on paper and in wood, made by hand since a long time. ' * 2}</p></section></main></body>",
    "null": None,
}


@pytest.fixture(scope="module")
def bios(spark):
    df = spark.createDataFrame([(i, PROFILE, h) for i, h in enumerate(BIOS.values())], "page_id long, url string, html string")
    rows = {r.page_id: r for r in S.biography(E.page_elements(df, tree=True)).collect()}
    return {k: rows[i] for i, k in enumerate(BIOS)}


def test_biographies(bios):
    assert bios["good"].biography == "About the work Ann Lee is a painter from the Karoo whose canvases layer memory and migration in oil and ash. She shows in Lagos and Oslo.\n\nAnn Lee is a painter from the Karoo whose canvases layer memory and migration in oil and ash. She shows in Lagos and Oslo."
    noisy = bios["noisy"].biography
    assert "urban rhythms" in noisy and not {"Facebook", "sam@ray.example", "+27 11", "▼"} & {w for w in ("Facebook", "sam@ray.example", "+27 11", "▼") if w in noisy}
    assert bios["heading"].biography == ("Etchings of botanical archives and time. " * 2 + "Drawn in Oslo.") and bios["heading"].candidates == 1 and not bios["heading"].fallback_used
    assert bios["many"].biography == " ".join(f"Part {i} of a text that is long enough." for i in range(6))
    assert (bios["none"].biography, bios["none"].fallback_used) == ("", True) and bios["null"].biography == ""
    assert bios["broad"].fallback_used and bios["broad"].biography == ("Works on paper and in wood, made by hand since a long time. " * 2).strip()


@pytest.mark.parametrize(
    ("url", "title", "h1", "name"),
    [
        ("https://www.site.example/marriabooy/", f"Marria Booy | {SITE}", "Artist Statement", "Marria Booy"),
        ("https://www.site.example/grietmeul/", "About Griet Meul - South African Artists", "About Griet Meul", "Griet Meul"),
        ("https://www.site.example/x/", f"Emma Will | {SITE}", "Selected Works", "Emma Will"),
        ("https://www.site.example/x/", f"Chan Coe | {SITE}", "African Queens: Restoring History", "Chan Coe"),
        ("https://www.site.example/hosmat/", SITE, "Artist Statement", "Hos Mat"),
        ("https://www.site.example/ann-van_lee/page", SITE, "Artworks", "Ann Van Lee"),
        ("https://www.site.example/x/", SITE, f"Jo Ess | {SITE}", "Jo Ess"),
        ("https://www.site.example/quiz/", SITE, "Art Quiz", None),
        ("https://www.site.example/nobody/", None, "", None),
    ],
)
def test_artist_names(spark, url, title, h1, name):
    page = spark.createDataFrame([(1, url, f"<html><head><title>{title or ''}</title></head><body><h1>{h1}</h1></body></html>")], "page_id long, url string, html string")
    assert S.artist(E.page_elements(page, tree=True), site=SITE, overrides={"hosmat": "Hos Mat"}).first().artist_name == name


@pytest.mark.parametrize(("name", "label", "valid"), [("Selected works", True, True), ("About  Ann", True, True), ("Recent work", True, False), ("Ann: a life", True, True), ("Ann Lee", False, True), ("", True, False), (None, True, False), ("Watch list of May", False, False), (f"{SITE} news", False, False), ("Ann Lee Recent Work 2020", True, True)])
def test_labels_and_valid_names(spark, name, label, valid):
    r = spark.createDataFrame([(name,)], "n string").select(X.artist_label(F.col("n")).alias("label"), X.artist_name_valid(F.col("n"), site=SITE).alias("valid")).first()
    assert (r.label, r.valid) == (label, valid)


def test_images_in_the_scope_of_the_slug(spark):
    html = """<img src="/ann-lee/work-a.jpg" alt="Work A"><img src="/ann-lee/artworks/work-b.jpg"><img src="/images/free.jpg"><img src="/images/top-facebook.png"><img src="https://other.example/ann-lee/c.jpg"><img src="/ann-lee/studio-1.jpg">
      <img src="/ann-lee/front001.jpg"><img src="/ann-lee/d.jpg" alt="Artist photo"><img src="/ann-lee/work-a.jpg" alt="again"><img src="https://site.example/ann-lee/e.jpg" title="E">"""
    df = spark.createDataFrame([(1, PROFILE, html), (2, "https://www.site.example/", html), (3, PROFILE, None)], "page_id long, url string, html string")
    rows = S.scoped_artworks(E.page_elements(df)).collect()
    got = {r.image_url.rpartition("/")[2]: (r.reason, r.artwork_title) for r in rows if r.page_id == 1}
    assert got == {
        "work-a.jpg": ("kept", "Work A"), "work-b.jpg": ("kept", "Work B"), "free.jpg": ("out_of_scope", "Free"), "top-facebook.png": ("chrome", "Top Facebook"), "c.jpg": ("other_host", "C"), "studio-1.jpg": ("not_a_work", "Studio 1"),
        "front001.jpg": ("not_a_work", "Front001"), "d.jpg": ("not_a_work", "Artist photo"), "e.jpg": ("kept", "E"),
    }
    assert {r.reason for r in rows if r.page_id == 2} == {"out_of_scope", "chrome", "other_host"}


VENUE = """<html><head><meta property="og:image" content="/images/memory.jpg"></head><body><main><h1>Future Memory</h1><div class="category">Exhibitions</div><p>12 April 2026 - 18 May 2026</p>
  <section class="venue-details"><h2>Example Gallery</h2><p>Address: 10 Example Street, London</p><p>City: London</p><p>Country: United Kingdom</p><a href="https://gallery.example">Website</a><a href="https://www.instagram.com/gallery">I</a></section></main>
  <footer><a href="https://www.facebook.com/listing">F</a></footer></body></html>"""
SEO = """<html><head><title>Beyond Reflection - Exhibition at The Rose Gallery in London</title></head><body><main><h1>Save Event</h1><div class="venue-details"><p>Save Event</p></div></main></body></html>"""
MARKED = """<html><head><title>x</title><meta name="description" content="A show."></head><body><article><h1>Marks</h1><img src="a.png"><div data-testid="the-venue"><strong>Block</strong><span itemprop="name">Marked Hall</span><span itemprop="streetAddress">1 Way</span>
  <span itemprop="addressLocality">Oslo</span><span itemprop="addressCountry">Norway</span></div></article></body></html>"""


def test_events_with_a_venue_block(spark):
    df = spark.createDataFrame([(1, "https://www.list.example/events/future-memory", VENUE), (2, "https://www.list.example/events/beyond", SEO), (3, "https://www.list.example/events/marks", MARKED), (4, None, None)], "page_id long, url string, html string")
    events = S.venue_event(E.page_elements(df, tree=True), city="London", country="UK")
    r = {x.page_id: x for x in events.collect()}
    assert (r[1].event_title, r[1].event_type, r[1].venue_name, r[1].venue_address, r[1].city, r[1].country) == ("Future Memory", "exhibition", "Example Gallery", "10 Example Street, London", "London", "United Kingdom")
    assert (r[1].start_date, r[1].end_date, r[1].image_url, r[1].website_url, r[1].instagram_url, r[1].facebook_url) == (dt.date(2026, 4, 12), dt.date(2026, 5, 18), "https://www.list.example/images/memory.jpg", "https://gallery.example", "https://www.instagram.com/gallery", None)
    assert (r[2].event_title, r[2].event_type, r[2].venue_name, r[2].city, r[2].country, r[2].venue_address) == ("Beyond Reflection", "Exhibition", "The Rose Gallery", "London", "UK", None)
    assert (r[3].venue_name, r[3].venue_address, r[3].city, r[3].country, r[3].description, r[3].image_url) == ("Marked Hall", "1 Way", "Oslo", "Norway", "A show.", "https://www.list.example/events/a.png")
    galleries = {g.gallery_name: g for g in S.venue_galleries(events).collect()}
    assert galleries["Example Gallery"].address == "10 Example Street, London" and galleries["Example Gallery"].source_url == "https://gallery.example" and galleries["The Rose Gallery"].address is None


def test_tree_of_broken_pages(spark):
    html = "<div class='a  b' id=x><p>one<p>two<ul><li>three<li>four</ul></span>five<br>six</div><b>seven"
    tree = E.page_elements(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string"), tree=True).first().tree
    at = {n.at: n for n in tree}
    up = lambda n: at[n.up].tag if n.up else None
    assert [(n.text, up(n)) for n in tree if n.tag == "#text"] == [("one", "p"), ("two", "p"), ("three", "li"), ("four", "li"), ("five", "div"), ("six", "div"), ("seven", "b")]
    assert tree[0].classes == " a b " and tree[0].last == max(n.at for n in tree if n.text == "six") and [n.at for n in tree] == list(range(1, len(tree) + 1))
