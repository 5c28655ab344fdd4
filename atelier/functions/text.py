"""Column functions for names, keys, contacts, URLs and short texts. No UDFs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Candidate names that are not people.
STOP_PHRASES = ["exhibition", "gallery", "opening", "preview", "talk", "panel", "workshop", "artist talk", "group show", "private view", "book now", "tickets", "event"]
#: Query parameters that only track.
TRACKING = "utm_source utm_medium utm_campaign utm_term utm_content".split()
_NO_TEXTS = "cast(array() as array<string>)"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def clean_text(c: Column) -> Column:
    """Runs of white space become a blank, ends are trimmed, nothing becomes null. Texts without such a run are not rewritten."""
    return F.nullif(F.trim(F.when(c.rlike(r"[\t-\r]|  "), F.regexp_replace(c, r"\s+", " ")).otherwise(c)), F.lit(""))


def slugify(c: Column, *, max_len: int | None = None) -> Column:
    slug = F.lower(F.regexp_replace(F.regexp_replace(c, "[^a-zA-Z0-9]+", "-"), "^-|-$", ""))
    return F.substring(slug, 1, max_len) if max_len else slug


def initcap_alnum(c: Column) -> Column:
    """Upper case after anything that is neither letter nor digit, lower case elsewhere."""
    parts = F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substr(p, F.lit(2))))), "")


def normalize_person_name(c: Column) -> Column:
    """Lower case letters and digits, single blanks; the words artist and studio go after that, so blanks around them stay."""
    flat = F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9\s]", " "), r"\s+", " ")
    return F.nullif(F.trim(F.regexp_replace(flat, r"\b(artist|studio)\b", "")), F.lit(""))


def norm_key(c: Column, *, default: str = "") -> Column:
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit(default)), r"\s+", " "))


def md5_uuid(c: Column) -> Column:
    return F.regexp_replace(F.md5(c), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def content_hash(*cs: Column) -> Column:
    return F.sha2(F.array_join(F.array(*(F.coalesce(c.cast("string"), F.lit("")) for c in cs)), "|"), 256)


def tokenize_mentions(c: Column, *, split_on_and: bool = False) -> Column:
    """Array of candidate names: split on comma, ampersand and, if asked for, the word and; too short, letterless and stop phrases go."""
    pattern = r"\s*(?:,|\band\b|&)\s*" if split_on_and else r"\s*[,&]\s*"
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), pattern), lambda p: F.trim(p))

    def real(t: Column) -> Column:
        low = F.lower(t)
        return (F.length(t) > 3) & t.rlike("[A-Za-z]") & ~low.isin(STOP_PHRASES) & ~F.contains(low, F.lit("gallery"))

    return F.filter(parts, real)


def split_artist_names(c: Column) -> Column:
    """Names after the last cue word, split on comma, semicolon, ampersand and the word and."""
    after = F.element_at(F.split(c, r"(?i)(?:artists?\s*:|\bfeaturing\b|\bparticipants?\b:?|\bwith\b|\bby\b)"), -1)
    parts = F.transform(F.split(after, r"(?i)\s*(?:,|;|&|\band\b)\s*"), lambda p: F.trim(p))
    return F.filter(parts, lambda t: (F.length(t) >= 3) & ~t.rlike("[0-9]") & ~F.lower(t).isin(STOP_PHRASES))


def gallery_name_clean(c: Column, domain: Column, *, site: str, label: str) -> Column:
    """Without the listing suffix " | <label>..." on the site's own records; single blanks; title case."""
    suffix = rf"(?i)\s*\|\s*\Q{label}\E(?:\s+Art\s+Gallery\s+Listings)?\s*$"
    own = F.coalesce(F.lower(F.trim(domain)) == site, F.lit(False))
    name = F.when(own, F.regexp_replace(F.trim(c), suffix, "")).otherwise(F.trim(c))
    return initcap_alnum(F.nullif(F.regexp_replace(F.trim(name), r"\s+", " "), F.lit("")))


def venue_name_clean(c: Column, domain: Column, *, site: str, label: str) -> Column:
    """VENUE of "TITLE at VENUE | <label> Art Exhibition Listings", else without the site's suffixes; other sites: trimmed."""
    t = F.trim(c)
    q = rf"\Q{label}\E"
    venue = F.regexp_extract(t, rf"(?is)^(?:.*)\s+at\s+(.*)\s+\|\s+{q} Art Exhibition Listings\z", 1)
    plain = t
    for tail in (" Art Exhibition Listings", " Art Gallery Listings", " Art Training", ""):
        plain = F.regexp_replace(plain, rf"(?i)\s+\|\s+{q}{tail}\z", "")
    own = F.coalesce(F.lower(F.trim(domain)) == site, F.lit(False))
    name = F.when(own, F.coalesce(F.nullif(venue, F.lit("")), plain)).otherwise(t)
    return F.regexp_replace(F.trim(name), r"\s+", " ")


def phone_normalize(c: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9+]+", " ")), F.lit(""))


def _query_kept(url: Column) -> Column:
    params = F.filter(F.split(F.split_part(url, F.lit("?"), F.lit(2)), "&"), lambda p: (p != "") & ~F.lower(F.split_part(p, F.lit("="), F.lit(1))).isin(TRACKING))
    return F.array_join(params, "&")


def website_normalize(c: Column) -> Column:
    """With a scheme, in lower case, without tracking parameters; the order of the others stays."""
    full = F.lower(F.when(F.lower(c).rlike("^https?://"), c).otherwise(F.concat(F.lit("https://"), c)))
    kept = _query_kept(full)
    host = F.split_part(full, F.lit("?"), F.lit(1))
    return F.when(F.coalesce(c, F.lit("")) != "", F.when(kept == "", host).otherwise(F.concat(host, F.lit("?"), kept)))


def social_normalize(c: Column, host: str, *, own: str) -> Column:
    """One form of the host; the listing site's own account becomes null."""
    url = F.regexp_replace(F.lower(c), rf"^https?://(www\.)?\Q{host}\E/", f"https://{host}/")
    return F.when(F.regexp_replace(url, "/+$", "") != f"https://{host}/{own}", url)


def url_canonicalize(c: Column, *, mode: str = "plain") -> Column:
    """Lower host without www, no fragment, tracking parameters or last slash. mode: plain, sorted (parameters) or page (only the page parameter)."""

    def of(u: Column) -> Column:
        host = F.regexp_replace(F.lower(F.regexp_extract(u, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1)), r"^www\.", "")
        path = F.regexp_replace(F.regexp_extract(u, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)", 1), "/+$", "")
        params = F.filter(F.split(F.regexp_extract(u, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~F.lower(F.split_part(p, F.lit("="), F.lit(1))).isin([*TRACKING, "ref", "fbclid", "gclid"]))
        if mode == "sorted":
            params = F.array_sort(params)
        if mode == "page":
            params = F.filter(params, lambda p: p.rlike("^page="))
        tail = let(F.array_join(params, "&"), lambda q: F.when(q == "", "").otherwise(F.concat(F.lit("?"), q)))
        return let(F.lower(F.regexp_extract(u, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1)), lambda scheme: F.when(scheme != "", F.concat(scheme, F.lit("://"), host, path, tail)))

    return let(F.regexp_replace(F.trim(c), "#.*$", ""), of)


#: Classes of URLs by their path, in order.
URL_CLASSES = [
    ("artist_profile", r"/artists?/[a-z-]+/?$"), ("event_detail", r"/(?:exhibitions|events?)/[^/?]+"), ("artwork_detail", r"/work/[0-9]+"), ("collection", r"/collections?/"),
    ("directory_profile", r"/directory/"), ("listing", r"[?&]page=[0-9]+|/(?:list|listing|show)"),
]


def url_class(c: Column) -> Column:
    """struct of class and reject_reason (null for a valid URL): at most 200 characters, no markup or blanks, no @, one host."""
    reason = (
        F.when(c.isNull() | (c == ""), "empty").when(F.length(c) > 200, "too_long").when(c.rlike(r"[<>\"\s]"), "markup").when(F.contains(c, F.lit("@")), "address")
        .when(F.size(F.regexp_extract_all(c, F.lit("https?://"), F.lit(0))) != 1, "not_one_host")
    )
    kind = F.coalesce(F.when(reason.isNotNull(), F.lit("invalid")), *(F.when(c.rlike(p), F.lit(k)) for k, p in URL_CLASSES), F.lit("other"))
    return F.struct(kind.alias("class"), reason.alias("reject_reason"))


def page_number(c: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(c, r"[?&]page=([0-9]{1,9})(?:&|#|$)", 1), F.lit("")).cast("int"), F.lit(1))


def artist_name_from_slug(url: Column, *, overrides: dict[str, str] | None = None) -> Column:
    """Title-cased last path part that is made of letters, hyphens and underscores, else null; overrides go first."""
    slug = F.lower(F.regexp_extract(url, r"^[a-z]+://[^/?#]+/(?:[^?#]*/)?([A-Za-z_-]*[-_][A-Za-z_-]*)/?(?:[?#].*)?$", 1))
    name = F.initcap(F.trim(F.regexp_replace(slug, "[-_]+", " ")))
    for k, v in (overrides or {}).items():
        name = F.when(slug == k, v).otherwise(name)
    return F.nullif(name, F.lit(""))


def source_record_id(kind: str, domain: Column, url: Column, title: Column) -> Column:
    """domain:kind:slug, slug being the name parameter, the last path part, the title or the start of the URL's SHA-1."""
    slug = F.coalesce(
        F.nullif(F.regexp_extract(url, r"[?&]nom=([^&#]+)", 1), F.lit("")),
        F.nullif(slugify(F.regexp_extract(url, r"^[a-z]+://[^/?#]+/(?:[^?#]*/)?([^/?#]+)/?(?:[?#].*)?$", 1)), F.lit("")),
        F.nullif(slugify(title), F.lit("")),
        F.substring(F.sha1(url), 1, 16),
    )
    return F.concat_ws(":", domain, F.lit(kind), slug)


#: What counts as an address, a number, a navigation line.
EMAIL = r"(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}"
PHONE = r"(?:\+?\d[\d\-\s().]{7,}\d)"


def contains_email(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(EMAIL)


def contains_phone(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(PHONE)


def contact_redact(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), EMAIL, " "), PHONE, " ")


def contact_extract(text: Column, links: Column) -> Column:
    """struct of email, phone, website, instagram, facebook: the first in the links, else in the text."""
    first = lambda pattern: F.try_element_at(F.filter(links, lambda x: x.rlike(pattern)), F.lit(1))
    of = lambda pattern: F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), pattern, 0), F.lit(""))
    social = r"(?i)^https?://(?:www\.)?(?:instagram|facebook)\.com/"
    return F.struct(
        F.lower(F.coalesce(F.regexp_replace(first("(?i)^mailto:"), r"(?i)^mailto:|\?.*$", ""), of(EMAIL))).alias("email"),
        F.coalesce(F.regexp_replace(first("(?i)^tel:"), "(?i)^tel:", ""), of(PHONE)).alias("phone"),
        F.try_element_at(F.filter(links, lambda x: x.rlike("(?i)^https?://") & ~x.rlike(social)), F.lit(1)).alias("website"),
        first(r"(?i)^https?://(?:www\.)?instagram\.com/").alias("instagram"),
        first(r"(?i)^https?://(?:www\.)?facebook\.com/").alias("facebook"),
    )


def preview(c: Column, n: int = 140) -> Column:
    flat = clean_text(c)
    return F.when(F.length(flat) > n, F.concat(F.rtrim(F.substring(flat, 1, n - 1)), F.lit("…"))).otherwise(flat)


def label_value(c: Column, labels: list[str]) -> Column:
    """What follows "label:" on its line."""
    return clean_text(F.nullif(F.regexp_extract(c, rf"(?im)(?:{'|'.join(labels)})\s*:[ \t]*([^\n|]+)", 1), F.lit("")))


def city_gazetteer(c: Column, names: list[str]) -> Column:
    """The first of the names that the text contains."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return F.coalesce(*(F.when(F.contains(low, F.lit(n.lower())), F.lit(n)) for n in names))


def title_infer(*cs: Column) -> Column:
    return F.coalesce(*(clean_text(c) for c in cs))


def seo_title_parse(c: Column) -> Column:
    """struct of title, type, venue, city from "TITLE - TYPE at VENUE in CITY"."""
    pattern = r"(?s)^(.+?)\s+-\s+(.+?)\s+at\s+(.+?)\s+in\s+(.+?)\s*$"
    return F.struct(*(F.nullif(F.trim(F.regexp_extract(c, pattern, i)), F.lit("")).alias(n) for i, n in enumerate(("title", "type", "venue", "city"), 1)))


def event_type_from_url_text(url: Column, text: Column) -> Column:
    low = F.lower(F.concat_ws(" ", url, text))
    kinds = [("workshop", "workshop|masterclass"), ("talk", "talk|lecture|conversation|panel"), ("fair", "art fair|expo|biennale"), ("opening", "opening|vernissage|launch"), ("exhibition", "exhibition|solo show|group show|retrospective")]
    return F.coalesce(*(F.when(low.rlike(p), F.lit(k)) for k, p in kinds))


def first_by_key(items: Column, key) -> Column:  # noqa: ANN001
    """The items of an array without those whose key an earlier one has: the places of equal keys are sorted together, so long arrays stay cheap."""
    pairs = F.array_sort(F.transform(items, lambda x, i: F.struct(key(x).alias("k"), i.alias("i"), x.alias("x"))))
    before = F.concat(F.array(F.lit(None).cast("string")), F.transform(pairs, lambda p: p["k"]))
    heads = F.filter(F.zip_with(pairs, before, lambda p, b: F.when(p.isNotNull() & ~p["k"].eqNullSafe(b), F.struct(p["i"].alias("i"), p["x"].alias("x")))), lambda p: p.isNotNull())
    return F.transform(F.array_sort(heads), lambda p: p["x"])


def ordered_dedupe_join(c: Column, *, split: str, join: str) -> Column:
    """Parts in order, one of each lower-cased and trimmed form."""
    parts = F.filter(F.transform(F.split(c, split), lambda p: F.trim(p)), lambda p: p != "")
    return F.array_join(first_by_key(parts, F.lower), join)


#: Fixed values.
_NAVIGATION = "about the artist|artworks\\s*[▼v]|painting prints|earlier works"


def bio_clean(c: Column) -> Column:
    """struct of the cleaned biography and what was found: contacts removed, headings and year lines dropped, repeated paragraphs and sentences once."""

    def of(raw: Column, no_contact: Column, paragraphs: Column, sentences: Column, cleaned: Column) -> Column:
        letters, capitals = F.length(F.regexp_replace(raw, "[^A-Za-z]", "")), F.length(F.regexp_replace(raw, "[^A-Z]", ""))
        return F.struct(
            cleaned.alias("cleaned"),
            contains_email(raw).alias("contains_email"),
            contains_phone(raw).alias("contains_phone"),
            raw.rlike(f"(?i)({_NAVIGATION})").alias("navigation_noise"),
            (F.length(F.coalesce(cleaned, F.lit(""))) < 80).alias("too_short"),
            ((no_contact != raw) | (paragraphs != no_contact) | (sentences != paragraphs)).alias("duplicate_content"),
            (F.when(letters < 20, False).otherwise(capitals * 10 > letters * 6)).alias("noisy_uppercase"),
        )

    def lines(no_contact: Column) -> Column:
        plain = F.regexp_replace(no_contact, rf"(?im)^\s*({_NAVIGATION})\s*$", " ")
        return F.regexp_replace(F.regexp_replace(plain, r"(?im)^\s*(?:19|20)\d{2}\s*[-–:|].*$", " "), r"[\r\t]+", " ")

    once = lambda paragraphs: ordered_dedupe_join(F.regexp_replace(paragraphs, r"\s+", " "), split="[.!?]+", join=". ")
    # each step is computed once, however often the next ones look at it
    return let(F.coalesce(c, F.lit("")), lambda raw: let(contact_redact(raw), lambda n: let(ordered_dedupe_join(lines(n), split="\n{2,}", join="\n\n"), lambda p: let(once(p), lambda x: let(clean_text(x), lambda done: of(raw, n, p, x, done))))))


def bio_score(b: Column) -> Column:
    lost = {"contains_email": 30, "contains_phone": 20, "navigation_noise": 20, "duplicate_content": 10, "too_short": 10, "noisy_uppercase": 10}
    return F.greatest(F.lit(0), F.lit(100) - sum((F.when(b[k], v).otherwise(0) for k, v in lost.items()), F.lit(0)))


def bio_flags(b: Column, *, uppercase: bool = False) -> Column:
    names = ["contains_email", "contains_phone", "navigation_noise", "too_short", "duplicate_content"] + ["noisy_uppercase"] * uppercase
    return flag_array({n: b[n] for n in names})


def presence_score(weights: dict[str, int], *, lo: int = 0, hi: int = 100) -> Column:
    return F.least(F.lit(hi), F.greatest(F.lit(lo), sum((F.when(F.col(k).isNotNull(), v).otherwise(0) for k, v in weights.items()), F.lit(0))))


def flag_array(rules: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in rules.items())))


def blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def title_suggestion(c: Column) -> Column:
    """struct of value, confidence, reason: the first step that changes a title - trim, collapse, repeated punctuation, all capitals."""
    made = lambda v, p, r: F.struct(v.alias("value"), F.lit(p).alias("confidence"), F.lit(r).alias("reason"))
    collapse = lambda x: F.regexp_replace(x, r"\s+", " ")
    single = lambda x: F.regexp_replace(F.regexp_replace(F.regexp_replace(x, "!{2,}", "!"), r"\?{2,}", "?"), r"\.{2,}", ".")

    def of(t: Column) -> Column:
        capitals = t["s"].rlike(r"\p{Lu}") & ~t["s"].rlike(r"\p{Ll}")
        return (
            F.when(F.coalesce(t["c"], F.lit("")) == "", None)
            .when(t["t"] != t["c"], made(t["t"], 0.99, "blanks at the ends"))
            .when(t["x"] != t["t"], made(t["x"], 0.99, "more than one blank"))
            .when(t["s"] != t["x"], made(t["s"], 0.95, "a mark repeats"))
            .when(capitals, made(initcap_alnum(t["s"]), 0.90, "capitals only"))
        )

    steps = lambda t: let(collapse(t), lambda x: let(single(x), lambda s: let(F.struct(c.alias("c"), t.alias("t"), x.alias("x"), s.alias("s")), of)))
    return let(F.trim(c), steps)


#: Event type, confidence, keywords, in order.
EVENT_KEYWORDS = [
    ("workshop", 0.95, ["workshop", "masterclass", "class", "course"]),
    ("exhibition", 0.93, ["exhibition", "solo show", "group show", "retrospective"]),
    ("talk", 0.92, ["artist talk", "lecture", "conversation", "panel"]),
    ("fair", 0.90, ["art fair", "expo", "biennale"]),
    ("opening", 0.85, ["opening", "vernissage", "launch"]),
]


def type_suggestion(text: Column) -> Column:
    """struct of value, confidence, reason by the first group with a keyword in the text."""
    low = F.lower(F.coalesce(text, F.lit("")))
    out = None
    for kind, p, words in EVENT_KEYWORDS:
        hit = low.rlike("|".join(words))
        made = F.struct(F.lit(kind).alias("value"), F.lit(p).alias("confidence"), F.lit(f"a word of {kind}").alias("reason"))
        out = F.when(hit, made) if out is None else out.when(hit, made)
    return out



#: From this length on, characters of the second text that make up more than a hundredth of it start no block.
LONG_TEXT = 200
#: Stands for such a character; no text has it.
_NONE = "￿"


def _masked(text: Column) -> Column:
    chars = F.split(text, "")
    often = lambda c: F.length(text) - F.length(F.replace(text, c, F.lit(""))) > F.floor(F.length(text) / 100) + 1
    common = F.filter(F.array_distinct(chars), often)
    return F.when(F.length(text) < LONG_TEXT, text).otherwise(F.array_join(F.transform(chars, lambda c: F.when(F.array_contains(common, c), F.lit(_NONE)).otherwise(c)), ""))


def _shared_prefix(a: Column, b: Column) -> Column:
    n = F.least(F.length(a), F.length(b))
    return F.when(n < 1, 0).otherwise(F.size(F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: F.left(a, k) == F.left(b, k))))


def _longest(a: Column, m: Column) -> Column:
    """Length of the longest text that both hold, by halving: whatever holds one of k characters holds one of k - 1. Neither is empty."""
    n = F.least(F.length(a), F.length(m))
    held = lambda k: F.exists(F.sequence(F.lit(1), F.length(a) - k + 1), lambda i: F.contains(m, F.substr(a, i, k)))
    halves = F.sequence(F.lit(0), F.ceil(F.log2(n)).cast("int") + 1)

    def step(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"] + 1) / 2).cast("int")
        return F.when(s["lo"] >= s["hi"], s).when(held(mid), F.struct(mid.alias("lo"), s["hi"].alias("hi"))).otherwise(F.struct(s["lo"].alias("lo"), (mid - 1).alias("hi")))

    return F.aggregate(halves, F.struct(F.lit(0).alias("lo"), n.alias("hi")), step)["lo"]


def matching_share(a: Column, b: Column) -> Column:
    """Twice the characters in matching blocks of two texts over the characters of both, trimmed and in lower case; two empty texts match wholly.

    The longest text that both hold is a block (the first in a, then the first in b), and so on to its left and its right. Parts between
    blocks are taken level by level, so the work follows the number of blocks. In a long b, frequent characters only lengthen blocks.
    """
    plain = lambda c: F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)^\s+|\s+$", ""))
    part = lambda x, y, m: F.struct(x.alias("a"), y.alias("b"), m.alias("m"))

    def blocks(x: Column, y: Column, m: Column) -> Column:
        long = F.length(y) >= LONG_TEXT

        def found(p: Column) -> Column:
            k = _longest(p["a"], p["m"])

            def placed(k: Column) -> Column:
                i = F.filter(F.sequence(F.lit(1), F.length(p["a"]) - k + 1), lambda i: F.contains(p["m"], F.substr(p["a"], i, k)))[0]
                return F.when(k == 0, F.struct(F.lit(1).alias("i"), F.lit(1).alias("j"), k.alias("k"))).otherwise(let(i, lambda i: F.struct(i.alias("i"), F.position(F.substr(p["a"], i, k), p["m"]).alias("j"), k.alias("k"))))

            def grown(at: Column) -> Column:
                before = _shared_prefix(F.reverse(F.left(p["a"], at["i"] - 1)), F.reverse(F.left(p["b"], at["j"] - 1)))
                rest = lambda t, x: F.substr(t, x + at["k"], F.length(t))
                after = _shared_prefix(rest(p["a"], at["i"]), rest(p["b"], at["j"]))
                return let(before, lambda s: F.struct((at["i"] - s).alias("i"), (at["j"] - s).alias("j"), (at["k"] + s + after).alias("k")))

            at = let(k, placed)
            return let(F.when(long, let(at, grown)).otherwise(at), lambda at: F.struct(p.alias("p"), at.alias("at")))

        def parts(f: Column) -> Column:
            p, at = f["p"], f["at"]
            rest = lambda t, x: F.substr(t, x + at["k"], F.length(t))
            left = part(F.left(p["a"], at["i"] - 1), F.left(p["b"], at["j"] - 1), F.left(p["m"], at["j"] - 1))
            right = part(rest(p["a"], at["i"]), rest(p["b"], at["j"]), rest(p["m"], at["j"]))
            return F.slice(F.array(left, right), F.lit(1), F.when(at["k"] > 0, 2).otherwise(0))

        def level(s: Column, _: Column) -> Column:
            matched = lambda f: F.aggregate(f, F.lit(0), lambda n, x: n + x["at"]["k"])
            open_ = lambda f: F.filter(F.flatten(F.transform(f, parts)), lambda p: (p["a"] != "") & (p["b"] != ""))
            return F.when(F.size(s["open"]) == 0, s).otherwise(let(F.transform(s["open"], found), lambda f: F.struct(open_(f).alias("open"), (s["n"] + matched(f)).alias("n"))))

        start = F.struct(F.filter(F.array(part(x, y, m)), lambda p: (p["a"] != "") & (p["b"] != "")).alias("open"), F.lit(0).alias("n"))
        return F.aggregate(F.sequence(F.lit(0), F.least(F.length(x), F.length(y))), start, level)["n"]

    def share(t: Column) -> Column:
        both = F.length(t["a"]) + F.length(t["b"])
        return F.when(both == 0, 1.0).when(t["a"] == t["b"], 1.0).otherwise(2.0 * let(_masked(t["b"]), lambda m: blocks(t["a"], t["b"], m)) / both)

    return let(F.struct(plain(a).alias("a"), plain(b).alias("b")), share)


def shared_letters(a: Column, b: Column) -> Column:
    """An upper bound of matching_share of texts that are trimmed and in lower case: by how often each character stands in both."""
    both = F.length(a) + F.length(b)
    times = lambda t, c: F.length(t) - F.length(F.replace(t, c, F.lit("")))
    n = F.aggregate(F.array_distinct(F.split(a, "")), F.lit(0), lambda n, c: n + F.when(c == "", 0).otherwise(F.least(times(a, c), times(b, c))))
    return F.when(both == 0, 1.0).otherwise(2.0 * n / both)


def similar(a: Column, b: Column, least: float) -> Column:
    """Whether matching_share is `least` or more; lengths, then letters, settle most pairs that are not."""
    plain = lambda c: F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)^\s+|\s+$", ""))

    def decide(t: Column) -> Column:
        x, y = F.length(t["a"]), F.length(t["b"])
        return F.when(t["a"] == t["b"], True).when(2.0 * F.least(x, y) < least * (x + y), False).when(shared_letters(t["a"], t["b"]) < least, False).otherwise(matching_share(t["a"], t["b"]) >= least)

    return let(F.struct(plain(a).alias("a"), plain(b).alias("b")), decide)


#: Headings that name a section; parts of headings that are chrome; names that are none, and how such names begin.
SECTION_LABELS = ["artist statement", "about the artist", "selected works", "latest work", "artworks", "paintings", "prints", "drawing", "sculpture"]
CHROME = ["recent work", "featured work", "art in south africa"]
NO_NAMES = ["art training", "art quiz", "recent work", "featured work", "art in south africa"]
NO_NAME_STARTS = ["art galleries", "art auctions", "watch list"]
#: What titles add to a name.
TITLE_NOISE = ["South African Artists", "Artist Statement", "About"]


def artist_label(c: Column) -> Column:
    """Whether a heading names a section rather than a person: a label, a short "about", chrome, or words with a colon; blank ones do."""

    def of(low: Column) -> Column:
        words = F.size(F.split(low, " "))
        chrome = F.exists(F.array(*map(F.lit, CHROME)), lambda w: F.contains(low, w))
        return (low == "") | low.isin(SECTION_LABELS) | (F.contains(low, F.lit("about ")) & (words <= 6)) | chrome | (F.contains(low, F.lit(":")) & (words > 2))

    return let(F.lower(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))), of)


def _word(w: str) -> str:
    return rf"(?i)\b\Q{w}\E\b"


def artist_title(c: Column, *, site: str) -> Column:
    """A page title's first part that is no label, without the site's name and what it adds; else its first part."""
    plain = c
    for w in (site, *TITLE_NOISE):
        plain = F.regexp_replace(plain, _word(w), " ")
    parts = F.filter(F.transform(F.split(F.regexp_replace(plain, r"\s+", " "), r"[|-]"), lambda p: F.trim(p)), lambda p: p != "")
    return let(parts, lambda p: F.coalesce(F.try_element_at(F.filter(p, lambda x: ~artist_label(x)), F.lit(1)), F.try_element_at(p, F.lit(1))))


def artist_name_clean(c: Column, *, site: str) -> Column:
    """The name before any chrome that stands behind it."""
    cut = "|".join([*CHROME, rf"[|-] \Q{site}\E"])
    flat = F.trim(F.regexp_replace(c, r"\s+", " "))
    return let(F.regexp_replace(F.regexp_replace(flat, rf"(?i)(?:{cut}).*$", ""), r"[ |\-–—]+$", ""), lambda x: F.nullif(x, F.lit("")))


def artist_name_valid(c: Column, *, site: str) -> Column:
    """Whether a name can be a person's: not blank, none of the site's own pages, no chrome."""

    def of(low: Column) -> Column:
        starts = F.exists(F.array(*map(F.lit, [site.lower(), *NO_NAME_STARTS])), lambda w: F.startswith(low, w))
        return F.coalesce(~low.isin(NO_NAMES) & ~starts & ~F.exists(F.array(*map(F.lit, CHROME[:2])), lambda w: F.contains(low, w)), F.lit(False))

    return let(F.lower(artist_name_clean(c, site=site)), of)


#: Fields of an event's payload that name people, the first of them counts.
PAYLOAD_NAMES = ["artists", "artist", "participants", "performers"]


def payload_texts(payload: Column, keys: list[str] | None = None) -> Column:
    """The texts of a JSON payload's first field that has any: a text, a list of texts, an object with a name, or a list of those. Anything else, and what isn't JSON, has none."""
    none = F.expr(_NO_TEXTS)

    def text(v: Column) -> Column:
        kind = F.schema_of_variant(v)
        return F.when(kind == "STRING", F.try_variant_get(v, "$", "string")).when(kind.startswith("OBJECT"), let(F.try_variant_get(v, "$.name", "variant"), lambda n: F.when(F.schema_of_variant(n) == "STRING", F.try_variant_get(n, "$", "string"))))

    def of(v: Column, k: str) -> Column:
        many = F.try_variant_get(v, f"$.{k}", "array<variant>")
        found = F.when(many.isNotNull(), F.transform(many, text)).otherwise(let(F.try_variant_get(v, f"$.{k}", "variant"), lambda x: F.array(text(x))))
        return let(F.filter(found, lambda t: F.coalesce(F.trim(t) != "", F.lit(False))), lambda ts: F.when(F.size(ts) > 0, ts))

    return let(F.try_parse_json(payload), lambda v: F.coalesce(*(of(v, k) for k in keys or PAYLOAD_NAMES), none))
