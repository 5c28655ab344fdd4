"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams its events; block tags end a line, and a line's ratio is its
characters, those of links left out, over its tags. Subtrees that never hold article text (menus, adverts, forms, comments,
...) are left out by tag, role, and class or id words. The ratios of what remains are smoothed with a Gaussian; lines over
the threshold (the ratios' standard deviation, at most their mean) form clusters; a run of lines of link text alone is in
none. The clusters choose the region: from the page down, the container that holds most of the clusters' characters is entered,
whatever its tag is, and an <article> or <main> that is reached so is the region. Where no container holds most, each one
that holds a cluster stays, and so does what stands directly beside them, from the first cluster to the last and `gap` short lines around.
Inside a region all lines stay but runs of links before its first cluster and after its last; a heading right before it belongs to it.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atelier.llm.shared import table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset(
    "head title script style noscript template nav header footer aside form button select textarea fieldset iframe object svg canvas audio video dialog menu".split()
)
BLOCKS = frozenset(
    "address article blockquote body br caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - {"br", "body", "html"}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus
    footer header masthead menu modal nav navbar navigation newsletter notice notices popup promo promoted related respond share sharing
    sidebar social sponsor sponsored subscribe toolbar widget""".split()
)
MAIN = frozenset(["article", "main"])
#: What holds blocks of text rather than being one.
CONTAINERS = frozenset("article center div main section table tbody td tr".split())
HEADINGS = frozenset("h1 h2 h3".split())
#: Share of a line's characters in links from which it is a link.
LINKED = 0.9
#: Share of the clusters' characters that a container has to hold to be entered.
MOST = 0.6


def _boilerplate(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    if tag in SKIPPED:
        return True
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value and value.lower() in ROLES:
            return True
        if name in ("class", "id") and value and tag not in ("html", "body", "article", "main"):
            words = "".join(c if c.isalnum() else " " for c in value.lower()).split()
            if not WORDS.isdisjoint(words):
                return True
    return False


class Lines(HTMLParser):
    """lines: (text, tags, characters in links, container, whether it is a heading), container being the number of the innermost open one.

    above holds each container's own container, and marked those that are an article or main; 0 is the page. places holds where each
    tag's open elements stand, so an event costs the same however many elements are open.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int, bool]] = []
        self.parts: list[str] = []
        self.linked = 0
        self.tags = 0
        self.open: list[str] = []
        self.places: dict[str, list[int]] = defaultdict(list)
        self.skip_from = -1  # depth of the boilerplate subtree, or -1
        self.above, self.marked = [0], {0: False}
        self.inside: list[tuple[int, int]] = []  # depth and number of the open containers

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, self.tags, min(self.linked, len(text)), self.inside[-1][1] if self.inside else 0, any(self.places[h] for h in HEADINGS)))
            self.tags = 0
        self.parts, self.linked = [], 0

    def close_to(self, depth: int) -> None:
        if self.inside and depth <= self.inside[-1][0] and self.skip_from < 0:
            self.end_line()
        while len(self.open) > depth:
            self.places[self.open.pop()].pop()
        while self.inside and depth <= self.inside[-1][0]:
            self.inside.pop()
        if depth <= self.skip_from:
            self.skip_from = -1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS or tag in SKIPPED:
            if self.skip_from < 0:
                self.end_line()
            if tag in CLOSES_P and self.places["p"]:
                at = self.places["p"][-1]
                if self.skip_from < at:
                    self.close_to(at)
        if self.skip_from < 0:
            self.tags += 1
        if tag in VOID:
            return
        self.places[tag].append(len(self.open))
        self.open.append(tag)
        if self.skip_from < 0:
            if _boilerplate(tag, attrs):
                self.skip_from = len(self.open) - 1
            elif tag in CONTAINERS or ("role", "main") in attrs or ("itemprop", "articleBody") in attrs:
                self.end_line()
                number = len(self.above)
                self.above.append(self.inside[-1][1] if self.inside else 0)
                self.marked[number] = tag in MAIN or tag not in CONTAINERS or ("role", "main") in attrs or ("itemprop", "articleBody") in attrs
                self.inside.append((len(self.open) - 1, number))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS and self.skip_from < 0:
            self.end_line()
        if not self.places[tag]:
            return
        if self.skip_from < 0:
            self.tags += 1
        self.close_to(self.places[tag][-1])

    def handle_data(self, data: str) -> None:
        if self.skip_from < 0:
            self.parts.append(data)
            if self.places["a"]:
                self.linked += sum(map(len, data.split())) + max(0, len(data.split()) - 1)


def smoothed(ratios: list[float], sigma: float) -> list[float]:
    reach = max(1, math.ceil(2 * sigma))
    weights = [math.exp(-(i * i) / (2 * sigma * sigma)) for i in range(-reach, reach + 1)]
    n, out = len(ratios), []
    for i in range(n):
        lo, hi = max(0, i - reach), min(n, i + reach + 1)
        own = weights[lo - i + reach : hi - i + reach]
        out.append(sum(w * r for w, r in zip(own, ratios[lo:hi], strict=True)) / sum(own))
    return out


def _held(lines: list[tuple[str, int, int, int, bool]], above: list[int], content: list[bool]) -> tuple[list[int], list[list[int]]]:
    """Of each container: the clusters' characters in it, and the containers in it that hold any. A container's number is above that of its own."""
    held, inner = [0] * len(above), [[] for _ in above]
    for (text, _, _, box, _), c in zip(lines, content, strict=True):
        held[box] += len(text) * c
    for box in range(len(above) - 1, 0, -1):
        held[above[box]] += held[box]
    for box in range(1, len(above)):
        if held[box]:
            inner[above[box]].append(box)
    return held, inner


def _region(held: list[int], inner: list[list[int]], marked: dict[int, bool]) -> int:
    """The container that most of the clusters' characters lead to, an article or main at most."""
    at = 0
    while not marked[at]:
        best = max(inner[at], key=lambda box: held[box], default=0)
        if not best or held[best] < MOST * held[at]:
            break
        at = best
    return at


def _chosen(lines: list[tuple[str, int, int, int, bool]], above: list[int], marked: dict[int, bool], content: list[bool], listed: list[bool], gap: int) -> list[int]:
    held, inner = _held(lines, above, content)
    if not held[0]:  # no cluster at all: what articles there are, if any
        boxes = {box for box, m in marked.items() if m}
        child = _children(above, boxes)
        return [i for i, x in enumerate(lines) if child[x[3]] and not listed[i]]
    region = _region(held, inner, marked)
    whole = region != 0 and (marked[region] or not inner[region])
    parts = {region} if whole else set(inner[region])
    of = _children(above, {region} if region else set())
    part = _children(above, parts)
    first, last = next(i for i, c in enumerate(content) if c), len(lines) - 1 - next(i for i, c in enumerate(reversed(content)) if c)
    own = [i for i, x in enumerate(lines) if part[x[3]]]
    if whole:
        keep = set(own)
    else:  # those beside the parts, directly in the region
        beside = [i for i, x in enumerate(lines) if x[3] == region]
        keep = set(own) | {i for i in beside if first - gap <= i <= last + gap and (region or first <= i <= last or not listed[i])}
    if region and own:
        inside = [i for i, x in enumerate(lines) if of[x[3]]]
        before = inside[0] - 1
        while before >= 0 and lines[before][4] and not listed[before]:
            keep.add(before)
            before -= 1
    ends: dict[int, list[int]] = {}
    for i in sorted(keep):
        if content[i]:
            ends.setdefault(part[lines[i][3]], [i, i])[1] = i
    # runs of links stay between the clusters of their part
    return [i for i in sorted(keep) if not listed[i] or (part[lines[i][3]] in ends and ends[part[lines[i][3]]][0] < i < ends[part[lines[i][3]]][1])]


def _children(above: list[int], boxes: set[int]) -> list[int]:
    """The box of each container that it is or lies in, else 0."""
    out = [0] * len(above)
    for box in range(1, len(above)):
        out[box] = out[above[box]] or (box if box in boxes else 0)
    return out


def main_text(html: str | None, *, sigma: float = 1.0, gap: int = 2) -> tuple[str, int, int]:
    """The text, the page's lines outside boilerplate, and the lines kept."""
    if not html:
        return "", 0, 0
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.end_line()
    lines = parser.lines
    if not lines:
        return "", 0, 0
    ratios = [(len(text) - linked) / max(1, tags) for text, tags, linked, _, _ in lines]
    mean = sum(ratios) / len(ratios)
    threshold = min(mean, math.sqrt(sum((r - mean) ** 2 for r in ratios) / len(ratios)))
    links = [LINKED * len(text) <= linked for text, _, linked, _, _ in lines]
    listed = list(links)  # a link alone among text is part of it; several in a row are a list
    for i in range(len(lines)):
        listed[i] = links[i] and bool(0 < i and links[i - 1] or i + 1 < len(lines) and links[i + 1])
    # a cluster's own lines; what is over the threshold by its neighbours alone chooses nothing
    content = [s >= threshold and r >= threshold and r > 0 and not run for s, r, run in zip(smoothed(ratios, sigma), ratios, listed, strict=True)]
    kept = _chosen(lines, parser.above, parser.marked, content, listed, gap)
    return " ".join(lines[i][0] for i in kept), len(lines), len(kept)


def extract(pages: DataFrame, *, sigma: float = 1.0, gap: int = 2) -> DataFrame:
    """(page_id, url, text, n_chars, n_lines, n_kept) for each row of pages.

    Null and empty html give an empty text; null ids and urls stay null; repeated rows give repeated results;
    other columns of pages are left out. Broken markup is read as far as it goes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [main_text(x.as_py(), sigma=sigma, gap=gap) for x in batch.column("html")]
            text = pa.array([x[0] for x in done], pa.string())
            counts = [pa.array(x, pa.int64()) for x in ([len(x[0]) for x in done], [x[1] for x in done], [x[2] for x in done])]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), text, *counts], names=["page_id", "url", "text", "n_chars", "n_lines", "n_kept"])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long, n_lines long, n_kept long")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


QUERIES = {"op9_html_extraction": op9_html_extraction}
ORACLE: dict[str, str] = {}
