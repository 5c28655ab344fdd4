"""Personal data by weak supervision, with DataFrame functions alone.

Base spans come from four fixed patterns. Further candidates (spelled-out addresses, loose telephone numbers,
identity and account numbers, long tokens) are judged: regex, gazetteer, context and boundary labelers vote on every
candidate of every document, base spans included; expectation-maximisation over the table of vote patterns (at most
3^5 a kind, counted by Spark over all rows) estimates the labelers' reliabilities; its posteriors train a logistic
span classifier, and candidates it is sure of are added where they touch no base span. Base spans always stay.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atelier.llm.shared import table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "id", "account", "secret")
LABELERS = ("regex", "gazetteer", "context", "boundary", "shape")
SURE = 0.95

# Base patterns. They start only where their first run starts (or the last match ended), which finds the same leftmost
# matches in linear time; the card pattern is the run of digits of the right length, which cannot touch another digit.
# Groups that repeat without bound are possessive: Java loops over those, and recurses over others.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
_CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Candidates beyond them.
_SPELLED = r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63} ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z]{2,24}(?![A-Za-z0-9])"
_LOOSE = r"(?<![0-9+(])(?<![0-9][\x20().-])(?:\([0-9]{3}\) ?|[0-9]{3}[\x20.-])[0-9]{3}[.-][0-9]{4}(?![\x20.-]?[0-9])"
_ID = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_ACCOUNT = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_SECRET = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"

_CUES = {
    0: "mail|e-mail|courriel|correo|contact|kontakt|write|schreib",
    1: "ip|address|adresse|dirección|host|server|serveur|servidor",
    2: "card|carte|karte|tarjeta|visa|credit|kredit|amex|payment",
    3: "tel|phone|call|fax|mobile|handy|téléphone|telefon|teléfono|móvil",
    4: "ssn|social|security|identity|ausweis|identité|dni",
    5: "iban|account|konto|compte|cuenta|bank|banque|banco",
    6: "token|key|secret|password|passwort|clave|credential|bearer|auth",
}
_AGAINST = r"(?i)\b(?:version|isbn|issn|doi|sha1|sha256|md5|commit|checksum|order|article|section)\b[^\n]{0,12}$"
_TOP_LEVEL = "com|org|net|edu|gov|io|info|biz|eu|uk|fr|de|es|it|nl|ch|at|be|us|ca|au|jp"


#: Elements that one step of running() folds: k elements cost about k * BLOCK / 2 small copies, and k^2 / BLOCK^2 / 2 more.
BLOCK = 200
#: Characters in a piece of pieces().
PIECE = 512


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once: what a lambda uses from outside is otherwise computed anew for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def blocks_of(values: Column) -> Column:
    """The array in parts of BLOCK elements; one empty part if it is empty."""
    return let(values, lambda v: F.transform(F.sequence(F.lit(0), F.greatest(F.size(v) - 1, F.lit(0)), F.lit(BLOCK)), lambda i: F.slice(v, i + 1, F.lit(BLOCK))))


def running(values: Column, fold: Callable[[Column, Column], Column]) -> Column:
    """For each int of an array, the fold of all before it (0 for the first), in two levels of blocks."""
    none = "named_struct('now', {}, 'out', cast(array() as array<int>))"

    def step(state: Column, x: Column) -> Column:
        return F.struct(fold(state["now"], x).alias("now"), F.concat(state["out"], F.array(state["now"])).alias("out"))

    def every(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), fold))
        heads = F.aggregate(totals, F.expr(none.format(0)), step, lambda s: s["out"])
        within = lambda b, h: F.aggregate(b, F.struct(h.alias("now"), F.expr("cast(array() as array<int>)").alias("out")), step, lambda s: s["out"])
        return F.flatten(F.zip_with(blocks, heads, within))

    return let(blocks_of(values), every)


def located(text: Column, pattern: str) -> Column:
    """The matches as structs of start, end (code points) and text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = let(found, lambda f: F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(f)), f, lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("text"))))

    def span(g: Column, at: Column) -> Column:
        return F.struct((at + g["gap"]).alias("start"), (at + g["gap"] + F.length(g["text"])).alias("end"), g["text"].alias("text"))

    return let(gaps, lambda some: F.zip_with(some, running(F.transform(some, lambda g: g["gap"] + F.length(g["text"])), lambda a, b: a + b), span))


def pieces(text: Column) -> Column:
    """The text cut every PIECE characters: a place in a long text is then reached without reading all before it."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def part(cut: Column, start: Column, n: Column) -> Column:
    """n characters of a cut text from start (from 0); empty if n is not positive."""
    first = F.floor(start / PIECE).cast("int")
    many = F.floor((start + n - 1) / PIECE).cast("int") - first + 1
    whole = F.array_join(F.slice(cut, first + 1, F.greatest(many, F.lit(1))), "")
    return F.when(n > 0, F.substr(whole, start - first * PIECE + 1, n)).otherwise(F.lit(""))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def term(total: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = 2 * d
        return total + F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), term) % 10 == 0


def _at_most_255(p: Column) -> Column:
    plain = F.regexp_replace(p, "^0+(?=[0-9])", "")
    return (F.length(plain) <= 3) & (F.lpad(plain, 3, "0") <= "255")


_NONE = "cast(array() as array<struct<start: int, kind: int, end: int, text: string>>)"


def _of(text: Column, kind: int, pattern: str, guard: Column, valid: Callable[[Column], Column] | None = None) -> Column:
    spans = located(text, pattern)
    if valid:
        spans = F.filter(spans, lambda s: valid(s["text"]))
    spans = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"), s["text"].alias("text")))
    return F.when(guard, spans).otherwise(F.expr(_NONE))


def base_spans(text: Column) -> Column:
    """array<struct<start, kind, end, text>>, by start and then kind."""
    some = [
        _of(text, 0, _EMAIL, F.contains(text, F.lit("@"))),
        _of(text, 1, _IP, text.rlike(r"[0-9]\.[0-9]"), lambda m: F.forall(F.split(m, r"\."), _at_most_255)),
        _of(text, 2, _CARD, text.rlike(r"[0-9][\x20-]?[0-9][\x20-]?[0-9]"), lambda m: F.length(_digits(m)).between(14, 19) & luhn(_digits(m))),
        _of(text, 3, _PHONE, F.contains(text, F.lit("+")), lambda m: F.length(_digits(m)).between(10, 15)),
    ]
    return F.array_sort(F.concat(*some))


def further_spans(text: Column) -> Column:
    """Candidates that the base patterns leave out."""
    some = [
        _of(text, 0, _SPELLED, text.rlike(r"(?i)\bdot\b") & text.rlike(r"(?i)\bat\b")),
        _of(text, 3, _LOOSE, text.rlike(r"[0-9]{3}[.-][0-9]{4}")),
        _of(text, 4, _ID, text.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}")),
        _of(text, 5, _ACCOUNT, text.rlike("[A-Z]{2}[0-9]{2}")),
        _of(text, 6, _SECRET, text.rlike("[A-Za-z0-9+/_-]{20}"), lambda m: m.rlike("[0-9]") & m.rlike("[A-Za-z]")),
    ]
    return F.array_sort(F.concat(*some))


#: What a candidate of each kind looks like when its form alone speaks for it.
_STRICT = {
    0: r"(?i)(?:\(at\)|\[at\])",
    3: r"^(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[\x20.-])[2-9][0-9]{2}[.-][0-9]{4}$",
    4: r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    6: r"^(?:AKIA|ASIA|gh[pousr]_|sk[-_]|pk[-_]|xox[abpr]-|AIza|eyJ|glpat-)",
}


def _checked(value: Column) -> Column:
    """Whether an account number's check digits are right: its characters, the first four last and letters as 10 to 35, leave 1 modulo 97."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.split(F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4))), "")
    code = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.filter(turned, lambda c: c != ""), F.lit(0), lambda r, c: (r * F.when(code(c) > 9, 100).otherwise(10) + code(c)) % 97) == 1


def votes(cut: Column, span: Column, is_base: bool) -> Column:
    """One vote a labeler, in the order of LABELERS: 1 for personal data, -1 against, 0 no vote. cut: the text in pieces()."""
    around = F.struct(part(cut, F.greatest(span["start"] - 40, F.lit(0)), F.least(span["start"], F.lit(40))).alias("before"), part(cut, span["end"], F.lit(1)).alias("after"))
    return let(around, lambda x: F.array(*_votes(span, x["before"], x["after"], is_base)))


def _votes(span: Column, before: Column, after: Column, is_base: bool) -> list[Column]:
    kind, value = span["kind"], span["text"]
    last = F.when(span["start"] > 0, F.substr(before, F.length(before), F.lit(1))).otherwise(F.lit(" "))
    vote = lambda yes, no: F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(F.lit(0))
    digits = _digits(value)
    known = (
        F.when(kind == 0, value.rlike(rf"(?i)(?:\.|dot\)? ?|dot\] ?)(?:{_TOP_LEVEL})$"))
        .when(kind == 1, ~value.rlike(r"^(?:0|127|255)\."))
        .when(kind == 2, digits.rlike("^(?:4|5[1-5]|2[2-7]|3[4-9]|6)"))
        .when(kind == 3, value.rlike(r"^(?:\+(?:1|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])|\(?[2-9])"))
        .when(kind == 4, ~value.rlike("^(?:000|666|9)"))
        .when(kind == 5, value.rlike("^(?:AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)"))
        .otherwise(F.lit(False))
    )
    wanted = F.element_at(F.array(*(F.lit(rf"(?i)(?:^|[^\p{{L}}])(?:{c})") for c in _CUES.values())), kind + 1)
    cue = F.regexp_like(before, wanted)
    whole = ~(last.rlike(r"[\p{L}0-9]") | after.rlike(r"[\p{L}0-9]"))
    varied = F.size(F.array_distinct(F.split(digits, ""))) > 3
    mixed = value.rlike("[0-9].*[a-zA-Z].*[0-9].*[a-zA-Z].*[0-9]") & ~value.rlike("^[A-Z]?[a-z]+(?:[/_-][A-Za-z]?[a-z]+)*[0-9]{0,2}$")
    shape = F.when(kind == 6, mixed).when(kind == 0, F.length(value) >= 6).otherwise(varied)
    strict = F.when(kind == 5, _checked(value))
    for k, form in _STRICT.items():
        strict = strict.when(kind == k, value.rlike(form))
    regex = F.lit(1) if is_base else F.when(F.coalesce(strict, F.lit(False)), 1).otherwise(0)
    return [regex, vote(known, (kind == 4) | (kind == 5)), vote(cue, before.rlike(_AGAINST)), vote(whole, ~whole), vote(shape, ~shape)]


def _judged(cut: Column, spans: Column, is_base: bool) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), votes(cut, s, is_base).alias("votes")))


def _free(spans: Column, base: Column) -> Column:
    """Those of the spans that touch none of base (by start), block of base by block."""
    def edged(b: Column) -> Column:
        return F.struct(F.element_at(b, 1)["start"].alias("lo"), F.array_max(F.transform(b, lambda s: s["end"])).alias("hi"), b.alias("spans"))

    def rest(blocks: Column) -> Column:
        meets = lambda s, b: (b["start"] < s["end"]) & (s["start"] < b["end"])
        touched = lambda s: F.exists(blocks, lambda k: (k["lo"] < s["end"]) & (s["start"] < k["hi"]) & F.exists(k["spans"], lambda b: meets(s, b)))
        return F.filter(spans, lambda s: ~touched(s))

    return F.when(F.size(base) == 0, spans).otherwise(let(F.transform(blocks_of(base), edged), rest))


def found(docs: DataFrame) -> DataFrame:
    """docs with _base and _more: judged spans. Null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    spans = docs.withColumns({"_b": base_spans(text), "_m": further_spans(text)})
    some = F.size("_b") + F.size("_m") > 0
    spans = spans.withColumns({"_m": _free(F.col("_m"), F.col("_b")), "_cut": F.when(some, pieces(text))})
    return spans.withColumns({"_base": _judged(F.col("_cut"), F.col("_b"), True), "_more": _judged(F.col("_cut"), F.col("_m"), False)}).drop("_b", "_m", "_cut")


@dataclass
class Classifier:
    """Weights by kind and by labeler."""

    kind: list[float]
    vote: list[float]

    def probability(self, span: Column) -> Column:
        total = F.element_at(F.array(*map(F.lit, self.kind)), span["kind"] + 1)
        for i, w in enumerate(self.vote):
            total = total + span["votes"][i] * F.lit(w)
        return 1 / (1 + F.exp(-total))


def reliabilities(patterns: list[tuple[int, tuple[int, ...], int]], *, steps: int = 200) -> tuple[dict, list[float]]:
    """Expectation-maximisation for two latent classes: posterior by (kind, votes), and how often each labeler is right when it votes.

    A vote of 0 says nothing. A labeler is right in 0.55 to 0.99 of its votes; boundary and shape, which hold for much
    that is not personal, in 0.7 at most. The share of personal data is estimated by kind, with one imagined span of either class.
    """
    kinds = np.array([k for k, _, _ in patterns])
    v = np.array([p for _, p, _ in patterns])
    n = np.array([c for _, _, c in patterns], float)
    most = np.array([0.7 if x in ("boundary", "shape") else 0.99 for x in LABELERS])
    right, prior = np.minimum(0.8, most), np.full(len(KINDS), 0.5)
    for _ in range(steps):
        odds = np.log(prior[kinds] / (1 - prior[kinds])) + v @ np.log(right / (1 - right))
        post = 1 / (1 + np.exp(-odds))
        agree = np.where(v > 0, post[:, None], np.where(v < 0, 1 - post[:, None], 0)) * n[:, None]
        right = np.clip((agree.sum(0) + 8) / (((v != 0) * n[:, None]).sum(0) + 10), 0.55, most)
        yes, every = np.bincount(kinds, post * n, minlength=len(KINDS)), np.bincount(kinds, n, minlength=len(KINDS))
        prior = (yes + 1) / (every + 2)
    return {(k, p): float(q) for (k, p, _), q in zip(patterns, post, strict=True)}, right.tolist()


def train(docs: DataFrame) -> Classifier | None:
    """Counts vote patterns over all documents, estimates reliabilities and fits the span classifier; None without any span."""
    every = found(docs).select(F.explode(F.concat("_base", "_more")).alias("s"))
    rows = every.groupBy("s.kind", "s.votes").agg(F.count("*").alias("n")).collect()  # at most 7 * 3^5
    patterns = sorted((r["kind"], tuple(r["votes"]), r["n"]) for r in rows)
    if not patterns:
        return None
    posterior, right = reliabilities(patterns)
    x = np.array([[float(k == i) for i in range(len(KINDS))] + list(p) for k, p, _ in patterns])
    y, n = np.array([posterior[k, p] for k, p, _ in patterns]), np.array([c for _, _, c in patterns], float)
    # votes that always come together can't be told apart: the weights stay near the labelers' own log odds
    own = np.array([0.0] * len(KINDS) + [np.log(r / (1 - r)) for r in right])
    near, w = max(1.0, 0.2 * n.sum()), own.copy()
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (n * q * (1 - q))[:, None]).T @ x + near * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (n * (y - q)) - near * (w - own))
    return Classifier(w[: len(KINDS)].tolist(), w[len(KINDS) :].tolist())


def spans(docs: DataFrame, classifier: Classifier | None, *, sure: float = SURE) -> DataFrame:
    """docs, all columns kept, with _base and _spans: array<struct<start, kind, end>> by start and kind."""
    judged = found(docs)
    bare = lambda name: F.transform(name, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    added = F.filter("_more", lambda s: classifier.probability(s) >= sure) if classifier else F.slice("_more", 1, 0)
    return judged.withColumns({"_base": bare("_base"), "_spans": F.array_sort(F.concat(bare("_base"), bare(added)))}).drop("_more")


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(spans: Column, kind: int) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def digest(found: DataFrame) -> DataFrame:
    counts = [F.size(_of_kind(F.col("_base"), k)).cast("long").alias(f"n_{name}") for k, name in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(_listed(F.col("_base")), 256).alias("base_sha256"), _listed(F.col("_spans")).alias("spans"))


def redacted(docs: DataFrame, classifier: Classifier | None) -> DataFrame:
    """docs with each span of text replaced by its kind in angle brackets; overlapping spans are replaced once. Null text stays null."""
    names = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))
    text = F.col("text")

    cut = pieces(text)
    reached = running(F.transform("_spans", lambda s: s["end"]), lambda a, b: F.greatest(a, b))

    def kept(s: Column, at: Column) -> Column:
        return F.when(s["start"] >= at, F.concat(part(F.col("_cut"), at, s["start"] - at), F.element_at(names, s["kind"] + 1))).otherwise(F.lit(""))

    last = F.array_max(F.transform("_spans", lambda s: s["end"]))
    clean = F.concat(F.array_join(F.zip_with("_spans", reached, kept), ""), part(F.col("_cut"), last, F.length(text) - last))
    marked = spans(docs, classifier)
    marked = marked.withColumn("_cut", F.when(F.size("_spans") > 0, cut))
    return marked.withColumn("text", F.when(text.isNull() | (F.size("_spans") == 0), text).otherwise(clean)).select(*docs.columns)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null texts are empty and have no spans; a null doc_id stays null; repeated rows each get their result; other columns are left out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest(spans(docs, train(docs)))


QUERIES = {"op8_pii": op8_pii}
ORACLE: dict[str, str] = {}
