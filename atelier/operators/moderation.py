"""Decisions, suggestions, corrections, learned rules and queues as batch jobs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atelier.functions import text as X
from atelier.operators.tables import all_of, latest_per_key
from atelier.sources.shared import written

#: Patterns of names that are page headings.
SUSPECT = ["%selected works%", "%latest work%", "%artworks%", "%paintings%", "%prints%", "%about the artist%"]
#: Active rules that are broadcast, at most.
RULES = 5000
#: Characters of the parts by which more rules are found
GRAM = 8


def fold_decisions(decisions: DataFrame, key: str, fields: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row a key: each field's last value that is not null, in decision order; empty text counts as clearing and becomes null."""
    turn = F.struct(*order)
    last = [F.max_by(F.struct(F.col(f).alias("v")), F.when(F.col(f).isNotNull(), turn)).alias(f) for f in fields]
    folded = decisions.groupBy(key).agg(*last)
    kind = dict(decisions.dtypes)
    value = lambda f: F.nullif(F.col(f"{f}.v"), F.lit("")) if kind[f] == "string" else F.col(f"{f}.v")
    return folded.select(key, *(F.struct(value(f).alias("v"), F.col(f).isNotNull().alias("given")).alias(f) for f in fields))


def apply_decisions(overrides: DataFrame, decisions: DataFrame, known: DataFrame, *, key: str, fields: Sequence[str], order: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """(overrides after the decisions, decisions about unknown keys)."""
    ids = known.select(key).distinct()
    good, failed = decisions.join(ids, key, "left_semi"), decisions.join(ids, key, "left_anti")
    new = fold_decisions(good, key, fields, order)
    pairs = overrides.select(key, *fields).withColumnsRenamed({f: f"_old_{f}" for f in fields}).join(new, key, "full_outer")
    after = pairs.select(key, *(F.when(F.coalesce(F.col(f"{f}.given"), F.lit(False)), F.col(f"{f}.v")).otherwise(F.col(f"_old_{f}")).alias(f) for f in fields))
    return after, failed


def event_quality(events: DataFrame) -> DataFrame:
    """Presence flags, a score of five points, and the array of flags."""
    flags = {
        "missing_date": F.col("start_date").isNull(), "missing_venue": X.blank(F.col("venue_name")), "missing_artists": F.size("linked_artists") == 0, "no_linked_artists": F.size("linked_artists") == 0,
        "multiple_artist_match": F.col("artist_count") > 3, "missing_description": X.blank(F.col("description")), "missing_source_url": X.blank(F.col("source_url")),
        "end_before_start": F.coalesce(F.col("end_date") < F.col("start_date"), F.lit(False)),
    }
    there = [~X.blank(F.col("event_title")), ~flags["missing_date"], ~flags["missing_venue"], ~flags["missing_artists"], ~flags["missing_description"]]
    return events.withColumns({**flags, "quality_score": sum((c.cast("int") for c in there), F.lit(0)), "quality_flags": X.flag_array(flags)})


def rule_match(events: DataFrame, rules: DataFrame, *, few: int = RULES) -> DataFrame:
    """(event_id, rule_value, rule_confidence) of the surest active rule whose pattern the event's text contains, on its domain or any.

    Of rules with one pattern and domain only the surest can be chosen, so the others are left out first. Up to `few` rules are then broadcast and
    tried on every event. More are found by the parts of a text: a pattern of up to GRAM characters is looked up as it stands; a longer one is
    in a text only if its rarest part of GRAM characters is, so it is met by that and then looked for. No rule that can be chosen is left out.
    """
    active = rules.where("is_active and field_name = 'event_type' and trim(pattern) <> ''").withColumns({"_p": F.lower(F.trim("pattern")), "_domain": F.coalesce("source_domain", F.lit(""))})
    order = ["confidence", "support_count", "updated_at", "pattern"]
    surest = active.groupBy("_p", "_domain").agg(F.max_by(F.struct("suggested_value", *order), F.struct(*order)).alias("r")).select("_p", "_domain", "r.*")
    # a place in the order of all rules is one number: what is best of an event's hits needs no sort of them
    active = written(surest.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "rules")
    texts = events.select("event_id", "source_domain", F.lower(F.concat_ws(" ", "event_title", "description")).alias("_text"))
    own = (F.col("r._domain") == "") | (F.col("r._domain") == F.col("e.source_domain"))
    hits = []
    if active.count() <= few:
        hits.append(texts.alias("e").join(F.broadcast(active).alias("r"), F.contains(F.col("e._text"), F.col("r._p")) & own))
    else:
        texts = written(texts, "texts")
        short, long = (active.where(F.length("_p") <= GRAM), active.where(F.length("_p") > GRAM))
        hits.append(_parts(texts, F.col("_p"), short).alias("e").join(short.alias("r"), (F.col("e.gram") == F.col("r._p")) & own))
        if not long.isEmpty():
            met = _met(texts, long).alias("m")
            hits.append(met.join(texts.alias("e"), "event_id").join(long.alias("r"), F.col("m._p") == F.col("r._p")).where(F.contains(F.col("e._text"), F.col("r._p")) & own))
    best = reduce(DataFrame.unionByName, [h.select("e.event_id", "r._place") for h in hits]).groupBy("event_id").agg(F.max("_place").alias("_place"))
    return best.join(active, "_place").select("event_id", F.col("suggested_value").alias("rule_value"), F.col("confidence").cast("double").alias("rule_confidence"))


def _parts(texts: DataFrame, wanted: Column, rows: DataFrame) -> DataFrame:
    """The texts' rows, one a place and size, with the part that is there as gram: sizes are those of the wanted parts, of GRAM characters at most, and places those where one can start.

    Rows rather than arrays: they are looked up as they are made.
    """
    sizes = sorted(r[0] for r in rows.select(F.length(wanted)).distinct().collect())
    least, most = (sizes[0], sizes[-1]) if sizes else (1, 1)
    heads = rows.select(F.left(wanted, F.lit(least)).alias("_head")).distinct()
    places = texts.where(F.length("_text") > 0).select("*", F.explode(F.sequence(F.lit(1), F.length("_text"))).alias("_at"))
    places = places.select("event_id", "source_domain", F.substr("_text", F.col("_at"), F.lit(most)).alias("_rest"))
    places = places.join(heads, F.left("_rest", F.lit(least)) == F.col("_head"), "left_semi")
    sized = places.select("*", F.explode(F.array(*map(F.lit, sizes or [1]))).alias("_size")).where(F.col("_size") <= F.length("_rest"))
    return sized.select("event_id", "source_domain", F.left("_rest", F.col("_size")).alias("gram"))


def _grams(text: Column, size: Column) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text) - size + 1)), lambda i: F.substr(text, i, size)))


def _met(texts: DataFrame, rules: DataFrame) -> DataFrame:
    """(event_id, _p): a superset of the patterns that each text contains, by the part of each pattern that fewest texts have."""
    size = F.least(F.length("_p"), F.lit(GRAM))
    parts = written(rules.select("_p").distinct().select("_p", F.explode(_grams(F.col("_p"), size)).alias("gram")), "parts")
    wanted = parts.select("gram").distinct()
    # only parts of patterns leave the scan: Spark broadcasts them where their size allows, and shuffles grams else
    there = written(_parts(texts, F.col("gram"), parts).join(wanted, "gram").select("event_id", "gram").distinct(), "grams")
    counts = there.groupBy("gram").agg(F.count("*").alias("n"))
    # a pattern with a part that no text has is in no text
    rarest = parts.join(counts, "gram", "left").groupBy("_p").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
    return there.join(written(rarest, "rarest"), "gram").select("event_id", "_p")


def suggest(events: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """suggested_event_type and _title with confidence and reason; a learned rule goes before the keywords; a known type gets none."""
    free = X.blank(F.col("event_type"))
    kind = X.type_suggestion(F.concat_ws(" ", "event_title", "description"))
    # each computed once, however many of its fields are used
    out = events.withColumns({"_k": X.let(kind, lambda x: x), "_t": X.let(X.title_suggestion(F.col("event_title")), lambda x: x)})
    if rules is not None:
        out = out.join(rule_match(events, rules), "event_id", "left")
    else:
        out = out.withColumns({"rule_value": F.lit(None).cast("string"), "rule_confidence": F.lit(None).cast("double")})
    return out.withColumns(
        {
            "suggested_event_type": F.when(free, F.coalesce("rule_value", "_k.value")), "event_type_confidence": F.when(free, F.coalesce("rule_confidence", "_k.confidence")),
            "suggested_event_title": F.col("_t.value"), "event_title_confidence": F.col("_t.confidence"), "event_title_reason": F.col("_t.reason"),
        }
    ).drop("_k", "_t", "rule_value", "rule_confidence")


def auto_apply(events: DataFrame, rules: DataFrame | None = None, *, type_at: float = 0.93, title_at: float = 0.96, similar: float = 0.88) -> DataFrame:
    """Decisions (event_id, event_type, canonical_event_title) for all events that are neither approved nor hidden."""
    s = suggest(events.where("not is_hidden and not is_approved"), rules)
    safe = F.when(F.col("event_title_confidence") >= title_at, X.similar(F.col("event_title"), F.col("suggested_event_title"), similar))
    made = s.select("event_id", F.when(F.col("event_type_confidence") >= type_at, F.col("suggested_event_type")).alias("event_type"), F.when(safe, F.col("suggested_event_title")).alias("canonical_event_title"))
    return made.where("event_type is not null or canonical_event_title is not null")


def correction_action(old: Column, new: Column, suggested: Column, reason: Column, override: Column | None = None) -> Column:
    """What a change of a value amounts to, by a table of what was there (o), is now there (n) and was suggested (s); an override goes first."""
    o, n, s = (F.nullif(F.trim(c), F.lit("")) for c in (old, new, suggested))
    auto = F.coalesce(reason, F.lit("")).startswith("auto_applied")
    table = [
        ("reverted", n.isNull() & (auto | o.isNotNull())),
        ("rejected", auto | (n.isNull() & s.isNotNull())),
        ("accepted", n.isNotNull() & n.eqNullSafe(s)),
    ]
    known = F.coalesce(*(F.when(when, F.lit(name)) for name, when in table), F.lit("manually_edited"))
    return known if override is None else F.coalesce(F.nullif(override, F.lit("")), known)


def correction_log(decisions: DataFrame, *, key: str, field: str, order: Sequence[Column]) -> DataFrame:
    """One row a decision that changes the field: its value before and after, in decision order."""
    return corrections(decisions, key=key, fields=[field], order=order).drop("field_name")


def corrections(decisions: DataFrame, *, key: str, fields: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row a decision and field that it changes: field_name, original_value and final_value, in decision order."""
    texts = F.array(*(F.struct(F.lit(f).alias("f"), F.col(f).cast("string").alias("v")) for f in fields))
    given = decisions.withColumn("_c", F.explode(texts)).where("_c.v is not null").drop(*fields)
    given = given.select("*", F.col("_c.f").alias("field_name"), F.col("_c.v").alias("final_value")).drop("_c")
    before = given.withColumn("original_value", F.lag("final_value").over(Window.partitionBy(key, "field_name").orderBy(*order)))
    return before.where(~F.nullif("original_value", F.lit("")).eqNullSafe(F.nullif("final_value", F.lit(""))))


def learn_rules(rules: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Counters of each rule key, nulls being equal, and the confidence (accepted + 2) / (support + 4)."""
    keys = ["field_name", "pattern", "suggested_value", "source_domain"]
    new = outcomes.select(*keys, F.lit(1).cast("long").alias("support_count"), F.col("accepted").cast("long").alias("accepted_count"), (1 - F.col("accepted")).cast("long").alias("rejected_count"))
    every = rules.select(*keys, "support_count", "accepted_count", "rejected_count").unionByName(new)
    total = every.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in ("support_count", "accepted_count", "rejected_count")))
    return total.withColumn("confidence", F.round((F.col("accepted_count") + 2) / (F.col("support_count") + 4), 4))


def flag_state(actions: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last action's status of each flag."""
    return latest_per_key(actions, list(keys), order).withColumn("status", F.when(F.col("action") == "resolved", "resolved").otherwise("open"))


def suspect_name(c: Column) -> Column:
    out = F.lit(False)
    for p in SUSPECT:
        out |= F.coalesce(c.ilike(p), F.lit(False))
    return out


QUEUES = {
    "artworks_pending_review": lambda: F.col("review_status") == "pending",
    "artists_missing_bio": lambda: X.blank(F.col("artist_bio")),
    "artists_short_bio": lambda: ~X.blank(F.col("artist_bio")) & (F.length(F.trim("artist_bio")) < 120),
    "artists_poor_bio": lambda: F.coalesce("bio_quality_score", F.lit(100)) < 60,
    "artists_suspect_name": lambda: suspect_name(F.col("artist_name")),
    "artists_with_manual_bio": lambda: F.col("edited_bio").isNotNull(),
    "broken_or_missing_images": lambda: X.blank(F.col("image_url")),
}


def moderation_queue(df: DataFrame, name: str, *, status: str = "all", flags: DataFrame | None = None, key: str = "artist_name") -> DataFrame:
    """Rows of a queue, with the issue and, given flags (key, issue_type, status), how many of the issue are open.

    status open leaves out rows with a resolved flag of the issue, resolved keeps only those; works are open while they are pending.
    """
    rows = (df if name == "artists_without_events" else df.where(QUEUES[name]())).withColumn("issue", F.lit(name))
    if flags is None:
        return rows
    own = flags.where(F.col("issue_type") == name)
    counts = own.where("status = 'open'").groupBy(key).agg(F.count("*").alias("open_flags_count"))
    rows = rows.join(counts, key, "left").withColumn("open_flags_count", F.coalesce("open_flags_count", F.lit(0).cast("long")))
    done = own.where("status = 'resolved'").select(key).distinct()
    return rows if status == "all" else rows.join(done, key, "left_anti" if status == "open" else "left_semi")


#: The queues of works; the others are of profiles.
OF_WORKS = ["artworks_pending_review", "broken_or_missing_images"]


def queue_summary(rollup: DataFrame, profiles: DataFrame, links: DataFrame) -> DataFrame:
    """One row with the size of each queue. rollup: rows with how many works each queue of works has there; links: artists (artist_name) that an event names."""
    a = rollup.agg(*(F.coalesce(F.sum(n), F.lit(0).cast("long")).alias(n) for n in OF_WORKS))
    p = profiles.agg(*(F.count_if(F.coalesce(QUEUES[n](), F.lit(False))).alias(n) for n in QUEUES if n not in OF_WORKS))
    w = profiles.join(links.select("artist_name").distinct(), "artist_name", "left_anti").agg(F.count("*").alias("artists_without_events"))
    return a.join(F.broadcast(p)).join(F.broadcast(w))  # one row each


def moderation_counts(artworks: DataFrame, *keys: str) -> DataFrame:
    """total, approved, hidden and needs_review of works, by keys: a work is approved where it is public, and hidden with its artist."""
    public, waiting = F.coalesce("public_visibility", F.lit(False)), F.coalesce("review_status", F.lit("pending")).isin("pending", "unreviewed")
    return artworks.groupBy(*keys).agg(*_counted(public, F.coalesce("artist_is_hidden", F.lit(False)), waiting & ~public))


def _counted(*conditions: Column) -> list[Column]:
    return [F.count("*").alias("total"), *(F.count_if(c).alias(n) for n, c in zip(COUNTS[1:], conditions))]


#: What the summary counts.
COUNTS = ["total", "approved", "hidden", "needs_review"]


def moderation_summary(profiles: DataFrame, artworks: DataFrame, events: DataFrame, galleries: DataFrame) -> DataFrame:
    """(entity_type, total, approved, hidden, needs_review) of the four kinds of records, one aggregate each. Works may come as moderation_counts of them.

    An artist that is not hidden is approved once it has a canonical name; a work is approved where it is public, and hidden with its artist.
    """
    hidden, approved = F.coalesce("is_hidden", F.lit(False)), F.coalesce("is_approved", F.lit(False))
    named = ~X.blank(F.col("canonical_artist_name"))
    works = artworks if set(COUNTS) <= set(artworks.columns) else moderation_counts(artworks)
    kinds = {
        "artists": profiles.agg(*_counted(~hidden & named, hidden, ~hidden & ~named)), "artworks": works.agg(*(F.coalesce(F.sum(n), F.lit(0).cast("long")).alias(n) for n in COUNTS)),
        "events": events.agg(*_counted(approved, hidden, ~approved & ~hidden)), "galleries": galleries.agg(*_counted(approved, hidden, ~approved & ~hidden)),
    }
    return reduce(DataFrame.unionByName, (df.select(F.lit(kind).alias("entity_type"), *COUNTS) for kind, df in kinds.items()))


def admin_events(
    df: DataFrame, *, queue: str = "all", as_of: str, search: str | None = None, domain: str | None = None, kind: str | None = None, city: str | None = None,
    start_from: str | None = None, start_until: str | None = None, missing: Sequence[str] = (), linked: bool | None = None,
) -> DataFrame:
    """A queue of events, narrowed by what is asked for: text in title or venue, domain, type, city, dates, missing fields, and whether artists are linked."""
    state = {
        "all": F.lit(True), "needs_review": ~F.col("is_approved") & ~F.col("is_hidden"), "low_quality": F.col("quality_score") <= 2, "approved": F.col("is_approved"), "hidden": F.col("is_hidden"),
        "edited": F.col("moderation_override_exists"), "recent": F.col("crawl_timestamp") >= F.lit(as_of).cast("timestamp") - F.expr("INTERVAL '7' DAY"),
    }
    more = [state[queue], *(F.col(f"missing_{m}") for m in missing)]
    more += [F.col("event_title").ilike(f"%{search}%") | F.col("venue_name").ilike(f"%{search}%")] if search else []
    more += [F.col(c) == v for c, v in (("source_domain", domain), ("event_type", kind), ("city", city)) if v]
    more += [F.col("start_date") >= F.lit(start_from).cast("date")] if start_from else []
    more += [F.col("start_date") <= F.lit(start_until).cast("date")] if start_until else []
    more += [(F.size("linked_artists") > 0) == F.lit(linked)] if linked is not None else []
    return df.where(all_of(more))


#: What a flag may be about.
ENTITIES = ["artist", "artwork", "event", "gallery"]


def valid_flags(actions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(flags that name an entity, its kind and an issue, the others)."""
    good = F.col("entity_type").isin(ENTITIES) & ~X.blank(F.col("entity_id")) & ~X.blank(F.col("issue_type"))
    return actions.where(good), actions.where(~F.coalesce(good, F.lit(False)))


def apply_latest(overrides: DataFrame, decisions: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """overrides, a key's whole row replaced by its last decision; columns are those of overrides."""
    new = latest_per_key(decisions, list(keys), order).select(*overrides.columns)
    return overrides.join(new.select(*keys), list(keys), "left_anti").unionByName(new)


def apply_artist_decisions(overrides: DataFrame, decisions: DataFrame, candidates: DataFrame, order: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """(overrides after the decisions, decisions about unknown artists). An artist's domain is the newest of the candidates (artist_name, source_domain, last_seen)."""
    newest = latest_per_key(candidates, ["artist_name"], [F.desc_nulls_last("last_seen"), F.asc("source_domain")]).select("artist_name", "source_domain")
    placed = decisions.join(newest, "artist_name").withColumn("canonical_artist_name", F.nullif(F.trim("canonical_artist_name"), F.lit("")))
    return apply_latest(overrides, placed, ["artist_name", "source_domain"], order), decisions.join(newest, "artist_name", "left_anti")


def apply_artwork_reviews(reviews: DataFrame, approvals: DataFrame, rejections: DataFrame, decisions: DataFrame, known: DataFrame, order: Sequence[Column]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(reviews, approvals, rejections) after the decisions about known artworks.

    Each decision adds to the reviews; an artwork's last one leaves it in approvals or in rejections, never in both.
    """
    good = written(decisions.join(known.select("artwork_id").distinct(), "artwork_id", "left_semi"), "decisions")
    yes = F.col("action") == "approve"
    more = good.select("id", "artwork_id", F.when(yes, "approved").otherwise("rejected").alias("review_status"), F.col("decided_at").alias("reviewed_at"), F.col("decided_at").alias("created_at"))
    last = written(latest_per_key(good, ["artwork_id"], order), "last")
    approved, rejected = last.where(yes), last.where(~yes)
    a = approvals.join(rejected.select("artwork_id"), "artwork_id", "left_anti").unionByName(good.where(yes).join(rejected.select("artwork_id"), "artwork_id", "left_anti").select("id", "artwork_id", "public_visibility", F.col("decided_at").alias("approved_at")), allowMissingColumns=True)
    r = rejections.join(approved.select("artwork_id"), "artwork_id", "left_anti").unionByName(good.where(~yes).join(approved.select("artwork_id"), "artwork_id", "left_anti").select("id", "artwork_id", F.coalesce("rejection_reason", F.lit("Rejected by reviewer")).alias("rejection_reason"), F.col("decided_at").alias("rejected_at")), allowMissingColumns=True)
    return reviews.unionByName(more, allowMissingColumns=True), a, r


def append_bio_edits(edits: DataFrame, incoming: DataFrame, known: DataFrame) -> DataFrame:
    """edits and the incoming ones, trimmed, that are not blank and about a known (artist_name, source_domain)."""
    good = incoming.withColumn("edited_bio", F.trim("edited_bio")).where("edited_bio <> ''").join(known.select("artist_name", "source_domain").distinct(), ["artist_name", "source_domain"], "left_semi")
    return edits.unionByName(good.select(*edits.columns))
