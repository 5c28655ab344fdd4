"""Before/after audits, checks and gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atelier.functions import text as X
from atelier.sources.shared import written


def record_score(fields: Sequence[str]) -> Column:
    """Percent of the fields that are there."""
    return F.round(sum((F.when(~X.blank(F.col(f).cast("string")), 1).otherwise(0) for f in fields), F.lit(0)) * 100.0 / len(fields), 2)


def audit_match(before: DataFrame, after: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Pairs of equal key, the n-th with the n-th; columns b_* and a_*, and side: matched, only_before, only_after."""
    w = Window.partitionBy(*keys).orderBy(*order)
    side = lambda df, p: df.withColumn("_n", F.row_number().over(w)).select(*(F.col(k) for k in keys), "_n", *(F.col(c).alias(f"{p}_{c}") for c in df.columns if c not in keys), F.lit(True).alias(f"_{p}"))
    both = side(before, "b").join(side(after, "a"), [*keys, "_n"], "full_outer")
    return both.withColumn("side", F.when(F.col("_a").isNull(), "only_before").when(F.col("_b").isNull(), "only_after").otherwise("matched")).drop("_a", "_b")


def audit_stats(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    there = [F.count_if(~X.blank(F.col(f))).alias(f"with_{f}") for f in fields]
    size = F.length("description")
    return df.agg(
        F.count("*").alias("records"), F.countDistinct(F.lower("artist_name")).alias("artists"), *there, F.round(F.avg(size), 2).alias("mean_description"), F.median(size).alias("median_description")
    )


def audit_matched(matched: DataFrame) -> DataFrame:
    """Counts by side, mean scores and their difference."""
    pair = F.col("side") == "matched"
    return matched.agg(
        F.count_if(pair).alias("matched"), F.count_if(F.col("side") == "only_before").alias("only_before"), F.count_if(F.col("side") == "only_after").alias("only_after"),
        F.round(F.avg(F.when(pair, F.col("b_score"))), 2).alias("mean_before"), F.round(F.avg(F.when(pair, F.col("a_score"))), 2).alias("mean_after"),
        F.round(F.avg(F.when(pair, F.col("a_score") - F.col("b_score"))), 2).alias("mean_delta"),
    )


def audit_changed(matched: DataFrame) -> DataFrame:
    """Matched pairs of another score: improvements, then regressions; previews of the descriptions."""
    delta = F.round(F.col("a_score") - F.col("b_score"), 2)
    changed = matched.where(F.col("side") == "matched").withColumn("delta", delta).where("delta <> 0")
    return changed.withColumns({"turn": F.when(F.col("delta") > 0, 0).otherwise(1), "b_preview": X.preview(F.col("b_description")), "a_preview": X.preview(F.col("a_description"))})


def backfill_plan(matched: DataFrame, *, field: str, record: str = "source_record_id") -> DataFrame:
    """What to do with each pair's field: apply, or why not. Both sides must name the same record (b_/a_ columns of record, or the key itself)."""
    new, old = F.coalesce(F.trim(F.col(f"a_{field}")), F.lit("")), F.coalesce(F.trim(F.col(f"b_{field}")), F.lit(""))
    ids = [F.col(c) if c in matched.columns else F.col(record) for c in (f"b_{record}", f"a_{record}")]
    reason = (
        F.when(F.col("side") != "matched", "unmatched").when(new == old, "unchanged").when(X.blank(ids[0]) | X.blank(ids[1]), "no_record_id").when(ids[0] != ids[1], "other_record")
        .when(new == "", "no_new_value").otherwise("apply")
    )
    return matched.withColumn("action", reason)


def backfill_apply(base: DataFrame, plan: DataFrame, *, field: str, domain: str = "source_domain", record: str = "source_record_id") -> DataFrame:
    """base with the planned value where a row of the record still has the old one; a record with several plans takes the least new value."""
    todo = plan.where("action = 'apply'").groupBy(domain, record, F.coalesce(F.col(f"b_{field}"), F.lit("")).alias("_old")).agg(F.min(f"a_{field}").alias("_new"))
    joined = base.withColumn("_old", F.coalesce(F.col(field), F.lit(""))).join(todo, [domain, record, "_old"], "left")
    return joined.withColumn(field, F.coalesce("_new", field)).select(*base.columns)


def audit_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: each number of the second one-row table less that of the first."""
    names = [c for c, t in before.dtypes if t not in ("string", "boolean") and c in after.columns]
    b, a = (df.select(*(F.col(c).alias(f"_{p}_{c}") for c in names)) for p, df in (("b", before), ("a", after)))
    return b.join(F.broadcast(a)).select(*(F.round(F.col(f"_a_{c}") - F.col(f"_b_{c}"), 2).alias(f"delta_{c}") for c in names))


def stable_match(before: DataFrame, after: DataFrame, keys: Sequence[Column], order: Sequence[str]) -> DataFrame:
    """audit_match by the first of several keys (columns that may be blank) that a row has."""
    own = F.coalesce(*(F.when(~X.blank(k), F.concat(F.lit(f"{i}\x1f"), k)) for i, k in enumerate(keys)), F.lit(""))
    return audit_match(before.withColumn("_key", own), after.withColumn("_key", own), ["_key"], order)


def residual_match(before: DataFrame, after: DataFrame, keys: Sequence[Column], *, on: str, order: Sequence[str]) -> DataFrame:
    """(b_<on>, a_<on>, level): pairs by the first key, then of what is left by the second, and so on; what no key pairs has no level.

    Within a key's value the first rows of both sides meet, then the second, in the given order. Rows with a blank key wait for the next.
    `on` is unique on either side.
    """
    left, pairs = {"b": before, "a": after}, None
    for level, key in enumerate(keys):
        ranked = {}
        for side, df in left.items():
            keyed = df.withColumn("_key", key).where(~X.blank(F.col("_key")))
            ranked[side] = keyed.select("_key", F.row_number().over(Window.partitionBy("_key").orderBy(*order)).alias("_n"), F.col(on).alias(f"{side}_{on}"))
        found = written(ranked["b"].join(ranked["a"], ["_key", "_n"]).select(f"b_{on}", f"a_{on}", F.lit(level).alias("level")), "pairs")
        pairs = found if pairs is None else pairs.unionByName(found)
        left = {side: df.join(found.select(F.col(f"{side}_{on}").alias(on)), on, "left_anti") for side, df in left.items()}
    for side, df in left.items():
        pairs = pairs.unionByName(df.select(F.col(on).alias(f"{side}_{on}")), allowMissingColumns=True)
    return pairs


def breaking(df: DataFrame, rule: Column) -> DataFrame:
    """Rows for which a rule does not hold; a rule that is null does not hold."""
    return df.where(~F.coalesce(rule, F.lit(False)))


def year_range() -> Column:
    return F.col("year_start").isNull() | F.col("year_end").isNull() | (F.col("year_start") <= F.col("year_end"))


def accepted_values(column: str, values: Sequence[str]) -> Column:
    return F.col(column).isNull() | F.col(column).isin(list(values))


def no_negative(*columns: str) -> Column:
    out = F.lit(True)
    for c in columns:
        out &= F.coalesce(F.col(c) >= 0, F.lit(True))
    return out


def artist_linking_failures(links: DataFrame, mentions: DataFrame, artists: DataFrame) -> DataFrame:
    """(failure, n): duplicate links, links whose names are not equal, and mentions that are only stop phrases; kinds without a failure are left out."""
    twice = links.groupBy("event_id", "artist_id").agg(F.count("*").alias("c")).where("c > 1").select(F.lit("duplicate_event_artist_links").alias("failure"))
    named = links.join(artists.select("artist_id", "normalized_artist_name"), "artist_id").join(mentions.select("event_id", F.col("normalized_candidate_artist_name").alias("normalized_artist_name"), F.lit(True).alias("_m")).distinct(), ["event_id", "normalized_artist_name"], "left")
    lost = named.where("_m is null").select(F.lit("link_without_mention").alias("failure"))
    generic = mentions.where(F.lower("candidate_artist_name").isin(X.STOP_PHRASES)).select(F.lit("generic_text_should_not_match").alias("failure"))
    return twice.unionByName(lost).unionByName(generic).groupBy("failure").agg(F.count("*").alias("n"))


def raw_ranked_check(latest: DataFrame, rows: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], on: str) -> DataFrame:
    """Keys whose kept row is not the first in order: (on) of rows that rank first and are not kept."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").join(latest.select(on), on, "left_anti").select(on)


#: Words of page headings that a name doesn't hold.
DENIED = ("selected works", "latest work", "artworks", "paintings", "prints")


def suspect_reason(name: Column, *, deny: Sequence[str] = DENIED) -> Column:
    low = F.lower(F.trim(name))
    return F.when(low.rlike("|".join(deny)), "denylist").when(F.contains(name, F.lit(":")), "colon").when(F.length(name) > 60, "too_long").when((low != "") & ~F.contains(low, F.lit(" ")), "single_token")


def slug_suggestion(url: Column) -> Column:
    """The name that the URL's slug spells, for a name of one token."""
    return X.artist_name_from_slug(url)


def suspect_names(df: DataFrame, *, name: str = "artist_name", url: str = "source_url", overrides: dict[str, str] | None = None, deny: Sequence[str] = DENIED) -> DataFrame:
    """Rows whose name is suspect, with reason and the name that the URL's slug spells (empty where it spells none).

    In order: the whole name is a heading, it holds a colon, it is longer than 60 characters, or it is one token though the slug spells a name.
    """
    said, spelled = X.clean_text(F.col(name)), X.artist_name_from_slug(F.col(url), overrides=overrides)
    one = ~F.contains(said, F.lit(" ")) & spelled.isNotNull()
    reason = F.when(F.lower(said).isin(list(deny)), "denylist").when(F.contains(said, F.lit(":")), "colon").when(F.length(said) > 60, "too_long").when(one, "single_token")
    return df.withColumns({"reason": reason, "suggested_artist_name": F.coalesce(spelled, F.lit(""))}).where("reason is not null")


def check(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, failures): rows that break each rule, all in one aggregate."""
    one = df.agg(*(F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()))
    return one.select(F.inline(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(n).alias("failures")) for n in rules))))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that more than one row has."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def ingest_gate(df: DataFrame, *, run_id: str, as_of: str, recent: str, minimum: int) -> DataFrame:
    """(records, passed, reason): the run's records, or if it has none those of the recent interval, against the minimum."""
    since = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {recent}")
    counts = df.agg(F.count_if(F.col("crawl_run_id") == run_id).alias("strict"), F.count_if(F.col("crawl_timestamp") >= since).alias("lately"))
    n = F.when(F.col("strict") > 0, F.col("strict")).otherwise(F.col("lately"))
    return counts.select(n.alias("records"), (n >= minimum).alias("passed"), F.when(n < minimum, "too few records").when(F.col("strict") > 0, "run").otherwise("recent").alias("reason"))


def city_gate(events: DataFrame, *, domain: str, since: str, as_of: str, recent: str, cities: Sequence[str], galleries: DataFrame | None = None, per_city: bool = True) -> DataFrame:
    """(records, cities_with_records, galleries, passed, reason) of a domain's events in the configured cities: those since the run began or, without any, those of the recent interval.

    It passes with a record, with a city of recent records (unless per_city is off) and, where galleries are given, with a gallery of the same time.
    """
    key, wanted = F.lower(F.trim("city")), [c.lower() for c in cities]
    began, lately = F.lit(since).cast("timestamp"), F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {recent}")
    counts = lambda df, extra: df.where((F.col("source_domain") == domain) & key.isin(wanted)).agg(F.count_if(F.col("crawl_timestamp") >= began).alias("_strict"), F.count_if(F.col("crawl_timestamp") >= lately).alias("_recent"), *extra)
    either = F.when(F.col("_strict") > 0, F.col("_strict")).otherwise(F.col("_recent"))
    e = counts(events, [F.count_distinct(F.when(F.col("crawl_timestamp") >= lately, key)).alias("cities_with_records")]).select(either.alias("records"), "cities_with_records", F.when(F.col("_strict") > 0, "run").otherwise("recent").alias("_by"))
    g = (counts(galleries, []).select(either.alias("galleries")) if galleries is not None else events.sparkSession.range(1).select(F.lit(None).cast("long").alias("galleries")))
    both = e.join(F.broadcast(g))  # one row each
    reason = F.when(F.col("records") == 0, "no records").when(F.lit(per_city) & (F.col("cities_with_records") == 0), "no city").when(F.col("galleries") == 0, "no galleries")
    return both.select("records", "cities_with_records", "galleries", reason.isNull().alias("passed"), F.coalesce(reason, F.col("_by")).alias("reason"))


def freshness(df: DataFrame, *, as_of: str, warn: int = 7, error: int = 30) -> DataFrame:
    """(source_domain, last_seen, age_days, status) against the day given."""
    last = df.groupBy("source_domain").agg(F.max("crawl_timestamp").alias("last_seen"))
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date("last_seen"))
    return last.withColumns({"age_days": age, "status": F.when(age > error, "error").when(age > warn, "warn").otherwise("fresh")})


def city_counts(df: DataFrame, cities: Sequence[str]) -> DataFrame:
    """Counts of the configured cities, zero where there are none."""
    wanted = df.sparkSession.createDataFrame([(c.lower(),) for c in cities], "city_key string")
    counts = df.groupBy(F.lower(F.trim("city")).alias("city_key")).agg(F.count("*").alias("n"))
    return F.broadcast(wanted).join(counts, "city_key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
