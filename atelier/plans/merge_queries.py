"""Streams of slices into bucketed tables, chains of decisions, similar titles, and rules found by their rarest part."""

from __future__ import annotations

from pyspark.sql import functions as F

from atelier.functions import text as X
from atelier.operators import moderation as D
from atelier.operators import summaries as S
from atelier.operators import tables as O
from atelier.plans import queries as Q
from atelier.plans.queries import EVENTS, query
from atelier.sources.shared import scratch
from atelier.streaming import buckets as B
from atelier.streaming import jobs as J

SLICES = ["crawl_run_id < 'run-4'", "crawl_run_id >= 'run-4' and crawl_run_id < 'run-8'", "crawl_run_id >= 'run-8'"]


@query("""WITH k AS (SELECT *, CASE WHEN coalesce(source_record_id, '') <> '' THEN 'id' || source_domain || '|' || source_record_id ELSE 'url' || source_domain || '|' || coalesce(source_url, '') END AS k,
  CASE WHEN crawl_run_id < 'run-4' THEN 0 WHEN crawl_run_id < 'run-8' THEN 1 ELSE 2 END AS s FROM a_artworks),
l AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY k, s ORDER BY crawl_timestamp DESC, id DESC) = 1)
SELECT arg_min(struct_pack(v := id), s).v AS id, arg_max(struct_pack(v := artwork_title), s).v AS artwork_title, arg_max(struct_pack(v := crawl_timestamp), s).v AS crawl_timestamp, arg_min(struct_pack(v := price_text), s).v AS price_text FROM l GROUP BY k""")
def stream_upsert(t):
    """Three slices of the crawl stream into a bucketed table; what it holds then is what three upserts make."""
    # the table holds what is asked of it, and the key made once: a batch shuffles and rewrites whole rows
    rows = t["a_artworks"].select("id", "artwork_title", "crawl_timestamp", "price_text", O.record_key().alias("key"), "crawl_run_id")
    at, schema = scratch(t.spark, "stream"), rows.drop("crawl_run_id").schema
    for part in SLICES:
        rows.where(part).drop("crawl_run_id").write.mode("append").parquet(f"{at}/in")
        stream = t.spark.readStream.schema(schema).parquet(f"{at}/in")
        J.stream_upsert(stream, f"{at}/table", f"{at}/checkpoint", update_cols=["artwork_title", "crawl_timestamp"], order=[F.desc("crawl_timestamp"), F.desc("id")], key=F.col("key"), buckets=32).awaitTermination()
    B.vacuum(t.spark, f"{at}/table")
    return B.current(t.spark, f"{at}/table", schema).select("id", "artwork_title", "crawl_timestamp", "price_text")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_first_seen(t):
    """The users' kinds of events as a stream sees them first; the table spans less than the watermark."""
    at = scratch(t.spark, "seen")
    rows = t["events"].select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    rows.write.parquet(f"{at}/in")
    seen = J.stream_first_seen(t.spark.readStream.schema(rows.schema).parquet(f"{at}/in"), ["user_id", "event_type"], ts="ts", within="3650 days")
    seen.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.schema(rows.schema).parquet(f"{at}/out").select("user_id", "event_type")


_CHAINS = """d AS (SELECT o_orderkey AS id, coalesce(lag(o_orderkey) OVER w, CASE WHEN o_custkey % 5 = 0 THEN last_value(o_orderkey) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) END) AS next
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))"""


@query(f"""WITH RECURSIVE {_CHAINS}, w(id, p, seen) AS (SELECT id, id, []::bigint[] FROM d WHERE next IS NOT NULL UNION ALL SELECT w.id, d.next, list_append(seen, p) FROM w JOIN d ON w.p = d.id WHERE d.next IS NOT NULL AND NOT list_contains(seen, p)),
e AS (SELECT w.id, CASE WHEN list_contains(seen, p) THEN list_min(seen[list_position(seen, p):]) ELSE p END AS e FROM w LEFT JOIN d ON w.p = d.id WHERE d.next IS NULL OR list_contains(seen, p))
SELECT o_orderkey AS raw_artwork_id, coalesce(e, o_orderkey) AS canonical_id FROM orders LEFT JOIN e ON id = o_orderkey""")
def duplicate_resolution_chains(t):
    """Each order is a duplicate of its customer's order before it; every fifth customer's first points to the last, which closes a cycle."""
    spark = t.spark
    t["orders"].createOrReplaceTempView("atelier_chain_orders")
    last = "last_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    d = spark.sql(f"SELECT o_orderkey AS duplicate_id, coalesce(lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), CASE WHEN o_custkey % 5 = 0 THEN {last} END) AS canonical_id FROM atelier_chain_orders")
    return S.duplicate_resolution(t["orders"].select(F.col("o_orderkey").alias("raw_artwork_id")), d).select("raw_artwork_id", "canonical_id")


_TITLE = "p_name || ' ' || p_type || ' ' || p_brand"


@query(f"""WITH RECURSIVE x AS (SELECT p_partkey, lower({_TITLE}) AS a FROM part), y AS MATERIALIZED (SELECT x.p_partkey, x.a, z.a AS b FROM x JOIN x z ON z.p_partkey = x.p_partkey + 1),
d AS (SELECT DISTINCT a, b FROM y), r(a0, b0, a, b, k) AS (SELECT a, b, a, b, 0 FROM d UNION ALL
  SELECT a0, b0, u.a, u.b, CASE WHEN u.first THEN n ELSE 0 END FROM (SELECT a0, b0, a, b, (SELECT struct_pack(n := n, i := i, j := position(substr(r.a, i, n) IN r.b)) FROM (SELECT unnest(range(1, length(r.a) + 1)) AS i) p, (SELECT unnest(range(1, least(length(r.a), length(r.b)) + 1)) AS n) q
    WHERE i + n - 1 <= length(r.a) AND contains(r.b, substr(r.a, i, n)) ORDER BY n DESC, i LIMIT 1) AS s FROM r WHERE a <> '' AND b <> '') m, LATERAL (SELECT s.n AS n), LATERAL (VALUES (TRUE, left(m.a, s.i - 1), left(m.b, s.j - 1)), (FALSE, substr(m.a, s.i + s.n), substr(m.b, s.j + s.n))) u(first, a, b) WHERE s IS NOT NULL),
k AS (SELECT a0, b0, 2.0 * sum(k) / (length(a0) + length(b0)) AS share FROM r GROUP BY a0, b0)
SELECT p_partkey, round(share::double, 9) AS share, share >= 0.7 AS alike FROM y JOIN k ON a0 = y.a AND b0 = y.b""")
def title_similarity(t):
    """Titles of parts with that of the next one."""
    x = t["part"].select("p_partkey", F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("title"))
    both = x.join(x.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("title").alias("other")), "p_partkey")
    return both.select("p_partkey", F.round(X.matching_share(F.col("title"), F.col("other")), 9).alias("share"), X.similar(F.col("title"), F.col("other"), 0.7).alias("alike"))


_RULES = """rule AS (SELECT right(lower(s_name), 2 + s_suppkey % 6) AS p, 'kind ' || s_suppkey AS v, CASE WHEN s_suppkey % 3 = 0 THEN lower(n_name) || '.example' END AS d, s_suppkey AS n, round((s_suppkey % 7 + 2) / 13.0, 4) AS c FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


@query(f"""WITH {EVENTS}, {_RULES}, hit AS (SELECT event_id, arg_max(struct_pack(v := v, c := c), struct_pack(c := c, n := n)) AS m FROM mev JOIN rule ON contains(lower(concat_ws(' ', event_title, description)), p) AND (d IS NULL OR d = source_domain) GROUP BY 1)
SELECT event_id, m.v AS rule_value, m.c::double AS rule_confidence FROM hit""")
def learned_rule_match_by_grams(t):
    """Rules whose patterns are ends of suppliers' names, met by their rarest part as if they were too many to be broadcast."""
    s = t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
    rules = s.select(
        F.lit("event_type").alias("field_name"), F.expr("right(lower(s_name), cast(2 + s_suppkey % 6 as int))").alias("pattern"), F.concat(F.lit("kind "), F.col("s_suppkey").cast("string")).alias("suggested_value"),
        F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lower("n_name"), F.lit(".example"))).alias("source_domain"), F.lit(True).alias("is_active"), F.col("s_suppkey").alias("support_count"), F.col("s_suppkey").alias("updated_at"),
        F.round((F.col("s_suppkey") % 7 + 2) / 13, 4).alias("confidence"),
    )
    return D.rule_match(Q.ev(t), rules, few=0)
