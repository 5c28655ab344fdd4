"""Record tables as projections of the driver's tables, in SQL that both engines run as it stands.

Only an ordered list differs: `@LIST(value; separator; order)` becomes each engine's own aggregate. `@UUID(value)` is short for the
value's MD5 in the form of a UUID.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from atelier.sources.shared import written

BASE = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split()

SQL: dict[str, str] = {
    "a_artworks": """
SELECT cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) AS id, lower(n.n_name) || '.example' AS source_domain, 'Source ' || n.n_name AS source_name,
  CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE 'https://www.' || lower(n.n_name) || '.example/work/' || cast(l_partkey AS string) || '/?page=' || cast(l_linenumber AS string) || '&utm_source=x' END AS source_url,
  CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE cast(l_partkey AS string) || '-' || cast(l_suppkey AS string) END AS source_record_id,
  CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE '  ' || s_name || '  Studio ' END AS artist_name,
  CASE WHEN l_orderkey % 19 = 0 THEN '   ' ELSE p_name END AS artwork_title,
  CASE l_orderkey % 8 WHEN 0 THEN NULL WHEN 1 THEN 'c. ' || cast(year(l_shipdate) AS string) WHEN 2 THEN cast(year(l_shipdate) AS string) || '-' || cast(year(l_shipdate) + 3 AS string)
    WHEN 3 THEN 'late 19th century' WHEN 4 THEN '20th Century' WHEN 5 THEN 'undated' ELSE cast(year(l_shipdate) AS string) END AS artwork_date_text,
  CASE l_partkey % 6 WHEN 0 THEN 'Oil on Canvas' WHEN 1 THEN 'Watercolour on paper' WHEN 2 THEN 'Bronze, edition of 3' WHEN 3 THEN 'Silver print' WHEN 4 THEN p_type ELSE NULL END AS medium_text,
  CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN cast(cast(floor(l_quantity) AS int) AS string) || ' x ' || cast(p_size AS string) || ' cm' WHEN 3 THEN '10 1/2 x 8 in' WHEN 4 THEN 'variable' ELSE '30 x 20 x 4.5 cm' END AS dimensions_text,
  CASE l_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'Price on request' WHEN 2 THEN 'SOLD' WHEN 3 THEN '$' || cast(cast(floor(l_extendedprice) AS int) AS string) WHEN 4 THEN '€1,250 - €2,500' WHEN 5 THEN 'GBP 3,400.50' ELSE 'unknown' END AS price_text,
  c_name AS gallery_name,
  CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE 'https://img.example/' || cast(l_partkey AS string) || '.jpg' END AS image_url,
  CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE p_name || ' by ' || s_name END AS description,
  'run-' || cast(l_orderkey % 10 AS string) AS crawl_run_id, l_shipdate AS crawl_timestamp, o_orderdate AS created_at
FROM lineitem JOIN part p ON l_partkey = p_partkey JOIN supplier s ON l_suppkey = s_suppkey JOIN nation n ON s_nationkey = n.n_nationkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
""",
    "a_artists": "SELECT cast(s_suppkey AS string) AS id, lower(n_name) || '.example' AS source_domain, s_name || ' Artist' AS artist_name FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "a_events": """
SELECT cast(o_orderkey AS string) AS id, lower(n_name) || '.example' AS source_domain, 'Source ' || n_name AS source_name, 'https://' || lower(n_name) || '.example/event/' || cast(o_orderkey AS string) AS source_url,
  cast(o_orderkey AS string) AS source_record_id, CASE WHEN o_orderkey % 3 = 0 THEN 'exhibition' ELSE NULL END AS event_type,
  CASE o_orderkey % 6 WHEN 0 THEN '  Exhibition of ' || c_mktsegment WHEN 1 THEN 'ARTIST TALK' WHEN 2 THEN 'Workshop with  friends' WHEN 3 THEN 'Grand opening!!' WHEN 4 THEN NULL ELSE 'Evening of ' || o_orderpriority END AS event_title,
  CASE WHEN o_orderkey % 29 = 0 THEN ' ' WHEN o_orderkey % 31 = 0 THEN 'Opening night at ' || c_name || ' | Customer Art Exhibition Listings' WHEN o_orderkey % 37 = 0 THEN 'List your gallery ' || o_orderpriority WHEN o_orderkey % 41 = 0 THEN 'Home' WHEN o_orderkey % 43 = 0 THEN 'ab' ELSE c_name END AS venue_name, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE cast(c_custkey AS string) || ' Main Road' END AS venue_address,
  n_name AS city, r_name AS country, cast(o_orderdate AS date) AS start_date,
  CASE WHEN o_orderkey % 23 = 0 THEN cast(cast(o_orderdate AS date) - INTERVAL '1' DAY AS date) WHEN o_orderkey % 5 = 0 THEN NULL ELSE cast(cast(o_orderdate AS date) + INTERVAL '30' DAY AS date) END AS end_date,
  m.mentions AS description, CASE WHEN o_orderkey % 4 = 1 THEN NULL ELSE 'https://img.example/e' || cast(o_orderkey AS string) || '.jpg' END AS image_url,
  cast(o_orderkey % 6 AS string) AS payload_score, o_orderdate AS crawl_timestamp, o_orderdate AS created_at
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN (SELECT l_orderkey, @LIST(s_name; ', '; l_linenumber, s_name) AS mentions FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_orderkey) m ON o_orderkey = m.l_orderkey
""",
    "a_galleries": """
SELECT 'g' || cast(c_custkey AS string) || '-' || cast(v AS string) AS id, lower(n_name) || '.example' AS source_domain, 'https://' || lower(n_name) || '.example/gallery/' || cast(c_custkey AS string) AS source_url,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'g' || cast(c_custkey AS string) END AS source_record_id, CASE WHEN v = 1 THEN '  ' || c_name || ' ' ELSE c_name END AS gallery_name,
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE cast(c_custkey AS string) || ' Main Road' END AS address, n_name AS city, r_name AS country,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE '(0' || cast(c_custkey % 90 + 10 AS string) || ') 555/' || cast(1000 + c_custkey % 9000 AS string) END AS phone,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE 'Info' || cast(c_custkey AS string) || '@Mail.example.COM' END AS email,
  CASE c_custkey % 8 WHEN 0 THEN NULL WHEN 2 THEN 'WWW.Site' || cast(c_custkey AS string) || '.example/?utm_source=a&id=5&UTM_medium=b&z=1' ELSE 'https://site' || cast(c_custkey AS string) || '.example/a?utm_term=q' END AS website_url,
  CASE c_custkey % 8 WHEN 2 THEN 'http://www.instagram.com/Listing/' WHEN 4 THEN 'https://instagram.com/G' || cast(c_custkey AS string) ELSE NULL END AS instagram_url,
  CASE WHEN c_custkey % 10 = 0 THEN 'https://www.facebook.com/g' || cast(c_custkey AS string) ELSE NULL END AS facebook_url,
  CASE WHEN v = 1 THEN timestamp '2024-02-01 00:00:00' ELSE timestamp '2024-01-01 00:00:00' END AS crawl_timestamp, timestamp '2024-01-01 00:00:00' AS created_at,
  CASE c_custkey % 4 WHEN 0 THEN '{"represented_artists": [{"name": "Artist of ' || c_name || '"}, {"name": "Jo Bee", "profile_url": "https://x.example/jo"}]}' WHEN 1 THEN '{"represented_artists": []}' ELSE NULL END AS raw_payload
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey CROSS JOIN (SELECT 0 AS v UNION ALL SELECT 1 AS v) versions WHERE c_acctbal > 0
""",
    "a_reviews": """
SELECT 'r' || cast(doc_id AS string) AS id, @UUID(cast(doc_id - doc_id % 3 AS string) || '-1') AS artwork_id, CASE WHEN quality = 1 THEN 'approved' WHEN toxic = 1 THEN 'rejected' ELSE 'pending' END AS review_status,
  CASE WHEN doc_id % 4 = 0 THEN NULL ELSE timestamp '2024-03-01 00:00:00' + doc_id % 50 * INTERVAL '1' DAY END AS reviewed_at, timestamp '2024-02-01 00:00:00' AS created_at FROM labels
""",
    "a_event_overrides": """
SELECT cast(doc_id AS string) AS event_id, toxic = 1 AS is_hidden, quality = 1 AS is_approved, CASE WHEN doc_id % 2 = 0 THEN 'Title ' || cast(doc_id AS string) ELSE NULL END AS canonical_event_title,
  CASE WHEN doc_id % 3 = 1 THEN 'talk' ELSE NULL END AS event_type, CASE WHEN doc_id % 5 = 0 THEN 'auto_applied' ELSE NULL END AS moderation_reason,
  CASE WHEN doc_id % 7 = 0 THEN 'seen' ELSE NULL END AS moderator_notes, timestamp '2024-05-01 00:00:00' + doc_id % 30 * INTERVAL '1' DAY AS updated_at FROM labels
""",
    "a_flags": """
SELECT 'f' || cast(event_id AS string) AS id, 'artist' AS entity_type, cast(user_id % 100 AS string) AS entity_id, CASE WHEN event_type = 'purchase' THEN 'duplicate' ELSE 'suspect' END AS issue_type,
  CASE WHEN event_id % 4 = 0 THEN 'resolved' WHEN event_id % 4 = 1 THEN 'reopened' ELSE 'open' END AS action, ts AS created_at FROM events
""",
    "a_decisions": """
SELECT cast(event_id AS string) AS id, cast(user_id AS string) AS event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 2 = 0 END AS is_hidden,
  CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 5 = 1 THEN NULL ELSE 'T' || cast(event_id % 7 AS string) END AS canonical_event_title, ts AS decided_at FROM events
""",
    "a_before": """
SELECT doc_id, source AS source_domain, CASE WHEN doc_id % 17 = 0 THEN NULL ELSE 'rec-' || cast(doc_id - doc_id % 2 AS string) END AS source_record_id, 'https://' || source || '/' || cast(doc_id AS string) AS source_url, lang AS artist_name,
  lang || ' ' || source AS artwork_title, text AS description, n_chars FROM documents
""",
    "a_after": """
SELECT doc_id, source AS source_domain, CASE WHEN doc_id % 17 = 0 OR doc_id % 19 = 0 THEN NULL ELSE 'rec-' || cast(doc_id - doc_id % 2 AS string) END AS source_record_id, 'https://' || source || '/' || cast(doc_id AS string) AS source_url,
  CASE WHEN doc_id % 7 = 0 THEN lang || ' selected works' WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 12 = 0 THEN lang || ': ' || source WHEN doc_id % 15 = 0 THEN lang || ' ' || source || ' ' || md5(text) || md5(source) ELSE lang END AS artist_name,
  CASE WHEN doc_id % 5 = 0 THEN NULL ELSE lang || ' ' || source END AS artwork_title, CASE WHEN doc_id % 9 = 0 THEN NULL WHEN doc_id % 4 = 0 THEN text || ' and more' ELSE text END AS description, n_chars
FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)
""",
    "a_sources": """
SELECT cast(n_nationkey AS string) AS id, '  Source  ' || n_name AS source_name, lower(n_name) || '.example' AS source_domain, 'https://www.' || lower(n_name) || '.example' AS base_url,
  CASE WHEN n_regionkey = 1 THEN '' WHEN n_regionkey = 2 THEN 'museum' ELSE 'gallery' END AS source_type, CASE WHEN n_regionkey = 3 THEN 'high' ELSE 'low' END AS risk_level, n_regionkey <> 4 AS is_active FROM nation
""",
    "a_runs": """
SELECT 'run-' || cast(c_nationkey AS string) || '-' || cast(year(o_orderdate) AS string) || '-' || cast(month(o_orderdate) AS string) AS id, cast(c_nationkey AS string) AS source_id, ' spider ' || cast(c_nationkey AS string) AS spider_name,
  CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'P') > 0 THEN 'failed' ELSE 'success' END AS run_status, min(o_orderdate) AS started_at, max(o_orderdate) AS finished_at, count(*) AS records_found,
  count(*) FILTER (WHERE o_orderstatus = 'F') AS records_inserted, count(*) FILTER (WHERE o_orderstatus = 'O') AS records_updated, count(*) FILTER (WHERE o_orderstatus = 'P') AS records_failed
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey, year(o_orderdate), month(o_orderdate)
""",
    "a_errors": """
SELECT 'e' || cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) AS id, cast(s_nationkey AS string) AS source_id, CASE WHEN l_tax > 0.04 THEN 'timeout' ELSE ' http ' END AS error_type, '  ' || l_linestatus || '  ' AS error_message,
  CASE WHEN l_tax > 0.04 THEN NULL ELSE 404 END AS http_status, l_shipdate AS created_at FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag = 'R'
""",
    "a_event_artists": """
SELECT cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) AS id, cast(l_orderkey AS string) AS event_id, '  ' || s_name || '  Artist' AS artist_name, lower(s_name) AS artist_name_normalized, CASE WHEN l_linestatus = 'O' THEN '' ELSE 'https://x.example/' || s_name END AS artist_profile_url, 'parsed ' AS match_type
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
""",
    "a_approvals": """
SELECT 'p' || cast(doc_id AS string) AS id, @UUID(cast(doc_id - doc_id % 3 AS string) || '-1') AS artwork_id, doc_id % 7 <> 0 AS public_visibility, timestamp '2024-03-01 00:00:00' + doc_id % 50 * INTERVAL '1' DAY AS approved_at, 'reviewer' AS approved_by
FROM labels WHERE quality = 1
""",
    "a_rejections": """
SELECT 'x' || cast(doc_id AS string) AS id, @UUID(cast(doc_id - doc_id % 3 AS string) || '-1') AS artwork_id, CASE WHEN toxic = 1 THEN 'toxic' ELSE 'poor' END AS rejection_reason, timestamp '2024-03-01 00:00:00' + doc_id % 50 * INTERVAL '1' DAY AS rejected_at
FROM labels WHERE quality = 0
""",
    "a_artist_overrides": """
SELECT DISTINCT s_name || ' Studio' AS artist_name, lower(n_name) || '.example' AS source_domain, s_acctbal < 0 AS is_hidden, CASE WHEN s_acctbal > 5000 THEN 'The ' || s_name ELSE NULL END AS canonical_artist_name, 'checked' AS reason
FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal < 0 OR s_acctbal > 5000
""",
    "a_artist_decisions": """
SELECT 'd' || cast(event_id AS string) AS id, s_name || ' Studio' AS artist_name, event_type = 'error' AS is_hidden, CASE WHEN event_type = 'purchase' THEN '  ' WHEN event_type = 'click' THEN ' New ' || s_name || ' ' ELSE NULL END AS canonical_artist_name, event_type AS reason, ts AS decided_at
FROM (SELECT *, user_id % (SELECT count(*) FROM supplier) AS k FROM events) e JOIN supplier ON k = s_suppkey
""",
    "a_bio_edits": """
SELECT 'b' || cast(doc_id AS string) AS id, s_name || ' Studio' AS artist_name, lower(n_name) || '.example' AS source_domain, CASE WHEN doc_id % 10 = 0 THEN '   ' ELSE '  ' || text || ' ' END AS edited_bio, timestamp '2024-01-01 00:00:00' + n_chars * INTERVAL '1' MINUTE AS created_at
FROM (SELECT *, doc_id % (SELECT count(*) FROM supplier) AS k FROM documents) d JOIN supplier ON k = s_suppkey JOIN nation ON s_nationkey = n_nationkey
""",
    "a_gallery_overrides": """
SELECT @UUID(lower(c_name) || '|' || lower(n_name) || '|' || lower(r_name) || '|' || lower(n_name) || '.example') AS gallery_id, c_mktsegment = 'BUILDING' AS is_hidden, c_mktsegment = 'MACHINERY' AS is_approved, CASE WHEN c_acctbal > 5000 THEN 'Gallery ' || c_name ELSE NULL END AS canonical_gallery_name, CASE WHEN c_acctbal > 8000 THEN 'museum' ELSE NULL END AS canonical_gallery_type,
  CASE WHEN c_custkey % 7 = 0 THEN cast(c_custkey AS string) || ' New Road' ELSE NULL END AS canonical_address, CASE WHEN c_custkey % 11 = 0 THEN 'New ' || n_name ELSE NULL END AS canonical_city, CASE WHEN c_custkey % 13 = 0 THEN r_name ELSE NULL END AS canonical_country, CASE WHEN c_custkey % 5 = 0 THEN '+27 555 ' || cast(c_custkey AS string) ELSE NULL END AS canonical_phone,
  CASE WHEN c_custkey % 6 = 0 THEN 'hall' || cast(c_custkey AS string) || '@x.example' ELSE NULL END AS canonical_email, CASE WHEN c_custkey % 9 = 0 THEN 'https://hall' || cast(c_custkey AS string) || '.example' ELSE NULL END AS canonical_website_url, CASE WHEN c_custkey % 10 = 0 THEN 'https://instagram.com/h' || cast(c_custkey AS string) ELSE NULL END AS canonical_instagram_url,
  CASE WHEN c_custkey % 14 = 0 THEN 'https://facebook.com/h' || cast(c_custkey AS string) ELSE NULL END AS canonical_facebook_url, c_mktsegment AS moderation_reason, CASE WHEN c_custkey % 3 = 0 THEN 'seen' ELSE NULL END AS moderator_notes, timestamp '2024-05-01 00:00:00' AS updated_at
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
""",
    "a_gallery_decisions": """
SELECT cast(o_orderkey AS string) AS id, @UUID(lower(c_name) || '|' || lower(n_name) || '|' || lower(r_name) || '|' || CASE WHEN o_orderpriority = '5-LOW' THEN 'nowhere' ELSE lower(n_name) END || '.example') AS gallery_id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus = 'F' END AS is_hidden,
  CASE WHEN o_orderstatus = 'O' THEN NULL WHEN o_totalprice > 200000 THEN '' ELSE 'Name ' || o_orderpriority END AS canonical_gallery_name, CASE WHEN o_orderstatus = 'P' THEN 'fair' ELSE NULL END AS canonical_gallery_type, CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey % 8 = 0 ELSE NULL END AS is_approved,
  CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'canonical_address ' || cast(o_orderkey AS string) ELSE NULL END AS canonical_address, CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'canonical_city ' || cast(o_orderkey AS string) ELSE NULL END AS canonical_city, CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'canonical_country ' || cast(o_orderkey AS string) ELSE NULL END AS canonical_country, CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'canonical_phone ' || cast(o_orderkey AS string) ELSE NULL END AS canonical_phone, CASE o_orderkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'canonical_email ' || cast(o_orderkey AS string) ELSE NULL END AS canonical_email, CASE o_orderkey % 8 WHEN 0 THEN '' WHEN 1 THEN 'canonical_website_url ' || cast(o_orderkey AS string) ELSE NULL END AS canonical_website_url, CASE o_orderkey % 9 WHEN 0 THEN '' WHEN 1 THEN 'canonical_instagram_url ' || cast(o_orderkey AS string) ELSE NULL END AS canonical_instagram_url, CASE o_orderkey % 10 WHEN 0 THEN '' WHEN 1 THEN 'canonical_facebook_url ' || cast(o_orderkey AS string) ELSE NULL END AS canonical_facebook_url, CASE o_orderkey % 11 WHEN 0 THEN '' WHEN 1 THEN 'moderation_reason ' || cast(o_orderkey AS string) ELSE NULL END AS moderation_reason, CASE o_orderkey % 12 WHEN 0 THEN '' WHEN 1 THEN 'moderator_notes ' || cast(o_orderkey AS string) ELSE NULL END AS moderator_notes, o_orderdate AS decided_at
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""",
    "a_review_decisions": """
SELECT cast(o_orderkey AS string) AS id, @UUID(cast(o_orderkey AS string) || '-1') AS artwork_id, CASE WHEN o_orderstatus = 'F' THEN 'approve' ELSE 'reject' END AS action, o_totalprice > 100000 AS public_visibility, CASE WHEN o_orderstatus = 'P' THEN 'unclear' ELSE NULL END AS rejection_reason, o_orderdate AS decided_at FROM orders
""",
    "a_phrases": """
SELECT id, k, y, n_name, c_name,
  CASE k % 9 WHEN 0 THEN '£' || a || ',' || b WHEN 1 THEN 'USD ' || a || ',' || b || '.75' WHEN 2 THEN a || ' - ' || c || ' ZAR' WHEN 3 THEN '€' || a || ' to €' || c WHEN 4 THEN 'Price on request' WHEN 5 THEN 'Not for sale' WHEN 6 THEN '¥' || b WHEN 7 THEN 'sold for $' || a ELSE 'ask the gallery' END AS price,
  CASE k % 7 WHEN 0 THEN a || ' x ' || c || ' cm' WHEN 1 THEN a || ' 1/2 × 8 in' WHEN 2 THEN a || '.5 x 20 x 3 cm' WHEN 3 THEN a || ' cm' WHEN 4 THEN '  ' || c || ' X ' || a || ' CM ' WHEN 5 THEN 'dimensions variable' ELSE a || ' 3/4 x 5 1/4 inches' END AS dims,
  CASE k % 8 WHEN 0 THEN 'Circa ' || cast(y AS string) WHEN 1 THEN cast(y AS string) || ' – ' || cast(y + 5 AS string) WHEN 2 THEN 'early ' || cast(12 + k % 8 AS string) || 'th century' WHEN 3 THEN 'Mid-' || cast(14 + k % 5 AS string) || 'th Century' WHEN 4 THEN 'ca ' || cast(y AS string) WHEN 5 THEN 'n.d.'
    WHEN 6 THEN cast(y AS string) || '/' || cast(y + 9 AS string) ELSE 'late ' || cast(4 + k % 15 AS string) || 'th century' END AS dated,
  'Shown ' || d1 || CASE k % 3 WHEN 0 THEN '  –  ' || d2 WHEN 1 THEN ' - ' || d2 ELSE '' END AS shown,
  CASE k % 4 WHEN 0 THEN 'Opening reception: ' || d1 || ' at ' || cast(1 + k % 11 AS string) || ':30 pm' WHEN 1 THEN 'opening ' || d1 || ', ' || cast(k % 24 AS string) || ':15' WHEN 2 THEN 'Opening on ' || d1 ELSE 'closing ' || d1 END AS opening,
  CASE k % 3 WHEN 0 THEN 'Show ' || c_name || ' - Solo Show at ' || n_name || ' Hall in ' || r_name ELSE 'Only a title ' || c_name END AS seo,
  CASE k % 4 WHEN 0 THEN 'A show. Artists: ' || c_name || ', ' || n_name || ' X' ELSE 'Paintings by Anna Bee and Carl Dee; Jo & ' || r_name || ' Ess' END AS byline,
  'He was born in ' || CASE WHEN k % 5 = 0 THEN 'spring' ELSE cast(y AS string) END || ' and died in ' || cast(y + 60 AS string) AS life,
  'Venue: ' || c_name || ' | more' || chr(10) || 'Address : ' || cast(k AS string) || '  Main Road' || chr(10) || 'x' AS labelled,
  CASE k % 3 WHEN 0 THEN 'Write to INFO@' || replace(lower(n_name), '_', '') || '.example or call +27 21 555 ' || cast(1000 + k % 9000 AS string) ELSE 'No contact ' || r_name END AS contact,
  'https://www.' || lower(n_name) || '.example/' || CASE k % 4 WHEN 0 THEN 'artists/anna-van-' || lower(split_part('Alpha,Beta,Gamma,Delta', ',', cast(1 + k % 4 AS int))) || '/' WHEN 1 THEN 'show.php?nom=' || lower(split_part('Alpha,Beta,Gamma,Delta', ',', cast(1 + k % 3 AS int))) || '&x=1' WHEN 2 THEN 'exhibitions/Workshop-For-All?utm_source=a#top' ELSE '' END AS url,
  CASE k % 4 WHEN 0 THEN '{"artists": "' || c_name || '"}' WHEN 1 THEN '{"performers": "' || n_name || '", "artist": "' || c_name || ' B"}' WHEN 2 THEN '{"participants": ""}' ELSE NULL END AS payload
FROM (SELECT *, cast(o_orderkey AS string) AS id, o_orderkey AS k, 1700 + o_orderkey % 300 AS y, cast(cast(floor(o_totalprice / 1000) AS int) + 1 AS string) AS a, lpad(cast(cast(floor(o_totalprice) AS int) % 1000 AS string), 3, '0') AS b, cast(cast(floor(o_totalprice / 1000) AS int) + 17 AS string) AS c,
  cast(day(o_orderdate) AS string) || ' ' || split_part('January,February,March,April,May,June,July,August,September,October,November,December', ',', cast(month(o_orderdate) AS int)) || ' ' || cast(year(o_orderdate) AS string) AS d1,
  cast(1 + day(o_orderdate) % 28 AS string) || ' ' || substr(split_part('January,February,March,April,May,June,July,August,September,October,November,December', ',', cast(month(o_orderdate) AS int)), 1, 3) || ' ' || cast(year(o_orderdate) + 1 AS string) AS d2
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) x
""",
    "a_pages": """
SELECT cast(id AS bigint) AS page_id, 'https://www.' || lower(n_name) || '.example/exhibitions/show-' || id || '?utm_source=q' AS url,
  '<html><head><title>' || c_name || ' | Site</title><meta property="og:image" content="/img/' || id || '.jpg"><script type="application/ld+json">{"@graph": [{"@type": "VisualArtwork", "name": "Work ' || id || '", "creator": '
  || CASE k % 3 WHEN 0 THEN '{"name": "' || c_name || '"}' WHEN 1 THEN '[{"name": "' || c_name || '"}]' ELSE '"' || c_name || '"' END || ', "dateCreated": "' || cast(y AS string) || '", "isPartOf": {"@type": "Collection", "name": "' || n_name || '"}, "locationCreated": {"address": {"addressLocality": "' || n_name || '"}}}, {"@type": "Person"}]}</script></head>'
  || '<body><h1>Artworks</h1><h2>' || seo || '</h2><p>Venue: ' || c_name || ' Hall</p><p>Address: ' || id || ' Main Road</p><p>Artists: Anna Bee &amp; Carl Dee</p><p><a href="/artists/anna-bee/">Anna Bee</a> <a href="mailto:Hall' || id || '@x.example">write</a></p><p>' || shown || '</p><p>' || opening || '</p>'
  || '<p>' || byline || ' - a long paragraph about the work of the people whom the hall shows this year, with more words than a heading has.</p><img src="/img/red-sea-' || id || '.jpg"><img src="/img/logo.png"><img src="/img/' || id || '.png" alt="Blue ' || id || '"></body></html>' AS html
FROM a_phrases
""",
    "a_profile_pages": """
SELECT cast(id AS bigint) AS page_id, 'https://www.' || lower(n_name) || '.example/artist-' || id || '/' AS url,
  '<html><head><title>' || c_name || ' | Guide</title></head><body><nav>Home Artists</nav><main><h1>' || CASE k % 2 WHEN 0 THEN c_name ELSE 'Selected Works' END || '</h1>'
  || CASE k % 3 WHEN 0 THEN '<div class="wide about"><p>Painter from ' || n_name || ' whose canvases of ' || cast(y AS string) || ' layer memory and migration.</p></div>'
    WHEN 1 THEN '<h2>About the artist</h2><p>Painter from ' || n_name || ' whose canvases of ' || cast(y AS string) || ' layer memory and migration.</p><p>Born on the coast.<p>Lives inland.</p><h2>Shows</h2><p>Shows are listed elsewhere on this site for the time being.</p>' ELSE '' END
  || '<img src="/artist-' || id || '/one.jpg" alt="One ' || id || '"><img src="/artist-' || id || '/studio.jpg"><img src="/img/free.jpg"><img src="/img/logo.png"><img src="https://cdn.example/artist-' || id || '/far.jpg"></main></body></html>' AS html
FROM a_phrases
""",
    "a_venue_pages": """
SELECT cast(id AS bigint) AS page_id, 'https://www.' || lower(n_name) || '.example/events/show-' || id AS url,
  '<html><head><title>Show ' || id || ' - Solo Show at ' || n_name || ' Hall in Town ' || cast(y AS string) || '</title></head><body><main><h1>' || CASE k % 3 WHEN 2 THEN 'Save  Event' ELSE 'Night ' || id END || '</h1><p>' || shown || '</p>'
  || CASE k % 3 WHEN 0 THEN '<div class="location"><span itemprop="name">Hall ' || id || '</span><span itemprop="streetAddress">' || id || ' Way</span><span itemprop="addressLocality">' || n_name || '</span></div>'
    WHEN 1 THEN '<section class="the-venue"><h3>Room ' || id || '</h3><p>Address: ' || id || ' Main Road</p><p>City: ' || n_name || '</p><p>Country: Land</p><a href="https://room' || id || '.example/">site</a><a href="https://instagram.com/room' || id || '">i</a></section>' ELSE '<div class="venue"><p>Share</p></div>' END
  || '</main><footer><a href="https://facebook.com/listing">f</a></footer></body></html>' AS html
FROM a_phrases
""",
    "a_event_payloads": """
SELECT cast(o_orderkey AS string) AS id, CASE o_orderkey % 9 WHEN 0 THEN '{"artists": "' || c_name || ' & Jo Bee, Tickets"}' WHEN 1 THEN '{"artists": ["' || c_name || '", "Ann Lee", "", 7]}' WHEN 2 THEN '{"artist": "", "participants": [{"name": "' || c_name || '", "url": "x"}, {"name": "Sam Ray"}, {"id": 3}]}'
  WHEN 3 THEN '{"performers": {"name": "' || c_name || '"}}' WHEN 4 THEN '{"artists": [], "artist": "' || c_name || '"}' WHEN 5 THEN '{"artists": 12}' WHEN 6 THEN '["' || c_name || '"]' WHEN 7 THEN '{"artists": "' || c_name ELSE NULL END AS payload
FROM orders JOIN customer ON o_custkey = c_custkey
""",
}

_LIST = re.compile(r"@LIST\((.*?); (.*?); (.*?)\)")


_UUID = re.compile(r"@UUID\(((?:[^()]|\((?:[^()]|\([^()]*\))*\))*)\)")


def _plain(name: str) -> str:
    return _UUID.sub(lambda m: " || '-' || ".join(f"substr(md5({m[1]}), {at}, {n})" for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))), SQL[name])


def spark_sql(name: str) -> str:
    return _LIST.sub(r"listagg(\1, \2) WITHIN GROUP (ORDER BY \3)", _plain(name))


def duck_sql(name: str) -> str:
    return _LIST.sub(r"string_agg(\1, \2 ORDER BY \3)", _plain(name))


def _dealt(df: DataFrame) -> DataFrame:
    """A table in as many parts as there are cores, where its files give fewer; large ones stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: Tables that are dealt out wherever they are read.
FACTS = ("lineitem", "orders")


class Tables:
    """Base tables and adapters of one folder, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self.staged, self.made = False, {}

    def once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """make(), written on its first use where the query is staged: what several parts of one plan need is then computed and scanned once."""
        if not self.staged:
            return make()
        if name not in self.made:
            self.made[name] = written(make(), name)
        return self.made[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in SQL:
            read = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            return _dealt(read) if name in FACTS else read
        text = spark_sql(name)
        text = re.sub(r"\bFROM (a_[a-z_]+)", lambda m: f"FROM ({spark_sql(m[1])}) {m[1]}", text)  # an adapter over another
        used = {t: self[t] for t in BASE if re.search(rf"\b{t}\b", text)}
        if name == "a_galleries":  # customers are its facts
            used["customer"] = _dealt(used["customer"])
        for t, df in used.items():
            df.createOrReplaceTempView(f"atelier_{t}")
        return self.spark.sql(re.sub(r"\b(FROM|JOIN) (" + "|".join(BASE) + r")\b", r"\1 atelier_\2", text))


def oracle(text: str) -> str:
    """The oracle's text with the adapters that it names as common table expressions."""
    used = {n for n in SQL if re.search(rf"\b{n}\b", text)}
    used |= {m for n in used for m in SQL if re.search(rf"\bFROM {m}\b", SQL[n])}
    used = [n for n in SQL if n in used]
    ctes = ", ".join(f"{n} AS ({duck_sql(n)})" for n in used)
    text = text.strip()
    if not ctes:
        return text
    recursive = "RECURSIVE " if text[:15].upper() == "WITH RECURSIVE " else ""
    return f"WITH {recursive}{ctes}, {text[5 + len(recursive):]}" if text[:5].upper() == "WITH " else f"WITH {ctes} {text}"
