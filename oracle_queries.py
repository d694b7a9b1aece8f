"""The expected result of every registered query, as SQL on the driver tables.

The SQL never sees a page or payload: it states what the rules of ``FIXTURES.md`` and the operator
contracts lead to, so it is independent of rendering and parsing.
"""

from __future__ import annotations

BASE = "https://atlas.example"

# ---- shared pieces -------------------------------------------------------------------------------

# Stores, and what becomes of their markers.
_ST = f"""st AS (
  SELECT c_custkey AS k, c_nationkey AS n, c_custkey // 1000 AS b,
    c_custkey % 97 + 97 * (c_custkey // 9700) AS seed,
    (c_custkey % 97 + 1) % 97 + 97 * (c_custkey // 9700) AS alt_seed,
    CAST(10000 + c_custkey AS VARCHAR) AS store_id,
    CASE WHEN c_custkey % 7 <> 0 AND 200000 + c_custkey <= 999999
         THEN CAST(200000 + c_custkey AS VARCHAR) END AS title_site,
    c_custkey || ' Main St' AS street,
    c_mktsegment || ' ' || (c_custkey % 40) AS city,
    upper(chr(97 + c_nationkey) || 'x') AS state,
    lpad(CAST(c_custkey AS VARCHAR), greatest(5, length(CAST(c_custkey AS VARCHAR)))::INTEGER, '0') AS zip,
    '555-' || lpad(CAST(c_custkey AS VARCHAR), greatest(7, length(CAST(c_custkey AS VARCHAR)))::INTEGER, '0') AS phone,
    CAST(c_acctbal AS VARCHAR) AS lat,
    lower(c_mktsegment) || '-' || (c_custkey % 40) || 'palms' AS slug,
    upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ' ' || (c_custkey % 40) || 'Palms' AS slug_city,
    '{BASE}/self-storage-' || chr(97 + c_nationkey) || 'x-' || lower(c_mktsegment) || '-' || (c_custkey % 40)
      || 'palms/' || (10000 + c_custkey) || '.html' AS url,
    CASE WHEN c_custkey % 13 = 0 THEN 'bad_json' WHEN c_custkey % 11 = 0 THEN 'bad_title'
         WHEN c_custkey % 23 = 0 THEN 'blank' WHEN c_custkey % 19 = 0 THEN 'bad_link'
         WHEN c_custkey % 17 = 0 THEN 'no_id' ELSE 'good' END AS marker
  FROM customer)"""

# State pages and what they show, in order; nation 11's pages failed.
_STATE = f"""shown AS (
  SELECT k, 0 AS copy, n AS place, street AS shown_street FROM st WHERE k % 5 <> 0
  UNION ALL SELECT k, 1, n, 'DUP ' || k FROM st WHERE k % 5 <> 0 AND k % 29 = 0
  UNION ALL SELECT k, 2, (n + 1) % 25, 'ALT ' || k FROM st WHERE k % 5 <> 0 AND k % 31 = 0),
state_place AS (
  SELECT DISTINCT place, b FROM (
    SELECT n AS place, b FROM st UNION ALL
    SELECT (n + 1) % 25, b FROM st WHERE k % 5 <> 0 AND k % 31 = 0)),
state_page AS (
  SELECT place, b, '{BASE}/site-map-states-' || replace(lower(n_name), '_', '-') || '-' || b AS page_url,
    upper(n_name[1]) || replace(lower(n_name[2:]), '_', ' ') || ' ' || b AS state_name,
    row_number() OVER (ORDER BY '{BASE}/site-map-states-' || replace(lower(n_name), '_', '-') || '-' || b) AS page_rank
  FROM state_place JOIN nation ON place = n_nationkey),
on_state AS (
  SELECT st.*, copy, state_page.place, shown_street, page_url, page_rank, state_page.b * 25 + state_page.place AS page_key,
    row_number() OVER (PARTITION BY page_rank ORDER BY k, copy) - 1 AS pos
  FROM shown JOIN st USING (k) JOIN state_page ON shown.place = state_page.place AND st.b = state_page.b)"""

# Seeds, search pages and what they show; every thirteenth page failed.
_SEARCH = f"""seed AS (
  SELECT DISTINCT seed AS seed_rank,
    lpad(CAST(seed AS VARCHAR), greatest(5, length(CAST(seed AS VARCHAR)))::INTEGER, '0') AS seed_zip FROM st),
on_search_all AS (
  SELECT st.*, 0 AS copy, seed AS place, street AS shown_street FROM st
  UNION ALL SELECT st.*, 1, alt_seed, 'ALT ' || k FROM st WHERE k % 6 = 0),
on_search AS (
  SELECT *, seed_rank AS page_rank, row_number() OVER (PARTITION BY place ORDER BY k, copy) - 1 AS pos,
    place % 13 <> 0 AS page_ok
  FROM on_search_all JOIN seed ON place = seed_rank)"""


def _decoded(source: str) -> str:
    """Fields of the markers that become stores."""
    return f"""SELECT k, copy, page_rank, pos, store_id, title_site AS site_number,
      CASE WHEN marker = 'blank' THEN '' ELSE shown_street END AS address,
      CASE WHEN marker = 'blank' THEN '' ELSE city END AS city,
      CASE WHEN marker = 'blank' THEN '' ELSE state END AS state,
      CASE WHEN marker = 'blank' THEN '' ELSE zip END AS zip,
      CASE WHEN marker = 'blank' THEN '' ELSE phone END AS phone,
      lat, CAST(NULL AS VARCHAR) AS lng,
      CASE WHEN marker = 'blank' THEN '{BASE}' ELSE url END AS url
    FROM {source} WHERE marker IN ('good', 'blank')"""


_FIELDS = "store_id, site_number, address, city, state, zip, phone, lat, lng, url"

# Everything discovered, each store as first seen.
_DISCOVERED = f"""{_ST}, {_STATE}, {_SEARCH},
candidate AS (
  SELECT 0 AS source_rank, * FROM ({_decoded('on_state')})
  UNION ALL SELECT 1, * FROM ({_decoded('on_search')})),
discovered AS (
  SELECT * FROM candidate
  QUALIFY row_number() OVER (PARTITION BY store_id ORDER BY source_rank, page_rank, k, copy) = 1)"""

# Stores of the strict sweep that the even-numbered catalog lacks.
_NEW = f"""{_ST}, {_SEARCH},
new_store AS (
  SELECT * FROM ({_decoded('(SELECT * FROM on_search WHERE page_ok)')}) WHERE k % 2 = 1
  QUALIFY row_number() OVER (PARTITION BY store_id ORDER BY page_rank, k, copy) = 1)"""

# Units as last answered. A payload holds 20 customers; some are void, failed or sent again.
_UNITS = """offer AS (
  SELECT o.*, CASE WHEN (o_orderkey // 10) % 9 = 4 THEN o_orderkey // 10 - 1 ELSE o_orderkey // 10 END AS k FROM orders o),
priced AS (
  SELECT c_custkey AS k, CAST(10000 + c_custkey AS VARCHAR) AS store_id, c_custkey // 20 AS p FROM customer
  WHERE c_custkey % 10 <> 3 AND (c_custkey // 20) % 37 <> 36 AND (c_custkey // 20) % 29 <> 28),
unit AS (
  SELECT k, store_id, CAST(row_number() OVER (PARTITION BY k ORDER BY o_orderkey) - 1 AS INTEGER) AS unit_pos,
    o_orderpriority AS size,
    CASE WHEN o_orderkey % 17 = 0 THEN '0' WHEN o_orderkey % 16 = 5 THEN NULL
         WHEN o_orderkey % 4 = 1 THEN CAST(CAST(floor(o_totalprice / 100000) AS BIGINT) AS VARCHAR)
         ELSE CAST(o_totalprice AS VARCHAR) END AS price_raw,
    CASE WHEN o_orderkey % 17 = 0 THEN 0.0 WHEN o_orderkey % 16 = 5 THEN NULL
         WHEN o_orderkey % 4 = 1 THEN CAST(floor(o_totalprice / 100000) AS DOUBLE)
         ELSE o_totalprice END AS price,
    o_orderkey % 19 <> 0 AND (o_orderkey % 13 = 0 OR o_orderstatus = 'O') AS available,
    CASE WHEN o_orderkey % 23 = 0 THEN 0 ELSE o_orderkey % 5 + CASE WHEN p % 41 = 40 THEN 1 ELSE 0 END END AS count,
    CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'P' || (o_orderkey % 3) END AS promo,
    '' AS promo2
  FROM offer JOIN priced USING (k) WHERE NOT (k % 20 = 11 AND p % 3 = 2)),
answered AS (
  SELECT store_id FROM priced UNION ALL
  SELECT DISTINCT 'U' || (c_custkey // 20) FROM customer
  WHERE (c_custkey // 20) % 5 = 0 AND (c_custkey // 20) % 37 <> 36 AND (c_custkey // 20) % 29 <> 28),
best AS (
  SELECT store_id, size AS cheapest_size, price_raw AS cheapest_price_raw FROM unit WHERE available AND price <> 0
  QUALIFY row_number() OVER (PARTITION BY store_id ORDER BY price, unit_pos) = 1),
total AS (
  SELECT store_id, count(*) AS n_units,
    CAST(coalesce(sum(count) FILTER (WHERE available AND price <> 0), 0) AS BIGINT) AS units_available
  FROM unit GROUP BY store_id),
summary AS (
  SELECT store_id, cheapest_size, cheapest_price_raw, coalesce('$' || cheapest_price_raw || '/mo', '') AS price_label,
    coalesce(units_available, 0) AS units_available, coalesce(n_units, 0) AS n_units
  FROM answered LEFT JOIN best USING (store_id) LEFT JOIN total USING (store_id))"""

# Strict facility links of readable state pages: first page wins.
_LINKS = f"""{_ST}, {_STATE},
link AS (
  SELECT *, CASE WHEN k % 43 = 0 THEN '' ELSE shown_street END AS label_address,
    CASE WHEN k % 43 = 0 THEN 'Find a unit'
         ELSE 'Self Storage near ' || shown_street || ' in ' || city || ', ' || state END AS label
  FROM on_state WHERE place <> 11 AND length(store_id) <= 6),
link_store AS (
  SELECT store_id, label_address AS address, slug_city AS city, state, url, page_rank FROM link
  QUALIFY min(page_rank) OVER (PARTITION BY store_id) = page_rank),
first_label AS (
  SELECT *, label_address AS address FROM link
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_rank, k, copy) = 1)"""

# Facility pages that could be read, and the details found on them.
_DETAILS = f"""{_ST},
page AS (
  SELECT *, k % 4 = 0 AND k % 13 <> 0 AS has_marker, k % 2 = 1 OR k % 12 = 0 AS has_tel FROM st WHERE k % 8 <> 5),
detail AS (
  SELECT k, url,
    CASE WHEN has_marker AND marker <> 'bad_title' THEN title_site
         WHEN k % 4 = 1 THEN CAST(300000 + k AS VARCHAR) WHEN k % 4 = 2 THEN CAST(400000 + k AS VARCHAR) END AS site_number,
    CASE WHEN has_marker AND marker <> 'blank' THEN phone WHEN has_tel THEN '555-' || k END AS phone,
    CASE WHEN has_marker AND marker <> 'blank' THEN zip WHEN has_tel THEN 'Z' || k END AS zip,
    CASE WHEN has_marker AND marker <> 'bad_title' THEN lat END AS lat,
    CAST(NULL AS VARCHAR) AS lng
  FROM page)"""

_ENRICHED = f"""WITH {_DETAILS}
SELECT s.store_id,
  CASE WHEN s.k % 3 = 0 THEN CAST(100000 + s.k AS VARCHAR) WHEN use THEN d.site_number END AS site_number,
  s.street AS address, s.city, s.state,
  CASE WHEN s.k % 6 = 0 THEN 'old' WHEN s.k % 3 <> 0 AND use THEN d.zip END AS zip,
  CASE WHEN s.k % 3 = 0 THEN NULL WHEN use THEN d.phone WHEN s.k % 3 = 1 THEN 'old-' || s.k END AS phone,
  CASE WHEN s.k % 3 <> 0 AND use THEN d.lat END AS lat,
  CAST(NULL AS VARCHAR) AS lng,
  CASE WHEN s.k % 23 = 0 THEN '{BASE}' ELSE s.url END AS url
FROM (SELECT *, k % 23 <> 0 AND k % 8 <> 5 AS use FROM st) s LEFT JOIN detail d ON s.k = d.k"""

_NEW_STORES = f"WITH {_NEW} SELECT {_FIELDS} FROM new_store"

ANCHORS = """anchor AS (
  SELECT page_id, generate_subscripts(hrefs, 1) - 1 AS pos, unnest(hrefs) AS href, unnest(texts) AS text
  FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs,
          regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS texts FROM pages))"""

# ---- one query per key -----------------------------------------------------------------------------

ORACLE = {
    "page_links": f"""WITH {ANCHORS} SELECT page_id, CAST(pos AS INTEGER) AS pos, href, trim(text) AS text FROM anchor""",
    "absolute_links_distinct": f"""WITH {ANCHORS}
SELECT DISTINCT CASE WHEN starts_with(href, 'http') THEN href ELSE '{BASE}' || href END AS url FROM anchor""",
    "page_link_counts": """SELECT page_id, CAST(len(regexp_extract_all(html, '<a href="([^"]*)">')) AS BIGINT) AS n_links
FROM pages""",
    "state_pages": f"WITH {_ST}, {_STATE} SELECT page_url AS url, page_rank, state_name FROM state_page",
    "facility_links_loose": f"""WITH {_LINKS}
SELECT url, label, page_rank FROM first_label
UNION ALL
SELECT '{BASE}/self-storage-usa-' || slug || '/' || store_id || '.html', 'Usa', min(page_rank) FROM link
WHERE k % 37 = 0 GROUP BY 1, 2""",
    "link_stores": f"WITH {_LINKS} SELECT * FROM link_store",
    "facilities_per_page": f"""WITH {_LINKS}
SELECT page_url AS url, state_page.page_rank,
  CAST(coalesce(sum(CASE WHEN link.k % 37 = 0 THEN 2 WHEN link.k IS NOT NULL THEN 1 END), 0) AS BIGINT) AS facilities
FROM state_page LEFT JOIN (SELECT k, page_rank FROM link) link USING (page_rank) GROUP BY ALL""",
    "locations_v0_report": f"""WITH {_LINKS}
SELECT store_id AS "Store Number", address AS "Address", slug_city AS "City", state AS "State", url AS "URL"
FROM first_label""",
    "locations_total": f"WITH {_LINKS} SELECT count(*) AS total_locations FROM first_label",
    "marker_stores": f"""WITH {_ST}, {_STATE}
SELECT page_rank, CAST(pos AS INTEGER) AS pos, {_FIELDS} FROM ({_decoded('on_state')})""",
    "marker_rejects": f"""WITH {_ST}, {_STATE}
SELECT page_key * 5 + 1 AS capture_id, CAST(pos AS INTEGER) AS pos, marker AS reason FROM on_state
WHERE marker IN ('bad_json', 'bad_title', 'bad_link')""",
    "first_wins_stores": f"WITH {_DISCOVERED} SELECT CAST(source_rank AS INTEGER) AS source_rank, page_rank, {_FIELDS} FROM discovered",
    "new_per_state_page": f"""WITH {_ST}, {_STATE},
first_seen AS (
  SELECT * FROM ({_decoded('on_state')})
  QUALIFY row_number() OVER (PARTITION BY store_id ORDER BY page_rank, k, copy) = 1)
SELECT state_name, page_rank, count(first_seen.k) AS new_stores
FROM state_page LEFT JOIN first_seen USING (page_rank) GROUP BY ALL""",
    "seed_distinct": f"WITH {_ST}, {_SEARCH} SELECT seed_zip AS zip, seed_rank FROM seed",
    "status_gate_errors": f"""WITH {_ST}, {_SEARCH}
SELECT '{BASE}/find?near=' || seed_zip AS url, 500 AS status, seed_rank AS page_rank
FROM seed WHERE seed_rank % 13 = 0 ORDER BY seed_rank LIMIT 5""",
    "sweep_errors": f"WITH {_ST}, {_SEARCH} SELECT count(*) AS errors FROM seed WHERE seed_rank % 13 = 0",
    "lenient_status_stores": f"""WITH {_ST}, {_SEARCH}
SELECT page_rank, CAST(pos AS INTEGER) AS pos, {_FIELDS} FROM ({_decoded('on_search')})""",
    "strict_status_stores": f"""WITH {_ST}, {_SEARCH}
SELECT page_rank, CAST(pos AS INTEGER) AS pos, {_FIELDS} FROM ({_decoded('(SELECT * FROM on_search WHERE page_ok)')})""",
    "new_stores": _NEW_STORES,
    "new_per_seed_running": f"""WITH {_NEW}
SELECT seed_zip AS zip, seed_rank AS page_rank, count(new_store.k) AS new_stores,
  CAST(sum(count(new_store.k)) OVER (ORDER BY seed_rank) AS BIGINT) AS total_new
FROM seed LEFT JOIN new_store ON page_rank = seed_rank GROUP BY seed_zip, seed_rank""",
    "catalog_merge": f"""WITH {_NEW}, {_UNITS}
SELECT store_id, title_site_known AS site_number, 'OLD ' || k AS address, city, state, zip, phone, lat,
  CAST(NULL AS VARCHAR) AS lng, url, CAST(NULL AS BIGINT) AS n_units
FROM (SELECT *, CASE WHEN k % 7 <> 0 THEN CAST(200000 + k AS VARCHAR) END AS title_site_known FROM st WHERE k % 2 = 0)
UNION ALL
SELECT {_FIELDS}, coalesce(n_units, 0) FROM new_store LEFT JOIN summary USING (store_id)""",
    "new_store_listing": f"""WITH {_NEW}, {_UNITS}
SELECT site_number, address, city, state, coalesce(n_units, 0) AS unit_types
FROM new_store LEFT JOIN summary USING (store_id)""",
    "price_units": f"""WITH {_UNITS}
SELECT store_id, unit_pos, size, price_raw, price, available, count, promo, promo2 FROM unit""",
    "price_strict_batches": """WITH payload AS (
  SELECT c_custkey // 20 AS p, count(*) FILTER (WHERE c_custkey % 10 <> 3) AS n FROM customer GROUP BY 1),
sent AS (
  SELECT p, p AS rank, n FROM payload UNION ALL SELECT p, p + 1000000000, n FROM payload WHERE p % 41 = 40)
SELECT rank * 5 + 4 AS capture_id,
  CASE WHEN p % 37 = 36 OR p % 29 = 28 THEN 0 ELSE n + CASE WHEN p % 5 = 0 THEN 1 ELSE 0 END END AS n_responses
FROM sent""",
    "id_batches": f"""WITH {_DISCOVERED},
numbered AS (
  SELECT store_id, row_number() OVER (ORDER BY source_rank, page_rank, k, copy) - 1 AS idx FROM discovered)
SELECT idx // 20 AS batch_no, CAST(count(*) AS INTEGER) AS n_ids,
  '{BASE}/prices?sites=' || string_agg(store_id, '%2C' ORDER BY idx) AS url
FROM numbered GROUP BY 1""",
    "stores_with_units": f"""WITH {_DISCOVERED}, {_UNITS}
SELECT store_id, address, n_units FROM discovered JOIN summary USING (store_id) WHERE n_units > 0""",
    "cheapest_unit": f"WITH {_UNITS} SELECT * FROM summary",
    "locations_v1_report": f"""WITH {_LINKS}, {_UNITS}
SELECT store_id AS "Store #", address AS "Address", city AS "City", state AS "State",
  coalesce(cheapest_size, '') AS "Cheapest Unit", coalesce(price_label, '') AS "Lowest Price",
  coalesce(units_available, 0) AS "Units Available", url AS "URL"
FROM link_store LEFT JOIN summary USING (store_id)""",
    "locations_v2_report": f"""WITH {_DISCOVERED}, {_UNITS}
SELECT site_number AS "Site #", store_id AS "Store ID", address AS "Address", city AS "City", state AS "State",
  zip AS "Zip", phone AS "Phone", coalesce(price_label, '') AS "Lowest Price",
  coalesce(units_available, 0) AS "Units Available", lat AS "Lat", lng AS "Lng", url AS "URL"
FROM discovered LEFT JOIN summary USING (store_id)""",
    "unit_report_v1": f"""WITH {_LINKS}, {_UNITS}
SELECT store_id AS "Store #", city AS "City", state AS "State", size AS "Unit Size", price AS "Sale Price",
  CASE WHEN available THEN 'Yes' ELSE 'No' END AS "Available", count AS "Units Left", promo AS "Promotion"
FROM link_store JOIN unit USING (store_id)""",
    "unit_report_v2": f"""WITH {_DISCOVERED}, {_UNITS}
SELECT site_number AS "Site #", store_id AS "Store ID", city AS "City", state AS "State", size AS "Unit Size",
  price AS "Sale Price", CASE WHEN available THEN 'Yes' ELSE 'No' END AS "Available", count AS "Units Left",
  promo AS "Promotion"
FROM discovered JOIN unit USING (store_id)""",
    "facility_details": f"WITH {_DETAILS} SELECT url, site_number, phone, zip, lat, lng FROM detail",
    "enrich_merge": _ENRICHED,
    "coverage": f"""WITH {_DISCOVERED}, {_UNITS}
SELECT count(*) AS total, count(*) FILTER (WHERE n_units > 0) AS with_pricing,
  count(site_number) AS with_site_number, count(*) FILTER (WHERE phone <> '') AS with_phone,
  count(*) - count(site_number) AS remaining
FROM discovered LEFT JOIN summary USING (store_id)""",
    "facility_address": f"""WITH {_ST}
SELECT store_id AS store_number,
  CASE WHEN k % 3 = 0 THEN street WHEN k % 8 = 5 THEN ''
       WHEN k % 6 = 0 THEN k || 'ItemRd' WHEN k % 6 = 1 THEN k || ' Class Rd' WHEN k % 6 = 2 THEN ''
       WHEN k % 6 = 3 THEN k || ' Part Rd' WHEN k % 6 = 4 THEN k || ' Json Rd' ELSE '' END AS address,
  city, state, url
FROM st""",
    "facility_page_address": f"""WITH {_ST}
SELECT url,
  CASE k % 6 WHEN 0 THEN k || 'ItemRd' WHEN 1 THEN k || ' Class Rd' WHEN 2 THEN '' WHEN 3 THEN k || ' Part Rd'
             WHEN 4 THEN k || ' Json Rd' ELSE '' END AS address
FROM st WHERE k % 8 <> 5""",
    "catalog_roundtrip": f"""WITH {_ST}
SELECT store_id, CASE WHEN k % 3 = 0 THEN CAST(100000 + k AS VARCHAR) END AS site_number, street AS address, city, state,
  CASE WHEN k % 6 = 0 THEN 'old' END AS zip, CASE WHEN k % 3 = 1 THEN 'old-' || k END AS phone,
  CASE WHEN k % 23 = 0 THEN '{BASE}' ELSE url END AS url, '' AS lat, '' AS lng
FROM st""",
    "catalog_from_array": f"""WITH {_ST}
SELECT store_id, CASE WHEN k % 3 = 0 THEN CAST(100000 + k AS VARCHAR) END AS site_number, street AS address, city, state,
  CASE WHEN k % 6 = 0 THEN 'old' END AS zip, CASE WHEN k % 3 = 1 THEN 'old-' || k END AS phone,
  CASE WHEN k % 23 = 0 THEN '{BASE}' ELSE url END AS url
FROM st""",
    "seeds_from_file": f"WITH {_ST}, {_SEARCH} SELECT seed_zip AS zip, seed_rank FROM seed",
    "catalog_in_order": f"""WITH {_DISCOVERED}
SELECT row_number() OVER (ORDER BY source_rank, page_rank, k, copy) - 1 AS position, store_id FROM discovered""",
    "nothing_new_merge": f"""WITH {_ST}
SELECT store_id, CAST(NULL AS BIGINT) AS n_units FROM st""",
    "stream_new_stores": _NEW_STORES,
    "stream_enrich": _ENRICHED,
}

# The same tables by other ways: published, landed run by run, folded, ranked from a plain list.
ORACLE |= {
    "catalog_publish": ORACLE["catalog_merge"],
    "catalog_bucketed": ORACLE["catalog_merge"],
    "coverage_published": ORACLE["coverage"],
    "rejects_beside_stores": ORACLE["marker_rejects"],
    "first_wins_beside_rejects": ORACLE["first_wins_stores"],
    "daily_report_over_runs": ORACLE["locations_v2_report"],
    "price_units_over_runs": ORACLE["price_units"],
    "seeds_from_list": f"WITH {_ST}, {_SEARCH} SELECT seed_zip AS zip, row_number() OVER (ORDER BY seed_rank) - 1 AS seed_rank FROM seed",
}
