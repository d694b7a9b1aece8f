"""Round-trip captures: the driver tables rendered as the pages a site would serve.

``FIXTURES.md`` lists the rules. ``customer`` becomes stores, ``nation`` state pages, ``orders`` unit
offers. Every row of those tables is rendered; a remainder only picks which case of the contract a row
exercises. All groups collected into one document are bounded by unique keys, however the other
columns are distributed: 1000 customers (three variants) to a state page, 200 to a search page, 20
offers to a store and 20 stores to a price payload.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteatlas.operators.reconcile import union_all
from siteatlas.schema import CAPTURES
from siteatlas.spec import SiteSpec

BASE = "https://atlas.example"
SPEC = SiteSpec(
    base_url=BASE,
    search_template=BASE + "/find?near={}",
    price_template=BASE + "/prices?sites={}",
    marker_class="siteMarker",
)
RESENT = 1_000_000_000  # added to the key of a payload that is sent again by a later run, whose ranks start anew

# Columns of a store, from customer.
STORE_COLUMNS = {
    "k": "c_custkey",
    "n": "c_nationkey",
    "b": "c_custkey div 1000",
    "seed": "c_custkey % 97 + 97 * (c_custkey div 9700)",
    "alt_seed": "(c_custkey % 97 + 1) % 97 + 97 * (c_custkey div 9700)",
    "store_id": "string(10000 + c_custkey)",
    "title": "if(c_custkey % 7 = 0, c_name, concat(200000 + c_custkey, ' - ', c_name))",
    "street": "concat(c_custkey, ' Main St')",
    "city": "concat(c_mktsegment, ' ', c_custkey % 40)",
    "state": "upper(concat(chr(97 + c_nationkey), 'x'))",
    "zip": "lpad(string(c_custkey), greatest(5, length(string(c_custkey))), '0')",
    "phone": "concat('555-', lpad(string(c_custkey), greatest(7, length(string(c_custkey))), '0'))",
    "lat": "string(c_acctbal)",
    "slug": "concat(lower(c_mktsegment), '-', c_custkey % 40, 'palms')",
    "link": "concat('/self-storage-', chr(97 + c_nationkey), 'x-', lower(c_mktsegment), '-',"
    " c_custkey % 40, 'palms/', 10000 + c_custkey, '.html')",
}

# The JSON of a marker; the first broken case that applies is taken.
CONTENT_JSON = """concat('{"storeAddress":"', shown_street, '","city":"', city, '","stateCode":"', state,
    '","postalCode":"', zip, '","storePhone":"', phone, '","plpLink":',
    if(k % 19 = 0, 'null', concat('"', link, '"')), '}')"""
MARKER_JSON = f"""case
    when k % 13 = 0 then concat('{{"storeID":"', store_id, '","title":"', title)
    when k % 11 = 0 then concat('{{"storeID":"', store_id, '","title":null,"content":', {CONTENT_JSON}, '}}')
    when k % 23 = 0 then concat('{{"storeID":"', store_id, '","title":"', title, '","mlat":', lat, ',"mlng":null}}')
    else concat('{{',
        case when k % 17 = 0 and k % 19 <> 0 then ''
             when k % 2 = 1 then concat('"storeID":', store_id, ',')
             else concat('"storeID":"', store_id, '",') end,
        '"title":"', title, '","mlat":', lat, ',"mlng":null,"content":', {CONTENT_JSON}, '}}')
    end"""

# A marker element, with the attribute quoted either way.
MARKER_HTML = """if(k % 2 = 1,
    concat('<input class=siteMarker value="', replace(marker_json, '"', '&quot;'), '">'),
    concat('<INPUT type="hidden" class="map siteMarker" value=\\'', marker_json, '\\' />'))"""

# A facility link: relative or absolute, with or without an address in its label, and for some
# stores a second one whose state part is too long for a store.
LINK_HTML = """concat('<li><b>', '<a href="', if(k % 3 = 1, base, ''), link, '">',
    if(k % 43 = 0, 'Find a unit', concat('Self Storage near ', shown_street, ' in ', city, ', ', state)),
    '<img src="x.png"></a>',
    if(k % 37 = 0, concat('<a href="/self-storage-usa-', slug, '/', store_id, '.html">Usa</a>'), ''), '</li>')"""

# A facility page: the details are in one of four places.
FACILITY_HTML = """concat('<html><body><p>Unit <b>sizes &amp; prices',
    case k % 4
      when 0 then marker_html
      when 1 then concat('<div data-sitenumber="', 300000 + k, '">')
      when 2 then concat('<div id=PLPReviews data-ratingurl="/r?a=1&amp;SiteNumber=', 400000 + k, '&amp;z=2"></div>')
      else '' end,
    if(k % 2 = 1 or k % 12 = 0, concat('<a href="tel: 555-', k, ' ">call</a><span itemprop="postalCode"> Z', k, ' </span>'), ''),
    case k % 6
      when 0 then concat('<i itemprop="streetAddress">', k, ' <b>Item</b> Rd</i>')
      when 1 then concat('<div class="old-address">wrong</div><div class="x facility-address">', k, ' Class Rd</div>')
      when 2 then concat('<div class="property-address"> </div><script type="application/ld+json">{"address":{"streetAddress":"no"}}</script>')
      when 3 then concat('<div class="myaddresses">', k, ' Part Rd</div>')
      when 4 then concat('<script type="application/ld+json">[1]</script><script type="application/ld+json">',
                         '{"address":"text"}</script><script type="application/ld+json">',
                         '{"address":{"streetAddress":"', k, ' Json Rd"}}</script>')
      else '' end, '</body></html>')"""

# A unit offer, from orders; bump is 1 in a payload that is sent again.
UNIT_JSON = """concat('{"name":"', o_orderpriority, '"',
    case when o_orderkey % 17 = 0 then ',"saleprice":0'
         when o_orderkey % 16 = 5 then ''
         when o_orderkey % 4 = 1 then concat(',"saleprice":', floor(o_totalprice / 100000))
         else concat(',"saleprice":', o_totalprice) end,
    case when o_orderkey % 19 = 0 then '' when o_orderkey % 13 = 0 then if(o_orderkey % 2 = 0, ',"availability":"false"', ',"availability":"0"')
         else concat(',"availability":', o_orderstatus = 'O') end,
    if(o_orderkey % 23 = 0, '', concat(',"count":', o_orderkey % 5 + bump)),
    ',"promotionName":', if(o_orderkey % 3 = 0, 'null', concat('"P', o_orderkey % 3, '"')), '}')"""


# Columns used of the driver tables. Naming them spares a job per read to look into the files.
TABLES = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING",
    "orders": "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderpriority STRING",
    "pages": "page_id BIGINT, url STRING, html STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with every field a page may show."""
    columns = [f"{expression} AS {name}" for name, expression in STORE_COLUMNS.items()]
    return table(spark, sf_dir, "customer").selectExpr(*columns)


def _shown(stores: DataFrame, *cases: tuple[str, str, str]) -> DataFrame:
    """One row per place a store is shown at: (condition, place, street) of each case."""
    places = ", ".join(
        f"if({condition}, struct({copy} AS copy, {place} AS place, {street} AS shown_street), null)"
        for copy, (condition, place, street) in enumerate(cases)
    )
    return stores.selectExpr("*", f"inline(filter(array({places}), x -> x IS NOT NULL))")


def _grouped(rows: DataFrame, *keys: str) -> DataFrame:
    """Spread rows by key over the session's shuffle partitions.

    Reading the documents costs far more than their size suggests, so the number of partitions is
    not left to be reduced by size.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _page(rows: DataFrame, html: str, head: str, *keys: str) -> DataFrame:
    """One page per key: the html of its rows in order of (k, copy)."""
    items = "transform(array_sort(collect_list(struct(k, copy, html))), x -> x.html)"
    body = F.expr(f"concat('{head}', array_join({items}, '\\n'))").alias("body")
    return _grouped(rows.selectExpr(*keys, "k", "copy", f"{html} AS html"), *keys).groupBy(*keys).agg(body)


def _captures(rows: DataFrame, kind: str, key: str, url: str, status: str, page_rank: str = "null") -> DataFrame:
    """Captures of one kind; ``key`` is unique inside the kind."""
    offset = ["index", "sitemap", "search", "facility", "price"].index(kind)
    values = {
        "capture_id": f"{key} * 5 + {offset}",
        "kind": f"'{kind}'",
        "url": url,
        "status": status,
        "body": "body",
        "page_rank": page_rank,
        "fetched_at": f"timestamp_seconds({key})",
    }
    return rows.selectExpr(
        *[f"CAST({values[field.name]} AS {field.dataType.simpleString()}) AS {field.name}" for field in CAPTURES]
    )


def _with_history(captures: DataFrame, when: str, body: str) -> DataFrame:
    """Where ``when`` holds for the capture id, the page was also captured earlier, successfully and with another ``body``."""
    names = [field.name for field in CAPTURES]
    earlier = {"capture_id": "-1 - capture_id", "status": "200", "body": body, "fetched_at": "timestamp_seconds(-1)"}
    both = [", ".join(f"{values.get(n, n)} AS {n}" for n in names) for values in ({}, earlier)]
    rows = captures.selectExpr(f"inline(if({when}, array(struct({both[0]}), struct({both[1]})), array(struct({both[0]}))))")
    return rows.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in CAPTURES])


def _with_marker(shown: DataFrame) -> DataFrame:
    return shown.selectExpr("*", f"{MARKER_JSON} AS marker_json").selectExpr("*", f"{MARKER_HTML} AS marker_html")


def _state_page_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each store on the state page of its nation, some twice, some also on the next nation's.

    A store that no state page shows still makes its page exist; its html is null.
    """
    shown = _shown(
        customers(spark, sf_dir),
        ("true", "n", "street"),
        ("k % 5 <> 0 and k % 29 = 0", "n", "concat('DUP ', k)"),
        ("k % 5 <> 0 and k % 31 = 0", "(n + 1) % 25", "concat('ALT ', k)"),
    )
    nations = table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey AS place", "replace(lower(n_name), '_', '-') AS nation_slug"
    )
    return shown.join(nations, "place").selectExpr(
        "*", "concat('/site-map-states-', nation_slug, '-', b) AS path", f"'{BASE}' AS base"
    )


def index_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One per block of 1000 customers, linking the block's state pages."""
    pages = _state_page_places(spark, sf_dir).select("b", "place", "path").distinct()
    link = f"""concat('<a href="', if(place % 2 = 1, '{BASE}', ''), path, '">', place, '</a>',
        if(place = 3, concat('<a href="', path, '">again</a>'), ''))"""
    head = '<html><a href="/about">About</a><a name="site-map-states-">top</a>'
    rows = pages.selectExpr("b", "place AS k", "0 AS copy", "place", "path")
    pages = _captures(_page(rows, link, head, "b"), "index", "b", f"concat('{BASE}/index/', b)", "200")
    return _with_history(pages, "capture_id % 2 = 0", "concat(body, '<a href=\"/site-map-states-gone\">gone</a>')")


def state_page_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation 11's pages failed with a body, which only lenient readers use."""
    item = f"if(k % 5 <> 0, concat(marker_html, {LINK_HTML}), null)"
    pages = _page(
        _with_marker(_state_page_places(spark, sf_dir)), item, '<html><a href="/">Home</a><ul>', "b", "place", "path"
    )
    found = _captures(pages, "sitemap", "(b * 25 + place)", f"concat('{BASE}', path)", "if(place = 11, 404, 200)")
    gone = "<a href=\"/self-storage-zz-gone/12345.html\">Self Storage near 1 Gone St in Gone</a>"
    return _with_history(found, "capture_id % 4 = 1", f"concat('{gone}', replace(body, ' Main St', ' Past Rd'))")


def _zip(seed: str) -> str:
    return f"lpad(string({seed}), greatest(5, length(string({seed}))), '0')"


def search_page_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores near a seed; every thirteenth page failed with a body."""
    shown = _shown(
        customers(spark, sf_dir),
        ("true", "seed", "street"),
        ("k % 6 = 0", "alt_seed", "concat('ALT ', k)"),
    )
    pages = _page(_with_marker(shown), "marker_html", "<html><p>Results<p>", "place")
    url = f"concat('{BASE}/find?near=', {_zip('place')})"
    found = _captures(pages, "search", "place", url, "if(place % 13 = 0, 500, 200)")
    return _with_history(found, "capture_id % 3 = 1", "replace(replace(body, ' Main St', ' Past Rd'), 'ALT ', 'OLD ')")


def facility_page_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = _grouped(customers(spark, sf_dir), "k").withColumnRenamed("street", "shown_street")
    pages = _with_marker(spread).selectExpr("k", "link", f"{FACILITY_HTML} AS body")
    found = _captures(pages, "facility", "k", f"concat('{BASE}', link)", "if(k % 8 = 5, 500, 200)")
    earlier = "<a href=\"tel:gone\">call</a><i itemprop=\"streetAddress\">1 Gone St</i>"
    return _with_history(found, "status = 200 AND capture_id % 9 = 4", f"'{earlier}'")


def price_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload per 20 customers; some are void, some failed, some are sent again later.

    Customers and offers meet in one shuffle, by payload.
    """
    offers = table(spark, sf_dir, "orders").selectExpr(
        "if((o_orderkey div 10) % 9 = 4, o_orderkey div 10 - 1, o_orderkey div 10) AS k",
        "null AS store_id",
        "o_orderkey",
        f"{UNIT_JSON.replace('bump', '0')} AS unit",
        f"{UNIT_JSON.replace('bump', '1')} AS unit_again",
    )
    stores = customers(spark, sf_dir).selectExpr(
        "k", "store_id", "null AS o_orderkey", "null AS unit", "null AS unit_again"
    )
    rows = union_all(stores, offers).selectExpr("k div 20 AS p", "*")

    def info(unit):
        return f"array_join(transform(array_sort(collect_list(struct(o_orderkey, {unit} AS u))), x -> x.u), ',')"

    def entry(units):
        return f"""concat(
            if(k % 20 = 7 and p % 3 = 1, concat('{{"storeID":"', store_id, '","info":[]}},'), ''),
            '{{"storeID":', if(k % 2 = 1, store_id, concat('"', store_id, '"')), ',"info":',
            case when k % 20 = 0 and p % 37 = 36 then 'null' when k % 20 = 11 and p % 3 = 2 then if(p % 2 = 0, '{{}}', '""')
                 else concat('[', {units}, ']') end, '}}')"""

    def payload(json):
        listed = f"array_join(transform(array_sort(collect_list(struct(k, {json} AS j))), x -> x.j), ',')"
        more = """if(p % 5 = 0, concat(',{"storeID":"U', p, '"}'), '')"""
        return F.expr(f"""concat('{{"promoInfoArr":[', {listed}, {more}, ']}}')""")

    entries = (
        _grouped(rows, "p")
        .groupBy("p", "k")
        .agg(
            F.max("store_id").alias("store_id"),
            F.expr(info("unit")).alias("units"),
            F.expr(info("unit_again")).alias("units_again"),
        )
        .filter("store_id IS NOT NULL")
        .selectExpr(
            "p",
            "k",
            f"if(k % 10 <> 3, {entry('units')}, null) AS entry",
            f"if(k % 10 <> 3 and p % 41 = 40, {entry('units_again')}, null) AS entry_again",
        )
    )
    payloads = entries.groupBy("p").agg(payload("entry").alias("first"), payload("entry_again").alias("again"))
    sent = payloads.selectExpr(
        "p",
        f"""inline(if(p % 41 = 40, array(struct(p AS rank, first AS body), struct(p + {RESENT}L AS rank, again AS body)),
                      array(struct(p AS rank, first AS body))))""",
    )
    return _captures(
        sent, "price", "rank", f"concat('{BASE}/prices?sites=batch-', p)", "if(p % 29 = 28, 503, 200)", f"if(rank >= {RESENT}, 0, rank)"
    )


_RENDER = {
    "index": index_pages,
    "sitemap": state_page_captures,
    "search": search_page_captures,
    "facility": facility_page_captures,
    "price": price_captures,
}


class Captures(dict):
    """Captures by kind, as ``of_kind`` reads them."""

    def union(self) -> DataFrame:
        return union_all(*self.values())


def captures(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame | Captures:
    """One kind as a table, several (or all, if none is named) by kind."""
    found = Captures({kind: _RENDER[kind](spark, sf_dir) for kind in kinds or _RENDER})
    return found[kinds[0]] if len(kinds) == 1 else found


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seed some customer is near to; each tenth is repeated at the end."""
    ranks = f"if(seed % 10 = 0, array(seed, seed + {RESENT}), array(seed))"
    near = customers(spark, sf_dir).select("seed").distinct()
    return near.selectExpr(f"explode({ranks}) AS seed_rank", f"{_zip('seed')} AS zip")


def known_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The even customers, as found by an earlier run, with no units yet."""
    return customers(spark, sf_dir).filter("k % 2 = 0").selectExpr(
        "store_id",
        "if(k % 7 <> 0, string(200000 + k), null) AS site_number",
        "concat('OLD ', k) AS address",
        *("city", "state", "zip", "phone", "lat"),
        "string(null) AS lng",
        f"concat('{BASE}', link) AS url",
    )


def partly_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers: a third done, a third with only a phone, a third bare."""
    return customers(spark, sf_dir).selectExpr(
        "store_id",
        "if(k % 3 = 0, string(100000 + k), null) AS site_number",
        "concat(k, ' Main St') AS address",
        *("city", "state"),
        "if(k % 6 = 0, 'old', null) AS zip",
        "if(k % 3 = 1, concat('old-', k), null) AS phone",
        f"if(k % 23 = 0, '{BASE}', concat('{BASE}', link)) AS url",
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as link-only locations; two thirds lack an address."""
    return customers(spark, sf_dir).selectExpr(
        "store_id AS store_number",
        "if(k % 3 = 0, street, '') AS address",
        *("city", "state"),
        f"concat('{BASE}', link) AS url",
    )
