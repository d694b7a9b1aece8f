"""Details from a store's own page, and merging them into the catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteatlas.functions import html, json, text
from siteatlas.session import bound_arrow_batches
from siteatlas.sources.captures import of_kind
from siteatlas.spec import SiteSpec

DETAIL_FIELDS = ("site_number", "phone", "zip", "lat", "lng")

_FOUND_MARKER = f"""struct(
  {json.parsed('_found.marker', 'title mlat mlng content')} AS m,
  try_parse_json(_found.marker) AS typed)"""

_WITH_CONTENT = f"""struct(
  _marker.m, _marker.typed, {json.parsed('_marker.m.v.content', 'title storePhone postalCode')} AS c)"""

# The title decides how far a marker can be read. The marker's own title is used if truthy, else the
# content's; a title of another type, or a content that is no object, ends the reading there.
_OWN_IS_TEXT = json.type_is("x.typed", "$.title", "STRING", True)
_READ_TITLE = f"""struct(
  x.m, x.c,
  x.m.v._bad IS NULL AND x.m.keys IS NOT NULL AS readable,
  NOT {json.has('x.m', 'content')}
    OR (x.c.keys IS NOT NULL AND NOT {json.type_is('x.typed', '$.content', 'STRING', False)}) AS content_ok,
  x.m.v.title IS NOT NULL
    AND CASE WHEN {_OWN_IS_TEXT} THEN x.m.v.title <> '' ELSE {json.truthy('x.m.v.title')} END AS use_own,
  {_OWN_IS_TEXT} AS own_ok,
  NOT {json.has('x.c', 'title')}
    OR (x.c.v.title IS NOT NULL AND {json.type_is('x.typed', '$.content.title', 'STRING', True)}) AS inner_ok)"""

_TITLE_OK = "x.readable AND CASE WHEN x.use_own THEN x.own_ok ELSE x.content_ok AND x.inner_ok END"

_FROM_MARKER = f"""struct(
  CASE WHEN {_TITLE_OK} THEN CASE WHEN x.use_own THEN x.m.v.title ELSE coalesce(x.c.v.title, '') END END AS title,
  CASE WHEN {_TITLE_OK} AND x.content_ok
       THEN struct(x.c.v.storePhone AS phone, x.c.v.postalCode AS zip, x.m.v.mlat AS lat, x.m.v.mlng AS lng) END AS rest)"""


def decode_details(found: DataFrame, *keep: str) -> DataFrame:
    """Choose among the candidates in column ``_found`` (see ``html.details``).

    Empty text passes on to the next candidate, but stands if there is none.
    """

    def first_filled(first, second):
        return F.coalesce(F.nullif(first, F.lit("")), second, first)

    site_attr = F.col("_found.site_attr")
    return (
        found.selectExpr(*keep, "_found", f"{_FOUND_MARKER} AS _marker")
        .selectExpr(*keep, "_found", f"{_WITH_CONTENT} AS x")
        .selectExpr(*keep, "_found", f"{_READ_TITLE} AS x")
        .selectExpr(*keep, "_found", f"{_FROM_MARKER} AS _read")
        .select(
            *keep,
            F.coalesce(
                text.title_site_number(F.col("_read.title")),
                F.nullif(site_attr, F.lit("")),
                text.review_site_number(F.col("_found.review_url")),
                site_attr,
            ).alias("site_number"),
            first_filled(F.col("_read.rest.phone"), text.tel_phone(F.col("_found.tel"))).alias("phone"),
            first_filled(F.col("_read.rest.zip"), F.col("_found.postal")).alias("zip"),
            F.col("_read.rest.lat").alias("lat"),
            F.col("_read.rest.lng").alias("lng"),
        )
    )


def facility_details(pages: DataFrame, spec: SiteSpec, *keep: str) -> DataFrame:
    """The ``keep`` columns and the five detail fields of every facility page."""
    bound_arrow_batches(pages.sparkSession)
    found = pages.select(*keep, html.details(F.col("body"), spec.marker_class).alias("_found"))
    return decode_details(found, *keep)


# The first script that is an object with an object as its address decides.
_JSON_LD_STREET = f"""transform(
  array(get(filter(
    transform(transform(_found.json_ld, script -> {json.fields('script', 'address')}),
              x -> CASE WHEN x._bad IS NULL THEN {json.parsed('x.address', 'streetAddress')} END),
    x -> x.keys IS NOT NULL), 0)),
  x -> CASE WHEN {json.has('x', 'streetAddress')} THEN x.v.streetAddress ELSE '' END)[0]"""


def facility_addresses(pages: DataFrame, *keep: str) -> DataFrame:
    """The ``keep`` columns and ``address``: address element, else JSON-LD, else empty text."""
    bound_arrow_batches(pages.sparkSession)
    found = pages.select(*keep, html.address(F.col("body")).alias("_found"))
    return found.selectExpr(*keep, f"coalesce(_found.text, {_JSON_LD_STREET}) AS address")


_SALTS = 64


def _lookup_key(wanted: Column, own_id: str, base_url: str | None = None) -> Column:
    """The url where a page is wanted, else a key that no url equals.

    A null key would send all other rows to one task; the record's own id spreads them. Unfinished stores share the bare
    ``base_url``, so they look it up under one of a few salted keys.
    """
    url = F.col("url")
    if base_url is not None:
        salted = F.concat(url, F.lit("\u0000"), F.pmod(F.xxhash64(own_id), F.lit(_SALTS)).cast("string"))
        url = F.when(url == base_url, salted).otherwise(url)
    return F.when(wanted & F.col("url").isNotNull(), url).otherwise(F.concat(F.lit("\u0000"), own_id))


def _by_lookup_key(details: DataFrame, base_url: str | None) -> DataFrame:
    """Rows by url as rows by ``_wanted``: the base url's row, if there is one, under each salted key."""
    if base_url is None:
        return details.withColumnRenamed("url", "_wanted")
    salts = ", ".join(f"concat(url, '\\u0000', '{i}')" for i in range(_SALTS))
    keys = F.when(F.col("url") == base_url, F.expr(f"array({salts})")).otherwise(F.array("url"))
    return details.withColumn("_wanted", F.explode(keys)).drop("url")


def latest_per_url(pages: DataFrame, *fields: str) -> DataFrame:
    """One row per url: the one captured last."""
    return (
        pages.groupBy("url")
        .agg(F.max_by(F.struct(*fields), F.struct("fetched_at", "capture_id")).alias("_last"))
        .select("url", "_last.*")
    )


def needs_details(stores: DataFrame) -> DataFrame:
    return stores.filter(~text.truthy_text(F.col("site_number")))


def page_details(pages: DataFrame, spec: SiteSpec) -> DataFrame:
    """(url, capture_id, fetched_at, page_ok, details) of facility pages: narrow rows, read where the page was scanned."""
    found = facility_details(pages, spec, "url", "capture_id", "fetched_at", "status")
    return found.select(
        "url",
        "capture_id",
        "fetched_at",
        F.coalesce(F.col("status") < 400, F.lit(False)).alias("page_ok"),
        F.struct(*DETAIL_FIELDS).alias("details"),
    )


def details_by_url(captures: DataFrame, spec: SiteSpec) -> DataFrame:
    """(url, page_ok, details) of the latest capture of every facility page.

    All pages are read in place, whatever stores want them: the result does not depend on how long the list of wanted
    pages is, the stores are planned once, and no page body is shuffled to save reading it.
    """
    return latest_per_url(page_details(of_kind(captures, "facility", strict=False), spec), "page_ok", "details")


def has_site_number(details: str) -> Column:
    return text.truthy_text(F.col(details)["site_number"])


def details_until_done(found: DataFrame) -> DataFrame:
    """(url, page_ok, details) after enriching with every capture in the order they were made.

    Each readable page overwrites what the ones before it said, and the first that gives a site number is the last that is asked
    for. So the outcome does not depend on how the captures were cut into batches.
    """
    at = F.struct("fetched_at", "capture_id")
    done = F.col("page_ok") & has_site_number("details")
    first_done = F.min_by(F.when(done, F.col("details")), F.when(done, at))
    last_read = F.max_by(F.when(F.col("page_ok"), F.col("details")), F.when(F.col("page_ok"), at))
    merged = found.groupBy("url").agg(F.coalesce(first_done, last_read).alias("details"))
    return merged.select("url", F.col("details").isNotNull().alias("page_ok"), "details")


def merge_details(stores: DataFrame, details: DataFrame, base_url: str | None = None) -> DataFrame:
    """Stores already done are unchanged, readable pages overwrite (even with null), others keep."""
    missing = [name for name in DETAIL_FIELDS if name not in stores.columns]
    stores = stores.withColumns({name: F.lit(None).cast("string") for name in missing})
    todo = ~text.truthy_text(F.col("site_number"))
    joined = stores.withColumn("_wanted", _lookup_key(todo, "store_id", base_url)).join(
        _by_lookup_key(details, base_url), "_wanted", "left"
    )
    overwrite = F.coalesce(F.col("page_ok"), F.lit(False))
    return joined.select(
        *[
            F.when(overwrite, F.col("details")[c]).otherwise(F.col(c)).alias(c) if c in DETAIL_FIELDS else F.col(c)
            for c in stores.columns
        ]
    )


def enrich(stores: DataFrame, captures: DataFrame, spec: SiteSpec) -> DataFrame:
    """Fill the detail fields of stores without a site number from their facility pages."""
    return merge_details(stores, details_by_url(captures, spec), spec.base_url)


def fill_addresses(locations: DataFrame, captures: DataFrame) -> DataFrame:
    """Look up the address of locations that have none; a page whose latest capture is unreadable leaves it empty."""
    empty = F.col("address") == ""
    pages = of_kind(captures, "facility", strict=False)
    found = latest_per_url(facility_addresses(pages, "url", "capture_id", "fetched_at", "status"), "address", "status")
    wanted = found.filter("status < 400").select(F.col("url").alias("_wanted"), F.struct("address").alias("_found"))
    joined = locations.withColumn("_wanted", _lookup_key(empty, "store_number")).join(wanted, "_wanted", "left")
    looked_up = F.when(F.col("_found").isNull(), F.lit("")).otherwise(F.col("_found.address"))
    return joined.withColumn("address", F.when(empty, looked_up).otherwise(F.col("address"))).select(
        *locations.columns
    )
