"""Store records embedded in pages as JSON on marker inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteatlas.functions import html, json, text
from siteatlas.operators.links import on_pages
from siteatlas.session import bound_arrow_batches, persist_reliably
from siteatlas.sources.captures import of_kind, only_latest
from siteatlas.spec import SiteSpec

# Each marker is parsed once: m is the marker, c its content; v holds values and keys what is there.
_PARSED = f"""
transform(
  transform(_values, value -> struct(
    value,
    {json.parsed('value', 'storeID title mlat mlng content')} AS m,
    try_parse_json(value) AS typed)),
  x -> struct(
    x.value, x.m, x.typed,
    {json.parsed('x.m.v.content', 'storeAddress city stateCode postalCode storePhone plpLink')} AS c))"""

_REASON = f"""
CASE
  WHEN x.value IS NULL OR x.value = '' THEN 'no_value'
  WHEN x.m.v._bad IS NOT NULL OR x.m.keys IS NULL THEN 'bad_json'
  WHEN {json.has('x.m', 'content')}
    AND (x.c.keys IS NULL OR {json.type_is('x.typed', '$.content', 'STRING', False)}) THEN 'bad_content'
  WHEN {json.has('x.m', 'title')}
    AND (x.m.v.title IS NULL OR NOT {json.type_is('x.typed', '$.title', 'STRING', True)}) THEN 'bad_title'
  WHEN {json.has('x.c', 'plpLink')}
    AND (x.c.v.plpLink IS NULL OR NOT {json.type_is('x.typed', '$.content.plpLink', 'STRING', True)}) THEN 'bad_link'
  WHEN {json.has('x.m', 'storeID')} AND x.m.v.storeID IS NULL THEN 'null_id'
END"""


def _content_field(name: str) -> str:
    """Empty text where missing, null where null."""
    return f"CASE WHEN {json.has('x.c', name)} THEN x.c.v.{name} ELSE '' END"


_DECODED = f"""
transform({_PARSED}, x -> struct(
  x.value AS raw,
  {_REASON} AS reason,
  coalesce(x.m.v.storeID, '') AS store_id,
  x.m.v.title AS title,
  {_content_field('storeAddress')} AS address,
  {_content_field('city')} AS city,
  {_content_field('stateCode')} AS state,
  {_content_field('postalCode')} AS zip,
  {_content_field('storePhone')} AS phone,
  x.m.v.mlat AS lat,
  x.m.v.mlng AS lng,
  {_content_field('plpLink')} AS link))"""


def page_markers(pages: DataFrame, spec: SiteSpec, *keep: str) -> DataFrame:
    """One row per marker input: the ``keep`` columns, pos, raw, reason (null if usable), fields.

    Everything up to the explode happens inside the page's row, in the stage that scans it.
    """
    bound_arrow_batches(pages.sparkSession)
    body = F.col("body")
    possible = html.may_have_tag(body, "input") & html.may_have_class(body, spec.marker_class)
    read = pages.filter(possible).select(*keep, html.markers(body, spec.marker_class).alias("_values"))
    # Outer: otherwise the optimizer tests "not empty" with a second pass in front of the explode.
    return (
        read.selectExpr(*keep, f"posexplode_outer({_DECODED}) AS (pos, _marker)")
        .filter("_marker IS NOT NULL")
        .select(*keep, "pos", "_marker.*")
    )


def marker_rejects(pages: DataFrame, spec: SiteSpec) -> DataFrame:
    """Markers of the latest captures that cannot become a store, and why: capture_id, pos, reason, raw."""
    rejected = page_markers(pages, spec, "capture_id").filter("reason IS NOT NULL")
    return only_latest(rejected, pages).select("capture_id", "pos", "reason", "raw")


def page_stores(pages: DataFrame, spec: SiteSpec, *keep: str) -> DataFrame:
    """Stores on the pages; a bad marker costs only itself, and so does one without an id."""
    return _as_stores(page_markers(pages, spec, *keep), spec, *keep)


def _as_stores(found: DataFrame, spec: SiteSpec, *keep: str) -> DataFrame:
    return (
        found.filter("reason IS NULL AND store_id <> ''")
        .select(
            *keep,
            "pos",
            "store_id",
            text.title_site_number(F.col("title")).alias("site_number"),
            *("address", "city", "state", "zip", "phone", "lat", "lng"),
            F.concat(F.lit(spec.base_url), "link").alias("url"),
        )
    )


def stores_on_pages(
    captures: DataFrame, kind: str, pages: DataFrame, spec: SiteSpec, source_rank: int, strict: bool
) -> DataFrame:
    """Stores on the latest captures of those pages of one kind that are listed in ``pages``, with discovery order.

    Markers are read and decoded where the page was scanned; only then does the narrow result meet
    the page list, so no page body crosses the network.
    """
    pages_read = of_kind(captures, kind, strict).withColumnRenamed("url", "page_url")
    stores = page_stores(pages_read, spec, "page_url", "capture_id")
    found = on_pages(stores, pages, of_kind(captures, kind, strict=False))
    return found.withColumn("source_rank", F.lit(source_rank))


def stores_and_rejects(
    captures: DataFrame, kind: str, pages: DataFrame, spec: SiteSpec, source_rank: int, strict: bool
) -> tuple[DataFrame, DataFrame]:
    """As ``stores_on_pages``, and beside it the rejected markers of the same captures: source_rank, capture_id, pos, reason, raw.

    Pages are read once for both: the markers, free of bodies and with their raw text only where rejected, are written to the
    shared folder, so this starts a job.
    """
    pages_read = of_kind(captures, kind, strict).withColumnRenamed("url", "page_url")
    found = page_markers(pages_read, spec, "page_url", "capture_id").withColumns(
        {"raw": F.when(F.col("reason").isNotNull(), F.col("raw")), "_capture": F.col("capture_id")}
    )
    kept = persist_reliably(on_pages(found, pages, of_kind(captures, kind, strict=False)))
    rank = F.lit(source_rank)
    stores = _as_stores(kept, spec, "page_url", "page_rank").withColumn("source_rank", rank)
    rejects = kept.filter("reason IS NOT NULL").select(rank.alias("source_rank"), F.col("_capture").alias("capture_id"), "pos", "reason", "raw")
    return stores, rejects
