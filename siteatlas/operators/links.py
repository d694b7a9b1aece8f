"""Links found on pages, and the stores that can be read off facility links alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteatlas.functions import html, text
from siteatlas.operators.ordering import dense_index
from siteatlas.session import bound_arrow_batches
from siteatlas.sources.captures import latest_versions, of_kind
from siteatlas.spec import SiteSpec


def page_links(pages: DataFrame, *keep: str, body: str = "body") -> DataFrame:
    """One row per anchor with an ``href``: the ``keep`` columns, pos, href, text.

    The body is read in the scan stage and never shuffled.
    """
    bound_arrow_batches(pages.sparkSession)
    found = pages.filter(html.may_have_tag(F.col(body), "a")).select(*keep, html.links(F.col(body)).alias("_links"))
    # Outer: otherwise the optimizer tests "not empty" with a second HTML pass in front of the explode.
    return (
        found.select(*keep, F.posexplode_outer("_links").alias("pos", "_link"))
        .filter("_link IS NOT NULL")
        .select(*keep, "pos", "_link.href", "_link.text")
    )


def links_per_page(pages: DataFrame, *keep: str, body: str = "body") -> DataFrame:
    """Number of links on every page, pages without links included. No shuffle."""
    bound_arrow_batches(pages.sparkSession)
    n_links = F.coalesce(F.size(html.links(F.col(body))), F.lit(0))
    return pages.select(*keep, n_links.cast("long").alias("n_links"))


def distinct_absolute_links(links: DataFrame, base_url: str) -> DataFrame:
    return links.select(text.absolute_url(F.col("href"), base_url).alias("url")).distinct()


def state_pages(captures: DataFrame, spec: SiteSpec) -> DataFrame:
    """(url, state_name) of the state pages the index links to. Their order is the order of their urls.

    An error if the index failed or is absent, see ``with_index_check``.
    """
    index = of_kind(captures, "index", strict=False)
    read = latest_versions(index, "status").filter("status < 400")
    links = page_links(index, "capture_id").join(read.select("capture_id"), "capture_id", "left_semi")
    urls = distinct_absolute_links(links.filter(F.contains("href", F.lit(spec.state_page_token))), spec.base_url)
    found = urls.select("url", text.state_name(F.col("url"), spec.state_page_token).alias("state_name"))
    return with_index_check(found, captures)


def with_index_check(rows: DataFrame, captures: DataFrame) -> DataFrame:
    """The rows, and an error when the plan runs if an index page's latest capture failed or there is no index page at all.

    Without the index nothing can be found. The check is a part of the union that has no rows, made from an aggregate that always has one.
    A plan that finds another input empty drops what is joined with it, and a check inside with it; so builds put this on
    the rows that their result is grouped from, behind all joins. The columns of that part fail like the part itself, so a filter that is moved in
    front of the check cannot take it out. The columns are text or numbers.
    """
    pages = latest_versions(of_kind(captures, "index", strict=False), "status")
    seen = pages.agg(F.count("*").alias("pages"), F.min(F.when(F.coalesce(F.col("status") < 400, F.lit(False)), F.lit(None)).otherwise(F.col("url"))).alias("failed"))
    wrong = F.when(F.col("pages") == 0, F.lit("no index page was captured")).otherwise(F.concat(F.lit("index page failed: "), "failed"))
    checked = F.when(wrong.isNotNull(), F.raise_error(wrong).cast("string"))
    none = seen.select(*[checked.cast(f.dataType).alias(f.name) for f in rows.schema], checked.alias("_checked"))
    return rows.unionByName(none.filter("_checked IS NOT NULL").drop("_checked"))


def with_page_rank(pages: DataFrame) -> DataFrame:
    """State pages with their place in the order of urls, from 1. For output; it numbers globally, so it runs a job."""
    ranked = dense_index(pages, ["url"], "_place")
    return ranked.select(*pages.columns, (F.col("_place") + 1).alias("page_rank"))


def show_page_rank(rows: DataFrame, ranked: DataFrame) -> DataFrame:
    """Rows found on state pages or others: ``page_rank`` becomes the place of the state page where it is one."""
    places = ranked.select(F.col("url").alias("page_url"), F.col("page_rank").alias("_place"))
    return rows.join(places, "page_url", "left").withColumn("page_rank", F.coalesce("_place", "page_rank")).drop("_place")


def on_pages(rows: DataFrame, pages: DataFrame, captures: DataFrame) -> DataFrame:
    """Rows off the latest captures of the given pages, with ``page_rank`` (0 for pages that have none).

    ``rows`` hold ``page_url`` and ``capture_id`` and are already free of bodies.
    """
    rank = F.col("page_rank") if "page_rank" in pages.columns else F.lit(0).cast("long").alias("page_rank")
    wanted = pages.select("url", rank).join(latest_versions(captures), "url").withColumnRenamed("url", "page_url")
    # A left join may send the pages to the rows, never the rows, whose size Spark guesses far too small behind an explode. The filter
    # names both sides, or Spark would make an inner join of it again.
    met = rows.join(wanted.withColumn("_wanted", F.lit(True)), ["page_url", "capture_id"], "left")
    return met.filter(F.coalesce("_wanted", F.col("pos") < 0)).drop("capture_id", "_wanted")


def parse_facility_url(href, spec: SiteSpec) -> dict:
    """(store_id, state, city) columns of a facility url; null store_id where it is none."""
    return {
        "store_id": text.extract(href, spec.facility_url, 3),
        "state": F.upper(text.extract(href, spec.facility_url, 1)),
        "city": text.slug_title(text.extract(href, spec.facility_url, 2)),
    }


def state_page_links(captures: DataFrame, pages: DataFrame) -> DataFrame:
    """Links on the state pages: page_rank, page_url, pos, href, text. Failed pages contribute nothing."""
    links = page_links(of_kind(captures, "sitemap").withColumnRenamed("url", "page_url"), "page_url", "capture_id")
    found = on_pages(links, pages, of_kind(captures, "sitemap", strict=False))
    return found.select("page_rank", "page_url", "pos", "href", "text")


def facility_links(links: DataFrame, spec: SiteSpec) -> DataFrame:
    """Facility links in the wide sense: the state part may have any length."""
    return links.filter(F.col("href").rlike("(?dU)" + spec.facility_link)).select(
        "page_rank", "page_url", "pos", text.absolute_url(F.col("href"), spec.base_url).alias("url"), F.col("text").alias("label")
    )


def first_label_per_url(links: DataFrame) -> DataFrame:
    """Each url once with the label, page and place it was first seen at."""
    return (
        links.groupBy("url")
        .agg(F.min(F.struct("page_rank", "page_url", "pos", "label")).alias("_first"))
        .select("url", "_first.label", "_first.page_rank", "_first.page_url", "_first.pos")
    )


def locations_from_links(links: DataFrame, spec: SiteSpec) -> DataFrame:
    """Facility links that parse, as store_number, address, city, state, url."""
    url = F.col("url")
    return (
        links.withColumns(parse_facility_url(url, spec))
        .filter(F.col("store_id").isNotNull())
        .select(
            F.col("store_id").alias("store_number"),
            text.label_address(F.col("label"), spec.near_label).alias("address"),
            "city",
            "state",
            "url",
            "page_rank",
            "page_url",
            "pos",
        )
    )


def link_stores(links: DataFrame, spec: SiteSpec) -> DataFrame:
    """One row per strict facility link, before deduplication."""
    return (
        links.withColumns(parse_facility_url(F.col("href"), spec))
        .filter(F.col("store_id").isNotNull())
        .select(
            "store_id",
            text.label_address(F.col("text"), spec.near_label).alias("address"),
            "city",
            "state",
            text.absolute_url(F.col("href"), spec.base_url).alias("url"),
            F.lit(0).alias("source_rank"),
            "page_rank",
            "page_url",
            "pos",
        )
    )
