"""Flat reports and coverage counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteatlas.functions import text
from siteatlas.operators.ordering import running_total
from siteatlas.operators.prices import unit_summary
from siteatlas.schema import ORDER_FIELDS
from siteatlas.sources.captures import errors, latest_versions


def _field(df: DataFrame, name: str) -> Column:
    """A field, or empty text where the records lack it; nulls stay null."""
    return F.col(name) if name in df.columns else F.lit("")


def _summary(df: DataFrame) -> Column:
    return F.col("summary") if "summary" in df.columns else unit_summary()


def _price_and_count(df: DataFrame) -> list[Column]:
    summary = _summary(df)
    return [
        text.price_label(summary["cheapest_price_raw"]).alias("Lowest Price"),
        F.coalesce(summary["units_available"], F.lit(0).cast("long")).alias("Units Available"),
    ]


def locations_v0(locations: DataFrame) -> DataFrame:
    return locations.select(
        F.col("store_number").alias("Store Number"),
        F.col("address").alias("Address"),
        F.col("city").alias("City"),
        F.col("state").alias("State"),
        F.col("url").alias("URL"),
    )


def total_locations(locations: DataFrame) -> DataFrame:
    return locations.agg(F.count(F.nullif("store_number", F.lit(""))).alias("total_locations"))


def locations_v1(stores: DataFrame) -> DataFrame:
    """Takes stores with ``units`` or, cheaper, with the ``summary`` made from them."""
    return stores.select(
        F.col("store_id").alias("Store #"),
        F.col("address").alias("Address"),
        F.col("city").alias("City"),
        F.col("state").alias("State"),
        text.or_empty(_summary(stores)["cheapest_size"]).alias("Cheapest Unit"),
        *_price_and_count(stores),
        F.col("url").alias("URL"),
    )


def locations_v2(stores: DataFrame) -> DataFrame:
    """Takes stores with ``units`` or, cheaper, with the ``summary`` made from them."""
    return stores.select(
        _field(stores, "site_number").alias("Site #"),
        F.col("store_id").alias("Store ID"),
        F.col("address").alias("Address"),
        F.col("city").alias("City"),
        F.col("state").alias("State"),
        _field(stores, "zip").alias("Zip"),
        _field(stores, "phone").alias("Phone"),
        *_price_and_count(stores),
        _field(stores, "lat").alias("Lat"),
        _field(stores, "lng").alias("Lng"),
        F.col("url").alias("URL"),
    )


def _unit_rows(stores: DataFrame, *keep: Column) -> DataFrame:
    return stores.select(*keep, F.posexplode("units").alias("unit_pos", "_unit"))


def _unit_columns() -> list[Column]:
    return [
        F.col("_unit.size").alias("Unit Size"),
        F.col("_unit.price").alias("Sale Price"),
        text.yes_no(F.col("_unit.available")).alias("Available"),
        F.col("_unit.count").alias("Units Left"),
        F.col("_unit.promo").alias("Promotion"),
    ]


def units_v1(stores: DataFrame) -> DataFrame:
    """One row per unit; stores without units do not appear."""
    return _unit_rows(stores, F.col("store_id"), F.col("city"), F.col("state")).select(
        F.col("store_id").alias("Store #"),
        F.col("city").alias("City"),
        F.col("state").alias("State"),
        *_unit_columns(),
    )


def units_v2(stores: DataFrame) -> DataFrame:
    keep = [_field(stores, "site_number").alias("site_number"), F.col("store_id"), F.col("city"), F.col("state")]
    return _unit_rows(stores, *keep).select(
        F.col("site_number").alias("Site #"),
        F.col("store_id").alias("Store ID"),
        F.col("city").alias("City"),
        F.col("state").alias("State"),
        *_unit_columns(),
    )


def new_store_listing(stores: DataFrame) -> DataFrame:
    """Newly found stores by site number (those without one first), then in discovery order."""
    return stores.orderBy(text.or_empty(F.col("site_number")), *ORDER_FIELDS).select(
        "site_number", "address", "city", "state", F.size("units").cast("long").alias("unit_types")
    )


def coverage_counts(stores: DataFrame) -> list[Column]:
    """The coverage counts as aggregates, for ``coverage`` or for the job that writes the catalog (``write_catalog``)."""
    has_site = text.truthy_text(F.col("site_number"))
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.coalesce(_summary(stores)["n_units"], F.lit(0)) > 0).alias("with_pricing"),
        F.count_if(has_site).alias("with_site_number"),
        F.count_if(text.truthy_text(F.col("phone"))).alias("with_phone"),
        F.count_if(~has_site).alias("remaining"),
    ]


def coverage(stores: DataFrame) -> DataFrame:
    """All coverage counts of a catalog in one pass."""
    return stores.agg(*coverage_counts(stores))


def new_per_page(pages: DataFrame, winners: DataFrame) -> DataFrame:
    """How many stores each page (by ``url``) was the first to show, pages with none included."""
    return _counted(pages, winners, "new_stores")


def _counted(pages: DataFrame, rows: DataFrame, name: str) -> DataFrame:
    counts = rows.groupBy(F.col("page_url").alias("url")).agg(F.count("*").alias("_n"))
    return pages.join(counts, "url", "left").withColumn(name, F.coalesce("_n", F.lit(0))).drop("_n")


def with_running_total(per_page: DataFrame) -> DataFrame:
    """Add the number of new stores found so far along the page order."""
    return running_total(per_page, ["page_rank"], F.col("new_stores"), "total_new")


def facilities_per_page(pages: DataFrame, links: DataFrame) -> DataFrame:
    """Facility links on each page (by ``url``) before deduplication."""
    return _counted(pages, links, "facilities")


def error_count(captures: DataFrame) -> DataFrame:
    """Pages whose latest capture failed."""
    return latest_versions(captures, "status").agg(F.count_if(F.col("status") >= 400).alias("errors"))


def first_errors(captures: DataFrame, pages: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` pages along the page order whose latest capture failed."""
    failed = errors(latest_versions(captures, "status")).select("url", "status")
    return failed.join(pages, "url").orderBy("page_rank").limit(n)
