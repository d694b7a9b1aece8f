"""Whole builds: each is one lazy plan from captures to a catalog or report; building it starts no job, unless its docstring says so."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteatlas.operators import details, links, markers, prices, reconcile, reports
from siteatlas.sources.seeds import search_pages
from siteatlas.spec import SiteSpec

SITEMAP, SEARCH = 0, 1


def sweep(captures: DataFrame, seeds: DataFrame, spec: SiteSpec, strict: bool = True) -> DataFrame:
    """Every store seen on the seeds' search pages, repeats included."""
    return markers.stores_on_pages(captures, "search", search_pages(seeds, spec), spec, SEARCH, strict)


def discovered(captures: DataFrame, seeds: DataFrame, spec: SiteSpec) -> DataFrame:
    """Stores of the state pages, then of the search sweep, each as first seen.

    This build reads pages whatever their status. The result is partitioned by store id, which the
    price join uses again.
    """
    pages = links.state_pages(captures, spec)
    from_states = markers.stores_on_pages(captures, "sitemap", pages, spec, SITEMAP, strict=False)
    found = reconcile.union_all(from_states, sweep(captures, seeds, spec, strict=False))
    return reconcile.first_wins(links.with_index_check(found, captures))


def discovered_with_rejects(captures: DataFrame, seeds: DataFrame, spec: SiteSpec) -> tuple[DataFrame, DataFrame]:
    """As ``discovered``, and beside it every marker that could not become a store, of state and search pages. Each page is read once for both; reading them starts jobs."""
    from_states, bad_states = markers.stores_and_rejects(captures, "sitemap", links.state_pages(captures, spec), spec, SITEMAP, strict=False)
    from_search, bad_search = markers.stores_and_rejects(captures, "search", search_pages(seeds, spec), spec, SEARCH, strict=False)
    found = links.with_index_check(reconcile.union_all(from_states, from_search), captures)
    return reconcile.first_wins(found), bad_states.unionAll(bad_search)


def daily_catalog(captures: DataFrame, seeds: DataFrame, spec: SiteSpec) -> DataFrame:
    """Discover, reconcile and price: the full scheduled build."""
    return prices.attach_units(discovered(captures, seeds, spec), prices.price_units(captures))


def daily_locations_report(captures: DataFrame, seeds: DataFrame, spec: SiteSpec) -> DataFrame:
    """The location report of the full build, moving only price summaries instead of unit lists."""
    stores = discovered(captures, seeds, spec)
    return reports.locations_v2(prices.attach_summary(stores, prices.price_summary(captures)))


def found_new(captures: DataFrame, seeds: DataFrame, known: DataFrame, spec: SiteSpec) -> DataFrame:
    """Stores of the search sweep that the known catalog lacks, each as first seen."""
    return reconcile.not_known(reconcile.first_wins(sweep(captures, seeds, spec)), known)


def gap_catalog(captures: DataFrame, seeds: DataFrame, known: DataFrame, spec: SiteSpec) -> DataFrame:
    """Known catalog plus the missing stores, priced. Nothing new gives the known catalog."""
    priced = prices.attach_newest_units(found_new(captures, seeds, known, spec), prices.price_entries(captures))
    return reconcile.append_new(known, priced)


def enriched_catalog(stores: DataFrame, captures: DataFrame, spec: SiteSpec) -> DataFrame:
    return details.enrich(stores, captures, spec)


def _indexed_links(captures: DataFrame, spec: SiteSpec) -> DataFrame:
    found = links.state_page_links(captures, links.state_pages(captures, spec))
    return links.with_index_check(found, captures)


def link_catalog(captures: DataFrame, spec: SiteSpec) -> DataFrame:
    """Stores read off the facility links of the state pages, first page wins, priced."""
    found = _indexed_links(captures, spec)
    stores = reconcile.first_page_wins(links.link_stores(found, spec))
    return prices.attach_units(stores, prices.price_units(captures))


def link_locations_report(captures: DataFrame, spec: SiteSpec) -> DataFrame:
    found = _indexed_links(captures, spec)
    stores = reconcile.first_page_wins(links.link_stores(found, spec))
    return reports.locations_v1(prices.attach_summary(stores, prices.price_summary(captures)))


def link_locations(captures: DataFrame, spec: SiteSpec, fetch_addresses: bool = False) -> DataFrame:
    """The link-only location list; ``fetch_addresses`` looks up missing ones on facility pages."""
    found = _indexed_links(captures, spec)
    locations = links.locations_from_links(links.first_label_per_url(links.facility_links(found, spec)), spec)
    return details.fill_addresses(locations, captures) if fetch_addresses else locations
