
from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_queries  # noqa: E402
from siteatlas import fixtures as fx  # noqa: E402
from siteatlas.functions import text  # noqa: E402
from siteatlas.operators import details, links, markers, ordering, prices, reconcile, reports  # noqa: E402
from siteatlas.plans import catalogs  # noqa: E402
from siteatlas.schema import ORDER_FIELDS, STORE_FIELDS  # noqa: E402
from siteatlas.session import new_work_dir  # noqa: E402
from siteatlas.sources import catalog, runs, seeds  # noqa: E402
from siteatlas.sources.captures import of_kind, only_latest  # noqa: E402
from siteatlas.streaming import incremental, price_state  # noqa: E402

# The text operators and the pipeline built on them; the library works without them.
LLM = []
try:
    from siteatlas.llm import queries as llm_queries  # noqa: E402

    LLM.append((llm_queries.QUERIES, llm_queries.ORACLE))
    import corpus_pipeline  # noqa: E402

    LLM.append(({"pipeline": corpus_pipeline.run}, {"pipeline": corpus_pipeline.ORACLE_SQL}))
except ModuleNotFoundError as missing:
    if missing.name not in ("siteatlas.llm", "corpus_pipeline"):
        raise

SPEC = fx.SPEC
SMALLEST = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    return locations_v2_report(spark, SMALLEST)


def _pages(spark, sf_dir):
    return fx.table(spark, sf_dir, "pages")


def _state_links(spark, sf_dir):
    captures = fx.captures(spark, sf_dir, "index", "sitemap")
    return links.state_page_links(captures, links.state_pages(captures, SPEC))


def _sweep(spark, sf_dir, strict):
    return catalogs.sweep(fx.captures(spark, sf_dir, "search"), fx.seeds(spark, sf_dir), SPEC, strict)


def _discovered(spark, sf_dir):
    captures = fx.captures(spark, sf_dir, "index", "sitemap", "search")
    return catalogs.discovered(captures, fx.seeds(spark, sf_dir), SPEC)


def _new(spark, sf_dir):
    captures = fx.captures(spark, sf_dir, "search")
    return catalogs.found_new(captures, fx.seeds(spark, sf_dir), fx.known_catalog(spark, sf_dir), SPEC)


def _daily(spark, sf_dir):
    captures = fx.captures(spark, sf_dir, "index", "sitemap", "search", "price")
    return catalogs.daily_catalog(captures, fx.seeds(spark, sf_dir), SPEC)


# ---- links -----------------------------------------------------------------------------------------


def page_links(spark, sf_dir):
    return links.page_links(_pages(spark, sf_dir), "page_id", body="html")


def absolute_links_distinct(spark, sf_dir):
    return links.distinct_absolute_links(page_links(spark, sf_dir), SPEC.base_url)


def page_link_counts(spark, sf_dir):
    return links.links_per_page(_pages(spark, sf_dir), "page_id", body="html")


def state_pages(spark, sf_dir):
    return links.with_page_rank(links.state_pages(fx.captures(spark, sf_dir, "index"), SPEC))


def _show_page_rank(rows, spark, sf_dir):
    return links.show_page_rank(rows, state_pages(spark, sf_dir))


def facility_links_loose(spark, sf_dir):
    found = links.facility_links(_state_links(spark, sf_dir), SPEC)
    shown = _show_page_rank(links.first_label_per_url(found), spark, sf_dir)
    return shown.select("url", "label", "page_rank")


def link_stores(spark, sf_dir):
    found = reconcile.first_page_wins(links.link_stores(_state_links(spark, sf_dir), SPEC))
    shown = _show_page_rank(found, spark, sf_dir)
    return shown.select("store_id", "address", "city", "state", "url", "page_rank")


def facilities_per_page(spark, sf_dir):
    captures = fx.captures(spark, sf_dir, "index", "sitemap")
    pages = links.with_page_rank(links.state_pages(captures, SPEC)).select("url", "page_rank")
    found = links.facility_links(links.state_page_links(captures, pages), SPEC)
    return reports.facilities_per_page(pages, found)


def locations_v0_report(spark, sf_dir):
    captures = fx.captures(spark, sf_dir, "index", "sitemap")
    return reports.locations_v0(catalogs.link_locations(captures, SPEC))


def locations_total(spark, sf_dir):
    captures = fx.captures(spark, sf_dir, "index", "sitemap")
    return reports.total_locations(catalogs.link_locations(captures, SPEC))


# ---- markers, sweeps and reconciliation --------------------------------------------------------------


def marker_stores(spark, sf_dir):
    captures = fx.captures(spark, sf_dir, "index", "sitemap")
    pages = links.state_pages(captures, SPEC)
    found = markers.stores_on_pages(captures, "sitemap", pages, SPEC, catalogs.SITEMAP, strict=False)
    return _show_page_rank(found, spark, sf_dir).select("page_rank", "pos", *STORE_FIELDS)


def marker_rejects(spark, sf_dir):
    pages = of_kind(fx.captures(spark, sf_dir, "sitemap"), "sitemap", strict=False)
    return markers.marker_rejects(pages, SPEC).drop("raw")


def rejects_beside_stores(spark, sf_dir):
    """The rejects of the state pages, kept by the one reading that also finds the stores."""
    captures = fx.captures(spark, sf_dir, "index", "sitemap")
    pages = links.state_pages(captures, SPEC)
    return markers.stores_and_rejects(captures, "sitemap", pages, SPEC, catalogs.SITEMAP, strict=False)[1].drop("raw", "source_rank")


def first_wins_beside_rejects(spark, sf_dir):
    captures = fx.captures(spark, sf_dir, "index", "sitemap", "search")
    stores, _ = catalogs.discovered_with_rejects(captures, fx.seeds(spark, sf_dir), SPEC)
    return _show_page_rank(stores, spark, sf_dir).select("source_rank", "page_rank", *STORE_FIELDS)


def first_wins_stores(spark, sf_dir):
    shown = _show_page_rank(_discovered(spark, sf_dir), spark, sf_dir)
    return shown.select("source_rank", "page_rank", *STORE_FIELDS)


def new_per_state_page(spark, sf_dir):
    captures = fx.captures(spark, sf_dir, "index", "sitemap")
    pages = links.with_page_rank(links.state_pages(captures, SPEC))
    found = markers.stores_on_pages(captures, "sitemap", pages, SPEC, catalogs.SITEMAP, strict=False)
    return reports.new_per_page(pages, reconcile.first_wins(found)).drop("url")


def seed_distinct(spark, sf_dir):
    return seeds.distinct_seeds(fx.seeds(spark, sf_dir))


def status_gate_errors(spark, sf_dir):
    pages = seeds.search_pages(fx.seeds(spark, sf_dir), SPEC).select("url", "page_rank")
    return reports.first_errors(fx.captures(spark, sf_dir, "search").drop("page_rank"), pages)


def sweep_errors(spark, sf_dir):
    pages = seeds.search_pages(fx.seeds(spark, sf_dir), SPEC).select("url")
    captures = fx.captures(spark, sf_dir, "search").select("url", "status", "fetched_at", "capture_id")
    return reports.error_count(captures.join(pages, "url"))


def lenient_status_stores(spark, sf_dir):
    return _sweep(spark, sf_dir, strict=False).select("page_rank", "pos", *STORE_FIELDS)


def strict_status_stores(spark, sf_dir):
    return _sweep(spark, sf_dir, strict=True).select("page_rank", "pos", *STORE_FIELDS)


def new_stores(spark, sf_dir):
    return _new(spark, sf_dir).select(*STORE_FIELDS)


def new_per_seed_running(spark, sf_dir):
    pages = seeds.search_pages(fx.seeds(spark, sf_dir), SPEC)
    return reports.with_running_total(reports.new_per_page(pages, _new(spark, sf_dir)).drop("url"))


def catalog_merge(spark, sf_dir):
    captures = fx.captures(spark, sf_dir, "search", "price")
    merged = catalogs.gap_catalog(captures, fx.seeds(spark, sf_dir), fx.known_catalog(spark, sf_dir), SPEC)
    return merged.select(*STORE_FIELDS, F.size("units").cast("long").alias("n_units"))


def nothing_new_merge(spark, sf_dir):
    """The known catalog holds every customer, so it is returned as it is."""
    captures, known = fx.captures(spark, sf_dir, "search", "price"), fx.partly_enriched(spark, sf_dir)
    merged = catalogs.gap_catalog(captures, fx.seeds(spark, sf_dir), known, SPEC)
    return merged.select("store_id", F.size("units").cast("long").alias("n_units"))


def new_store_listing(spark, sf_dir):
    entries = prices.price_entries(fx.captures(spark, sf_dir, "price"))
    return reports.new_store_listing(prices.attach_newest_units(_new(spark, sf_dir), entries))


# ---- prices and reports --------------------------------------------------------------------------------


def price_units(spark, sf_dir):
    found = prices.price_units(fx.captures(spark, sf_dir, "price"))
    return found.select("store_id", F.posexplode("units").alias("unit_pos", "unit")).select(
        "store_id", "unit_pos", "unit.*"
    )


def price_strict_batches(spark, sf_dir):
    return prices.responses_per_payload(fx.captures(spark, sf_dir, "price"))


def id_batches(spark, sf_dir):
    return ordering.id_batches(_discovered(spark, sf_dir), SPEC)


def stores_with_units(spark, sf_dir):
    """Only counts leave the payloads."""
    found = prices.attach_summary(_discovered(spark, sf_dir), prices.price_summary(fx.captures(spark, sf_dir, "price")))
    return found.filter("summary.n_units > 0").select("store_id", "address", "summary.n_units")


def catalog_in_order(spark, sf_dir):
    stores = _discovered(spark, sf_dir)
    return ordering.dense_index(stores, list(ORDER_FIELDS), "position").select("position", "store_id")


def cheapest_unit(spark, sf_dir):
    found = prices.price_summary(fx.captures(spark, sf_dir, "price")).select("store_id", "summary.*")
    return found.withColumn("price_label", text.price_label(F.col("cheapest_price_raw")))


def locations_v1_report(spark, sf_dir):
    return catalogs.link_locations_report(fx.captures(spark, sf_dir, "index", "sitemap", "price"), SPEC)


def locations_v2_report(spark, sf_dir):
    captures = fx.captures(spark, sf_dir, "index", "sitemap", "search", "price")
    return catalogs.daily_locations_report(captures, fx.seeds(spark, sf_dir), SPEC)


def unit_report_v1(spark, sf_dir):
    return reports.units_v1(catalogs.link_catalog(fx.captures(spark, sf_dir, "index", "sitemap", "price"), SPEC))


def unit_report_v2(spark, sf_dir):
    return reports.units_v2(_daily(spark, sf_dir))


def coverage(spark, sf_dir):
    captures = fx.captures(spark, sf_dir, "price")
    return reports.coverage(prices.attach_summary(_discovered(spark, sf_dir), prices.price_summary(captures)))


def coverage_published(spark, sf_dir):
    """The coverage counts that the write of the daily catalog took and published with it."""
    path, stores = new_work_dir(spark, "counted"), _daily(spark, sf_dir)
    catalog.write_catalog(stores, path, counts=reports.coverage_counts(stores))
    counts = catalog.read_counts(spark, path)
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} long" for name in counts))


# ---- details and catalogs --------------------------------------------------------------------------------


def facility_details(spark, sf_dir):
    captures = fx.captures(spark, sf_dir, "facility")
    found = details.facility_details(of_kind(captures, "facility"), SPEC, "url", "capture_id")
    return only_latest(found, captures).drop("capture_id")


def enrich_merge(spark, sf_dir):
    stores = fx.partly_enriched(spark, sf_dir)
    enriched = catalogs.enriched_catalog(stores, fx.captures(spark, sf_dir, "facility"), SPEC)
    return enriched.select(*STORE_FIELDS)


def facility_address(spark, sf_dir):
    return details.fill_addresses(fx.locations(spark, sf_dir), fx.captures(spark, sf_dir, "facility"))


def facility_page_address(spark, sf_dir):
    captures = fx.captures(spark, sf_dir, "facility")
    found = details.facility_addresses(of_kind(captures, "facility"), "url", "capture_id")
    return only_latest(found, captures).drop("capture_id")


def catalog_roundtrip(spark, sf_dir):
    stores = fx.partly_enriched(spark, sf_dir)
    path = new_work_dir(spark, "catalog")
    catalog.write_catalog(stores, path, "jsonl")
    again = catalog.read_catalog(spark, path, "jsonl", stores.schema)
    return catalog.with_missing_fields(again, STORE_FIELDS)


def catalog_bucketed(spark, sf_dir):
    """As ``catalog_publish``, with a catalog in buckets by store id, which the gap build does not shuffle."""
    path, buckets = new_work_dir(spark, "bucketed"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = fx.known_catalog(spark, sf_dir).schema
    catalog.write_catalog(fx.known_catalog(spark, sf_dir), path, buckets=buckets)
    known = catalog.read_catalog(spark, path, schema=schema)
    merged = catalogs.gap_catalog(fx.captures(spark, sf_dir, "search", "price"), fx.seeds(spark, sf_dir), known, SPEC)
    catalog.write_catalog(merged, path, buckets=buckets)
    return catalog.read_catalog(spark, path).select(*STORE_FIELDS, F.size("units").cast("long").alias("n_units"))


def catalog_publish(spark, sf_dir):
    """The known catalog, the gap build read off it and written over it, then read again."""
    path = new_work_dir(spark, "published")
    catalog.write_catalog(fx.known_catalog(spark, sf_dir), path)
    known = catalog.read_catalog(spark, path, schema=fx.known_catalog(spark, sf_dir).schema)
    merged = catalogs.gap_catalog(fx.captures(spark, sf_dir, "search", "price"), fx.seeds(spark, sf_dir), known, SPEC)
    catalog.write_catalog(merged, path)
    return catalog.read_catalog(spark, path).select(*STORE_FIELDS, F.size("units").cast("long").alias("n_units"))


def catalog_from_array(spark, sf_dir):
    """Catalog files that each hold one JSON array, of at most 1000 customers; a file is cut into pieces for several tasks."""
    stores = fx.partly_enriched(spark, sf_dir)
    path = new_work_dir(spark, "arrays")
    part = F.expr("CAST(store_id AS BIGINT) div 1000").alias("part")
    array = F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(F.struct(*stores.columns))), ",\n"), F.lit("]"))
    stores.groupBy(part).agg(array.alias("value")).write.partitionBy("part").text(path)
    return catalog.read_catalog(spark, f"{path}/*", "json", stores.schema)


def seeds_from_file(spark, sf_dir):
    path = new_work_dir(spark, "seeds")
    fx.seeds(spark, sf_dir).write.csv(path)
    return seeds.distinct_seeds(seeds.read_seeds(spark, path))


def seeds_from_list(spark, sf_dir):
    """A plain list of zips in the order of their ranks, as several files."""
    path = new_work_dir(spark, "list")
    fx.seeds(spark, sf_dir).repartitionByRange(3, "seed_rank").sortWithinPartitions("seed_rank").select("zip").write.text(path)
    return seeds.distinct_seeds(seeds.read_seed_list(spark, path))


# ---- runs ------------------------------------------------------------------------------------------------


def _landed(spark, sf_dir):
    """The fixture's captures as two runs: what was captured before, then the latest."""
    path, before = new_work_dir(spark, "runs"), F.col("capture_id") < 0
    captures = fx.captures(spark, sf_dir, "index", "sitemap", "search").union()
    for run in (captures.filter(before), captures.filter(~before)):
        runs.land(run, path)
    return path


def daily_report_over_runs(spark, sf_dir):
    """The daily report off the runs that hold latest captures, with prices folded run by run."""
    current = runs.read_current(spark, _landed(spark, sf_dir))
    stores = catalogs.discovered(current, fx.seeds(spark, sf_dir), SPEC)
    return reports.locations_v2(prices.attach_summary(stores, price_state.price_summary(spark, _folded(spark, sf_dir))))


def _folded(spark, sf_dir):
    path, captures = new_work_dir(spark, "prices"), fx.captures(spark, sf_dir, "price")
    for run, part in enumerate((F.col("capture_id") % 2 == 0, F.col("capture_id") % 2 != 0)):
        price_state.fold(captures.filter(part), path, "fixture", run)
    return path


def price_units_over_runs(spark, sf_dir):
    found = price_state.price_units(spark, _folded(spark, sf_dir))
    return found.select("store_id", F.posexplode("units").alias("unit_pos", "unit")).select("store_id", "unit_pos", "unit.*")


# ---- streaming -------------------------------------------------------------------------------------------


def _in_two_runs(spark, first, second, run):
    """Land captures in two steps and run the stream after each; the second run resumes."""
    path = new_work_dir(spark, "landing")
    for part in (first, second):
        part.write.mode("append").parquet(path)
        run(incremental.capture_stream(spark, path))


def stream_new_stores(spark, sf_dir):
    captures = fx.captures(spark, sf_dir, "search")
    seed_table, known = fx.seeds(spark, sf_dir), fx.known_catalog(spark, sf_dir)
    output, checkpoint = new_work_dir(spark, "found"), new_work_dir(spark, "checkpoint")
    early = F.col("url") < SPEC.search_template.format("00048")

    def run(stream):
        incremental.find_new_stores(stream, seed_table, known, SPEC, output, checkpoint)

    _in_two_runs(spark, captures.filter(early), captures.filter(~early), run)
    return incremental.read_new_stores(spark, output).select(*STORE_FIELDS)


def stream_enrich(spark, sf_dir):
    captures = fx.captures(spark, sf_dir, "facility")
    stores = fx.partly_enriched(spark, sf_dir)
    output, checkpoint = new_work_dir(spark, "details"), new_work_dir(spark, "checkpoint")

    def run(stream):
        incremental.collect_details(stream, stores, SPEC, output, checkpoint)

    early = F.col("url") < SPEC.base_url + "/self-storage-m"
    _in_two_runs(spark, captures.filter(early), captures.filter(~early), run)
    return incremental.read_enriched(spark, stores, output, SPEC.base_url).select(*STORE_FIELDS)


_QUERIES = (
    page_links,
    absolute_links_distinct,
    page_link_counts,
    state_pages,
    facility_links_loose,
    link_stores,
    facilities_per_page,
    locations_v0_report,
    locations_total,
    marker_stores,
    marker_rejects,
    rejects_beside_stores,
    first_wins_beside_rejects,
    first_wins_stores,
    new_per_state_page,
    seed_distinct,
    status_gate_errors,
    sweep_errors,
    lenient_status_stores,
    strict_status_stores,
    new_stores,
    new_per_seed_running,
    catalog_merge,
    new_store_listing,
    price_units,
    price_strict_batches,
    id_batches,
    stores_with_units,
    cheapest_unit,
    locations_v1_report,
    locations_v2_report,
    unit_report_v1,
    unit_report_v2,
    coverage,
    coverage_published,
    facility_details,
    enrich_merge,
    facility_address,
    facility_page_address,
    catalog_roundtrip,
    catalog_from_array,
    catalog_publish,
    catalog_bucketed,
    seeds_from_file,
    seeds_from_list,
    daily_report_over_runs,
    price_units_over_runs,
    catalog_in_order,
    nothing_new_merge,
    stream_new_stores,
    stream_enrich,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _QUERIES} | {k: v for more, _ in LLM for k, v in more.items()}


def oracle_sql() -> dict[str, str]:
    return dict(oracle_queries.ORACLE) | {k: sql for _, more in LLM for k, sql in more.items() if sql}
