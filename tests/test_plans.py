"""What the plans must not do at scale."""

import re

import pytest

import __spark_entry__ as entry
from siteatlas import fixtures as fx
from siteatlas.operators import details, links, markers, prices
from siteatlas.plans import catalogs
from siteatlas.schema import CAPTURES
from siteatlas.sources.captures import of_kind, write_captures
from siteatlas.session import new_work_dir
from tests.conftest import SF

WRITERS = ("catalog_roundtrip", "catalog_from_array", "catalog_publish", "catalog_bucketed", "seeds_from_file", "seeds_from_list", "daily_report_over_runs", "price_units_over_runs")
BATCH_NAMES = [q.__name__ for q in entry._QUERIES if not q.__name__.startswith("stream_") and q.__name__ not in WRITERS]


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    """Captures as a user has them: parquet, partitioned by kind."""
    path = new_work_dir(spark, "captures")
    write_captures(fx.captures(spark, SF).union(), path)
    return spark.read.schema(CAPTURES).parquet(path)


@pytest.mark.parametrize("name", BATCH_NAMES)
def test_no_cross_join_and_no_row_by_row_python(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "FlatMapGroups"):
        assert bad not in text.replace("ArrowEvalPython", "")


def test_the_only_global_window_is_over_one_row_per_partition(spark):
    for name in BATCH_NAMES:
        for line in plan(entry.queries()[name](spark, SF)).splitlines():
            if re.search(r"Window \[", line) and "_part" not in line:
                raise AssertionError(f"{name}: {line}")


def exchanged_columns(frame):
    """The column names that cross the network, over all exchanges of the plan (broadcasts included)."""
    names = set()

    def walk(node):
        if node.nodeName().startswith(("Exchange", "BroadcastExchange")):
            output = node.output()
            names.update(output.apply(i).name() for i in range(output.size()))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    plan = frame._jdf.queryExecution().executedPlan()
    walk(plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan)
    assert names
    return names


def test_pages_are_read_once_and_bodies_never_shuffled(spark, stored):
    spec, seeds = fx.SPEC, fx.seeds(spark, SF)
    known, stores = fx.known_catalog(spark, SF), fx.partly_enriched(spark, SF)
    passes = {
        "daily": (catalogs.daily_locations_report(stored, seeds, spec), 3),  # index, state and search pages
        "gap": (catalogs.gap_catalog(stored, seeds, known, spec), 1),
        "links": (catalogs.link_locations_report(stored, spec), 2),  # index and state pages
        "enrich": (catalogs.enriched_catalog(stores, stored, spec), 1),
        "enrich daily": (catalogs.enriched_catalog(catalogs.daily_catalog(stored, seeds, spec), stored, spec), 4),
        "addresses": (details.fill_addresses(fx.locations(spark, SF), stored), 1),
    }
    for name, (frame, expected) in passes.items():
        assert plan(frame).count("ArrowEvalPython") == expected, name
        assert "body" not in exchanged_columns(frame), name


def jobs_started_by(spark, build):
    group = "building"
    spark.sparkContext.setJobGroup(group, group)
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_building_a_plan_starts_no_job(spark, stored):
    spec, seeds = fx.SPEC, fx.seeds(spark, SF)
    known, stores = fx.known_catalog(spark, SF), fx.partly_enriched(spark, SF)
    for build in (
        lambda: catalogs.daily_locations_report(stored, seeds, spec),
        lambda: catalogs.enriched_catalog(catalogs.daily_catalog(stored, seeds, spec), stored, spec),
        lambda: catalogs.gap_catalog(stored, seeds, known, spec),
        lambda: catalogs.link_locations(stored, spec, fetch_addresses=True),
        lambda: catalogs.enriched_catalog(stores, stored, spec),
    ):
        assert jobs_started_by(spark, build) == 0


def test_registered_reports_read_only_the_kinds_they_need(spark):
    assert plan(entry.locations_v2_report(spark, SF)).count("ArrowEvalPython") == 3


def test_filters_and_columns_reach_the_scan(spark, stored):
    text = plan(markers.page_stores(of_kind(stored, "search"), fx.SPEC, "url"))
    assert "PartitionFilters: [isnotnull(kind" in text
    assert "LessThan(status,400)" in text
    assert re.search(r"ReadSchema: struct<url:string,status:int,body:string>", text)
    text = plan(prices.price_summary(stored))
    assert re.search(r"ReadSchema: struct<capture_id:bigint,status:int,body:string,page_rank:bigint,fetched_at:timestamp>", text)


def test_json_is_parsed_once(spark, stored):
    text = plan(prices.price_entries(stored))
    assert text.count("promoInfoArr ARRAY") + text.count("StructField(promoInfoArr") == 1
    text = plan(markers.page_stores(of_kind(stored, "search"), fx.SPEC, "url"))
    assert text.count("try_parse_json") + text.count("parseJson") <= 1


def test_first_wins_combines_before_the_shuffle(spark, stored):
    text = plan(catalogs.discovered(stored, fx.seeds(spark, SF), fx.SPEC))
    assert "partial_min_by" in text


def test_link_counts_need_no_shuffle(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    text = plan(links.links_per_page(pages, "page_id", body="html"))
    assert "Exchange" not in text
    assert "ReadSchema: struct<page_id:bigint,html:string>" in text
