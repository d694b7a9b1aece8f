"""Catalog and seed files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from siteatlas.operators import reconcile, reports
from siteatlas.schema import CAPTURES, STORES
from siteatlas.session import new_work_dir, shared_dir
from siteatlas.sources import captures, catalog, published, seeds

UNIT = {"size": "5x5", "price_raw": "45.0", "price": 45.0, "available": True, "count": 2, "promo": "", "promo2": ""}
RECORDS = [
    {"store_id": "007", "site_number": None, "address": "a", "city": "c", "state": "KS", "zip": "01234", "phone": None,
     "lat": "1", "lng": None, "url": "u", "units": [UNIT]},
    {"store_id": "8", "site_number": "1", "address": "", "city": "c", "state": "KS", "zip": "", "phone": "",
     "lat": None, "lng": None, "url": "v", "units": []},
]


def plain(frame):
    return sorted((r.asDict(recursive=True) for r in frame.collect()), key=lambda r: r["store_id"])


@pytest.mark.parametrize("file_format", ["parquet", "jsonl"])
def test_catalog_round_trip(spark, file_format):
    path = new_work_dir(spark, "catalog")
    catalog.write_catalog(spark.createDataFrame(RECORDS, STORES), path, file_format)
    assert plain(catalog.read_catalog(spark, path, file_format)) == RECORDS
    if file_format == "jsonl":
        lines = [json.loads(r.value) for r in spark.read.text(catalog.current_path(spark, path)).collect()]
        assert all(set(line) == set(RECORDS[0]) for line in lines)


def test_json_array_catalog(spark, tmp_path):
    file = tmp_path / "catalog.json"
    file.write_text(json.dumps(RECORDS, indent=1))
    assert plain(catalog.read_catalog(spark, str(file), "json")) == RECORDS


def test_fields_an_old_catalog_lacks(spark):
    old = spark.createDataFrame([("1", None)], "store_id string, zip string")
    assert catalog.with_missing_fields(old, ("zip", "phone")).first().asDict() == {"store_id": "1", "zip": None, "phone": ""}


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        catalog.read_catalog(spark, "x", "xml")


def test_seeds_keep_leading_zeros(spark, tmp_path, spec):
    (tmp_path / "seeds.csv").write_text("0,01001\n1,20001\n2,01001\n")
    frame = seeds.read_seeds(spark, str(tmp_path / "seeds.csv"))
    pages = {r.url: r.page_rank for r in seeds.search_pages(frame, spec).collect()}
    assert pages == {"https://atlas.example/find?near=01001": 0, "https://atlas.example/find?near=20001": 1}


def test_captures_table(spark, make_captures):
    path = new_work_dir(spark, "captures")
    captures.write_captures(make_captures(("index", "a", "x"), ("price", "b", "{}", 500, 7)), path)
    table = captures.read_captures(spark, path)
    assert set(table.columns) == {f.name for f in CAPTURES}
    assert [(r.url, r.page_rank) for r in captures.of_kind(table, "price", strict=False).collect()] == [("b", 7)]
    assert captures.of_kind(table, "price").count() == 0
    assert captures.errors(table).count() == 1


def test_shared_dir_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_dir(spark) == configured


def test_catalog_written_over_the_one_it_was_read_from(spark):
    path = new_work_dir(spark, "catalog")
    catalog.write_catalog(spark.createDataFrame(RECORDS, STORES), path)
    for n in range(3, 8):
        known = catalog.read_catalog(spark, path)
        one = spark.createDataFrame([{**RECORDS[0], "store_id": str(n)}], STORES)
        assert catalog.write_catalog(reconcile.append_new(known, one), path) == n
        assert plain(known)[0]["store_id"] == "007"  # a reader from before still sees its own state
        assert catalog.read_catalog(spark, path).count() == n
    folders = [f for f in os.listdir(path.removeprefix("file:")) if f.startswith("_catalog")]
    assert len(folders) == 3  # the current one and two before


def test_failed_write_leaves_the_old_catalog(spark):
    path = new_work_dir(spark, "catalog")
    catalog.write_catalog(spark.createDataFrame(RECORDS, STORES), path)
    known = catalog.read_catalog(spark, path)
    half = known.unionByName(known.repartition(3)).withColumn("city", F.when(F.col("store_id") == "8", F.raise_error(F.lit("broken"))).otherwise(F.col("city")))
    with pytest.raises(Exception, match="broken"):
        catalog.write_catalog(half, path)
    assert plain(catalog.read_catalog(spark, path)) == RECORDS
    assert catalog.write_catalog(known.filter("store_id = '8'"), path, "jsonl") == 1
    assert plain(catalog.read_catalog(spark, path, "jsonl")) == RECORDS[1:]


def test_two_writers_do_not_undo_each_other(spark):
    path = new_work_dir(spark, "catalog")
    stores = spark.createDataFrame(RECORDS, STORES)
    catalog.write_catalog(stores, path)
    before = published.state(spark, path)
    catalog.write_catalog(stores, path)
    with pytest.raises(published.PublishError):
        published.switch(spark, path, before, {"folders": ["_late"]})
    assert catalog.read_catalog(spark, path).count() == 2


def test_counts_are_published_with_the_catalog(spark):
    path = new_work_dir(spark, "counted")
    assert catalog.read_counts(spark, path) == {}
    stores = spark.createDataFrame(RECORDS, STORES)
    assert catalog.write_catalog(stores, path, counts=reports.coverage_counts(stores)) == 2
    assert catalog.read_counts(spark, path) == reports.coverage(stores).first().asDict()
    assert catalog.read_counts(spark, path) == {"total": 2, "with_pricing": 1, "with_site_number": 1, "with_phone": 0, "remaining": 1}
    catalog.write_catalog(stores.limit(0), path, counts=reports.coverage_counts(stores))
    assert set(catalog.read_counts(spark, path).values()) == {0}
    catalog.write_catalog(stores, path)  # counts belong to the catalog they were taken of
    assert catalog.read_counts(spark, path) == {}


def test_records_are_made_once_for_the_write_and_its_counts(spark):
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    stores = spark.createDataFrame(RECORDS, STORES).mapInArrow(seen, STORES)
    catalog.write_catalog(stores, new_work_dir(spark, "once"), counts=reports.coverage_counts(stores))
    assert made.value == len(RECORDS)
