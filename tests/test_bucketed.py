"""A catalog in buckets by store id: same rows, and no build shuffles it."""

import re

import pytest
from pyspark.sql import functions as F

from siteatlas import fixtures as fx
from siteatlas.operators import reconcile
from siteatlas.plans import catalogs
from siteatlas.schema import STORE_FIELDS
from siteatlas.sources import catalog
from tests.conftest import SF


@pytest.fixture
def no_broadcast(spark):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.maxMetadataStringLength": "4000"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def shuffled_scans(frame, folder):
    """(scans of a folder, those below an exchange) in the physical plan."""
    above, scans, below = [], 0, 0
    for line in frame._jdf.queryExecution().executedPlan().treeString().splitlines():
        depth = re.search(r"[A-Za-z(*]", line).start()
        above = [(d, x) for d, x in above if d < depth]
        if "FileScan" in line and folder in line:
            scans += 1
            below += any("Exchange" in x for _, x in above)
        above.append((depth, line))
    return scans, below


def published(spark, path, **options):
    known = fx.known_catalog(spark, SF)
    catalog.write_catalog(known, path, **options)
    return catalog.read_catalog(spark, path, schema=known.schema)


def test_same_rows(spark, tmp_path):
    plain, bucketed = published(spark, str(tmp_path / "a")), published(spark, str(tmp_path / "b"), buckets=4)
    assert plain.exceptAll(bucketed).isEmpty() and bucketed.exceptAll(plain).isEmpty()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("siteatlas")]


@pytest.mark.parametrize("options, below", [({}, True), ({"buckets": 4}, False)])
def test_the_gap_build_shuffles_no_row_of_the_known_catalog(spark, no_broadcast, tmp_path, options, below):
    path = str(tmp_path / "known")
    known = published(spark, path, **options)
    folder = catalog.current_path(spark, path).rsplit("/", 1)[1]
    merged = catalogs.gap_catalog(fx.captures(spark, SF, "search", "price"), fx.seeds(spark, SF), known, fx.SPEC)
    scans, shuffled = shuffled_scans(merged, folder)
    assert scans >= 2 and bool(shuffled) == below


def test_repeated_and_null_ids_and_empty_catalogs(spark, no_broadcast, tmp_path):
    schema = fx.known_catalog(spark, SF).schema
    row = {name: "x" for name in STORE_FIELDS}
    known = spark.createDataFrame([{**row, "store_id": i} for i in ["1", "1", None, "2"]], schema)
    path = str(tmp_path / "known")
    assert catalog.write_catalog(known, path, buckets=4) == 4
    read = catalog.read_catalog(spark, path, schema=schema)
    assert sorted(r.store_id or "" for r in read.collect()) == ["", "1", "1", "2"]
    new = spark.createDataFrame([("2",), ("3",), (None,)], "store_id string")
    assert sorted(r.store_id or "" for r in reconcile.not_known(new, read).collect()) == ["", "3"]
    assert catalog.write_catalog(read.filter("false"), path, buckets=4) == 0
    assert catalog.read_catalog(spark, path, schema=schema).isEmpty()


def test_a_catalog_is_written_over_itself_with_other_buckets(spark, tmp_path):
    path = str(tmp_path / "known")
    known = published(spark, path, buckets=4)
    want = sorted(r.store_id for r in known.collect())
    catalog.write_catalog(known, path, buckets=7)
    again = catalog.read_catalog(spark, path, schema=known.schema)
    assert sorted(r.store_id for r in again.collect()) == want
    catalog.write_catalog(again.withColumn("phone", F.lit("0")), path)
    assert catalog.read_catalog(spark, path, schema=known.schema).filter("phone = '0'").count() == len(want)


def test_only_parquet_has_buckets(spark, tmp_path):
    with pytest.raises(ValueError):
        catalog.write_catalog(fx.known_catalog(spark, SF), str(tmp_path / "x"), "jsonl", buckets=4)
