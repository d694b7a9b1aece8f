"""Incremental builds: split input, repeated runs, repeated batches."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteatlas import fixtures as fx
from siteatlas.plans import catalogs
from siteatlas.session import new_work_dir
from siteatlas.sources import published
from siteatlas.streaming import incremental, segments
from tests.conftest import SF


def rows(frame):
    return sorted(map(tuple, frame.select("store_id", "site_number", "address", "url").collect()), key=str)


def test_new_stores_over_many_small_batches(spark):
    """One file per page in seed order: the same stores as one batch build over all pages."""
    captures = fx.captures(spark, SF, "search")
    seeds, known = fx.seeds(spark, SF), fx.known_catalog(spark, SF)
    landing, output, checkpoint = (new_work_dir(spark, n) for n in ("landing", "found", "checkpoint"))
    for part in range(3):
        low, high = f"{30 * part:05d}", f"{30 * (part + 1) + 20 * (part == 2):05d}"
        url = F.col("url")
        piece = captures.filter(
            (url >= fx.SPEC.search_template.format(low)) & (url < fx.SPEC.search_template.format(high))
        )
        piece.coalesce(1).write.mode("append").parquet(landing)
    stream = incremental.capture_stream(spark, landing, max_files=1)
    incremental.find_new_stores(stream, seeds, known, fx.SPEC, output, checkpoint)
    expected = rows(catalogs.found_new(captures, seeds, known, fx.SPEC))
    assert rows(incremental.read_new_stores(spark, output)) == expected
    # Nothing new landed: nothing changes.
    incremental.find_new_stores(incremental.capture_stream(spark, landing, 1), seeds, known, fx.SPEC, output, checkpoint)
    assert rows(incremental.read_new_stores(spark, output)) == expected

    # All batches run again, as after losing the checkpoint, cut in the same way and in others.
    for max_files in (1, None, 2):
        again = new_work_dir(spark, "checkpoint")
        stream = incremental.capture_stream(spark, landing, max_files)
        incremental.find_new_stores(stream, seeds, known, fx.SPEC, output, again)
        assert rows(incremental.read_new_stores(spark, output)) == expected


def test_enrichment_resumes_and_skips_what_is_done(spark):
    captures = fx.captures(spark, SF, "facility")
    stores = fx.partly_enriched(spark, SF)
    landing, output, checkpoint = (new_work_dir(spark, n) for n in ("landing", "details", "checkpoint"))

    def run():
        stream = incremental.capture_stream(spark, landing)
        incremental.collect_details(stream, stores, fx.SPEC, output, checkpoint)
        return rows(incremental.read_enriched(spark, stores, output))

    half = F.col("capture_id") % 2 == 0
    captures.filter(half).write.parquet(landing)
    first = run()
    assert first == rows(catalogs.enriched_catalog(stores, captures.filter(half), fx.SPEC))

    captures.filter(~half).write.mode("append").parquet(landing)
    assert run() == rows(catalogs.enriched_catalog(stores, captures, fx.SPEC))

    # A store with a site number asks for no page any more, so a changed copy changes nothing, in one more batch or all in one.
    before = rows(incremental.read_enriched(spark, stores, output))
    done = [r.url for r in incremental.read_enriched(spark, stores, output).filter("site_number <> ''").collect()]
    changed = captures.filter(F.col("url").isin(done)).withColumn("body", F.lit("<p data-sitenumber=1>"))
    changed = changed.withColumns({"capture_id": F.col("capture_id") + 10**12, "fetched_at": F.current_timestamp()})
    changed.write.mode("append").parquet(landing)
    assert run() == before
    checkpoint = new_work_dir(spark, "checkpoint")
    assert run() == before


def page(spec, zip_code, *store_ids):
    markers = "".join(f"""<input class="{spec.marker_class}" value='{{"storeID":"{i}","content":{{"plpLink":"/s/{i}"}}}}'>""" for i in store_ids)
    return "search", spec.search_template.format(zip_code), markers


def test_a_page_captured_again_withdraws_what_it_no_longer_shows(spark, spec, make_captures):
    """However the captures are cut into batches: as one batch, as the batch build."""
    seeds = spark.createDataFrame([(0, "01"), (1, "02"), (2, "03")], "seed_rank long, zip string")
    known = spark.createDataFrame([("9",)], "store_id string")
    captures = make_captures(
        page(spec, "01", "1", "5", "9"), page(spec, "02", "1", "3"), page(spec, "03", "7"), page(spec, "01", "2"), page(spec, "03", "8"), (*page(spec, "02")[:2], "", 500), page(spec, "02", "3", "4", "4")
    ).withColumn("fetched_at", F.timestamp_seconds(F.col("capture_id")))
    expected = rows(catalogs.found_new(captures, seeds, known, spec))
    assert [r[0] for r in expected] == ["2", "3", "4", "8"]
    for cut in ([7], [1] * 7, [3, 4], [4, 2, 1], "backwards"):
        landing, output, checkpoint = (new_work_dir(spark, n) for n in ("landing", "found", "checkpoint"))
        parts = [1] * 7 if cut == "backwards" else cut
        low = 0
        for size in parts:
            ids = range(low, low + size)
            ids = [6 - i for i in ids] if cut == "backwards" else list(ids)
            captures.filter(F.col("capture_id").isin(ids)).coalesce(1).write.mode("append").parquet(landing)
            low += size
            incremental.find_new_stores(incremental.capture_stream(spark, landing), seeds, known, spec, output, checkpoint)
        assert rows(incremental.read_new_stores(spark, output)) == expected, cut
        folders = published.state(spark, output)["folders"]
        assert len(folders) < 4 + len(parts) // 4


def test_segments_are_merged_and_a_batch_counts_once(spark):
    path = new_work_dir(spark, "segments")
    newest = lambda d: d.groupBy("k").agg(F.max("v").alias("v"))
    state = segments.Segments(spark, path, T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType())]), newest)
    assert state.read().count() == 0
    for batch in range(22):
        made = spark.range(5).select(F.col("id").alias("k"), F.lit(batch).cast("long").alias("v"))
        state.add(made, "a", batch)
        state.add(made.withColumn("v", F.lit(99).cast("long")), "a", batch)  # the same batch again
        now = published.state(spark, path)
        assert len(now["segments"]) <= 2 * (segments.FAN - 1) + 1
    assert sorted(map(tuple, state.read().collect())) == [(k, 21) for k in range(5)]
    on_disk = [f for f in os.listdir(path.removeprefix("file:")) if f.startswith(("_batch", "_level"))]
    assert len(on_disk) <= 12


def test_a_failed_batch_changes_nothing(spark):
    path = new_work_dir(spark, "segments")
    state = segments.Segments(spark, path, T.StructType([T.StructField("k", T.LongType())]), lambda d: d.distinct())
    state.add(spark.range(3).withColumnRenamed("id", "k"), "a", 0)
    with pytest.raises(Exception, match="broken"):
        state.add(spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("k")), "a", 1)
    assert state.read().count() == 3 and not state.has("a", 1)
