"""The same builds over captures as they land: file streams whose state is keyed by page.

Pages are captured again and again, and of a page only the latest capture counts. So what a batch keeps is one narrow row for each page that
landed, with its time and what it showed; the state is the row of the latest capture of every page, whichever batch brought it, and a
store that only an older capture showed is gone with it. The result is the same however the captures were cut into
batches, also when a lost checkpoint makes all of them run again. Batches are kept as ``segments``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteatlas.operators import details, reconcile
from siteatlas.plans import catalogs
from siteatlas.schema import CAPTURES, STORE_FIELDS
from siteatlas.session import persist_reliably
from siteatlas.sources.captures import latest_versions, of_kind
from siteatlas.sources.seeds import search_pages
from siteatlas.spec import SiteSpec
from siteatlas.streaming.segments import Segments

_SHOWN = T.StructType([T.StructField("pos", T.IntegerType())] + [T.StructField(name, T.StringType()) for name in STORE_FIELDS])
_PAGES = T.StructType(
    [
        T.StructField("page_url", T.StringType()),
        T.StructField("page_rank", T.LongType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("capture_id", T.LongType()),
        T.StructField("stores", T.ArrayType(_SHOWN)),
    ]
)
_DETAILS = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("capture_id", T.LongType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("page_ok", T.BooleanType()),
        T.StructField("details", T.StructType([T.StructField(n, T.StringType()) for n in details.DETAIL_FIELDS])),
    ]
)


def capture_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(CAPTURES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def _run(captures: DataFrame, checkpoint: str, on_batch: Callable[[DataFrame, int], None]) -> None:
    query = (
        captures.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _latest_pages(pages: DataFrame) -> DataFrame:
    """Of every page the row of its latest capture. A page may have come to another rank in the list of seeds; its latest row has the newest."""
    last = pages.groupBy("page_url").agg(F.max_by(F.struct("page_rank", "fetched_at", "capture_id", "stores"), F.struct("fetched_at", "capture_id")).alias("_last"))
    return last.select("page_url", "_last.*")


def _found(spark: SparkSession, output: str) -> Segments:
    return Segments(spark, output, _PAGES, _latest_pages)


def find_new_stores(
    captures: DataFrame,
    seeds: DataFrame,
    known: DataFrame,
    spec: SiteSpec,
    output: str,
    checkpoint: str,
) -> None:
    """Process the search pages landed since the last run: ``output`` keeps for every page the stores on its latest capture that nobody knew."""
    state = _found(captures.sparkSession, output)

    def on_batch(landed: DataFrame, batch_id: int) -> None:
        if state.has(checkpoint, batch_id):
            return
        # The candidates are used twice, so the batch's pages are read once and the narrow result is kept.
        found = persist_reliably(catalogs.sweep(landed, seeds, spec).select("page_url", "pos", *STORE_FIELDS))
        new = reconcile.not_known_few(found, known)
        shown = new.groupBy("page_url").agg(F.sort_array(F.collect_list(F.struct("pos", *STORE_FIELDS))).alias("stores"))
        pages = search_pages(seeds, spec).select("url", "page_rank").join(latest_versions(of_kind(landed, "search", strict=False), "fetched_at"), "url")
        pages = pages.withColumnRenamed("url", "page_url").join(shown, "page_url", "left")
        state.add(pages.withColumn("stores", F.coalesce("stores", F.array().cast(_PAGES["stores"].dataType))), checkpoint, batch_id)

    _run(captures, checkpoint, on_batch)


def read_new_stores(spark: SparkSession, output: str) -> DataFrame:
    """Every store on the pages' latest captures once, as first in discovery order."""
    shown = _found(spark, output).read().select("page_rank", "page_url", F.inline("stores"))
    return reconcile.first_wins(shown.withColumn("source_rank", F.lit(catalogs.SEARCH)))


def _deciding(rows: DataFrame) -> DataFrame:
    """Of every page the captures that decide what it says: the first that gave a site number, and the last that could be read."""
    at = F.struct("fetched_at", "capture_id")
    row = F.struct("capture_id", "fetched_at", "page_ok", "details")
    done = F.col("page_ok") & details.has_site_number("details")
    first, last = F.min_by(F.when(done, row), F.when(done, at)), F.max_by(F.when(F.col("page_ok"), row), F.when(F.col("page_ok"), at))
    kept = rows.groupBy("url").agg(F.array_distinct(F.array_compact(F.array(first, last))).alias("kept"))
    return kept.select("url", F.inline("kept"))


def _collected(spark: SparkSession, output: str) -> Segments:
    return Segments(spark, output, _DETAILS, _deciding)


def collect_details(
    captures: DataFrame, stores: DataFrame, spec: SiteSpec, output: str, checkpoint: str
) -> None:
    """Read the facility pages landed since the last run; what is kept are narrow rows of stores the catalog has open.

    Progress is saved per batch, so an interrupted run resumes after the last finished batch. Pages that land after a store
    was done are told apart when the output is read.
    """
    state = _collected(captures.sparkSession, output)
    todo = details.needs_details(stores).select("url").filter("url IS NOT NULL").distinct()

    def on_batch(landed: DataFrame, batch_id: int) -> None:
        if state.has(checkpoint, batch_id):
            return
        found = details.page_details(of_kind(landed, "facility", strict=False), spec)
        state.add(found.join(todo, "url", "left_semi"), checkpoint, batch_id)

    _run(captures, checkpoint, on_batch)


def read_enriched(spark: SparkSession, stores: DataFrame, output: str, base_url: str | None = None) -> DataFrame:
    """The catalog with all details collected so far: a store is done with the first page that gave its site number."""
    collected = _collected(spark, output).read()
    return details.merge_details(stores, details.details_until_done(collected), base_url)
