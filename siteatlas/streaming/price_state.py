"""The current price of every store, folded run by run instead of read off all payloads ever sent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from siteatlas.operators import prices
from siteatlas.schema import UNITS
from siteatlas.streaming.segments import Segments

_ENTRIES = T.StructType(
    [
        T.StructField("store_id", T.StringType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("page_rank", T.LongType()),
        T.StructField("capture_id", T.LongType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("units", UNITS),
    ]
)


def _state(spark: SparkSession, path: str) -> Segments:
    return Segments(spark, path, _ENTRIES, lambda entries: prices.last_wins(entries, *[f.name for f in _ENTRIES if f.name != "store_id"]))


def fold(captures: DataFrame, path: str, source: str, run: int, strict_batch: bool = True) -> None:
    """Add the payloads of one run; a run of a source that is in already adds nothing. The order of runs does not matter."""
    found = prices.price_entries(captures, strict_batch)
    _state(found.sparkSession, path).add(found, f"{source}/{run}", 0)


def entries(spark: SparkSession, path: str) -> DataFrame:
    """The newest entry of every store, as ``prices.price_entries`` of all runs would give after ``prices.last_wins``."""
    return _state(spark, path).read()


def price_units(spark: SparkSession, path: str) -> DataFrame:
    return entries(spark, path).select("store_id", "units")


def price_summary(spark: SparkSession, path: str) -> DataFrame:
    return entries(spark, path).select("store_id", prices.unit_summary().alias("summary"))
