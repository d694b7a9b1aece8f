"""The captures table: one row per fetched document."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteatlas.schema import CAPTURES


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """Captures stored as parquet, ideally partitioned by ``kind``."""
    return spark.read.schema(CAPTURES).parquet(path)


def write_captures(captures: DataFrame, path: str, mode: str = "append") -> None:
    captures.write.mode(mode).partitionBy("kind").parquet(path)


def of_kind(captures: DataFrame | Mapping[str, DataFrame], kind: str, strict: bool = True) -> DataFrame:
    """Documents of one kind. ``strict`` leaves out those whose status is an error.

    Captures may also be given as a mapping from kind to table, so that no plan holds kinds that it does not read.
    """
    chosen = captures[kind] if isinstance(captures, Mapping) else captures.filter(F.col("kind") == kind)
    return ok(chosen) if strict else chosen


def latest_versions(captures: DataFrame, *fields: str) -> DataFrame:
    """(url, capture_id, *fields) of the latest capture of every url, by (fetched_at, capture_id).

    The latest capture counts whatever its status: a page that fails now shows nothing, as in a run that only sees
    today's pages. The fields should be narrow; bodies are left where they are.
    """
    order = F.struct(F.col("fetched_at").alias("_at"), F.col("capture_id").alias("_id"))
    last = captures.groupBy("url").agg(F.max_by(F.struct("capture_id", *fields), order).alias("_last"))
    return last.select("url", "_last.*")


def only_latest(rows: DataFrame, captures: DataFrame) -> DataFrame:
    """The rows, read off any captures, that come from the latest capture of their page.

    The rows are narrow and hold ``capture_id``; page bodies never cross the network for this.
    """
    return rows.join(latest_versions(captures).select("capture_id"), "capture_id", "left_semi")


def ok(captures: DataFrame) -> DataFrame:
    return captures.filter(F.col("status") < 400)


def errors(captures: DataFrame) -> DataFrame:
    return captures.filter(F.col("status") >= 400)
