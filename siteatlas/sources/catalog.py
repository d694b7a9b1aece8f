"""Catalog files: the stores known so far, in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteatlas.schema import STORES
from siteatlas.sources import json_array, published

KEY = "store_id"
_FORMATS = {"parquet": ("parquet", {}), "jsonl": ("json", {"ignoreNullFields": False})}


def read_catalog(
    spark: SparkSession, path: str, file_format: str = "parquet", schema: T.StructType = STORES
) -> DataFrame:
    """``file_format``: parquet, jsonl, or json for a file holding one JSON array.

    Of a published catalog (``write_catalog``) the state at this moment is read, whatever is published later. A JSON array is read in several
    tasks, but its pieces are sorted and written once for that (a job); a file that is not one whole array raises here (``json_array``).
    A catalog written with ``buckets`` is read so that joins and groups by store id shuffle none of it.
    """
    reader = spark.read.schema(schema)
    state = _state(spark, path)
    path = _folder(path, state)
    if state and state.get("buckets"):
        return published.read_bucketed(spark, path, schema, state["buckets"], KEY)
    if file_format == "parquet":
        return reader.parquet(path)
    if file_format == "jsonl":
        return reader.json(path)
    if file_format == "json":
        return json_array.read_array(spark, path, schema)
    raise ValueError(f"unknown catalog format {file_format!r}")


def write_catalog(stores: DataFrame, path: str, file_format: str = "parquet", counts: list[Column] | None = None, buckets: int | None = None) -> int:
    """Publish all records with all keys (nulls are written as null) as the catalog at ``path``; returns their number.

    Readers see the old catalog or the new one, never a part: the records go to a folder of their own, are counted there, and only then does
    the catalog's file name this folder. So ``stores`` may be read from ``path`` itself, and a write that fails changes nothing. If
    another job has published meanwhile, this one raises. The folders of the two catalogs before stay for readers that still use them.

    ``counts`` are named aggregates of integers over the records, such as ``reports.coverage_counts``. The write itself takes them, so the records are made once;
    they are published with the catalog (``read_counts``).

    ``buckets`` (Parquet only): the records are dealt by store id into so many sorted files, in one shuffle. Builds that look stores up by id then read
    the catalog where it lies, if their ``spark.sql.shuffle.partitions`` is no more than ``buckets``; with more, Spark deals it anew.
    """
    if file_format not in _FORMATS:
        raise ValueError(f"unknown catalog format {file_format!r}")
    if buckets and file_format != "parquet":
        raise ValueError("only Parquet catalogs have buckets")
    spark = stores.sparkSession
    before = published.state(spark, path)
    folder = published.new_folder("catalog")
    spark_format, options = _FORMATS[file_format]
    seen = published.write_folder(stores, path, folder, spark_format, counts or [], (buckets, KEY) if buckets else None, **options)
    rows = seen.pop("rows")
    published.switch(spark, path, before, {"folders": [folder], "format": file_format, "rows": rows, "counts": seen, "buckets": buckets})
    return rows


def read_counts(spark: SparkSession, path: str) -> dict[str, int]:
    """The counts that were published with the catalog at ``path``, without reading its records; none where none were asked for."""
    state = published.state(spark, path)
    return (state or {}).get("counts", {})


def current_path(spark: SparkSession, path: str) -> str:
    """The folder that holds the catalog's files: the published one, or ``path`` itself for files from elsewhere."""
    return _folder(path, _state(spark, path))


def _state(spark: SparkSession, path: str) -> dict | None:
    return published.state(spark, path) if not any(c in path for c in "*?{[") else None


def _folder(path: str, state: dict | None) -> str:
    return f"{path}/{state['folders'][0]}" if state else path


def with_missing_fields(stores: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Fields an older catalog lacks become empty text; nulls stay null."""
    return stores.withColumns({name: F.lit("") for name in names if name not in stores.columns})
