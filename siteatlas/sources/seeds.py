"""Zip seeds of a search sweep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteatlas.functions import text
from siteatlas.operators.ordering import dense_index
from siteatlas.schema import SEEDS
from siteatlas.spec import SiteSpec


def read_seeds(spark: SparkSession, path: str, file_format: str = "csv") -> DataFrame:
    """(seed_rank, zip); zips stay text because leading zeros matter."""
    return spark.read.schema(SEEDS).format(file_format).load(path)


def read_seed_list(spark: SparkSession, path: str) -> DataFrame:
    """(seed_rank, zip) of text files with a zip a line, ranked by file name and line; blank lines are passed over.

    Lines know their file and block; a sort by (file, block, place in it) puts them in order in several tasks, and ranks come from the sizes of
    the sorted parts, so no task reads a whole file. Ranking writes the lines once to the shared folder, a job of its own.
    """
    at = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    lines = spark.read.text(path).select(F.trim(F.regexp_replace("value", r"\s+", " ")).alias("zip"), *at, F.monotonically_increasing_id().alias("_line"))
    ranked = dense_index(lines.filter("zip <> ''"), ["_file", "_block", "_line"], "seed_rank")
    return ranked.select("seed_rank", "zip")


def distinct_seeds(seeds: DataFrame) -> DataFrame:
    """Each zip once, at its first rank."""
    return seeds.groupBy("zip").agg(F.min("seed_rank").alias("seed_rank"))


def search_pages(seeds: DataFrame, spec: SiteSpec) -> DataFrame:
    """(url, page_rank, zip) of the search page of every distinct seed."""
    return distinct_seeds(seeds).select(
        text.fill_template(spec.search_template, F.col("zip")).alias("url"),
        F.col("seed_rank").alias("page_rank"),
        "zip",
    )
