"""Captures kept run by run, with an index of every page's latest capture, so that a report reads today's pages and not the history.

``land`` writes a run's captures to a folder of its own (``run=``) and merges their narrow columns into the index: one row per kind and url. The index
says how many of a run's captures still are the latest of their page. ``read_current`` opens only runs that hold such captures: partition
pruning, decided before any page is read. Where less than half of a run's captures of a kind still count, ``land`` copies those to a
folder beside the newest run, so readers never meet more than twice as many pages as there are.

Which capture of a page counts stays decided by ``captures.latest_versions``; the runs that are left out hold none. Price payloads are not pruned:
the newest price of a store may be in any of them (``price_state`` folds those).
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteatlas.schema import CAPTURES
from siteatlas.sources import published

_ALL = ("price",)  # kinds of which all captures count
_INDEX = "kind string, url string, capture_id long, fetched_at timestamp, folder string"


def _index(spark: SparkSession, path: str, state: dict) -> DataFrame:
    return spark.read.schema(_INDEX).parquet(f"{path}/{state['folders'][0]}")


def _read(spark: SparkSession, path: str, folders: list[tuple[str, str]]) -> DataFrame:
    """Captures of some (folder, kind). The kind is the name of a directory, so a reader of one kind lists no other."""
    names = [f.name for f in CAPTURES]
    if not folders:
        return spark.createDataFrame([], CAPTURES)
    parts = {}
    for folder, kind in folders:  # carried folders are hidden from readers of the history, so each is a table of its own
        base = f"{path}/{folder}" if folder.startswith("_") else path
        parts.setdefault(base, []).append(f"{path}/{folder}/kind={kind}")
    read = [spark.read.schema(CAPTURES).option("basePath", base).parquet(*paths).select(*names) for base, paths in parts.items()]
    return reduce(DataFrame.unionByName, read)


def _narrow(captures: DataFrame, folder: str) -> DataFrame:
    return captures.filter(~F.col("kind").isin(*_ALL)).select("kind", "url", "capture_id", "fetched_at", F.lit(folder).alias("folder"))


def land(captures: DataFrame, path: str) -> None:
    """Add the captures of one run. They are read twice: bodies once to be written, then narrow columns of what was written.

    A run that fails before its end is not listed and does not count. Captures without a url come along and are the latest of none.
    """
    spark = captures.sparkSession
    before = published.state(spark, path)
    number = before["runs"] if before else 0
    folder = f"run={number:06d}-{uuid.uuid4().hex[:8]}"
    captures.select(*[f.name for f in CAPTURES]).write.partitionBy("kind").parquet(f"{path}/{folder}")
    landed = spark.read.schema(CAPTURES).parquet(f"{path}/{folder}")
    rows = _narrow(landed, folder)
    if before:
        rows = _index(spark, path, before).unionByName(rows)
    order = F.struct("fetched_at", "capture_id")
    index = rows.groupBy("kind", "url").agg(F.max_by(F.struct("capture_id", "fetched_at", "folder"), order).alias("_last")).select("kind", "url", "_last.*")
    index_folder = published.new_folder("index")
    published.write_folder(index, path, index_folder)
    index = spark.read.schema(_INDEX).parquet(f"{path}/{index_folder}")

    written = {(r["folder"], r["kind"]): r["n"] for r in landed.groupBy(F.lit(folder).alias("folder"), "kind").agg(F.count("*").alias("n")).collect()}
    written |= {(f, k): n for f, k, n in before["written"]} if before else {}
    live = {(r["folder"], r["kind"]): r["n"] for r in index.groupBy("folder", "kind").agg(F.count("*").alias("n")).collect()}  # a row for each run and kind
    sparse = [key for key, n in live.items() if 2 * n < written[key]]
    if sparse:
        carried = f"_carried-{number:06d}-{uuid.uuid4().hex[:8]}"
        thin = F.struct("folder", "kind").isin(*[F.struct(F.lit(f), F.lit(k)) for f, k in sparse])
        kept = _read(spark, path, sparse).join(index.filter(thin).select("kind", "capture_id").distinct(), ["kind", "capture_id"], "left_semi")
        kept.select(*[f.name for f in CAPTURES]).write.partitionBy("kind").parquet(f"{path}/{carried}")
        moved = index.withColumn("folder", F.when(thin, F.lit(carried)).otherwise(F.col("folder")))
        index_folder = published.new_folder("index")
        published.write_folder(moved, path, index_folder)
        for key in sparse:
            n = live.pop(key)
            live[(carried, key[1])] = live.get((carried, key[1]), 0) + n
            written[(carried, key[1])] = live[(carried, key[1])]
    live |= {key: n for key, n in written.items() if key[1] in _ALL}
    published.switch(
        spark,
        path,
        before,
        {
            "folders": [index_folder],
            "runs": number + 1,
            "live": sorted([f, k, n] for (f, k), n in live.items()),
            "written": sorted([f, k, n] for (f, k), n in written.items() if (f, k) in live),
        },
    )


def read_current(spark: SparkSession, path: str, *kinds: str) -> DataFrame:
    """The captures of all runs that hold the latest capture of some page (of the given kinds, or of all); whole runs are left out, no rows."""
    state = published.state(spark, path)
    live = [(f, k) for f, k, n in state["live"] if n and (not kinds or k in kinds)] if state else []
    return _read(spark, path, live)


def latest_index(spark: SparkSession, path: str) -> DataFrame:
    """(kind, url, capture_id, fetched_at, folder) of the latest capture of every page."""
    state = published.state(spark, path)
    return _index(spark, path, state) if state else spark.createDataFrame([], _INDEX)
