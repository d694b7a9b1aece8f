"""Tables that change as a whole: every write is a new folder, and one small file says which folders count.

Readers look the file up when they are built and then read folders that no write touches, so a table can be written from itself. A
write that fails leaves the file as it was. The file is switched by a rename inside its folder, which a file system does as one step.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_POINTER = "_current.json"
_KEPT = 2  # folders of so many earlier states stay, for readers that still use them


class PublishError(RuntimeError):
    """A write that did not become the table's state; the state before it still counts."""


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def state(spark: SparkSession, path: str) -> dict | None:
    """What the table's file says, or None where there is none."""
    jvm, where, files = _file_system(spark, f"{path}/{_POINTER}")
    if not files.exists(where):
        return None
    stream = files.open(where)
    try:
        return json.loads(bytes(jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode())
    finally:
        stream.close()


def switch(spark: SparkSession, path: str, before: dict | None, after: dict) -> None:
    """Let ``after`` be the table's state if it still is ``before``; then remove folders that no recent state names.

    ``folders`` of a state are the folders it reads.
    """
    if state(spark, path) != before:
        raise PublishError(f"{path} was written by another job meanwhile")
    earlier = [before, *(before.get("earlier", []) if before else [])] if before else []
    earlier = [{"folders": s["folders"]} for s in earlier[:_KEPT]]
    jvm, new, files = _file_system(spark, f"{path}/_{uuid.uuid4().hex}.json")
    stream = files.create(new, True)
    stream.write(bytearray(json.dumps({**after, "earlier": earlier}).encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(new, jvm.org.apache.hadoop.fs.Path(f"{path}/{_POINTER}"), overwrite)
    live = {f for s in (after, *earlier) for f in s["folders"]}
    gone = {f for s in (before.get("earlier", []) if before else []) for f in s["folders"]} - live
    for folder in gone:
        files.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}"), True)


def new_folder(name: str) -> str:
    """A folder name that Spark's readers pass over when they list the table's own folder."""
    return f"_{name}-{uuid.uuid4().hex[:12]}"


def write_folder(
    rows: DataFrame, path: str, folder: str, file_format: str = "parquet", counts: Sequence[Column] = (), bucketed: tuple[int, str] | None = None, **options
) -> dict[str, int]:
    """Write rows to a folder that no state names yet; returns their number as ``rows``, checked by reading, and ``counts``, all taken by the write itself.

    ``bucketed``: so many buckets by a column, each one sorted file (``read_bucketed``).
    """
    spark = rows.sparkSession
    seen = Observation()
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
    if bucketed:
        buckets, key = bucketed
        name = _table_name()
        writer = rows.repartition(buckets, key).write.options(**options).format(file_format).bucketBy(buckets, key).sortBy(key)
        try:
            writer.option("path", f"{path}/{folder}").saveAsTable(name)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    else:
        rows.write.mode("overwrite").options(**options).format(file_format).save(f"{path}/{folder}")
    taken = seen.get
    written = taken["rows"]
    found = spark.read.schema(rows.schema).format(file_format).load(f"{path}/{folder}").count()
    if found != written:
        raise PublishError(f"{path}/{folder} holds {found} of {written} rows")
    return taken


def _table_name() -> str:
    return f"siteatlas_{uuid.uuid4().hex}"


def read_bucketed(spark: SparkSession, folder: str, schema: T.StructType, buckets: int, key: str) -> DataFrame:
    """A folder of bucketed Parquet files, with Spark knowing how its rows are dealt.

    Only tables tell Spark that, so the folder is one for as long as the DataFrame is built; no table stays in the session's catalog.
    """
    name = _table_name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{folder}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
