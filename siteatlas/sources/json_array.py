"""The objects of files that each hold one JSON array, read in several tasks.

A file is cut at ``}``, which Spark's text reader does block by block. What a piece means depends on what stands before it: whether it
begins inside a string, and how many objects are open there. Both follow from sums over the pieces before, so each sorted part sums its own
pieces for either beginning, and a table of one row per part gives every part its true beginning. A piece that begins with no object open is
the first one of an element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siteatlas.session import persist_reliably

_PART_SHIFT = 33  # monotonically_increasing_id = partition number << 33 | row in partition
_PLACE = ["_file", "_part"]


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _opened(text: Column) -> Column:
    """How many objects are opened in a text that begins outside of strings."""
    return _count(F.regexp_replace(text, r'"[^"]*("|$)', ""), "{")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The pieces in order, by part and id: quotes, and the change in open objects where the piece begins outside (d0) or inside (d1) of a string."""
    at = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    pieces = spark.read.option("lineSep", "}").text(path).select(F.col("value").alias("piece"), *at, F.monotonically_increasing_id().alias("_line"))
    # an escape is never cut: no JSON escape holds a }
    bare = F.regexp_replace("piece", r"(?s)\\.", "")
    quotes = _count(bare, '"')
    piece = F.col("piece")
    role = (
        F.when(piece.rlike(r"^\s*\[\s*\{"), "first")
        .when(piece.rlike(r"^\s*,\s*\{"), "next")
        .when(piece.rlike(r"^\s*\]\s*$"), "end")
        .when(piece.rlike(r"^\s*\[\s*\]\s*$"), "empty")
        .otherwise("wrong")
    )
    # the } behind the piece closes an object if the piece ends outside of strings
    pieces = pieces.withColumns(
        {
            "quotes": quotes,
            "d0": _opened(bare) - (quotes + 1) % 2,
            "d1": _opened(F.concat(F.lit('"'), bare)) - quotes % 2,
            "would_be": role,  # what the piece is if no object is open; found here, so that only one pass moves the text itself
        }
    )
    ordered = pieces.sort("_file", "_block", "_line").drop("_block", "_line").withColumn("_id", F.monotonically_increasing_id())
    return persist_reliably(ordered.withColumn("_part", F.shiftright("_id", _PART_SHIFT)))


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """(file, element): the JSON text of every object in the arrays of the files at ``path``.

    An empty file has no elements. A file that is anything else than one array of objects, or one that was cut off, raises a ``ValueError`` here,
    before an element is read; it is named in the message. The pieces are written once to the shared folder, so this starts jobs. An element is held whole by one task, a file is not.
    """
    before = Window.partitionBy(*_PLACE).orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    parts_before = Window.partitionBy("_file").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda name, over: F.coalesce(F.sum(name).over(over), F.lit(0).cast("long"))

    pieces = _pieces(spark, path).withColumn("odd", so_far("quotes", before) % 2)
    even = F.col("odd") == 0
    sums = pieces.groupBy(*_PLACE).agg(
        F.sum("quotes").alias("quotes"),
        F.sum(F.when(even, F.col("d0")).otherwise(F.col("d1"))).alias("outside"),
        F.sum(F.when(even, F.col("d1")).otherwise(F.col("d0"))).alias("inside"),
    )
    begins = sums.withColumn("part_odd", so_far("quotes", parts_before) % 2)
    begins = begins.withColumn("change", F.when(F.col("part_odd") == 0, F.col("outside")).otherwise(F.col("inside")))
    begins = persist_reliably(begins.select(*_PLACE, "part_odd", so_far("change", parts_before).alias("part_open")))

    known = pieces.join(begins, _PLACE)
    inside = (F.col("odd") + F.col("part_odd")) % 2
    known = known.withColumn("change", F.when(inside == 0, F.col("d0")).otherwise(F.col("d1"))).withColumn("inside", inside)
    known = known.withColumn("open", F.col("part_open") + so_far("change", before))
    ended = (F.col("open") + F.col("change") == 0) & ((F.col("inside") + F.col("quotes")) % 2 == 0)
    known = known.withColumn("role", F.when(F.col("open") == 0, F.col("would_be"))).withColumn("end_id", F.when(ended, F.col("_id")))

    parts = persist_reliably(
        known.groupBy(*_PLACE).agg(
            F.max("end_id").alias("end_id"),
            F.min_by("role", "_id").alias("role_first"),
            F.max_by("role", "_id").alias("role_last"),
            F.count_if(F.col("role").isin("first", "empty")).alias("begun"),
            F.count_if(F.col("role").isin("end", "empty")).alias("done"),
            F.count_if(F.col("role") == "wrong").alias("wrong"),
        )
    )
    _check(parts)

    carried = parts.select(*_PLACE, F.max("end_id").over(parts_before).alias("carried"))
    # an element goes by the piece that ended the one before it
    last_end = F.coalesce(F.max("end_id").over(before), "carried", F.lit(-1).cast("long"))
    keyed = known.join(carried, _PLACE).withColumn("after", last_end)
    keyed = keyed.filter(F.coalesce("role", F.lit("")).isin("end", "empty") == F.lit(False))
    gathered = keyed.groupBy("_file", "after").agg(F.sort_array(F.collect_list(F.struct("_id", "piece"))).alias("pieces"))
    text = F.concat(F.array_join(F.col("pieces.piece"), "}"), F.lit("}"))
    return gathered.select(F.col("_file").alias("file"), F.regexp_replace(text, r"^[\s,\[]*", "").alias("element"))


def _check(parts: DataFrame) -> None:
    """Every file begins with [, ends with ] behind the last object, and holds nothing but commas between its objects."""
    files = parts.groupBy("_file").agg(
        F.min_by("role_first", "_part").alias("role_first"), F.max_by("role_last", "_part").alias("role_last"), *[F.sum(n).alias(n) for n in ("begun", "done", "wrong")]
    )
    right = F.col("role_first").isin("first", "empty") & F.col("role_last").isin("end", "empty") & F.expr("begun = 1 AND done = 1 AND wrong = 0")
    bad = files.filter(~F.coalesce(right, F.lit(False))).select("_file").first()
    if bad:
        raise ValueError(f"{bad[0]} is not one whole JSON array of objects")


def read_array(spark: SparkSession, path: str, schema) -> DataFrame:
    """The objects of the arrays as rows of ``schema``, without an order. An object that is no JSON fails the job that reads it."""
    broken = F.raise_error(F.concat(F.lit("broken JSON object in "), "file")).cast("string")
    element = F.when(F.get_json_object("element", "$").isNull(), broken).otherwise(F.col("element"))
    return read_elements(spark, path).select(F.from_json(element, schema).alias("row")).select("row.*")
