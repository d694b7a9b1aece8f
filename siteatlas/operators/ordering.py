"""Global order without a global task: dense positions, running totals, fixed-size batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteatlas.functions import text
from siteatlas.schema import ORDER_FIELDS
from siteatlas.session import persist_reliably
from siteatlas.spec import ID_SEPARATOR, SiteSpec

_PARTITION_SHIFT = 33  # monotonically_increasing_id = partition number << 33 | row in partition


def running_total(df: DataFrame, order_by: list[str], value: Column, name: str) -> DataFrame:
    """Add the inclusive running sum of ``value`` along ``order_by`` (which must be unique).

    A range-partitioned sort puts the rows in order; each partition then only needs the total of the
    partitions before it, a table with one row per partition. The sorted rows are written once, so
    both uses see the same partitions.
    """
    ordered = persist_reliably(
        df.withColumn("_value", value.cast("long"))
        .sort(*order_by)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", _PARTITION_SHIFT))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy("_part")
        .agg(F.sum("_value").alias("_sum"))
        .select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)
    # offsets holds at most one row per shuffle partition, so broadcasting it is bounded.
    return (
        ordered.withColumn("_inside", F.sum("_value").over(inside))
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_inside") + F.col("_offset"))
        .drop("_part", "_id", "_value", "_inside", "_offset")
    )


def dense_index(df: DataFrame, order_by: list[str], name: str) -> DataFrame:
    """Add the 0-based position along ``order_by`` (which must be unique).

    As ``running_total``, but the place inside a partition is already known from the row id, so
    nothing is shuffled after the sort.
    """
    ordered = persist_reliably(
        df.sort(*order_by)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", _PARTITION_SHIFT))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    place = F.col("_id") - F.shiftleft("_part", _PARTITION_SHIFT)
    return (
        ordered.join(F.broadcast(offsets), "_part")
        .withColumn(name, place + F.col("_offset"))
        .drop("_part", "_id", "_offset")
    )


def in_discovery_order(stores: DataFrame) -> DataFrame:
    """Sort for output only; every other operator carries the order columns instead."""
    return stores.orderBy(*ORDER_FIELDS)


def id_batches(stores: DataFrame, spec: SiteSpec) -> DataFrame:
    """Store ids in discovery order, ``spec.batch_size`` to a price request.

    Returns (batch_no, n_ids, url). A group never holds more than one batch.
    """
    indexed = dense_index(stores.select("store_id", *ORDER_FIELDS), list(ORDER_FIELDS), "idx")
    batch = F.expr(f"idx div {int(spec.batch_size)}").alias("batch_no")
    ids = F.transform(
        F.array_sort(F.collect_list(F.struct("idx", "store_id"))), lambda row: row["store_id"]
    )
    return (
        indexed.groupBy(batch)
        .agg(ids.alias("ids"))
        .select(
            "batch_no",
            F.size("ids").alias("n_ids"),
            text.fill_template(
                spec.price_template, F.concat_ws(ID_SEPARATOR, "ids")
            ).alias("url"),
        )
    )
