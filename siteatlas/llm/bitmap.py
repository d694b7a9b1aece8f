"""A bitmap of fixed size over 64-bit hashes: one Bloom filter slice that tasks can look up.

Its size is a parameter, not a matter of the data: more members only mean more false positives, which every
user removes later with an exact join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def build(rows: DataFrame, value: Column, log2_bits: int = 24) -> np.ndarray:
    """The bits of all values (64-bit hashes, spread evenly), as 2^(log2_bits - 6) words."""
    bit = F.shiftrightunsigned(value, 64 - log2_bits)
    words = (
        rows.select(F.shiftright(bit, 6).alias("word"), F.expr("shiftleft(1L, 0)").alias("one"), bit.alias("bit"))
        .select("word", F.call_function("shiftleft", "one", (F.col("bit") % 64).cast("int")).alias("bits"))
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (log2_bits - 6), np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def contains(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    bit = values >> np.uint64(64 - (len(bitmap).bit_length() - 1 + 6))
    return (bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def test(spark: SparkSession, bitmap: np.ndarray, values: Column) -> Column:
    """Whether a column of 64-bit hashes may be among the bitmap's members. Only this column goes to Python."""
    sent = spark.sparkContext.broadcast(bitmap)

    @F.arrow_udf(T.BooleanType())
    def tested(column: pa.Array) -> pa.Array:
        return pa.array(contains(sent.value, column.to_numpy(zero_copy_only=False).view(np.uint64)))

    return tested(values)
