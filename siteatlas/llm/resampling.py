"""Quality by importance resampling.

Two generative models over hashed word n-grams, one of the target texts and one of all raw texts, give every document the
logarithm of its importance weight, the sum over its n-grams of log p_target - log p_raw. Adding a Gumbel variable, drawn from a hash of the id,
and taking the k largest samples k documents without replacement in proportion to the weights.

The models are tables of ``BUCKETS`` counts, whatever the data; the k-th largest key is found by counting keys in ever finer
ranges, so documents are never sorted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteatlas.llm import bitmap, words
from siteatlas.session import persist_reliably

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
ORDERS = (1, 2)  # words in an n-gram
FRACTION = 0.5  # of the documents that is sampled
_SLICES = 16
_STEP = 12  # bits of the key settled by one count


def _buckets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, buckets, owner, number of texts) of all n-grams of runs of texts."""
    for batch in words.batches(texts, rows=1 << 14):
        hashes, bounds = batch.word_hashes(words.NOT_SPACE)
        doc = words.owner(bounds)
        bucket, of = [], []
        for k in ORDERS:
            g = words.grams(hashes, k)
            inside = doc[: len(g)] == doc[k - 1 :] if len(g) else np.empty(0, bool)
            bucket.append((g[inside] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
            of.append(doc[: len(g)][inside])
        yield batch.first, np.concatenate(bucket), np.concatenate(of), batch.n


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, bucket, _, _ in _buckets(batch.column(0)):
            counts += np.bincount(bucket, minlength=BUCKETS)
    if counts.any():
        yield pa.record_batch([pa.array(range(_SLICES), pa.int32()), pa.array([p.tobytes() for p in np.split(counts, _SLICES)], pa.binary())], names=["slice", "counts"])


def _summed(table: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(x, np.int64) for x in table["counts"].to_pylist()], axis=0)
    return pa.table({"slice": table["slice"].slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Counts of all n-grams of a one-column frame of texts."""
    parts = texts.mapInArrow(_counted, "slice int, counts binary").groupBy("slice").applyInArrow(_summed, "slice int, counts binary")
    counts, step = np.zeros(BUCKETS, np.int64), BUCKETS // _SLICES
    for row in parts.toArrow().to_pylist():
        counts[row["slice"] * step : (row["slice"] + 1) * step] = np.frombuffer(row["counts"], np.int64)
    return counts


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log p_target - log p_raw of every bucket, each count plus one."""
    return np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))


def _scored(ratio):
    @F.arrow_udf("struct<n_grams:bigint,log_weight:double>")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in texts:
            n, weight = np.zeros(len(array), np.int64), np.zeros(len(array))
            for first, bucket, of, rows in _buckets(array):
                n[first : first + rows] = np.bincount(of, minlength=rows)
                weight[first : first + rows] = np.bincount(of, ratio.value[bucket], minlength=rows)
            yield pa.StructArray.from_arrays([pa.array(n), pa.array(weight)], names=["n_grams", "log_weight"])

    return scored


def gumbel(id_col: Column, seed: int) -> Column:
    """A standard Gumbel variable from the id and the seed."""
    unit = (F.shiftrightunsigned(F.xxhash64(id_col, F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(unit))


@F.arrow_udf(T.LongType())
def _ordered(values: pa.Array) -> pa.Array:
    """Longs in the order of the doubles."""
    bits = (values.to_numpy(zero_copy_only=False) + 0.0).view(np.int64)
    return pa.array(np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits))


def kth_largest(keys: DataFrame, k: int) -> int | None:
    """The k-th largest value of a long column, by counts in ranges that shrink 2^12 times with every job; None if there are fewer."""
    low, width = -(1 << 63), 64  # the value lies in the 2^width from low
    while width:
        shift = max(0, width - _STEP)
        inside = keys.toDF("key").filter((F.col("key") >= low) & (F.col("key") <= low + (1 << width) - 1))
        rows = inside.groupBy(F.shiftright("key", shift).alias("range")).agg(F.count("*").alias("n")).collect()  # at most 2^12 rows
        for row in sorted(rows, key=lambda r: -r["range"]):
            if row["n"] >= k:
                low = row["range"] << shift
                break
            k -= row["n"]
        else:
            return None
        width = shift
    return low


def resample(
    docs: DataFrame,
    target_ids: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    fraction: float = FRACTION,
    seed: int = 17,
) -> DataFrame:
    """(id_col, n_grams, log_weight, sample_key, selected), one row per row of ``docs``.

    ``target_ids`` has one column, the ids of documents whose texts are the target. ``selected`` holds for the ``fraction`` of all rows (rounded up) with the
    largest keys, and for rows that tie with the last of them, such as repeated rows. Null and empty texts have weight 0 (a
    ratio of 1). Null ids share one random draw and are never targets. Without targets the target model is even.
    """
    spark = docs.sparkSession
    words.bound_arrow_batches(spark)
    ids = target_ids.toDF("id").select(F.col("id").cast("long").alias("id")).filter("id is not null").distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    raw = bucket_counts(texts.select("text"))
    # only texts that may be targets are joined
    maybe = bitmap.test(spark, bitmap.build(ids, F.xxhash64("id"), 22), F.xxhash64("id"))
    targets = texts.filter("id is not null").filter(maybe).join(ids, "id", "left_semi").select("text")
    ratio = spark.sparkContext.broadcast(log_ratio(bucket_counts(targets), raw))
    rows = texts.select("id", _scored(ratio)("text").alias("s")).select("id", "s.*")
    rows = rows.withColumn("sample_key", F.col("log_weight") + gumbel(F.col("id"), seed))
    rows = persist_reliably(rows.withColumn("ordered", _ordered("sample_key")))
    wanted = -(-rows.count() * int(round(fraction * 1000)) // 1000)
    least = kth_largest(rows.select("ordered"), wanted) if wanted else None
    selected = F.lit(False) if least is None else F.col("ordered") >= least
    return rows.select(F.col("id").alias(id_col), "n_grams", "log_weight", "sample_key", selected.alias("selected"))
