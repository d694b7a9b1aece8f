"""Mixing sources to target weights with hash-threshold histograms.

Every document has a hash; a source's mix is a number of whole passes over it plus the documents whose hash is below
the source's threshold. The threshold is found from sums of sizes by source and hash bucket: the bucket in which the budget
ends is refined by the next bits of the hash, the others are settled. Documents are never sorted and only sums by
(source, bucket) are shuffled, so neither a large source nor a large table reaches one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteatlas.llm import words
from siteatlas.session import persist_reliably

BITS = 12  # of the hash, for each histogram
LEVELS = 5
BROADCAST_BYTES = 8 << 20  # a table of sources up to this size is sent to all tasks


@F.arrow_udf(T.LongType())
def word_count(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Words between ASCII white space; 0 for null."""
    for array in texts:
        counts = [np.diff(batch.words(words.NOT_SPACE)[2]) for batch in words.batches(array, rows=1 << 20)]
        yield pa.array(np.concatenate([np.empty(0, np.int64), *counts]), pa.int64())


def document_hash(id_col: Column, seed: str) -> Column:
    """60 bits that depend on the id and the seed alone; rows without an id share the hash of an empty one."""
    key = F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(seed))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, share: float, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """Targets of the sources. sizes: (source, source_size), one row each.

    Weights go to the sources in code point order, null last. A target is the smaller of ``max_epochs`` times the source and
    its weight times the one level at which all targets add up to ``share`` of everything. The window here
    is over one row per source, not over documents.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_epochs)
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = F.coalesce(F.sum("cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    s = s.withColumn("level", (F.sum("source_size").over(everything) * F.lit(float(share)) - before) / rest)
    s = s.withColumn("target", F.least(F.col("cap").cast("double"), F.max("level").over(everything) * F.col("weight")))
    return s.select("source", "source_size", "target")


def _sent(sources: DataFrame) -> DataFrame:
    """A table with one row per source, to be broadcast if its size allows; beyond that Spark joins by a shuffle and splits hot sources."""
    size = sources.agg(F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + 100)).first()[0] or 0
    return F.broadcast(sources) if size <= BROADCAST_BYTES else sources


def _thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: ``passes`` over all of it, then documents with a hash below ``bound`` (or at it, if ``at_bound``)."""
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    s = targets.withColumn("passes", full.cast("long"))
    s = s.withColumn("budget", F.col("target") - F.col("passes") * F.col("source_size"))
    edge = s.filter("budget > 0").select("source", "budget", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"))
    width = BITS * LEVELS
    for level in range(1, LEVELS + 1):
        width -= BITS
        # only rows in the bucket where the budget ends go on
        r, e = rows.alias("r"), _sent(edge).alias("e")
        inside = F.col("r.source").eqNullSafe(F.col("e.source")) & (F.shiftright("r.hash", width + BITS) == F.col("e.prefix"))
        sums = (
            r.join(e, inside)
            .groupBy("e.source", "e.budget", "e.below", F.shiftright("r.hash", width).alias("bucket"))
            .agg(F.sum("r.size").alias("size"))
        )
        upto = Window.partitionBy("source").orderBy("bucket")
        sums = sums.withColumn("upto", F.col("below") + F.sum("size").over(upto))
        ending = sums.filter("upto >= budget").groupBy("source", "budget").agg(F.min(F.struct("bucket", "upto", "size")).alias("b"))
        edge = ending.select("source", "budget", F.col("b.bucket").alias("prefix"), (F.col("b.upto") - F.col("b.size")).alias("below"), F.col("b.upto").alias("upto"))
        edge = persist_reliably(edge)
    nearer = F.col("upto") - F.col("budget") <= F.col("budget") - F.col("below")
    edge = edge.select(F.col("source").alias("edge_source"), F.col("prefix").alias("bound"), nearer.alias("at_bound"))
    out = s.join(edge, F.col("source").eqNullSafe(F.col("edge_source")), "left")
    return persist_reliably(out.select("source", "source_size", "target", "passes", "bound", "at_bound"))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str, *columns: str) -> DataFrame:
    return docs.select(
        *columns,
        F.col(id_col).alias("__id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col).cast("string")).alias("size"),
        document_hash(F.col(id_col), seed).alias("hash"),
    )


def _copied(rows: DataFrame, limits: DataFrame) -> DataFrame:
    limits = _sent(limits).withColumnRenamed("source", "of")
    extra = (F.col("hash") < F.col("bound")) | ((F.col("hash") == F.col("bound")) & F.col("at_bound"))
    out = rows.join(limits, F.col("source").eqNullSafe(F.col("of")), "left")
    return out.withColumn("copies", F.col("passes") + F.when(extra, 1).otherwise(0)).withColumn("taken", F.col("copies") * F.col("size"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    share: float = 1.5,
    weights: Sequence[int] = (3, 1, 2),
    max_epochs: int = 2,
    seed: str = "",
    prefix: str | None = None,
) -> DataFrame:
    """(id_col, source_col, size, source_size, target, copies, taken), one row per row of ``docs``.

    ``copies`` says how often the mix has the document, ``taken`` is copies times size. Sources that may take
    more than ``max_epochs`` of themselves stop there, and the rest is shared by weight again. A source's sum differs
    from its target by at most half of one document. Null texts have size 0; a null source is a source. Repeated ids
    have one hash and are taken together. The result depends on ids, sizes and the seed only. Extra columns are not read.
    With a ``prefix`` the result is all of ``docs`` with columns of these names behind the prefix.
    """
    words.bound_arrow_batches(docs.sparkSession)
    rows = persist_reliably(_sized(docs, id_col, text_col, source_col, seed))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    limits = _thresholds(rows, persist_reliably(source_targets(sizes, share, weights, max_epochs)))
    if prefix is None:
        out = _copied(rows, limits)
        return out.select(F.col("__id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "copies", "taken")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), *docs.columns)
    out = _copied(_sized(whole, id_col, text_col, source_col, seed, "__doc"), limits)
    return out.select("__doc.*", *[F.col(c).alias(prefix + c) for c in ("size", "source_size", "target", "copies", "taken")])


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::INT] AS weight FROM d GROUP BY source),
l AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE - coalesce(sum(2 * source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s WINDOW f AS (ORDER BY 2 * source_size / weight::DOUBLE, source IS NULL, encode(source))),
t AS (SELECT source, source_size, least((2 * source_size)::DOUBLE, max(level) OVER () * weight) AS target FROM l),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes,
    target - passes * source_size AS budget FROM t),
c AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.passes, b.budget,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.hash) AS upto,
    sum(d.size) OVER (PARTITION BY d.source, d.hash) AS here
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, (size * (passes + CASE
  WHEN budget <= 0 THEN 0 WHEN upto < budget THEN 1 WHEN upto - here >= budget THEN 0
  WHEN upto - budget <= budget - (upto - here) THEN 1 ELSE 0 END))::BIGINT AS taken FROM c
"""
