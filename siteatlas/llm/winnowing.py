"""Benchmark decontamination by winnowing.

Of the k-gram hashes in every run of ``window`` words the smallest is kept, on both sides. A window shared by a document and an
item has the same words, hence the same smallest k-gram, so the join of the kept fingerprints meets every shared window;
each meeting is then extended word by word to both sides. Items shorter than a window are one fingerprint of all their words.

Documents send only fingerprints that pass a bitmap of fixed size over the items' fingerprints. What they send holds the
words around the fingerprint, so texts are read once and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteatlas.llm import bitmap, words
from siteatlas.session import persist_reliably

BITMAP_BITS = 24


def _winnow(hashes: np.ndarray, bounds: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the kept k-grams, and all k-gram hashes."""
    g = words.grams(hashes, k)
    n = len(hashes) - window + 1
    if n <= 0:
        return np.empty(0, np.int64), g
    doc = words.owner(bounds)
    inside = doc[:n] == doc[window - 1 :]
    span = window - k + 1
    least = g[:n].copy()
    for j in range(1, span):
        np.minimum(least, g[j : j + n], out=least)
    kept = np.zeros(len(g), bool)
    for j in reversed(range(span)):  # the last of equal ones
        hit = inside & (g[j : j + n] == least)
        kept[j : j + n] |= hit
        inside &= ~hit
    return np.flatnonzero(kept), g


def _around(hashes: np.ndarray, bounds: np.ndarray, at: np.ndarray, k: int, side: int) -> np.ndarray:
    """For each position the words from ``side`` before to ``side`` behind its k-gram; 0 outside the text."""
    if not len(at):
        return np.empty((0, k + 2 * side), np.uint64)
    doc = words.owner(bounds)[at]
    index = at[:, None] + np.arange(-side, k + side)
    inside = (index >= bounds[doc][:, None]) & (index < bounds[doc + 1][:, None])
    return np.where(inside, hashes[np.clip(index, 0, len(hashes) - 1)] | np.uint64(1), 0)


def _packed(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * 8
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _short(hashes, bounds, m):
    """(hash, position) of all m-grams."""
    g = words.grams(hashes, m)
    doc = words.owner(bounds)
    at = np.flatnonzero(doc[: len(g)] == doc[m - 1 :]) if len(g) else np.empty(0, np.int64)
    return words.mix(g[at] + np.uint64(m)), at


def _item_prints(k: int, window: int):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in words.batches(batch.column(1), rows=1 << 16):
                hashes, bounds = texts.word_hashes(words.ALNUM)
                ids = batch.column(0).slice(texts.first, texts.n)
                doc, count = words.owner(bounds), np.diff(bounds)
                at, g = _winnow(hashes, bounds, k, window)
                yield pa.record_batch(
                    [ids.take(pa.array(doc[at])), g[at].view(np.int64), np.zeros(len(at), np.int32), _packed(_around(hashes, bounds, at, k, window - k))],
                    names=["item", "fp", "m", "around"],
                )
                for m in range(1, window):
                    fp, at = _short(hashes, bounds, m)
                    whole = (count == m)[doc[at]]
                    at, fp = at[whole], fp[whole]
                    yield pa.record_batch(
                        [ids.take(pa.array(doc[at])), fp.view(np.int64), np.full(len(at), m, np.int32), _packed(np.zeros((len(at), 0), np.uint64))],
                        names=["item", "fp", "m", "around"],
                    )

    return over, "item string, fp long, m int, around binary"


def _document_prints(k: int, window: int, sizes: list[int], bits):
    kind = pa.list_(pa.struct([("fp", pa.int64()), ("m", pa.int32()), ("at", pa.int32()), ("around", pa.binary())]))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in words.batches(batch.column(1), rows=1 << 16):
                hashes, bounds = texts.word_hashes(words.ALNUM)
                doc = words.owner(bounds)
                at, g = _winnow(hashes, bounds, k, window)
                at = at[bitmap.contains(bits.value, g[at])]
                found = [(g[at], np.zeros(len(at), np.int32), at, _around(hashes, bounds, at, k, window - k))]
                for m in sizes:
                    fp, at = _short(hashes, bounds, m)
                    hit = bitmap.contains(bits.value, fp)
                    fp, at = fp[hit], at[hit]
                    found.append((fp, np.full(len(at), m, np.int32), at, np.zeros((len(at), 0), np.uint64)))
                fp, m, at = (np.concatenate([f[i] for f in found]) for i in range(3))
                around = pa.concat_arrays([_packed(f[3]) for f in found])
                order = np.argsort(at, kind="stable")
                fp, m, at, around = fp[order], m[order], at[order], around.take(pa.array(order))
                offsets = np.searchsorted(at, bounds)
                values = pa.StructArray.from_arrays(
                    [pa.array(fp.view(np.int64)), pa.array(m), pa.array((at - bounds[doc[at]]).astype(np.int32)), around], fields=list(kind.value_type)
                )
                yield pa.record_batch(
                    [batch.column(0).slice(texts.first, texts.n), np.diff(bounds), pa.ListArray.from_arrays(offsets.astype(np.int32), values)],
                    names=["id", "n_words", "found"],
                )

    return over, "id long, n_words long, found array<struct<fp:bigint,m:int,at:int,around:binary>>"


def _extended(k: int, window: int):
    """Meetings as (row, item, first word, end); those shorter than a window are none."""
    side = window - k

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.column(1).to_numpy()
            at = batch.column(2).to_numpy().astype(np.int64)
            low, high = at.copy(), at + m
            ours, theirs = batch.column(3), batch.column(4)
            long = np.flatnonzero(m == 0)
            if len(long):
                def grid(column):
                    data = words.buffer_of(column.take(pa.array(long))).data
                    return np.frombuffer(data.tobytes(), np.uint64).reshape(len(long), k + 2 * side)

                a, b = grid(ours), grid(theirs)
                same = (a == b) & (a != 0)
                left = np.cumprod(same[:, side - 1 :: -1], axis=1).sum(axis=1) if side else 0
                right = np.cumprod(same[:, side + k :], axis=1).sum(axis=1)
                middle = same[:, side : side + k].all(axis=1)
                low[long] = at[long] - left
                high[long] = np.where(middle & (left + k + right >= window), at[long] + k + right, low[long])
            hit = np.flatnonzero(high > low)
            take = pa.array(hit)
            yield pa.record_batch([batch.column(0).take(take), low[hit], high[hit], batch.column(5).take(take)], names=["row", "low", "high", "items"])

    return over, "row long, low long, high long, items array<string>"


def find(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    k: int = 5,
    window: int = 10,
) -> DataFrame:
    """(id_col, n_words, spans, items, n_items), one row per row of ``docs``.

    ``spans`` are the maximal runs [low, high) of words inside occurrences of item windows (``window`` consecutive words,
    or all words of a shorter item), ``items`` the sorted distinct ids, as strings, of items with an occurring window.
    Items without an id count like others for ``spans`` and together as one for ``n_items``; in ``items`` they have no entry. A-Z are
    folded, words are ASCII letters, digits and non-ASCII characters. Null and empty texts have no words; items without
    words occur nowhere; rows with null or repeated ids are judged each by its own text.
    """
    spark = docs.sparkSession
    words.bound_arrow_batches(spark)
    prints = items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    prints = prints.mapInArrow(*_item_prints(k, window))
    unnamed = F.when(F.bool_or(F.col("item").isNull()), F.expr("array(CAST(NULL AS string))")).otherwise(F.expr("CAST(array() AS array<string>)"))
    prints = persist_reliably(prints.groupBy("fp", "m", "around").agg(F.concat(F.collect_set("item"), unnamed).alias("items")))
    sizes = sorted(row["m"] for row in prints.select("m").distinct().collect() if row["m"])  # fewer than `window` values
    bits = spark.sparkContext.broadcast(bitmap.build(prints, F.col("fp"), BITMAP_BITS))

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.mapInArrow(*_document_prints(k, window, sizes, bits))
    rows = persist_reliably(rows.withColumn("row", F.monotonically_increasing_id()))
    found = rows.filter("size(found) > 0").select("row", F.inline("found"))
    met = found.join(prints.withColumnRenamed("around", "theirs"), ["fp", "m"])
    met = met.select("row", "m", "at", "around", "theirs", "items").mapInArrow(*_extended(k, window))
    met = persist_reliably(met)
    spans = met.select("row", "low", "high").distinct().groupBy("row").agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("spans"))
    of = met.select("row", F.explode("items").alias("item")).distinct().groupBy("row")
    of = of.agg(F.sort_array(F.collect_list("item")).alias("items"), F.count("*").alias("n_items"))  # lists leave the null out
    empty = "CAST(array() AS array<struct<low:bigint,high:bigint>>)"
    merged = F.expr(
        f"""aggregate(spans, {empty}, (done, s) -> CASE
            WHEN size(done) > 0 AND element_at(done, -1).high >= s.low THEN concat(slice(done, 1, size(done) - 1),
              array(named_struct('low', element_at(done, -1).low, 'high', greatest(element_at(done, -1).high, s.high))))
            ELSE concat(done, array(s)) END)"""
    )
    out = rows.select("row", "id", "n_words").join(spans.select("row", merged.alias("spans")), "row", "left").join(of, "row", "left")
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("spans", F.expr(empty)).alias("spans"),
        F.coalesce("items", F.expr("CAST(array() AS array<string>)")).alias("items"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
    )


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and a digest of what ``find`` returned."""
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.high - s.low)")
    return found.select(
        id_col,
        "n_words",
        n_hit.alias("n_hit"),
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
i AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS m, array_to_string(ws[p:p + least(len(ws), 10) - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS p FROM i WHERE len(ws) > 0)),
dw AS (
  SELECT doc_id, m, p, array_to_string(ws[p:p + m - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(ws) - m + 2)) AS p FROM d CROSS JOIN (SELECT DISTINCT m FROM iw) WHERE len(ws) >= m)),
h AS (SELECT doc_id, p, m, item_id FROM dw JOIN iw USING (m, g)),
n AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(p, p + m)) AS at FROM h) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
  sha256(coalesce(t.items, '')) AS items_sha256, n.n IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""
