"""Schemas of the tables that flow through the library."""

from __future__ import annotations

from pyspark.sql import types as T

# One row per fetched document. ``kind`` is index | sitemap | search | facility | price and is the
# natural partition column of the table. ``page_rank`` is the send order of price payloads; the rank
# of index-linked and seed pages is derived from the state-page and seed tables instead.
CAPTURES = T.StructType(
    [
        T.StructField("capture_id", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("body", T.StringType()),
        T.StructField("page_rank", T.LongType()),
        T.StructField("fetched_at", T.TimestampType()),
    ]
)

UNIT = T.StructType(
    [
        T.StructField("size", T.StringType()),
        T.StructField("price_raw", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("available", T.BooleanType()),
        T.StructField("count", T.LongType()),
        T.StructField("promo", T.StringType()),
        T.StructField("promo2", T.StringType()),
    ]
)
UNITS = T.ArrayType(UNIT)

STORE_FIELDS = (
    "store_id",
    "site_number",
    "address",
    "city",
    "state",
    "zip",
    "phone",
    "lat",
    "lng",
    "url",
)
STORES = T.StructType(
    [T.StructField(name, T.StringType()) for name in STORE_FIELDS] + [T.StructField("units", UNITS)]
)

# The columns that define discovery order: source, page inside the source, place on the page. Search pages go by the rank of
# their seed; state pages share a rank and go by their url.
ORDER_FIELDS = ("source_rank", "page_rank", "page_url", "pos")

SEEDS = T.StructType(
    [T.StructField("seed_rank", T.LongType()), T.StructField("zip", T.StringType())]
)

REJECTS = T.StructType(
    [
        T.StructField("capture_id", T.LongType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("reason", T.StringType()),
        T.StructField("raw", T.StringType()),
    ]
)
