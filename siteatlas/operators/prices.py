"""Unit prices from JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteatlas.functions import json, text
from siteatlas.schema import UNITS
from siteatlas.sources.captures import of_kind

# The stores of a payload, element by element, so that a bad one is told from its neighbours: id, and
# ``info`` as text (an empty list where missing, null where null or where the store is no object).
# An empty text or an empty object holds no unit, like an empty list.
_STORES = f"""
transform(
  transform({json.typed_field('body', 'promoInfoArr', 'ARRAY<STRING>')}, raw -> struct(raw, {json.parsed('raw', 'storeID info')} AS e)),
  x -> struct(
    CASE WHEN {json.has('x.e', 'storeID')} THEN coalesce(x.e.v.storeID, 'None') ELSE '' END AS store_id,
    CASE WHEN NOT {json.has('x.e', 'info')} THEN CASE WHEN x.e.keys IS NOT NULL THEN '[]' END
         WHEN x.e.v.info = '' THEN '[]'
         WHEN x.e.v.info = '{{}}' AND {json.type_is('try_parse_json(x.raw)', '$.info', 'OBJECT<>', False)} THEN '[]'
         ELSE x.e.v.info END AS info))"""

# A missing key and a null give the same null in a typed struct. Where one turns up that matters, and
# only there, the same list is read again as maps to tell them apart. ``transform(array(x), ...)[0]``
# names an intermediate value, so that it is made once.

# Whether a unit is available: JSON texts such as "false" or "0" are true, other than the values. Only a list that holds such a
# text is read once more, with types.
_QUOTED_FALSE = "s.info RLIKE ': *\"(false|0|0[.]0|-0[.]0|\\\\[\\\\]|[{][}])\"'"

# The units of a store, null if ``info`` is no list of objects.
_UNIT_LIST = f"""
transform(
  array(CASE WHEN s.info LIKE '[%' THEN
    {json.typed('s.info', 'ARRAY<STRUCT<name STRING, saleprice STRING, availability STRING, count STRING, '
                          'promotionName STRING, promotionName2 STRING>>')} END),
  units -> CASE
    WHEN exists(units, v -> v.name IS NULL OR v.count IS NULL) THEN zip_with(
      units,
      {json.typed('s.info', 'ARRAY<MAP<STRING, STRING>>')},
      (v, keys) -> struct(v, map_contains_key(keys, 'name') AS has_name, map_contains_key(keys, 'count') AS has_count))
    ELSE transform(units, v -> struct(v, true AS has_name, true AS has_count)) END)[0]"""

_TEXT_FLAGS = f"""
CASE WHEN {_QUOTED_FALSE} THEN transform(
  {json.typed('s.info', 'ARRAY<STRUCT<availability VARIANT>>')},
  v -> coalesce(schema_of_variant(v.availability) = 'STRING', false)) END"""

_ENTRIES = f"transform({_STORES}, s -> struct(s.store_id, {_UNIT_LIST} AS units, {_TEXT_FLAGS} AS texts))"

_USABLE = "coalesce(forall(e.units, u -> u.v IS NOT NULL), false)"

# One-element wrapper, so that the parsed entries are made once for the test and for the result.
_STRICT_ENTRIES = f"flatten(filter(array({_ENTRIES}), entries -> forall(entries, e -> {_USABLE})))"
_LENIENT_ENTRIES = f"filter({_ENTRIES}, e -> {_USABLE})"

_UNITS = f"""
transform(_entry.units, (u, i) -> struct(
  CASE WHEN u.has_name THEN u.v.name ELSE '' END AS size,
  u.v.saleprice AS price_raw,
  try_cast(u.v.saleprice AS DOUBLE) AS price,
  {json.truthy('u.v.availability')} OR (coalesce(_entry.texts[i], false) AND u.v.availability <> '') AS available,
  CASE WHEN u.has_count THEN try_cast(u.v.count AS BIGINT) ELSE 0L END AS count,
  coalesce(u.v.promotionName, '') AS promo,
  coalesce(u.v.promotionName2, '') AS promo2))"""


def price_entries(captures: DataFrame, strict_batch: bool = True) -> DataFrame:
    """One row per store of every price payload: capture_id, fetched_at, page_rank, pos, store_id, units.

    A payload is one row, so ``strict_batch`` (one unusable store voids the whole payload) is decided
    inside the row, before anything is exploded or shuffled.
    """
    entries = _STRICT_ENTRIES if strict_batch else _LENIENT_ENTRIES
    # Outer: otherwise the optimizer tests "not empty" with a second parse in front of the explode.
    return (
        of_kind(captures, "price")
        .selectExpr("capture_id", "fetched_at", "page_rank", f"posexplode_outer({entries}) AS (pos, _entry)")
        .filter("_entry IS NOT NULL")
        .selectExpr("capture_id", "fetched_at", "page_rank", "pos", "_entry.store_id", f"{_UNITS} AS units")
    )


# A later run, then a later payload of the run, then a later place in it. Payload ranks start anew in every run.
_NEWEST = ("fetched_at", "page_rank", "capture_id", "pos")


def last_wins(entries: DataFrame, *fields: str) -> DataFrame:
    """The newest entry of every store."""
    return (
        entries.groupBy("store_id")
        .agg(F.max_by(F.struct(*fields), F.struct(*_NEWEST)).alias("_last"))
        .select("store_id", "_last.*")
    )


def price_units(captures: DataFrame, strict_batch: bool = True) -> DataFrame:
    """(store_id, units): the current unit list of every store that has a usable response."""
    return last_wins(price_entries(captures, strict_batch), "units")


def price_summary(captures: DataFrame, strict_batch: bool = True) -> DataFrame:
    """(store_id, summary) for the location reports.

    Unit lists are reduced where they were parsed; four scalars per store are shuffled instead.
    """
    entries = price_entries(captures, strict_batch)
    return last_wins(entries.withColumn("summary", unit_summary()), "summary")


def unit_summary(units: str = "units") -> Column:
    """Cheapest available unit (the first of equals), units available, and length of a unit list.

    A unit is available at a price only: a price of zero or null does not count. Prices compare as
    numbers; a price that is none comes last.
    """
    available = f"filter({units}, u -> u.available AND {json.truthy('u.price_raw')})"
    cheapest = f"""array_min(transform({available}, (u, i) -> struct(
        u.price IS NULL AS no_number, u.price, i, u.size, u.price_raw)))"""
    total = f"aggregate({available}, 0L, (total, u) -> total + coalesce(u.count, 0L))"
    return F.expr(
        f"""struct(
            {cheapest}.size AS cheapest_size,
            {cheapest}.price_raw AS cheapest_price_raw,
            coalesce({total}, 0L) AS units_available,
            CAST(coalesce(size({units}), 0) AS BIGINT) AS n_units)"""
    )


def attach_units(stores: DataFrame, prices: DataFrame) -> DataFrame:
    """Every store with its units, or with none; prices of unknown stores are ignored."""
    joined = stores.drop("units").join(prices.select("store_id", "units"), "store_id", "left")
    return joined.withColumn("units", F.coalesce("units", F.array().cast(UNITS)))


def attach_newest_units(stores: DataFrame, entries: DataFrame) -> DataFrame:
    """As ``attach_units`` with ``last_wins``, for few stores (each once): entries meet them before they are reduced.

    Unit lists of other stores are dropped by the join, and a short list of stores is sent to the entries by Spark's own size check.
    """
    fields = [c for c in stores.columns if c not in ("store_id", "units")]
    joined = stores.drop("units").join(entries.select("store_id", *[F.col(c).alias(f"_{c}") for c in _NEWEST], "units"), "store_id", "left")
    newest = F.max_by("units", F.struct(*[f"_{c}" for c in _NEWEST]))
    priced = joined.groupBy("store_id").agg(F.first(F.struct(*fields)).alias("_store"), newest.alias("units"))
    return priced.select("store_id", "_store.*", F.coalesce("units", F.array().cast(UNITS)).alias("units"))


def attach_summary(stores: DataFrame, summaries: DataFrame) -> DataFrame:
    return stores.drop("summary").join(summaries.select("store_id", "summary"), "store_id", "left")


def with_pricing(stores: DataFrame) -> DataFrame:
    return stores.filter(text.truthy_array(F.col("units")))


def responses_per_payload(captures: DataFrame) -> DataFrame:
    """Distinct stores answered by each payload; 0 for a void or failed one. No shuffle."""
    answered = f"size(array_distinct(transform({_STRICT_ENTRIES}, e -> e.store_id)))"
    return of_kind(captures, "price", strict=False).selectExpr(
        "capture_id",
        f"CAST(CASE WHEN status < 400 THEN coalesce({answered}, 0) ELSE 0 END AS BIGINT) AS n_responses",
    )
