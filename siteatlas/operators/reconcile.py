"""Duplicates and differences between sources and the known catalog.

All "first" and "last" rules are aggregates with map-side combine, not windows: copies of one store
collapse in the tasks that read them, so a store that makes up a third of the rows is no hot spot.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteatlas.schema import ORDER_FIELDS, STORE_FIELDS


def union_all(*parts: DataFrame) -> DataFrame:
    """All rows of all parts; columns a part lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def first_wins(stores: DataFrame) -> DataFrame:
    """Each store once, as first discovered."""
    fields = [c for c in stores.columns if c != "store_id"]
    return (
        stores.groupBy("store_id")
        .agg(F.min_by(F.struct(*fields), F.struct(*ORDER_FIELDS)).alias("_first"))
        .select("store_id", "_first.*")
    )


def first_page_wins(stores: DataFrame) -> DataFrame:
    """Each store from the first page that lists it; repeats on that page all stay.

    The inner group is bounded by one page, as only its latest capture counts; the outer one keeps a single such group per store.
    """
    page = ("page_rank", "page_url")
    fields = [c for c in stores.columns if c not in ("store_id", *page)]
    return (
        stores.groupBy("store_id", *page)
        .agg(F.collect_list(F.struct(*fields)).alias("_rows"))
        .groupBy("store_id")
        .agg(F.min_by(F.struct(*page, "_rows"), F.struct(*page)).alias("_first"))
        .select("store_id", "_first.page_rank", "_first.page_url", F.inline("_first._rows"))
    )


def not_known(stores: DataFrame, known: DataFrame) -> DataFrame:
    """Stores whose id is not in the known catalog.

    The known ids are made distinct first: on the same key as the join, so at no extra shuffle, and a
    much repeated id cannot pile up in one task.
    """
    return stores.join(known.select("store_id").distinct(), "store_id", "left_anti")


def not_known_few(stores: DataFrame, known: DataFrame) -> DataFrame:
    """As ``not_known``, for few stores and a large catalog: the catalog is reduced to the candidates' ids first.

    A short list of candidates is sent to the catalog's scan (by Spark's own size check) instead of shuffling the catalog.
    """
    hits = known.select("store_id").join(stores.select("store_id"), "store_id", "left_semi")
    return not_known(stores, hits)


def append_new(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Catalog plus new stores; the existing rows are kept as they are, repeats included."""
    names = [c for c in (*STORE_FIELDS, "units") if c in existing.columns or c in new.columns]
    return union_all(existing, new).select(*names)
