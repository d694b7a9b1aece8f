"""First- and last-wins rules, differences and global order against brute force."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siteatlas.operators import links, ordering, prices, reconcile, reports
from siteatlas.sources import seeds

SCHEMA = "store_id string, address string, source_rank int, page_rank long, page_url string, pos int"
PLACE = ("source_rank", "page_rank", "page_url", "pos")


def sightings(n, ids, seed, hot=None):
    """Random sightings in unique places; a third belong to one store if ``hot``."""
    rng = random.Random(seed)
    places = rng.sample([(s, p // 2, f"u{p}", i) for s in (0, 1) for p in range(12) for i in range(40)], n)
    rows = []
    for j, place in enumerate(places):
        store = hot if hot and j % 3 == 0 else str(rng.randrange(ids))
        rows.append((store, f"a{j}", *place))
    return rows


def order(row):
    return row[2:]


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_first_wins(spark, partitions):
    rows = sightings(600, 90, 1, hot="hot")
    best = {}
    for row in sorted(rows, key=order):
        best.setdefault(row[0], row)
    found = reconcile.first_wins(spark.createDataFrame(rows, SCHEMA).repartition(partitions))
    assert sorted(map(tuple, found.select("store_id", "address", *PLACE).collect())) == sorted(best.values())


@pytest.mark.parametrize("partitions", [1, 5])
def test_first_page_wins_keeps_repeats_on_that_page(spark, partitions):
    rows = [r for r in sightings(500, 25, 2, hot="hot") if r[2] == 0]
    seen, kept = set(), []
    for page in sorted({r[3:5] for r in rows}):
        new = [r for r in rows if r[3:5] == page and r[0] not in seen]
        seen |= {r[0] for r in new}
        kept += new
    found = reconcile.first_page_wins(spark.createDataFrame(rows, SCHEMA).repartition(partitions))
    assert sorted(map(tuple, found.select("store_id", "address", *PLACE).collect())) == sorted(kept)
    assert len(kept) > len({r[0] for r in kept})


def test_not_known_and_append(spark):
    rows = sightings(300, 50, 3, hot="hot")
    known = spark.createDataFrame([("hot", "k")] * 200 + [(str(i), "k") for i in range(0, 50, 2)], "store_id string, address string")
    found = reconcile.first_wins(spark.createDataFrame(rows, SCHEMA))
    new = reconcile.not_known(found, known)
    assert sorted(map(tuple, reconcile.not_known_few(found, known).collect())) == sorted(map(tuple, new.collect()))
    assert {r.store_id for r in new.collect()} == {r[0] for r in rows} - {"hot", *map(str, range(0, 50, 2))}
    merged = reconcile.append_new(known, new)
    assert merged.columns == ["store_id", "address"]
    assert merged.count() == known.count() + new.count()
    nothing = reconcile.append_new(known, new.limit(0))
    assert sorted(map(tuple, nothing.collect())) == sorted(map(tuple, known.collect()))


def test_last_wins(spark):
    rng = random.Random(4)
    # ranks start anew with every run of 70 entries
    rows = [(str(rng.randrange(20)), f"v{i}", i // 70, i // 7 % 10, i // 7, i % 7) for i in range(200)]
    rng.shuffle(rows)
    last = {}
    for row in sorted(rows, key=lambda r: r[2:]):
        last[row[0]] = row[1]
    frame = spark.createDataFrame(rows, "store_id string, v string, fetched_at int, page_rank long, capture_id long, pos int")
    assert {r.store_id: r.v for r in prices.last_wins(frame, "v").collect()} == last


def test_first_label_per_url(spark):
    rows = [("u", "late", 0, "q", 0), ("u", "first", 0, "p", 5), ("u", "later", 0, "p", 6), ("v", "", 0, "z", 9)]
    frame = spark.createDataFrame(rows, "url string, label string, page_rank long, page_url string, pos int")
    assert {r.url: r.label for r in links.first_label_per_url(frame).collect()} == {"u": "first", "v": ""}


def test_distinct_seeds_keep_their_first_rank(spark):
    frame = spark.createDataFrame([(0, "01001"), (1, "1001"), (2, "01001"), (3, "20001")], "seed_rank long, zip string")
    assert {r.zip: r.seed_rank for r in seeds.distinct_seeds(frame).collect()} == {"01001": 0, "1001": 1, "20001": 3}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-5, 50), max_size=80), partitions=st.integers(1, 6))
def test_running_total_and_index(spark, values, partitions):
    frame = spark.createDataFrame(list(enumerate(values)), "at int, v int").repartition(partitions)
    totals = {r.at: r.total for r in ordering.running_total(frame, ["at"], F.col("v"), "total").collect()}
    places = {r.at: r.place for r in ordering.dense_index(frame, ["at"], "place").collect()}
    assert totals == {i: sum(values[: i + 1]) for i in range(len(values))}
    assert places == {i: i for i in range(len(values))}


@pytest.mark.parametrize("n", [0, 1, 20, 41, 300])
def test_id_batches(spark, spec, n):
    rows = [(f"s{i}", f"a{i}", *place) for i, (_, _, *place) in enumerate(sightings(n, 10, n))] if n else []
    batches = ordering.id_batches(spark.createDataFrame(rows, SCHEMA).repartition(5), spec).orderBy("batch_no").collect()
    expected = [r[0] for r in sorted(rows, key=order)]
    assert [b.batch_no for b in batches] == list(range(-(-n // 20)))
    prefix = spec.price_template.format("")
    ids = [i for b in batches for i in b.url.removeprefix(prefix).split("%2C")]
    assert ids == expected
    assert all(b.n_ids == 20 for b in batches[:-1])


def test_counts_per_page_include_empty_pages(spark):
    pages = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "page_rank long, url string")
    winners = spark.createDataFrame([("x", "a"), ("y", "a"), ("z", "c")], "store_id string, page_url string")
    counted = reports.with_running_total(reports.new_per_page(pages, winners))
    assert sorted((r.page_rank, r.new_stores, r.total_new) for r in counted.collect()) == [(1, 2, 2), (2, 0, 2), (3, 1, 3)]
    per_page = reports.facilities_per_page(pages, winners)
    assert sorted((r.page_rank, r.facilities) for r in per_page.collect()) == [(1, 2), (2, 0), (3, 1)]


def test_listing_order(spark):
    rows = [("9", None, 1, 0, "u", 0), ("8", "20", 0, 0, "u", 0), ("7", "100", 0, 0, "u", 1), ("6", "", 0, 0, "v", 0), ("5", "100", 0, 0, "u", 0)]
    frame = spark.createDataFrame(rows, "address string, site_number string, source_rank int, page_rank long, page_url string, pos int")
    stores = frame.withColumns({"city": F.lit("c"), "state": F.lit("s"), "units": F.array(F.lit(1))})
    assert [r.address for r in reports.new_store_listing(stores).collect()] == ["6", "9", "5", "7", "8"]
    unique = frame.filter("address <> '5'")
    assert [r.address for r in ordering.in_discovery_order(unique).collect()] == ["8", "7", "6", "9"]


def test_errors(make_captures, spark):
    captures = make_captures(*[("search", f"u{i}", "", 500 if i % 2 else 200) for i in range(20)])
    pages = spark.createDataFrame([(f"u{i}", 100 - i) for i in range(20)], "url string, page_rank long")
    assert reports.error_count(captures).first().errors == 10
    found = reports.first_errors(captures.drop("page_rank"), pages).collect()
    assert [r.url for r in found] == ["u19", "u17", "u15", "u13", "u11"]


def test_a_page_captured_again_counts_once(make_captures, spark):
    captures = make_captures(("search", "u", "", 500), ("search", "u", "", 500), ("search", "v", "", 500), ("search", "v", "", 200))
    pages = spark.createDataFrame([("u", 1), ("v", 0)], "url string, page_rank long")
    assert reports.error_count(captures).first().errors == 1
    assert [r.url for r in reports.first_errors(captures.drop("page_rank"), pages).collect()] == ["u"]
