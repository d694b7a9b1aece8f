"""The contract of a price payload, and what is computed from unit lists."""

import json

import pytest
from pyspark.sql import functions as F

from siteatlas.operators import prices, reports


def payload(*stores):
    return json.dumps({"promoInfoArr": list(stores)})


def entries(make_captures, *bodies, strict=True):
    captures = make_captures(*[("price", f"u{i}", body, 200, i) for i, body in enumerate(bodies)])
    rows = prices.price_entries(captures, strict).orderBy("page_rank", "pos").collect()
    return [(r.page_rank, r.store_id, [u.asDict() for u in r.units]) for r in rows]


def unit(**changes):
    full = dict(size="", price_raw=None, price=None, available=False, count=0, promo="", promo2="")
    return {**full, **changes}


UNIT_CASES = [
    ({}, unit()),
    ({"name": None, "count": None, "saleprice": None, "availability": None}, unit(size=None, count=None)),
    ({"promotionName": None, "promotionName2": ""}, unit()),
    ({"promotionName": "A", "promotionName2": "B"}, unit(promo="A", promo2="B")),
    ({"extra": {"deep": [1, {"x": None}]}}, unit()),
    ({"name": "5x5", "count": 3}, unit(size="5x5", count=3)),
    ({"saleprice": 45}, unit(price_raw="45", price=45.0)),
    ({"saleprice": 45.0}, unit(price_raw="45.0", price=45.0)),
    ({"saleprice": "45"}, unit(price_raw="45", price=45.0)),
    ({"saleprice": "ask"}, unit(price_raw="ask", price=None)),
    ({"availability": True}, unit(available=True)),
    ({"availability": False}, unit()),
    ({"availability": 0}, unit()),
    ({"availability": 1}, unit(available=True)),
    ({"availability": ""}, unit()),
    ({"availability": []}, unit()),
    ({"availability": "yes"}, unit(available=True)),
    ({"availability": "false"}, unit(available=True)),
    ({"availability": "0"}, unit(available=True)),
    ({"availability": "{}"}, unit(available=True)),
    ({"availability": {}}, unit()),
]


def test_unit_rules(make_captures):
    (found,) = entries(make_captures, payload({"storeID": 1, "info": [given for given, _ in UNIT_CASES]}))
    for (given, expected), got in zip(UNIT_CASES, found[2]):
        assert got == expected, given


@pytest.mark.parametrize("body", ["x", '{"promoInfoArr":[{"storeID":"5","info":[]}', '{"promoInfoArr":{"a":1}}', "[1]", "{}", '{"promoInfoArr":null}', '{"promoInfoArr":[]}', "5", ""])
def test_unusable_payload_yields_nothing(make_captures, body):
    good = payload({"storeID": "1", "info": []})
    assert entries(make_captures, body, good) == [(1, "1", [])]


@pytest.mark.parametrize(
    "bad",
    [
        {"storeID": "2", "info": None},
        {"storeID": "2", "info": 5},
        {"storeID": "2", "info": {"a": 1}},
        {"storeID": "2", "info": [None]},
        {"storeID": "2", "info": [1]},
        {"storeID": "2", "info": [{}, "x"]},
        None,
        3,
        "x",
        [1],
    ],
)
def test_one_unusable_store_voids_its_payload(make_captures, bad):
    good = {"storeID": "1", "info": [{}]}
    bodies = payload(good, bad), payload({"storeID": "3"})
    assert entries(make_captures, *bodies) == [(1, "3", [])]
    assert entries(make_captures, *bodies, strict=False) == [(0, "1", [unit()]), (1, "3", [])]


def test_last_duplicate_key(make_captures):
    body = '{"promoInfoArr":[{"storeID":1,"storeID":2,"info":null,"info":[{"name":"a","name":"b","count":1,"count":null}]}]}'
    assert entries(make_captures, body) == [(0, "2", [unit(size="b", count=None)])]


def test_ids(make_captures):
    body = '{"promoInfoArr":[{"storeID":7},{"storeID":"07"},{},{"storeID":null}]}'
    assert [store for _, store, _ in entries(make_captures, body)] == ["7", "07", "", "None"]


def test_failed_payload_is_ignored_and_last_answer_wins(make_captures):
    captures = make_captures(
        ("price", "a", payload({"storeID": 1, "info": [{"name": "old"}]}, {"storeID": 2, "info": [{"name": "x"}]}), 200, 0),
        ("price", "b", payload({"storeID": 1, "info": []}, {"storeID": 1, "info": [{"name": "new"}]}), 200, 1),
        ("price", "c", payload({"storeID": 2, "info": [{"name": "late"}]}), 503, 2),
    )
    found = {r.store_id: [u.size for u in r.units] for r in prices.price_units(captures).collect()}
    assert found == {"1": ["new"], "2": ["x"]}
    responses = {r.capture_id: r.n_responses for r in prices.responses_per_payload(captures).collect()}
    assert responses == {0: 2, 1: 1, 2: 0}


SUMMARY_CASES = [
    # units as (size, price_raw, available, count); cheapest size and raw price, units available
    ([], None, None, 0),
    ([("a", "5", False, 3)], None, None, 0),
    ([("a", "0", True, 3), ("b", None, True, 2)], None, None, 0),
    ([("a", "9", True, 3), ("b", "10", True, 2)], "a", "9", 5),
    ([("a", "10", True, 1), ("b", "9.5", True, 2), ("c", "9.50", True, 4)], "b", "9.5", 7),
    ([("a", "7", True, None), ("b", "7.0", True, 2)], "a", "7", 2),
    ([("a", "ask", True, 1), ("b", "70", True, 2)], "b", "70", 3),
    ([("a", "ask", True, 1)], "a", "ask", 1),
]


def test_unit_summary(spark):
    rows = []
    for i, (units, *_) in enumerate(SUMMARY_CASES):
        def number(raw):
            try:
                return float(raw)
            except (TypeError, ValueError):
                return None

        rows.append((i, [(s, raw, number(raw), a, c, "", "") for s, raw, a, c in units]))
    schema = "id int, units array<struct<size string, price_raw string, price double, available boolean, count bigint, promo string, promo2 string>>"
    found = spark.createDataFrame(rows, schema).select("id", prices.unit_summary().alias("s")).orderBy("id").collect()
    for (units, size, raw, available), row in zip(SUMMARY_CASES, found):
        assert (row.s.cheapest_size, row.s.cheapest_price_raw, row.s.units_available) == (size, raw, available)
        assert row.s.n_units == len(units)


def test_price_join_keeps_every_store(make_captures, spark):
    captures = make_captures(("price", "a", payload({"storeID": 1, "info": [{}, {}]}, {"storeID": 9}), 200, 0))
    stores = spark.createDataFrame([("1",), ("2",), ("1",)], "store_id string")
    priced = prices.attach_units(stores, prices.price_units(captures))
    assert sorted((r.store_id, len(r.units)) for r in priced.collect()) == [("1", 2), ("1", 2), ("2", 0)]
    assert prices.with_pricing(priced).count() == 2


def test_reports_from_units_and_from_summaries_agree(make_captures, spark):
    info = [{"name": "a", "saleprice": 45.0, "availability": True, "count": 2}, {"name": "b", "saleprice": 46, "availability": True, "count": 1}]
    captures = make_captures(("price", "a", payload({"storeID": 1, "info": info}), 200, 0))
    stores = spark.createDataFrame(
        [("1", None, "A", "C", "KS", "u"), ("2", "5", "B", "C", "KS", "v")],
        "store_id string, site_number string, address string, city string, state string, url string",
    )
    with_units = prices.attach_units(stores, prices.price_units(captures))
    with_summary = prices.attach_summary(stores, prices.price_summary(captures))
    for report in (reports.locations_v1, reports.locations_v2):
        assert sorted(report(with_units).collect(), key=str) == sorted(report(with_summary).collect(), key=str)
    first, second = sorted(reports.locations_v2(with_units).collect(), key=lambda r: r["Store ID"])
    assert first["Lowest Price"] == "$45.0/mo" and first["Units Available"] == 3
    assert first["Site #"] is None and first["Zip"] == "" and first["Phone"] == ""
    assert second["Lowest Price"] == "" and second["Units Available"] == 0
    units = reports.units_v2(with_units).select("Site #", "Unit Size", "Sale Price", "Available", "Units Left").collect()
    assert [tuple(u) for u in units] == [(None, "a", 45.0, "Yes", 2), (None, "b", 46.0, "Yes", 1)]
    counts = reports.coverage(with_units.withColumn("phone", F.lit(""))).first()
    assert counts.asDict() == {"total": 2, "with_pricing": 1, "with_site_number": 1, "with_phone": 0, "remaining": 1}


@pytest.mark.parametrize("empty", [{}, "", []])
def test_empty_info_is_no_unit_and_voids_nothing(make_captures, empty):
    body = payload({"storeID": "1", "info": empty}, {"storeID": "2", "info": [{"name": "a"}]})
    assert [(s, len(units)) for _, s, units in entries(make_captures, body)] == [("1", 0), ("2", 1)]


@pytest.mark.parametrize("bad", [{"a": 1}, "x", "{}", 5, None])
def test_other_info_voids_the_payload(make_captures, bad):
    body = payload({"storeID": "1", "info": bad}, {"storeID": "2", "info": [{"name": "a"}]})
    assert entries(make_captures, body) == []


def test_newest_units_of_few_stores_equal_those_of_all(make_captures, spark):
    captures = make_captures(*[("price", f"u{i}", payload({"storeID": i % 3, "info": [{"name": str(i)}]}), 200, 9 - i) for i in range(9)])
    stores = spark.createDataFrame([("0", "a"), ("2", "b"), ("7", "c")], "store_id string, city string")
    few = prices.attach_newest_units(stores, prices.price_entries(captures))
    full = prices.attach_units(stores, prices.price_units(captures))
    pick = lambda frame: sorted((r.store_id, r.city, [u["size"] for u in r.units]) for r in frame.collect())
    assert pick(few) == pick(full) == [("0", "a", ["0"]), ("2", "b", ["2"]), ("7", "c", [])]
