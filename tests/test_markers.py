"""The contract of a marker: every rule on missing, null and wrongly typed values."""

import html as escape

import pytest

from siteatlas.operators import details, links, markers
from siteatlas.session import ARROW_BYTES

GOOD = '{"storeID":"7","title":"12345 - X","mlat":1.50,"mlng":"2","content":{"storeAddress":"1 Main","city":"C","stateCode":"KS","postalCode":"01234","storePhone":"5","plpLink":"/p"}}'
STORE = dict(
    store_id="7", site_number="12345", address="1 Main", city="C", state="KS", zip="01234", phone="5", lat="1.5",
    lng="2", url="https://atlas.example/p",
)
BLANK = dict(address="", city="", state="", zip="", phone="", url="https://atlas.example")

# (name, marker JSON, reject reason or None, changed fields)
CASES = [
    ("good", GOOD, None, {}),
    ("empty", "", "no_value", {}),
    ("no json", "x", "bad_json", {}),
    ("truncated", GOOD[:-1], "bad_json", {}),
    ("single quotes are no json", "{'storeID':'7'}", "bad_json", {}),
    ("array", "[1]", "bad_json", {}),
    ("scalar", "5", "bad_json", {}),
    ("null id", GOOD.replace('"7"', "null"), "null_id", {}),
    ("numeric id", GOOD.replace('"7"', "7"), None, {}),
    ("id keeps zeros", GOOD.replace('"7"', '"007"'), None, {"store_id": "007"}),
    ("content missing", '{"storeID":"7","title":"12345 - X","mlat":1.50,"mlng":"2"}', None, BLANK),
    ("content null", '{"storeID":"7","title":"1","content":null}', "bad_content", {}),
    ("content text", '{"storeID":"7","title":"1","content":"{}"}', "bad_content", {}),
    ("content array", '{"storeID":"7","title":"1","content":[1]}', "bad_content", {}),
    ("content empty", '{"storeID":"7","title":"12345 - X","mlat":1.5,"mlng":2,"content":{}}', None, BLANK),
    ("title missing", GOOD.replace('"title":"12345 - X",', ""), None, {"site_number": None}),
    ("title null", GOOD.replace('"12345 - X"', "null"), "bad_title", {}),
    ("title number", GOOD.replace('"12345 - X"', "12345"), "bad_title", {}),
    ("title without number", GOOD.replace("12345 - X", "X 12345 -"), None, {"site_number": None}),
    ("title number too short", GOOD.replace("12345 - X", "123 - X"), None, {"site_number": None}),
    ("title number too long", GOOD.replace("12345 - X", "1234567 - X"), None, {"site_number": None}),
    ("title without blank", GOOD.replace("12345 - X", "1234-X"), None, {"site_number": "1234"}),
    ("link null", GOOD.replace('"/p"', "null"), "bad_link", {}),
    ("link number", GOOD.replace('"/p"', "5"), "bad_link", {}),
    ("link missing", GOOD.replace(',"plpLink":"/p"', ""), None, {"url": "https://atlas.example"}),
    ("link is only prefixed", GOOD.replace('"/p"', '"http://p"'), None, {"url": "https://atlas.examplehttp://p"}),
    ("field null", GOOD.replace('"01234"', "null"), None, {"zip": None}),
    ("field missing", GOOD.replace('"postalCode":"01234",', ""), None, {"zip": ""}),
    ("no position", GOOD.replace('"mlat":1.50,"mlng":"2",', ""), None, {"lat": None, "lng": None}),
    ("null position", GOOD.replace("1.50", "null"), None, {"lat": None}),
    ("last duplicate key", GOOD.replace('"storeID":"7"', '"storeID":"6","storeID":"7"'), None, {}),
    ("last duplicate title", GOOD.replace('"title":', '"title":null,"title":'), None, {}),
    ("unknown keys", GOOD.replace('"storeID"', '"x":{"y":[1]},"storeID"'), None, {}),
]


def page(*values):
    return "".join(f'<input class=siteMarker value="{escape.escape(v)}">' for v in values)


@pytest.fixture(scope="module")
def decoded(make_captures, spec):
    captures = make_captures(*[("search", name, page(value)) for name, value, _, _ in CASES])
    stores = {r.url_of_page: r for r in markers.page_stores(captures.withColumnRenamed("url", "url_of_page"), spec, "url_of_page").collect()}
    rejects = {r.capture_id: r for r in markers.marker_rejects(captures, spec).collect()}
    return stores, rejects


@pytest.mark.parametrize("index", range(len(CASES)), ids=[c[0] for c in CASES])
def test_marker_rule(decoded, index):
    stores, rejects = decoded
    name, value, reason, changes = CASES[index]
    if reason:
        assert name not in stores
        assert rejects[index].reason == reason
        assert (rejects[index].raw or "") == value
    else:
        assert index not in rejects
        row = stores[name].asDict()
        assert {k: row[k] for k in STORE} == {**STORE, **changes}


def test_missing_value_and_missing_id(make_captures, spec):
    captures = make_captures(
        ("search", "u", "<input class=siteMarker>" + page('{"title":"x","content":{}}', '{"storeID":"","content":{}}', GOOD))
    )
    assert [(r.pos, r.reason) for r in markers.marker_rejects(captures, spec).collect()] == [(0, "no_value")]
    # Without an id a marker is no reject, but it is no store either.
    assert [(r.pos, r.store_id) for r in markers.page_stores(captures, spec).collect()] == [(3, "7")]


def test_bad_marker_costs_only_itself(make_captures, spec):
    captures = make_captures(("search", "u", page("x", GOOD, "[]", GOOD.replace('"7"', '"8"'))))
    assert [(r.pos, r.store_id) for r in markers.page_stores(captures, spec).orderBy("pos").collect()] == [(1, "7"), (3, "8")]


def test_status_and_page_list(make_captures, spec, spark):
    captures = make_captures(
        ("search", "a", page(GOOD)),
        ("search", "b", page(GOOD.replace('"7"', '"8"')), 500),
        ("search", "c", page(GOOD.replace('"7"', '"9"'))),
        ("sitemap", "a", page(GOOD.replace('"7"', '"10"'))),
    )
    pages = spark.createDataFrame([("a", 3), ("b", 4)], "url string, page_rank long")

    def found(strict):
        rows = markers.stores_on_pages(captures, "search", pages, spec, 1, strict).collect()
        return sorted((r.store_id, r.source_rank, r.page_rank, r.pos) for r in rows)

    assert found(strict=True) == [("7", 1, 3, 0)]
    assert found(strict=False) == [("7", 1, 3, 0), ("8", 1, 4, 0)]


def test_only_the_latest_capture_of_a_page_shows_stores(make_captures, spark, spec):
    from siteatlas.operators import links, reconcile

    def page(store):
        return f"""<input class=siteMarker value='{{"storeID":"{store}","title":"t","content":{{"storeAddress":"{store}","plpLink":"/x"}}}}'>"""

    captures = make_captures(("search", "a", page("old")), ("search", "a", page("new")), ("search", "b", page("was")), ("search", "b", "", 500))
    pages = spark.createDataFrame([("a", 3), ("b", 4)], "url string, page_rank long")
    for table in (captures, captures.repartition(5)):
        rows = markers.stores_on_pages(table, "search", pages, spec, 1, strict=True).collect()
        assert [(r.store_id, r.page_rank) for r in rows] == [("new", 3)]

    link = "<a href='/self-storage-tx-{}/12345.html'>Self Storage near {} in X</a>"
    captures = make_captures(
        ("index", "i", "<a href='/site-map-states-tx'>"), ("sitemap", spec.base_url + "/site-map-states-tx", link.format("old", 1)),
        ("sitemap", spec.base_url + "/site-map-states-tx", link.format("new", 2)),
    )
    found = links.link_stores(links.state_page_links(captures, links.state_pages(captures, spec)), spec)
    assert [(r.address, r.city) for r in reconcile.first_page_wins(found).collect()] == [("2", "New")]


def test_a_failed_index_is_an_error(make_captures, spec):
    from siteatlas.operators import links

    captures = make_captures(("index", "i", "<a href='/site-map-states-tx'>"), ("index", "i", "", 503))
    with pytest.raises(Exception, match="index page failed: i"):
        links.state_pages(captures, spec).collect()


@pytest.mark.parametrize("index", [[("index", "i", "", 503)], [], [("index", "i", "<a href='/site-map-states-tx'>"), ("index", "i", "", 404)]])
def test_site_down_is_always_an_error(spark, make_captures, spec, index):
    """Nothing but a failed index, or none: the empty inputs must not take the check out of the plan."""
    from siteatlas.plans import catalogs

    captures = make_captures(*index, ("price", "p", "{}", 500, 0))
    zips = spark.createDataFrame([(0, "01001")], "seed_rank long, zip string")
    for _ in range(2):
        for build in (
            lambda: catalogs.daily_locations_report(captures, zips, spec),
            lambda: catalogs.daily_catalog(captures, zips, spec),
            lambda: catalogs.link_locations_report(captures, spec),
            lambda: catalogs.link_locations(captures, spec, fetch_addresses=True),
        ):
            with pytest.raises(Exception, match="index page failed: i" if index else "no index page"):
                build().count()


def test_rejects_beside_stores_come_from_one_reading(spark, spec, make_captures, monkeypatch):
    def page(*values):
        return "".join(f"<input class='siteMarker' value='{escape.escape(v)}'>" for v in values)

    captures = make_captures(
        ("sitemap", "https://atlas.example/a", page(GOOD, "x", GOOD.replace('"7"', "null"))),
        ("sitemap", "https://atlas.example/b", page(GOOD.replace('"7"', '"9"')), 500),
        ("sitemap", "https://atlas.example/unlisted", page(GOOD, "x")),
    )
    pages = spark.createDataFrame([("https://atlas.example/a",), ("https://atlas.example/b",)], "url string")
    written, persist = [], markers.persist_reliably

    def noted(frame):
        written.append(frame)
        return persist(frame)

    monkeypatch.setattr(markers, "persist_reliably", noted)
    for strict, ids in ((True, {"7"}), (False, {"7", "9"})):
        written.clear()
        stores, rejects = markers.stores_and_rejects(captures, "sitemap", pages, spec, 3, strict)
        alone = markers.stores_on_pages(captures, "sitemap", pages, spec, 3, strict)
        assert sorted(map(str, stores.select(*alone.columns).collect())) == sorted(map(str, alone.collect()))
        assert {r.store_id for r in stores.collect()} == ids
        found = [(r.source_rank, r.capture_id, r.pos, r.reason, r.raw is not None) for r in rejects.orderBy("pos").collect()]
        assert found == [(3, 0, 1, "bad_json", True), (3, 0, 2, "null_id", True)]
        plan = lambda frame: frame._jdf.queryExecution().executedPlan().toString()
        assert len(written) == 1 and plan(written[0]).count("ArrowEvalPython") == 1
        assert "ArrowEvalPython" not in plan(stores) + plan(rejects)
        assert written[0].filter("reason IS NULL AND raw IS NOT NULL").isEmpty()


def test_stores_meet_their_pages_without_being_sent_to_all_tasks(spark, make_captures, spec):
    page = f"<input class=siteMarker value='{escape.escape(GOOD)}'>"
    captures = make_captures(("search", "u1", page), ("search", "u2", page), ("search", None, page))
    pages = spark.createDataFrame([("u1", 5), ("u3", 6)], "url string, page_rank long")
    found = markers.stores_on_pages(captures, "search", pages, spec, 1, strict=True)
    assert [(r.page_url, r.page_rank, r.store_id) for r in found.collect()] == [("u1", 5, "7")]
    joins = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line and "page_url" in line and "capture_id" in line]
    assert joins and all("Join LeftOuter" in line for line in joins)  # an inner one may broadcast either side


def test_pages_go_to_python_in_small_batches(spark, make_captures, spec):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    reads = [lambda p: markers.page_markers(p, spec, "url"), lambda p: links.page_links(p, "url"), lambda p: links.links_per_page(p, "url")]
    reads += [lambda p: details.facility_details(p, spec, "url"), lambda p: details.facility_addresses(p, "url")]
    try:
        for read in reads:
            spark.conf.set(name, "64m")
            read(make_captures(("search", "u1", "<p>")))
            assert spark.conf.get(name) == f"{ARROW_BYTES}b"
    finally:
        spark.conf.set(name, before)
