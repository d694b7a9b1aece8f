"""Captures and prices kept run by run."""

from pyspark.sql import functions as F

from siteatlas.operators import prices
from siteatlas.plans import catalogs
from siteatlas.session import new_work_dir
from siteatlas.sources import captures as C
from siteatlas.sources import runs, seeds
from siteatlas.streaming import price_state


def page(spec, kind, url, *ids):
    markers = "".join(f"""<input class="{spec.marker_class}" value='{{"storeID":"{i}","content":{{"plpLink":"/s/{i}"}}}}'>""" for i in ids)
    return kind, url, markers


def run_of(make_captures, number, *rows):
    made = make_captures(*rows)
    return made.withColumns({"capture_id": F.col("capture_id") + 1000 * number, "fetched_at": F.timestamp_seconds(F.lit(86400 * number))})


def site(spec, number, search=4):
    index = ("index", "i", "<a href='/site-map-states-tx'>Texas</a>")
    state = page(spec, "sitemap", spec.base_url + "/site-map-states-tx", "s1", f"s{number}")
    return [index, state, *[page(spec, "search", spec.search_template.format(z), f"z{z}", f"n{number}") for z in range(search)]]


def stores(found):
    return sorted((r.store_id, r.page_url) for r in found.select("store_id", "page_url").collect())


def test_ten_runs_of_the_same_pages_are_read_once(spark, spec, make_captures):
    path = new_work_dir(spark, "runs")
    zips = spark.createDataFrame([(z, str(z)) for z in range(4)], "seed_rank long, zip string")
    for number in range(10):
        runs.land(run_of(make_captures, number, *site(spec, number)), path)
    history = C.read_captures(spark, path).select(*[f.name for f in C.CAPTURES])
    current = runs.read_current(spark, path)
    assert history.count() == 60 and current.count() == 6
    assert runs.read_current(spark, path, "search").count() == 4
    assert stores(catalogs.discovered(current, zips, spec)) == stores(catalogs.discovered(history, zips, spec))
    assert [r.store_id for r in catalogs.discovered(current, zips, spec).filter("store_id like 's%'").orderBy("store_id").collect()] == ["s1", "s9"]


def test_partial_runs_are_carried(spark, spec, make_captures):
    """Runs that fetch few pages, late captures and errors: never more than twice the pages, and the same result as over the history."""
    path = new_work_dir(spark, "runs")
    zips = spark.createDataFrame([(z, str(z)) for z in range(8)], "seed_rank long, zip string")
    runs.land(run_of(make_captures, 5, *site(spec, 5, search=8)), path)
    for number, z in enumerate((0, 1, 2, 3, 4, 4, 5, 0), 6):
        status = 500 if z == 3 else 200
        one = [(*page(spec, "search", spec.search_template.format(z), f"new{number}"), status), ("search", None, "x")]
        runs.land(run_of(make_captures, number if number != 9 else 1, *one), path)  # run 9 brings an old capture
        current, history = runs.read_current(spark, path), C.read_captures(spark, path).select(*[f.name for f in C.CAPTURES])
        pages = current.filter("kind = 'search' and url is not null")
        assert pages.select("url").distinct().count() == 8 and pages.count() <= 16
        assert stores(catalogs.discovered(current, zips, spec)) == stores(catalogs.discovered(history, zips, spec))
    latest = {r.url: r.capture_id for r in C.latest_versions(history.filter("kind = 'search'")).collect()}
    assert latest == {r.url: r.capture_id for r in runs.latest_index(spark, path).filter("kind = 'search'").collect()}


def test_reading_before_the_first_run(spark):
    path = new_work_dir(spark, "runs")
    assert runs.read_current(spark, path).count() == 0 and runs.latest_index(spark, path).count() == 0


def test_prices_folded_run_by_run(spark, make_captures):
    path = new_work_dir(spark, "prices")
    body = lambda *s: '{"promoInfoArr":[' + ",".join(f'{{"storeID":"{i}","info":[{{"name":"{n}","saleprice":{p}}}]}}' for i, n, p in s) + "]}"
    parts = [
        run_of(make_captures, 1, ("price", "a", body(("1", "x", 10), ("2", "x", 20)), 200, 0), ("price", "b", body(("3", "x", 30)), 200, 1)),
        run_of(make_captures, 2, ("price", "a", body(("1", "y", 11)), 200, 0), ("price", "b", '{"promoInfoArr":[{"storeID":"3"},{"storeID":"4","info":null}]}', 200, 1)),
        run_of(make_captures, 3, ("price", "a", body(("2", "z", 22)), 503, 0), ("price", "c", body(("4", "z", 44), ("4", "w", 45)), 200, 1)),
    ]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    want = sorted((r.store_id, r.units[0].size) for r in prices.price_units(whole).collect())
    assert want == [("1", "y"), ("2", "x"), ("3", "x"), ("4", "w")]
    for run in (1, 0, 2, 0):  # in any order, one of them twice
        price_state.fold(parts[run], path, "site", run if run else 0)
    got = sorted((r.store_id, r.units[0].size) for r in price_state.price_units(spark, path).collect())
    assert got == want
    assert price_state.price_summary(spark, path).count() == 4


def test_plain_list_of_seeds(spark):
    path = new_work_dir(spark, "list")
    zips = [f"{(i * 7919) % 90000:05d}" for i in range(5000)]
    spark.createDataFrame([(" \n".join(zips[:4000]) + "\n\n",)], "value string").coalesce(1).write.text(path)
    spark.createDataFrame([("\r\n".join(zips[4000:]),)], "value string").coalesce(1).write.mode("append").text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        found = seeds.read_seed_list(spark, path)
        ranked = [r.zip for r in found.orderBy("seed_rank").collect()]
        assert [r.seed_rank for r in found.orderBy("seed_rank").collect()] == list(range(5000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    halves = (zips[:4000], zips[4000:])
    assert ranked in (halves[0] + halves[1], halves[1] + halves[0])  # by file name, which the test does not choose
