"""What is read from a page: anchors, markers, detail candidates, addresses."""

import pytest
from pyspark.sql import functions as F

from siteatlas.functions import html
from siteatlas.operators import links


def read(spark, column, *bodies):
    frame = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id int, body string")
    return [row[1] for row in frame.select("id", column(F.col("body"))).orderBy("id").collect()]


LINK_CASES = [
    ("plain", '<a href="/x">One</a>', [("/x", "One")]),
    ("no href", '<a name="x">One</a>', []),
    ("empty href", "<a href>One</a>", [("", "One")]),
    ("single and no quotes", "<a href='/x'>1</a><a href=/y>2</a>", [("/x", "1"), ("/y", "2")]),
    ("upper case", '<A HREF="/x">One</A>', [("/x", "One")]),
    ("nodes stripped and joined", '<a href="/x"> a <b> b </b> c </a>', [("/x", "abc")]),
    ("entity in text and value", '<a href="/x?a=1&amp;b=2">R&amp;D &#233;</a>', [("/x?a=1&b=2", "R&D é")]),
    ("comment splits text", '<a href="/x">a <!-- no --> b</a>', [("/x", "ab")]),
    ("script and style are no text", '<a href="/x">a<script>s</script><style>t</style></a>', [("/x", "a")]),
    ("template is no text", '<a href="/x">a<template>t<b>u</b></template>v</a>', [("/x", "av")]),
    ("tag inside script", "<script>'<a href=\"/no\">'</script><a href='/x'>y</a>", [("/x", "y")]),
    ("tag inside comment", "<!-- <a href='/no'>no</a> --><a href='/x'>y</a>", [("/x", "y")]),
    ("ends with enclosing element", "<li><a href='/x'>a<b>c</li>d", [("/x", "ac")]),
    ("unclosed runs to the end", "<a href='/x'>a<p>b", [("/x", "ab")]),
    ("nested unclosed", "<a href='/x'>a<a href='/y'>b</a>c</a>d", [("/x", "abc"), ("/y", "b")]),
    ("end tag without start", "<a href='/x'>a</i>b</a>", [("/x", "ab")]),
    ("void elements do not nest", "<a href='/x'>a<br>b<img src=i>c</a>d", [("/x", "abc")]),
    ("self-closing", "<a href='/x'/>a", [("/x", "")]),
    ("last duplicate attribute", "<a href='/x' href='/y'>a</a>", [("/y", "a")]),
    ("less-than in text", "<a href='/x'>a < b</a>", [("/x", "a < b")]),
    ("no-break space stripped", "<a href='/x'>&nbsp;a </a>", [("/x", "a")]),
    ("truncated tag", "<a href='/x'>a</a><a href='/y", [("/x", "a")]),
    ("empty", "", []),
]


def test_links(spark):
    results = read(spark, html.links, *[body for _, body, _ in LINK_CASES])
    for (name, _, expected), found in zip(LINK_CASES, results):
        assert [(link.href, link.text) for link in found] == expected, name


def test_null_body(spark):
    assert read(spark, html.links, None) == [None]


def test_page_links_has_no_row_for_pages_without_links(spark):
    pages = spark.createDataFrame([(1, "<p>x"), (2, "<a name=x>"), (3, None), (4, "<a href=/x>y")], "id int, body string")
    rows = links.page_links(pages, "id").collect()
    assert [(r.id, r.pos, r.href, r.text) for r in rows] == [(4, 0, "/x", "y")]
    counts = {r.id: r.n_links for r in links.links_per_page(pages, "id").collect()}
    assert counts == {1: 0, 2: 0, 3: 0, 4: 1}


def test_prefilter_never_drops_a_tag(spark):
    bodies = ["<A HREF=x>", "<a\nhref=x>", "<a/href=x>", "<a\thref=x>y"]
    frame = spark.createDataFrame([(b,) for b in bodies], "body string")
    assert frame.filter(html.may_have_tag(F.col("body"), "a")).count() == len(bodies)


def test_class_prefilter_never_drops_a_marker(spark):
    bodies = [
        "<input class=siteMarker>", "<input CLASS = 'x siteMarker'>", '<input class="site&#77;arker">',
        "<input class='&#x73;iteMarker'>", "<input class=site&#77;arker>", "<input\nclass\n=\n'a &#115;iteMarker'>",
    ]
    frame = spark.createDataFrame([(b,) for b in bodies + ["<input class=other>&amp;", "<p>"]], "body string")
    kept = frame.filter(html.may_have_class(F.col("body"), "siteMarker"))
    found = kept.select(F.size(html.markers(F.col("body"), "siteMarker")).alias("n")).collect()
    assert [r.n for r in found] == [1] * len(bodies)


@pytest.mark.parametrize(
    "body, expected",
    [
        ("<input class=siteMarker value=1>", ["1"]),
        ("<input class='a siteMarker b' value=1><input class=siteMarker>", ["1", None]),
        ("<input class=siteMarkers value=1><div class=siteMarker value=2>", []),
        ("<INPUT CLASS='siteMarker' VALUE='{&quot;a&quot;:1}'/>", ['{"a":1}']),
        ("<input class='x\n\tsiteMarker' value=''>", [""]),
    ],
)
def test_markers(spark, body, expected):
    assert read(spark, lambda b: html.markers(b, "siteMarker"), body) == [expected]


def test_details_take_the_first_of_each(spark):
    body = """<input class=siteMarker><input class=siteMarker value=2>
      <i data-sitenumber=''></i><i data-sitenumber=5></i>
      <p id=PLPReviews><p id=PLPReviews data-ratingurl=x>
      <a href='mailto:x'>m</a><a href='tel:1'>t</a><a href='tel:2'>t</a>
      <span itemprop=postalCode> 0<b>12 </b></span><span itemprop=postalCode>9</span>"""
    (found,) = read(spark, lambda b: html.details(b, "siteMarker"), body)
    assert found.asDict() == {"marker": None, "site_attr": "", "review_url": "", "tel": "tel:1", "postal": "012"}


@pytest.mark.parametrize(
    "body, text",
    [
        ("<p class='myaddress'>c</p><p class='facility-address'>a</p>", "a"),
        ("<p class='property-address'>b</p><p class='facility-address'>a</p>", "a"),
        ("<p class='property-address'>b</p><p class=address>c</p>", "b"),
        ("<p class=address>c</p><p itemprop=streetAddress> s </p>", "s"),
        ("<p class='x-addresses'>first</p><p class=address>second</p>", "first"),
        ("<p itemprop=streetAddress></p><p class=address>c</p>", ""),
        ("<meta itemprop=streetAddress content=x><p class=address>c</p>", ""),
        ("<p class=Address>c</p>", None),
    ],
)
def test_address_selectors(spark, body, text):
    (found,) = read(spark, html.address, body)
    assert found.text == text


def test_address_scripts(spark):
    body = "<script type='application/ld+json'>{\"a\":\"<b>\"}</script><script>no</script><script type='application/ld+json'></script>"
    (found,) = read(spark, html.address, body)
    assert found.json_ld == ['{"a":"<b>"}', ""]


def test_a_page_with_an_unknown_declaration_is_read_to_its_end(spark):
    from siteatlas.operators import links

    pages = spark.createDataFrame([(1, "<a href=1>x</a><![foo x]><a href=2>y</a>"), (2, "<![if IE]><a href=3>z</a><![endif]><![CDATA[q]]><a href=4>")], "id int, body string")
    found = links.page_links(pages, "id").orderBy("id", "pos").collect()
    assert [(r.id, r.href) for r in found] == [(1, "1"), (1, "2"), (2, "3"), (2, "4")]
