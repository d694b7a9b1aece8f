"""Pages of regular markup are read by expressions; the values must be those of the tokeniser."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siteatlas.functions import html, regular
from tests.conftest import SF
from tests.test_html import LINK_CASES

READERS = {
    "links": (html._regular_links, html._links),
    "markers": (html._regular_markers("siteMarker"), html._markers("siteMarker")),
    "details": (html._regular_details("siteMarker"), html._details("siteMarker")),
    "address": (html._regular_address, html._address),
}

NAMES = ["a", "A", "p", "li", "b", "br", "input", "script", "style", "template", "rt", "span", "abbr"]
ATTRIBUTES = [
    "href=/x", "href='/y?a=1&amp;b'", 'HREF="tel:1"', "href", "href = z/", "class=siteMarker", 'class="x siteMarker"', "class='site&#77;arker'",
    "value='{\"a\":1}'", "value=\"a > b\"", "value='<b>'", "data-sitenumber=5", "DATA-SITENUMBER=''", "id=PLPReviews", "data-ratingurl=r",
    "itemprop=postalCode", "itemprop=streetAddress", "class=facility-address", "class=my-addresses", "type=application/ld+json", "x=a\"b", "y='", "/", "=",
]
PIECES = [
    *[f"{start}{name}{end}" for name in NAMES for start, end in (("</", ">"), ("<", ">"))],
    "text", " & &amp; ", "é  ", "a < b", "<!-- c -->", "<!-- <a href=1>x</a> -->", "<!-->", "<!doctype html>", "<![x]>", "</a x>", "</ a>", "<?pi>",
    "<script>var a = '</p><b>' < 1;</script>", "<style>p{}</style>", "<SCRIPT type='application/ld+json'> {\"a\":\"<b>\"} </script>", "</>", "<", "<a href='",
]
tag = st.builds(lambda n, a, e: f"<{n}{''.join(' ' + x for x in a)}{e}", st.sampled_from(NAMES), st.lists(st.sampled_from(ATTRIBUTES), max_size=3), st.sampled_from([">", "/>", " >", " />", ""]))
closed = st.builds(lambda n, a, t: f"<{n} {a}>{t}</{n}>", st.sampled_from(["a", "p", "span", "li"]), st.sampled_from(ATTRIBUTES), st.sampled_from(["", " t ", "x<b>y &lt;</b> z", "<br>u"]))
pages = st.lists(st.one_of(closed, closed, tag, st.sampled_from(PIECES)), max_size=8).map("".join)


def same(body):
    if regular.is_regular(body):
        for name, (fast, slow) in READERS.items():
            found = fast(body)
            assert found is None or found == slow(body), (name, body)
    return regular.is_regular(body)


@settings(max_examples=3000, deadline=None)
@given(pages)
def test_regular_pages_give_the_values_of_the_tokeniser(body):
    same(body)


@pytest.mark.parametrize("name, body, _", LINK_CASES)
def test_link_cases(name, body, _):
    same(body)


@pytest.mark.parametrize(
    "body",
    [
        "<!DOCTYPE html><p class=x>a</p><!-- c --><a href=/x?y=1>b</a>", "<input value='{\"a\":1}' class=\"a b\"/><br/>",
        "<script>if (a < b) { x = '</div>' }</script>", "<li><a href='x'>a<b>c</li>", "", "no tag > at all",
    ],
)
def test_regular(body):
    assert same(body)


@pytest.mark.parametrize(
    "body",
    [
        "a < b", "<a href='/x", "<p><template><a href=x>y</a></template>", "<!--><p>", "<!-- a -- b -->", "<a href=x\"y>", "<a title='<b>'>", "</a x>", "<script>", "<script><!-- x --></script>",
        "<script></style>", "<?php ?>", "<![CDATA[x]]>", "<a href='x'class=y>", "<a href==x>", "<p",
    ],
)
def test_not_regular(body):
    assert not same(body)


def test_pages_of_the_tables_are_read_by_expressions(spark):
    from siteatlas import fixtures

    bodies = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").select("html").collect() if r.html]
    for kind in ("index", "sitemap", "search", "facility"):
        bodies += [r.body for r in fixtures.captures(spark, SF, kind).select("body").collect() if r.body]
    assert sum(map(same, bodies)) >= 0.9 * len(bodies)


def test_an_element_with_many_tags_is_walked_once():
    body = "<a href=x>" + "<b>" * 20000 + "t" + "<i></i>" * 20000 + "</b>" * 20000 + "</a>"
    assert regular.is_regular(body) and html._regular_links(body) == [{"href": "x", "text": "t"}]
