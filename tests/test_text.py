"""Scalar functions against what they must return, row by row."""

import pytest
from pyspark.sql import functions as F

from siteatlas.functions import text
from siteatlas.operators.links import parse_facility_url

CASES = [
    (lambda c: text.absolute_url(c, "B"), [("/x", "B/x"), ("http://x", "http://x"), ("httpx", "httpx"), ("", "B"), ("HTTP://x", "BHTTP://x")]),
    (text.slug_title, [("29palms", "29Palms"), ("st-louis", "St Louis"), ("a--b", "A  B"), ("x9y", "X9Y"), ("", ""), ("7-elevens", "7 Elevens"), ("o'neil-UPPER", "O'Neil Upper")]),
    (text.state_name, [("h/site-map-states-new-york", "New York"), ("site-map-states-a-site-map-states-b", "B"), ("none", "None")]),
    (text.label_address, [
        ("Self Storage Near 12 Main St in Foo, KS", "12 Main St"), ("SELF STORAGE NEAR 1 A in B in C", "1 A"),
        ("Self Storage Near 1 A inB", ""), ("x Self Storage Near  1 A  in B", "1 A"), ("", ""), ("Self Storage Near a\nb in c", ""),
    ]),
    (text.title_site_number, [("12345 - X", "12345"), ("1234-X", "1234"), ("123456\t- X", "123456"), ("1234567 - X", None), ("123 - X", None), (" 12345 - X", None), ("12345 X", None), (None, None)]),
    (text.review_site_number, [("a?SiteNumber=42&b", "42"), ("SiteNumber=", None), ("sitenumber=1", None), ("SiteNumber=1&SiteNumber=2", "1")]),
    (text.tel_phone, [("tel:1", "1"), ("tel: \t1  2 ", "1  2"), ("tel:tel:1", "1"), ("tel:", "")]),
    (text.or_empty, [(None, ""), ("x", "x")]),
    (text.price_label, [("45", "$45/mo"), ("45.0", "$45.0/mo"), (None, "")]),
    (lambda c: text.fill_template("a{}b", c), [("1", "a1b"), ("", "ab")]),
    (text.strip, [(" a ", "a"), ("\x1ca\x1f", "a"), ("　a b\n", "a b"), ("", "")]),
    (text.truthy_text, [("", False), (None, False), ("0", True)]),
]


@pytest.mark.parametrize("function, rows", CASES)
def test_function(spark, function, rows):
    frame = spark.createDataFrame([(i, given) for i, (given, _) in enumerate(rows)], "i int, v string")
    got = [r.out for r in frame.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]
    assert got == [expected for _, expected in rows]


@pytest.mark.parametrize(
    "href, expected",
    [
        ("/self-storage-ks-shawnee/77942.html", ("77942", "KS", "Shawnee")),
        ("http://x/self-storage-ks-29-palms/1234.html", ("1234", "KS", "29 Palms")),
        ("/self-storage-ks-a/b/77942.html", (None, None, None)),
        ("/self-storage-kan-a/77942.html", (None, None, None)),
        ("/self-storage-KS-a/77942.html", (None, None, None)),
        ("/self-storage-ks-a/123.html", (None, None, None)),
        ("/self-storage-ks-a/1234567.html", (None, None, None)),
        ("/self-storage-ks-a/77942.html?x", (None, None, None)),
        ("/self-storage-ks-a/77942.html\n", ("77942", "KS", "A")),
        ("/self-storage-ks-a/77942.html\r", (None, None, None)),
    ],
)
def test_facility_url(spark, spec, href, expected):
    row = spark.createDataFrame([(href,)], "u string").select(
        *[c.alias(n) for n, c in parse_facility_url(F.col("u"), spec).items()]
    ).first()
    assert tuple(row) == expected


def test_yes_no(spark):
    rows = spark.createDataFrame([(True,), (False,), (None,)], "b boolean").select(text.yes_no(F.col("b"))).collect()
    assert [r[0] for r in rows] == ["Yes", "No", "No"]
