"""The one step that needs Python: reading HTML, one Arrow batch of page bodies at a time.

Pages of regular markup are searched by expressions (``regular``). On all others ``HTMLParser`` from the standard library
tokenises; ``_Page`` keeps the open elements so that an element's text ends at its own end tag or where an enclosing element
closes. Both give the same values. Everything taken from a page comes back as one small struct and is interpreted by native
column functions.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from siteatlas import spec as S
from siteatlas.functions import regular

# The elements that lenient page parsers in common use take as having no end tag (HTML's own and
# historic ones), and elements whose text is not page text.
VOID = frozenset(
    {"area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr", "image", "img", "input"}
    | {"isindex", "keygen", "link", "menuitem", "meta", "nextid", "param", "source", "spacer", "track", "wbr"}
)
NOT_TEXT = frozenset({"rp", "rt", "script", "style", "template"})


class _Page(HTMLParser):
    """Feeds start tags to ``on_tag`` and collects the text of the elements it asks for."""

    def __init__(self, on_tag):
        super().__init__(convert_charrefs=True)
        self.on_tag = on_tag
        self.open = []  # (name, text collector or None), outermost first
        self.names = Counter()
        self.collecting = []  # (depth in not-text elements at its start, collector)
        self.not_text = 0
        self.data = []

    def read(self, body):
        self.feed(body)
        self.close()
        self._end_text()

    def parse_html_declaration(self, i):
        try:
            return super().parse_html_declaration(i)
        except AssertionError:  # a declaration the parser does not know is a comment up to its ">", and the page goes on
            return self.parse_bogus_comment(i)

    def _end_text(self):
        if self.data:
            text = "".join(self.data).strip()
            self.data = []
            if text:
                for depth, pieces in self.collecting:
                    if depth == self.not_text:
                        pieces.append(text)

    def handle_starttag(self, tag, attrs):
        self._end_text()
        pieces = self.on_tag(tag, {name: value or "" for name, value in attrs})
        if tag in VOID:
            return
        self.open.append((tag, pieces))
        self.names[tag] += 1
        self.not_text += tag in NOT_TEXT
        if pieces is not None:
            self.collecting.append((self.not_text if tag in NOT_TEXT else 0, pieces))

    def handle_endtag(self, tag):
        self._end_text()
        while self.names[tag]:
            name, pieces = self.open.pop()
            self.names[name] -= 1
            self.not_text -= name in NOT_TEXT
            if pieces is not None:
                self.collecting.pop()
            if name == tag:
                break

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_data(self, data):
        if self.collecting:
            self.data.append(data)

    def handle_comment(self, data):
        self._end_text()

    def handle_decl(self, decl):
        self._end_text()

    def handle_pi(self, data):
        self._end_text()

    def unknown_decl(self, data):
        self._end_text()
        if self.collecting and data.upper().startswith("CDATA["):
            self.data.append(data[6:])
            self._end_text()


_ANCHOR = regular.tag_pattern("a")
_INPUT = regular.tag_pattern("input")


def _regular_links(body):
    found = []
    for m in _ANCHOR.finditer(body):
        source, closed, text = m.groups()
        if source is None or "href" not in (attrs := regular.attributes(source)):
            continue
        if closed:
            text = ""
        elif text is None:
            text = regular.text(body, "a", m.end(), VOID)
            if text is None:
                return None
        else:
            text = unescape(text).strip()
        found.append({"href": attrs["href"], "text": text})
    return found


def _links(body):
    found = []

    def on_tag(tag, attrs):
        if tag == "a" and "href" in attrs:
            pieces = []
            found.append((attrs["href"], pieces))
            return pieces

    _Page(on_tag).read(body)
    return [{"href": href, "text": "".join(pieces)} for href, pieces in found]


def _has_class(attrs, name):
    value = attrs.get("class")
    return value is not None and (value == name or name in value.split())


def _regular_markers(marker_class):
    def read(body):
        sources = [m[1] for m in _INPUT.finditer(body) if m[1]]
        attrs = [regular.attributes(x) for x in sources if marker_class in x or "&" in x]
        return [x.get("value") for x in attrs if _has_class(x, marker_class)]

    return read


def _markers(marker_class):
    def read(body):
        found = []

        def on_tag(tag, attrs):
            if tag == "input" and _has_class(attrs, marker_class):
                found.append(attrs.get("value"))

        _Page(on_tag).read(body)
        return found

    return read


def _regular_details(marker_class):
    values = [marker_class, S.REVIEW_ELEMENT_ID, S.TEL_PREFIX, S.POSTAL_CODE_PROP]
    wanted = re.compile("|".join([*map(re.escape, values), f"(?i:{re.escape(S.SITE_NUMBER_ATTR)})", "&"]))

    def read(body):
        first = {}
        for tag, source, end, closed, raw in regular.tags(body):
            if not wanted.search(source):
                continue
            attrs = regular.attributes(source)
            if "postal" not in first and attrs.get("itemprop") == S.POSTAL_CODE_PROP:
                first["postal"] = _regular_text(body, tag, end, closed, raw)
                if first["postal"] is None:
                    return None
            _first_details(first, tag, attrs, marker_class)
            if len(first) == len(_DETAIL_NAMES):
                break
        return first

    return read


def _regular_text(body, tag, end, closed, raw):
    if raw is not None:
        return raw.strip()
    return "" if closed or tag in VOID else regular.text(body, tag, end, VOID)


def _first_details(first, tag, attrs, marker_class):
    if tag == "input" and "marker" not in first and _has_class(attrs, marker_class):
        first["marker"] = attrs.get("value")
    if S.SITE_NUMBER_ATTR in attrs:
        first.setdefault("site_attr", attrs[S.SITE_NUMBER_ATTR])
    if attrs.get("id") == S.REVIEW_ELEMENT_ID:
        first.setdefault("review_url", attrs.get(S.REVIEW_URL_ATTR, ""))
    if tag == "a" and attrs.get("href", "").startswith(S.TEL_PREFIX):
        first.setdefault("tel", attrs["href"])


def _details(marker_class):
    def read(body):
        first = {}

        def on_tag(tag, attrs):
            _first_details(first, tag, attrs, marker_class)
            if "postal" not in first and attrs.get("itemprop") == S.POSTAL_CODE_PROP:
                first["postal"] = []
                return first["postal"]

        _Page(on_tag).read(body)
        if "postal" in first:
            first["postal"] = "".join(first["postal"])
        return first

    return read


def _address_ranks(attrs):
    return (
        attrs.get("itemprop") == S.STREET_ADDRESS_PROP,
        _has_class(attrs, S.ADDRESS_CLASSES[0]),
        _has_class(attrs, S.ADDRESS_CLASSES[1]),
        S.ADDRESS_CLASS_PART in attrs.get("class", ""),
    )


_ADDRESS_WANTED = re.compile("|".join(map(re.escape, [S.STREET_ADDRESS_PROP, *S.ADDRESS_CLASSES, S.ADDRESS_CLASS_PART, S.JSON_LD_TYPE, "&"])))


def _regular_address(body):
    chosen = [None, None, None, None]
    scripts = []
    for tag, source, end, closed, raw in regular.tags(body):
        if not _ADDRESS_WANTED.search(source):
            continue
        attrs = regular.attributes(source)
        for i, hit in enumerate(_address_ranks(attrs)):
            if hit and chosen[i] is None:
                chosen[i] = (tag, end, closed, raw)
        if tag == "script" and attrs.get("type") == S.JSON_LD_TYPE:
            scripts.append(raw.strip())
    best = next((x for x in chosen if x is not None), None)
    text = None if best is None else _regular_text(body, *best)
    return None if best is not None and text is None else {"text": text, "json_ld": scripts}


def _address(body):
    chosen = [None, None, None, None]
    scripts = []

    def on_tag(tag, attrs):
        wanted = _address_ranks(attrs)
        pieces = []
        for i, hit in enumerate(wanted):
            if hit and chosen[i] is None:
                chosen[i] = pieces
        if tag == "script" and attrs.get("type") == S.JSON_LD_TYPE:
            scripts.append(pieces)
        elif not any(wanted):
            return None
        return pieces

    _Page(on_tag).read(body)
    texts = ["".join(pieces) for pieces in chosen if pieces is not None]
    return {"text": texts[0] if texts else None, "json_ld": ["".join(pieces) for pieces in scripts]}


_TEXT = pa.string()
_LINK_TYPE = pa.list_(pa.struct([("href", _TEXT), ("text", _TEXT)]))
_DETAIL_NAMES = ("marker", "site_attr", "review_url", "tel", "postal")
_DETAIL_TYPE = pa.struct([(name, _TEXT) for name in _DETAIL_NAMES])
_ADDRESS_TYPE = pa.struct([("text", _TEXT), ("json_ld", pa.list_(_TEXT))])


def _page_function(read_regular, read_any, arrow_type, spark_type):
    def read(body):
        found = read_regular(body) if regular.is_regular(body) else None
        return read_any(body) if found is None else found

    def over_batch(bodies: pa.Array) -> pa.Array:
        # body by body: the batch is not held as Python texts beside its Arrow buffers
        return pa.array([None if body is None else read(body) for body in (b.as_py() for b in bodies)], type=arrow_type)

    return F.arrow_udf(over_batch, spark_type)


def links(body: Column) -> Column:
    """Every anchor with an ``href``, in document order, with its stripped text."""
    return _page_function(_regular_links, _links, _LINK_TYPE, "array<struct<href:string,text:string>>")(body)


def markers(body: Column, marker_class: str) -> Column:
    """The ``value`` of every input of the marker class, null where there is none."""
    return _page_function(_regular_markers(marker_class), _markers(marker_class), pa.list_(_TEXT), "array<string>")(body)


def details(body: Column, marker_class: str) -> Column:
    """The first occurrence of each place a facility page may hold its details."""
    return _page_function(
        _regular_details(marker_class),
        _details(marker_class),
        _DETAIL_TYPE,
        "struct<marker:string,site_attr:string,review_url:string,tel:string,postal:string>",
    )(body)


def address(body: Column) -> Column:
    """Text of the best address element, and all JSON-LD scripts."""
    return _page_function(_regular_address, _address, _ADDRESS_TYPE, "struct<text:string,json_ld:array<string>>")(body)


def may_have_tag(body: Column, tag: str) -> Column:
    """False only where the page cannot hold the tag; keeps such pages away from Python."""
    return body.rlike(rf"(?i)<{tag}[\s/>]")


def may_have_class(body: Column, name: str) -> Column:
    """False only where no class attribute can hold the name.

    The name is there as it is, unless a character reference in a class attribute spells it.
    """
    spelled = r"""(?i)class\s*=\s*("[^"]*&|'[^']*&|[^\s"'>]*&)"""
    return body.contains(name) | body.rlike(spelled)
