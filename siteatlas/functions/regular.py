"""Pages of regular markup, read without a tokeniser in Python.

A page is regular when all of it is text, comments, a doctype, scripts and tags written in a way that no parser can read differently:
every ``<`` outside of comments and scripts starts one of these, and no attribute holds one. One expression decides that for a whole
page. On such a page tags can be looked for by expressions too, and only elements whose text is wanted are walked. Whatever else a page
holds, ``html`` reads it with its tokeniser; a function here returns None where it cannot tell, so both give the same values.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

_WS = r"[ \t\n\r\f]"
_VALUE = rf"""(?:"[^"<]*+"|'[^'<]*+'|[^\s"'<>=`][^\s"'<>`]*+)"""
_ATTRIBUTE = rf"{_WS}++[a-zA-Z_@:][a-zA-Z0-9_@:.\-]*+(?:{_WS}*+={_WS}*+{_VALUE})?+"
_COMMENT = r"!--(?!-?>)[^-]*+(?:-[^-]++)*+--"
_RAW = {"script": "[sS][cC][rR][iI][pP][tT]", "style": "[sS][tT][yY][lL][eE]"}
_RAW_NAME = "(?:" + "|".join(_RAW.values()) + ")"
_RAW_TEXT = rf"[^<]*+(?:<(?!/?\s*{_RAW_NAME}|!)[^<]*+)*+"
#: Elements whose text is no page text hide what is inside of them, so pages with one are left to the tokeniser.
_HIDING = "(?:[tT][eE][mM][pP][lL][aA][tT][eE]|[rR][pPtT])"
_NAME = r"[a-zA-Z][a-zA-Z0-9]*+"
_TAG_NAME = rf"(?!(?:{_RAW_NAME}|{_HIDING})[\s/>]){_NAME}"
_RAW_ELEMENTS = "|".join(rf"{n}(?:{_ATTRIBUTE})*+{_WS}*+>{_RAW_TEXT}</{n}{_WS}*+" for n in _RAW.values())

_TAG = rf"{_TAG_NAME}(?:{_ATTRIBUTE})*+{_WS}*+/?+"
_REGULAR = re.compile(rf"(?:[^<]++|<(?:{_TAG}|/{_NAME}{_WS}*+|{_RAW_ELEMENTS}|{_COMMENT}|![dD][oO][cC][tT][yY][pP][eE][^<>]*+)>)*+")

# On a regular page: a raw element with its attributes and text, or a tag with its attributes.
_RAW_ELEMENT = rf"({_RAW_NAME})((?:{_ATTRIBUTE})*+){_WS}*+>({_RAW_TEXT})</{_RAW_NAME}{_WS}*+"
_WITH_ATTRIBUTES = re.compile(rf"<(?:{_COMMENT}|{_RAW_ELEMENT}|({_NAME})((?:{_ATTRIBUTE})++){_WS}*+(/?+))>")
_PIECE = re.compile(rf"<(?:{_COMMENT}|![^>]*+|{_RAW_ELEMENT}|(/?+)({_NAME})(?:{_ATTRIBUTE})*+{_WS}*+(/?+))>")
_PARSED = re.compile(rf"""{_WS}++([a-zA-Z_@:][a-zA-Z0-9_@:.\-]*+)(?:{_WS}*+={_WS}*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'<>`]++)))?+""")


def is_regular(body: str) -> bool:
    return _REGULAR.match(body).end() == len(body)


def attributes(source: str) -> dict[str, str]:
    """Of attributes of one name the last counts; names are folded, references decoded."""
    return {name.lower(): unescape(a or b or c) for name, a, b, c in _PARSED.findall(source)}


def tags(body: str) -> Iterator[tuple[str, str, int, bool, str | None]]:
    """(name, attributes, end, self-closing, raw text) of every tag with attributes of a regular page."""
    for m in _WITH_ATTRIBUTES.finditer(body):
        raw, raw_attributes, text, name, source, closed = m.groups()
        if name:
            yield name.lower(), source, m.end(), closed == "/", None
        elif raw_attributes:
            yield raw.lower(), raw_attributes, m.end(), False, text


def text(body: str, tag: str, start: int, void: frozenset) -> str | None:
    """The text of an element whose start tag ends at ``start``, stripped between tags and joined.

    None where it is not closed by its own end tag, or an end tag inside may be that of an enclosing element.
    """
    found, inside, names, at = [], [], Counter(), start
    for m in _PIECE.finditer(body, start):
        found.append(unescape(body[at : m.start()]).strip())
        at = m.end()
        end, name, closed = m[4], m[5], m[6]
        if not name:
            continue
        name = name.lower()
        if not end:
            if not closed and name not in void:
                inside.append(name)
                names[name] += 1
        elif names[name]:
            while names[name]:
                names[last := inside.pop()] -= 1
                if last == name:
                    break
        elif name == tag:
            return "".join(found)
        else:
            return None
    return None


def tag_pattern(name: str) -> re.Pattern:
    """Start tags of one name with attributes (group 1), "/" where they close themselves (2) and their text up to an end tag that follows at once (3)."""
    letters = "".join(f"[{c.lower()}{c.upper()}]" for c in name)
    raw = rf"{_RAW_NAME}(?:{_ATTRIBUTE})*+{_WS}*+>{_RAW_TEXT}</{_RAW_NAME}{_WS}*+>"
    return re.compile(rf"<(?:{_COMMENT}>|{raw}|{letters}((?:{_ATTRIBUTE})++){_WS}*+(/?+)>(?:([^<]*+)</{letters}{_WS}*+>)?+)")
