"""Scalar column functions: urls, names, numbers, labels and truthiness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siteatlas import spec as S

# (?d): only \n ends a line. (?U): \d, \s and case follow Unicode.
_UNICODE = "(?dU)"
_WHITE = r"[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)^{_WHITE}+|{_WHITE}+$", "")


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    """A captured group, or null without a match."""
    return F.when(text.rlike(_UNICODE + pattern), F.regexp_extract(text, _UNICODE + pattern, group))


def absolute_url(href: Column, base_url: str) -> Column:
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(base_url), href))


def title_case(text: Column) -> Column:
    """Capital after every non-letter. ``initcap`` alone only looks at spaces."""
    words = F.split(F.lower(text), r"(?<=[^\p{L}])(?=\p{L})")
    return F.array_join(F.transform(words, F.initcap), "")


def slug_title(slug: Column) -> Column:
    return title_case(F.replace(slug, F.lit("-"), F.lit(" ")))


def state_name(url: Column, token: str = S.STATE_PAGE_TOKEN) -> Column:
    return slug_title(F.substring_index(url, token, -1))


def label_address(label: Column, pattern: str = S.NEAR_LABEL) -> Column:
    return strip(F.regexp_extract(label, "(?diu)" + pattern, 1))


def title_site_number(title: Column) -> Column:
    return extract(title, S.SITE_NUMBER_TITLE)


def review_site_number(url: Column) -> Column:
    return extract(url, S.REVIEW_SITE_NUMBER)


def tel_phone(href: Column) -> Column:
    return strip(F.replace(href, F.lit(S.TEL_PREFIX), F.lit("")))


def fill_template(template: str, value: Column) -> Column:
    """Put ``value`` in the place of the template's single ``{}``."""
    before, after = template.split("{}")
    return F.concat(F.lit(before), value, F.lit(after))


def or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def price_label(price_raw: Column) -> Column:
    return F.coalesce(F.concat(F.lit("$"), price_raw, F.lit("/mo")), F.lit(""))


def yes_no(flag: Column) -> Column:
    return F.when(flag, "Yes").otherwise("No")


def truthy_text(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def truthy_array(values: Column) -> Column:
    return F.coalesce(F.size(values) > 0, F.lit(False))
