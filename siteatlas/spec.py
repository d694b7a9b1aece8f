"""What a crawled site looks like: every site-specific value in one place."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# They describe the input format and must not change.
# ---------------------------------------------------------------------------
MARKER_CLASS = "googleMapMarkerData"
STATE_PAGE_TOKEN = "site-map-states-"
FACILITY_LINK = r"/self-storage-[a-z]+-[a-z0-9-]+/\d{4,6}\.html$"
FACILITY_URL = r"/self-storage-([a-z]{2})-([a-z0-9-]+)/(\d{4,6})\.html$"
NEAR_LABEL = r"Self Storage Near (.+?) in "
SITE_NUMBER_TITLE = r"^(\d{4,6})\s*-"
SITE_NUMBER_ATTR = "data-sitenumber"
REVIEW_ELEMENT_ID = "PLPReviews"
REVIEW_URL_ATTR = "data-ratingurl"
REVIEW_SITE_NUMBER = r"SiteNumber=(\d+)"
TEL_PREFIX = "tel:"
POSTAL_CODE_PROP = "postalCode"
STREET_ADDRESS_PROP = "streetAddress"
ADDRESS_CLASSES = ("facility-address", "property-address")
ADDRESS_CLASS_PART = "address"
JSON_LD_TYPE = "application/ld+json"
ID_SEPARATOR = "%2C"
PRICE_BATCH_SIZE = 20


@dataclass(frozen=True)
class SiteSpec:
    """Parameters of one crawled site.

    ``base_url`` is prefixed to relative links. The templates hold one ``{}``: a zip code for
    ``search_template``, joined store ids for ``price_template``.
    """

    base_url: str
    search_template: str
    price_template: str
    marker_class: str = MARKER_CLASS
    state_page_token: str = STATE_PAGE_TOKEN
    facility_link: str = FACILITY_LINK
    facility_url: str = FACILITY_URL
    near_label: str = NEAR_LABEL
    batch_size: int = PRICE_BATCH_SIZE
