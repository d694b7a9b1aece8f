import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from siteatlas import SiteSpec  # noqa: E402
from siteatlas.schema import CAPTURES  # noqa: E402
from siteatlas.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", shuffle_partitions=4, app_name="siteatlas-tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def spec():
    base = "https://atlas.example"
    return SiteSpec(base, base + "/find?near={}", base + "/prices?sites={}", marker_class="siteMarker")


@pytest.fixture(scope="session")
def make_captures(spark):
    """Captures from (kind, url, body[, status[, page_rank]]) rows."""

    def make(*rows):
        full = []
        for i, (kind, url, body, *more) in enumerate(rows):
            status, rank = (list(more) + [200, None][len(more) :])[:2]
            full.append((i, kind, url, status, body, rank, None))
        return spark.createDataFrame(full, CAPTURES)

    return make
