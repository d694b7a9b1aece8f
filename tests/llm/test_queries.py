"""Registered queries against their SQL, and the pipeline."""

import pytest

import __spark_entry__ as entry
from siteatlas.llm import queries
from tests.compare import connect, difference
from tests.conftest import SF


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query(spark, duck, name):
    found = queries.QUERIES[name](spark, SF).toArrow()
    expected = duck.execute(queries.ORACLE[name]).to_arrow_table()
    assert found.num_rows > 0
    assert difference(found, expected) is None


def test_all_are_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {name.split("_")[0] for name in names}
    assert "pipeline" in names
