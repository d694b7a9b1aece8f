"""Files of one JSON array, cut into pieces: against the standard library, element for element."""

import json
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from siteatlas.schema import STORES
from siteatlas.sources import catalog, json_array

TRICKY = [
    {"a": 'x "quoted" } { [ ] , \\'},
    {"a": "}"},
    {"a": "\\}\\\\", "b": {"c": [{"d": "{"}, {"d": "}"}], "e": {}}},
    {},
    {"a": "line\nbreak   é 🏬"},
    {"": None, "n": [1, 2.5, True, [], [[{}]]]},
]


def elements(spark, path):
    return sorted(json.dumps(json.loads(r.element), sort_keys=True) for r in json_array.read_elements(spark, str(path)).collect())


def expected(records):
    return sorted(json.dumps(r, sort_keys=True) for r in records)


@pytest.fixture
def small_blocks(spark):
    """Files are cut every 200 bytes, so strings, escapes and objects run over many blocks."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, "200b")
    yield
    for n, value in zip(names, before, strict=True):
        spark.conf.set(n, value)


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("ascii_only", [True, False])
def test_strings_nesting_and_escapes_over_many_blocks(spark, tmp_path, small_blocks, indent, ascii_only):
    rng = random.Random(7)
    records = [dict(rng.choice(TRICKY), k=i) for i in range(60)]
    (tmp_path / "a.json").write_text(json.dumps(records, indent=indent, ensure_ascii=ascii_only))
    assert elements(spark, tmp_path / "a.json") == expected(records)


def test_files_are_read_apart(spark, tmp_path, small_blocks):
    parts = [TRICKY, [], TRICKY[:1], [{"z": "}" * 50}]]
    for i, part in enumerate(parts):
        (tmp_path / f"{i}.json").write_text(" \n" + json.dumps(part) + "\n\n")
    (tmp_path / "nothing.json").write_text("")
    assert elements(spark, tmp_path) == expected([r for part in parts for r in part])


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    records = [{"store_id": str(i), "address": "x" * 200, "units": []} for i in range(5000)]
    (tmp_path / "a.json").write_text(json.dumps(records))  # one line
    changed = {"spark.sql.files.maxPartitionBytes": "200k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        scan = spark.read.option("lineSep", "}").text(str(tmp_path / "a.json"))
        assert scan.rdd.getNumPartitions() >= 5
        found = catalog.read_catalog(spark, str(tmp_path / "a.json"), "json")
        assert found.schema == STORES
        assert sorted(int(r.store_id) for r in found.select("store_id").collect()) == list(range(5000))
        assert json_array._pieces(spark, str(tmp_path / "a.json")).select("_part").distinct().count() > 1
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@pytest.mark.parametrize(
    "text",
    ['[{"a": 1}', '[{"a": 1', '[{"a": "1', '{"a": 1}', '{"a": 1}\n{"a": 2}\n', '[{"a": 1} {"a": 2}]', '[{"a": 1}, null]', "[5]", "x", '[{"a": 1}}]', '[{"a": 1}][{"a": 2}]',
     '[{"a": 1},]x', "null", '[{"a": 1}, [{"a": 2}]]', "[", "]"],
)
def test_anything_else_names_the_file(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    (tmp_path / "good.json").write_text(json.dumps(TRICKY))
    with pytest.raises(ValueError, match="bad.json"):
        json_array.read_elements(spark, str(tmp_path))


def test_a_broken_object_fails_its_reader(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"store_id": "1"}, {"store_id": x}]')
    with pytest.raises(Exception, match="broken JSON object in .*a.json"):
        catalog.read_catalog(spark, str(tmp_path / "a.json"), "json").collect()


_VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-9, 9) | st.text(alphabet='{}[],"\\: \nab', max_size=6),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(alphabet='{}"\\a', max_size=3), inner, max_size=3),
    max_leaves=8,
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.dictionaries(st.text(alphabet='{}"\\a', max_size=3), _VALUES, max_size=4), max_size=6), min_size=1, max_size=8))
def test_any_arrays(spark, tmp_path_factory, small_blocks, arrays):
    folder = tmp_path_factory.mktemp("arrays")
    for i, records in enumerate(arrays):
        (folder / f"{i}.json").write_text(json.dumps(records, indent=i % 3 or None))
    assert elements(spark, folder) == expected([r for records in arrays for r in records])
