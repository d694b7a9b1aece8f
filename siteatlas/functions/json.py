"""Reading JSON text while keeping *missing*, *null* and *wrong type* apart, as SQL fragments.

``from_json`` gives values (the last of duplicate keys wins), ``json_object_keys`` tells a missing key
from a null one and an object from anything else, and the variant type tells a string from a number.
All functions take and return SQL text, for use inside lambdas over arrays.
"""

from __future__ import annotations

# The JSON texts that count as false.
FALSY = "('', 'false', '0', '0.0', '-0.0', '[]', '{}')"

_STRICT = "map('allowSingleQuotes', 'false', 'columnNameOfCorruptRecord', '_bad')"


def fields(text: str, names: str) -> str:
    """A struct of string fields (``names`` blank-separated) plus ``_bad``, set if malformed."""
    columns = ", ".join(f"{name} STRING" for name in (*names.split(), "_bad"))
    return f"from_json({text}, '{columns}', {_STRICT})"


def typed(text: str, schema: str) -> str:
    """The text read with a schema; null if malformed or, for lists, if an element does not fit."""
    return f"from_json({text}, '{schema}', {_STRICT})"


def typed_field(text: str, name: str, schema: str) -> str:
    """One field of an object, read with a schema."""
    return f"from_json({text}, '{name} {schema}, _bad STRING', {_STRICT}).{name}"


def parsed(text: str, names: str) -> str:
    """A struct of the field values ``v`` and the ``keys``, null unless the text is an object."""
    return f"struct({fields(text, names)} AS v, json_object_keys({text}) AS keys)"


def has(parsed_text: str, name: str) -> str:
    return f"coalesce(array_contains({parsed_text}.keys, '{name}'), false)"


def type_is(variant: str, path: str, name: str, unknown: bool) -> str:
    """Whether the value at ``path`` has the type; ``unknown`` where duplicate keys hide it."""
    found = f"schema_of_variant(try_variant_get({variant}, '{path}', 'variant'))"
    return f"coalesce({found} = '{name}', {str(unknown).lower()})"


def truthy(text: str) -> str:
    """Truthiness of a JSON scalar kept as text."""
    return f"({text} IS NOT NULL AND {text} NOT IN {FALSY})"
