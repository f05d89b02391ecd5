"""Schemas of any form, checked by hand-made values."""

import pytest

from ridelake.llm.json_rules import broken_rules

FORMS = [
    ({}, {"any": 1}, []),
    (True, 5, []),
    (False, 5, ["value is not allowed"]),
    (None, 5, []),
    ({"enum": ["a", 1]}, True, ["value is none of its values"]),
    ({"enum": ["a", 1]}, 1.0, []),
    ({"enum": [[1, {"x": None}]]}, [1, {"x": None}], []),
    ({"const": None}, 0, ["value is none of its values"]),
    ({"type": ["integer", "null"]}, None, []),
    ({"type": ["integer", "null"]}, "1", ["value is no integer or null"]),
    ({"type": ["integer", "null"]}, True, ["value is no integer or null"]),
    ({"type": "anything"}, 3, []),
    ({"type": 5, "minimum": "low"}, 3, []),
    ({"type": "object"}, {"any": 1}, []),
    ({"required": ["a"]}, {}, ["a is missing"]),
    ({"properties": {"a": {"enum": [1]}}}, {"a": 2, "b": 3}, ["a is none of its values", "b is unknown"]),
    ({"properties": {"a": {}}, "additionalProperties": True}, {"b": 3}, []),
    ({"properties": {"a": {}}, "additionalProperties": {"type": "string"}}, {"b": 3}, ["b is no string"]),
    ({"additionalProperties": False}, {"b": 3}, ["b is unknown"]),
    ({"properties": {"o": {"properties": {"l": {"items": {"type": "number"}}}}}}, {"o": {"l": [1, "x"]}}, ["o.l[1] is no number"]),
    ({"minimum": 2, "exclusiveMaximum": 5}, 5, ["value is out of range"]),
    ({"minimum": 2, "exclusiveMaximum": 5}, 2, []),
    ({"exclusiveMinimum": 2.5}, 2, ["value is out of range"]),
    ({"maximum": 10**400}, 5.0, []),
    ({"minimum": 1}, "text", []),
    ({"minLength": 2, "maxLength": 3}, "abcd", ["value is too short or too long"]),
    ({"pattern": "^a+$"}, "aab", ["value has not its form"]),
    ({"pattern": "("}, "aab", []),
    ({"minItems": 1, "maxItems": 2}, [], ["value has too few or too many items"]),
    ({"anyOf": [{"type": "string"}, {"minimum": 3}]}, 2, ["value is none of its forms"]),
    ({"oneOf": [{"type": "integer"}, {"minimum": 3}]}, 4, ["value is several of its forms"]),
    ({"allOf": [{"type": "integer"}, {"minimum": 3}]}, 2, ["value is out of range"]),
]


@pytest.mark.parametrize(("schema", "value", "problems"), FORMS)
def test_forms_of_schemas(schema, value, problems):
    assert broken_rules(value, schema) == problems
