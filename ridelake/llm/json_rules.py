"""Checking values against JSON schemas of any form, as far as the rules below go; what a schema does not say is allowed.

Known rules: ``type`` (a name or a list of names), ``enum``, ``const``, ``minimum``, ``maximum``, ``exclusiveMinimum``,
``exclusiveMaximum``, ``minLength``, ``maxLength``, ``pattern``, ``required``, ``properties``, ``additionalProperties``, ``items``,
``minItems``, ``maxItems``, ``anyOf``, ``oneOf``, ``allOf``. Other rules, unknown type names, patterns that are none, and
rules whose own value is of the wrong form are passed over. Fields that are not among the ``properties`` of an object are a problem unless
``additionalProperties`` allows them; an object without ``properties`` may hold any.
"""

import operator
import re
from functools import lru_cache

KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list, "null": type(None)}


def _is(value, kind: str) -> bool:
    return isinstance(value, KINDS[kind]) and (kind == "boolean" or not isinstance(value, bool))


def same(a, b) -> bool:
    """Equality of JSON values: 1 is 1.0 but not true."""
    if isinstance(a, bool) or isinstance(b, bool):
        return a is b
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(same(v, b[k]) for k, v in a.items())
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(same, a, b))
    return a == b


@lru_cache(maxsize=1000)
def _pattern(text: str) -> re.Pattern | None:
    try:
        return re.compile(text)
    except re.error:
        return None


def _rule(schema: dict, name: str, form):
    """A rule's own value, or None if it is not of its form."""
    own = schema.get(name)
    return own if isinstance(own, form) and (form is bool or not isinstance(own, bool)) else None


def _of_type(value, schema: dict, name: str) -> list[str]:
    kinds = schema.get("type")
    kinds = [kind for kind in (kinds if isinstance(kinds, list) else [kinds]) if isinstance(kind, str) and kind in KINDS]
    return [f"{name} is no {' or '.join(kinds)}"] if kinds and not any(_is(value, kind) for kind in kinds) else []


BOUNDS = {"minimum": operator.ge, "maximum": operator.le, "exclusiveMinimum": operator.gt, "exclusiveMaximum": operator.lt}


def _in_range(value, schema: dict) -> bool:
    bounds = {rule: _rule(schema, rule, (int, float)) for rule in BOUNDS}
    return all(bound is None or BOUNDS[rule](value, bound) for rule, bound in bounds.items())


def _length_fits(value, schema: dict, least: str, most: str) -> bool:
    low, high = _rule(schema, least, int), _rule(schema, most, int)
    return (low is None or len(value) >= low) and (high is None or len(value) <= high)


def _of_object(value: dict, schema: dict, path: str) -> list[str]:
    def at(field):
        return f"{path}.{field}" if path else str(field)

    found = [f"{at(field)} is missing" for field in _rule(schema, "required", list) or [] if field not in value]
    properties, more = _rule(schema, "properties", dict), schema.get("additionalProperties")
    for field, own in sorted(value.items()):
        if properties is not None and field in properties:
            found += broken_rules(own, properties[field], at(field))
        elif isinstance(more, dict):
            found += broken_rules(own, more, at(field))
        elif more is False or (properties is not None and more is not True):
            found.append(f"{at(field)} is unknown")
    return found


def _of_any(value, schema: dict, path: str, name: str) -> list[str]:
    """``allOf``, ``anyOf`` and ``oneOf``."""
    found = [problem for option in _rule(schema, "allOf", list) or [] for problem in broken_rules(value, option, path)]
    for rule in ("anyOf", "oneOf"):
        options = _rule(schema, rule, list)
        if options:
            fits = sum(not broken_rules(value, option, path) for option in options)
            if not fits or (rule == "oneOf" and fits > 1):
                found.append(f"{name} is {'none' if not fits else 'several'} of its forms")
    return found


def broken_rules(value, schema, path: str = "") -> list[str]:
    """What a schema forbids about a value, by the path of the field."""
    if schema is False:
        return [f"{path or 'value'} is not allowed"]
    if not isinstance(schema, dict):
        return []
    name = path or "value"
    if wrong := _of_type(value, schema, name):
        return wrong
    found = []
    options = _rule(schema, "enum", list)
    if (options is not None and not any(same(value, option) for option in options)) or (
        "const" in schema and not same(value, schema["const"])
    ):
        found.append(f"{name} is none of its values")
    elif _is(value, "number") and not _in_range(value, schema):
        found.append(f"{name} is out of range")
    elif isinstance(value, str):
        if not _length_fits(value, schema, "minLength", "maxLength"):
            found.append(f"{name} is too short or too long")
        shape = _rule(schema, "pattern", str)
        if shape is not None and (rule := _pattern(shape)) and not rule.search(value):
            found.append(f"{name} has not its form")
    elif isinstance(value, list):
        if not _length_fits(value, schema, "minItems", "maxItems"):
            found.append(f"{name} has too few or too many items")
        for i, own in enumerate(value):
            found += broken_rules(own, schema.get("items"), f"{path}[{i}]")
    elif isinstance(value, dict):
        found += _of_object(value, schema, path)
    return found + _of_any(value, schema, path, name)
