"""Filter trees, attribute filters and predicates, compiled to Columns that reach the scan."""

from __future__ import annotations

import re
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_ORDER = {">": lambda c, v: c > v, ">=": lambda c, v: c >= v, "<": lambda c, v: c < v, "<=": lambda c, v: c <= v}
_LEGACY = {"$eq": "==", "$ne": "!=", "$gt": ">", "$gte": ">=", "$lt": "<", "$lte": "<=", "$in": "in", "$nin": "not in"}
_ATTRIBUTE = {"eq": "==", "ne": "!=", "gt": ">", "gte": ">=", "lt": "<", "lte": "<=", "in": "in", "nin": "not in"}


def _moment(value) -> Column | None:
    """A date or time as a literal without zone; one with a zone is taken to UTC first, one without counts as UTC."""
    if isinstance(value, str) and re.match(r"\d{4}-\d{2}-\d{2}", value):
        try:
            value = datetime.fromisoformat(value)
        except ValueError:
            return None
    if not isinstance(value, datetime):
        return None
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def compare(field: Column, operator: str, value) -> Column:
    """A comparison that is never null: ordering with null is false, inequality with null is true.

    Dates and times, also as ISO strings, are compared as moments in UTC; a field with a zone is read in the session's.
    """
    if operator == "==":
        return field.isNull() if value is None else field.eqNullSafe(F.lit(value))
    if operator == "!=":
        return ~compare(field, "==", value)
    if operator in _ORDER:
        if value is None or isinstance(value, (list, tuple, dict)):
            raise ValueError(f"{operator} needs a scalar, not {value!r}")
        moment = _moment(value)
        return F.coalesce(_ORDER[operator](field if moment is None else field.cast("timestamp_ntz"), F.lit(value) if moment is None else moment), F.lit(False))
    if operator in ("in", "not in"):
        if not isinstance(value, (list, tuple)):
            raise ValueError(f"{operator} needs a list")
        known = [v for v in value if v is not None]
        inside = F.coalesce(field.isin(known), F.lit(False)) if known else F.lit(False)
        inside = inside | field.isNull() if None in value else inside
        return inside if operator == "in" else ~inside
    raise ValueError(f"unknown operator {operator}")


def compile_filter(tree: dict) -> Column:
    """A tree of ``{operator: AND|OR|NOT, conditions}`` over ``{field, operator, value}``; NOT denies the conjunction."""
    if "conditions" in tree:
        parts = [compile_filter(t) for t in tree["conditions"]]
        if not parts:
            raise ValueError("conditions are empty")
        if tree["operator"] == "OR":
            return reduce(lambda a, b: a | b, parts)
        both = reduce(lambda a, b: a & b, parts)
        if tree["operator"] == "AND":
            return both
        if tree["operator"] == "NOT":
            return ~both
        raise ValueError(f"unknown combinator {tree['operator']}")
    missing = {"field", "operator", "value"} - set(tree)
    if missing:
        raise ValueError(f"a comparison lacks {sorted(missing)}")
    return compare(F.col(tree["field"]), tree["operator"], tree["value"])


def from_legacy(tree: dict, field: str | None = None) -> dict:
    """``{"$and": {...}}`` mappings in the tree form."""
    parts = []
    for key, value in tree.items():
        if key in ("$and", "$or", "$not"):
            items = value if isinstance(value, list) else [{k: v} for k, v in value.items()]
            parts.append({"operator": key[1:].upper(), "conditions": [from_legacy(i, field) for i in items]})
        elif key in _LEGACY:
            parts.append({"field": field, "operator": _LEGACY[key], "value": value})
        elif isinstance(value, dict):
            parts.append(from_legacy(value, key))
        else:
            parts.append({"field": key, "operator": "in" if isinstance(value, list) else "==", "value": value})
    return parts[0] if len(parts) == 1 else {"operator": "AND", "conditions": parts}


def from_attributes(tree: dict) -> dict:
    """``{type: and|or, filters}`` over ``{type, key, value}`` in the tree form."""
    if "filters" in tree:
        return {"operator": tree["type"].upper(), "conditions": [from_attributes(t) for t in tree["filters"]]}
    return {"field": tree["key"], "operator": _ATTRIBUTE[tree["type"]], "value": tree["value"]}


def mask_filter(values: Column, mask: Column, emit_null: bool = False) -> Column:
    """Elements of an array whose mask is true; a null mask drops the element, or makes it null with ``emit_null``."""
    pairs = F.arrays_zip(values.alias("v"), mask.alias("m"))
    kept = F.filter(pairs, lambda p: p["m"] | p["m"].isNull()) if emit_null else F.filter(pairs, lambda p: p["m"])
    return F.transform(kept, lambda p: F.when(p["m"], p["v"]))


def string_check(operation: str, value: Column, reference) -> Column:
    reference = F.lit(reference)
    if operation == "eq":
        return value == reference
    if operation == "ne":
        return value != reference
    if operation == "like":
        return F.contains(value, reference)
    if operation == "ilike":
        return F.contains(F.lower(value), F.lower(reference))
    raise ValueError(f"unknown operation {operation}")


#: Number words (fixed values).
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion trillion"
).split()


def like_number(token: Column) -> Column:
    """Whether a token reads as a number: digits with separators, fractions, number words, ordinals in digits."""
    bare = F.regexp_replace(F.regexp_replace(token, r"^[+\-~±]", ""), "[,.]", "")
    return bare.rlike("^[0-9]+$") | bare.rlike("^[0-9]+/[0-9]+$") | F.lower(bare).isin(NUMBER_WORDS) | F.lower(bare).rlike("^[0-9]+(?:st|nd|rd|th)$")


def like_url(token: Column) -> Column:
    return token.rlike(r"^(?i)(?:https?|ftp)://[^\s/$.?#][^\s]*$") | token.rlike(r"^(?i)www\.[a-z0-9-]+(?:\.[a-z0-9-]+)+(?:/\S*)?$")
