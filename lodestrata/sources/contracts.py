"""Validation of JSON by a schema: the first fault with its path, or none."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.sources.tabular import json_fault

_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def _is(value: object, kind: str) -> bool:
    if kind == "integer":
        return isinstance(value, int) and not isinstance(value, bool)
    if kind == "number":
        return isinstance(value, int | float) and not isinstance(value, bool)
    return isinstance(value, _TYPES[kind])


def _same(a: object, b: object) -> bool:
    """Equal as JSON: true is not 1."""
    return json.dumps(a, sort_keys=True) == json.dumps(b, sort_keys=True)


def fault(value: object, schema: dict, at: str = "$") -> str | None:
    """`path: keyword` of the first fault: type, const, enum, anyOf, required, additionalProperties, bounds, uniqueItems or pattern, outer before inner."""
    kinds = schema.get("type")
    if kinds is not None and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return f"{at}: type"
    if "const" in schema and not _same(value, schema["const"]):
        return f"{at}: const"
    if "enum" in schema and not any(_same(value, x) for x in schema["enum"]):
        return f"{at}: enum"
    if "anyOf" in schema and all(fault(value, s, at) for s in schema["anyOf"]):
        return f"{at}: anyOf"
    if _is(value, "number"):
        if value < schema.get("minimum", value):
            return f"{at}: minimum"
        if value > schema.get("maximum", value):
            return f"{at}: maximum"
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            return f"{at}: minLength"
        if len(value) > schema.get("maxLength", len(value)):
            return f"{at}: maxLength"
        if "pattern" in schema and not re.search(schema["pattern"], value):
            return f"{at}: pattern"
    if isinstance(value, list):
        if len(value) < schema.get("minItems", 0):
            return f"{at}: minItems"
        if len(value) > schema.get("maxItems", len(value)):
            return f"{at}: maxItems"
        if schema.get("uniqueItems") and len({json.dumps(x, sort_keys=True) for x in value}) < len(value):
            return f"{at}: uniqueItems"
        for i, x in enumerate(value):
            if found := fault(x, schema.get("items", {}), f"{at}[{i}]"):
                return found
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for name in schema.get("required", ()):
            if name not in value:
                return f"{at}.{name}: required"
        for name, x in value.items():
            if name not in known and schema.get("additionalProperties") is False:
                return f"{at}.{name}: additionalProperties"
            if found := fault(x, known.get(name, {}), f"{at}.{name}"):
                return found
    return None


def text_fault(text: str | None, schema: dict) -> str | None:
    """The same for a JSON text, which must be strict: no key twice, no NaN."""
    if found := json_fault(text):
        return f"$: {found}"
    return fault(json.loads(text), schema)


def faults(text: Column, schema: dict) -> Column:
    """The first fault of each JSON text; null where there is none."""

    @F.pandas_udf(T.StringType())
    def check(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: text_fault(t, schema))

    return check(text)


def valid(df: DataFrame, text: str, schema: dict) -> DataFrame:
    """df, or an error with the first faults: a contract never drops rows."""
    bad = df.select(faults(F.col(text), schema).alias("fault")).where("fault is not null").limit(5).collect()
    if bad:
        raise ValueError("; ".join(r.fault for r in bad))
    return df
