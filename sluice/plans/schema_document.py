"""Declared schemas: a JSON document to a StructType, by way of Spark's own schema JSON."""

from __future__ import annotations

import json

from pyspark.sql import types as T

# Type names a schema document may use, and what Spark's schema JSON calls them.
TYPE_NAMES = {
    "string": "string",
    "integer": "integer",
    "int": "integer",
    "long": "long",
    "short": "short",
    "byte": "byte",
    "float": "float",
    "double": "double",
    "boolean": "boolean",
    "binary": "binary",
    "date": "date",
    "timestamp": "timestamp",
    "null": "void",
    "daytimeinterval": "interval day to second",
    "yearmonthinterval": "interval year to month",
    "variant": "variant",
}

# Members of Spark's JSON that are types themselves, and those that may be left out.
_TYPES_WITHIN = ("elementType", "keyType", "valueType")
_DEFAULTS = {
    "field": {"nullable": True, "metadata": {}},
    "array": {"containsNull": True},
    "map": {"valueContainsNull": True},
    "decimal": {"precision": 10, "scale": 0},
}


def schema_from(document: str | dict) -> T.StructType:
    """StructType of a document `{"fields": [{"name", "type", "nullable"}, ..]}`."""
    parsed = json.loads(document) if isinstance(document, str) else document
    return T.StructType.fromJson(_spark_json({"type": "struct", "fields": parsed["fields"]}))


def schema_from_file(path: str) -> T.StructType:
    with open(path, encoding="utf-8") as f:
        return schema_from(f.read())


def data_type(node: str | dict) -> T.DataType:
    """A type name, or an object whose `type` is a name, struct, array, map or decimal."""
    return T.StructType.fromJson(_spark_json({"type": "struct", "fields": [{"name": "v", "type": node}]}))["v"].dataType


def _spark_json(node: str | dict) -> str | dict:
    """A type of the document as Spark writes it."""
    kind = (node.get("type", "") if isinstance(node, dict) else node).lower()
    if kind in TYPE_NAMES:
        return TYPE_NAMES[kind]
    if not isinstance(node, dict) or kind not in ("struct", "array", "map", "decimal"):
        raise ValueError(f"Unsupported type: {node}")
    full = _DEFAULTS.get(kind, {}) | node | {"type": kind}
    if kind == "decimal":
        return f"decimal({full['precision']},{full['scale']})"
    if kind == "struct":
        return {"type": kind, "fields": [_spark_field(f) for f in node["fields"]]}
    return {m: _spark_json(v) if m in _TYPES_WITHIN else v for m, v in full.items()}


def _spark_field(field: dict) -> dict:
    return _DEFAULTS["field"] | {"name": field["name"], "type": _spark_json(field["type"])} | {"nullable": field.get("nullable", True)}
