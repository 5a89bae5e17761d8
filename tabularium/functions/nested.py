"""JSON text, arrays and maps. JSON objects with string values are handled as maps of text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.operators import ordered

KEEP_NULLS = {"ignoreNullFields": "false"}
_TEXT_MAP = "map<string,string>"


def json_object(**fields: Column) -> Column:
    """JSON text with the fields in the given order; NULL fields stay as JSON null."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), KEEP_NULLS)


def event_envelope(event_type: str, version: int, occurred_at: Column, data: Mapping[str, Column]) -> Column:
    at = F.date_format(occurred_at, "yyyy-MM-dd'T'HH:mm:ss")
    body = F.struct(*[c.alias(n) for n, c in data.items()])
    return json_object(event_type=F.lit(event_type), event_version=F.lit(version), occurred_at=at, data=body)


def json_text(doc: Column, path: str) -> Column:
    return F.get_json_object(doc, path)


def json_number(doc: Column, path: str) -> Column:
    return F.try_variant_get(F.try_parse_json(doc), path, "double")


def has_key(doc: Column, key: str) -> Column:
    """True for a present key, also when its value is JSON null."""
    return F.array_contains(F.json_object_keys(doc), key)


def contains_fields(doc: Column, wanted: Mapping[str, str]) -> Column:
    test = F.lit(True)
    for key, value in wanted.items():
        test = test & F.coalesce(F.get_json_object(doc, f"$.{key}") == value, F.lit(False))
    return test


def as_map(doc: Column) -> Column:
    return F.from_json(doc, _TEXT_MAP)


def json_each(df: DataFrame, doc: str) -> DataFrame:
    """One row per top-level field: `key`, `value` as text."""
    rest = [c for c in df.columns if c != doc]
    return df.select(*rest, F.explode(as_map(F.col(doc))).alias("key", "value"))


def _fields(doc: Column) -> Column:
    """Top-level fields, each with its value as JSON text."""
    return F.transform_values(F.from_json(doc, "map<string,variant>"), lambda _, v: F.coalesce(F.to_json(v), F.lit("null")))


def _written(fields: Column) -> Column:
    """JSON object from fields whose values are JSON text; types stay as they are, and so does a JSON null."""
    parts = F.transform(F.map_entries(fields), lambda e: F.concat(_quoted(e["key"]), F.lit(":"), e["value"]))
    return F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))


def _quoted(text: Column) -> Column:
    whole = F.to_json(F.struct(text.alias("k")))
    return F.substring(whole, F.lit(6), F.length(whole) - 6)


def merge(left: Column, right: Column) -> Column:
    """Fields of both objects; the right side wins, also with a JSON null."""
    return _written(F.map_zip_with(_fields(left), _fields(right), lambda _, x, y: F.coalesce(y, x)))


def set_field(doc: Column, path: str | Sequence[str], value: Column) -> Column:
    """The document with `value`, as JSON of its type, at a key or a path of keys; objects on the way are made."""
    first, *rest = [path] if isinstance(path, str) else path
    fields = _fields(doc)
    if rest:
        inner = F.element_at(fields, first)
        inner = F.when(F.json_object_keys(inner).isNotNull(), inner).otherwise(F.lit("{}"))
        new = set_field(inner, rest, value)
    else:
        whole = F.to_json(F.struct(value.alias("v")), KEEP_NULLS)
        new = F.substring(whole, F.lit(6), F.length(whole) - 6)
    kept = F.map_filter(fields, lambda k, _: k != first)
    return _written(F.map_concat(kept, F.create_map(F.lit(first), new)))


def drop_field(doc: Column, path: str | Sequence[str]) -> Column:
    """The document without a key, or without the key at the end of a path."""
    first, *rest = [path] if isinstance(path, str) else path
    fields = _fields(doc)
    if not rest:
        return _written(F.map_filter(fields, lambda k, _: k != first))
    changed = lambda k, v: F.when((k == first) & F.json_object_keys(v).isNotNull(), drop_field(v, rest)).otherwise(v)
    return _written(F.transform_values(fields, changed))


def null_kind(doc: Column, key: str) -> Column:
    """How a field is missing: sql_null (no document), absent, json_null, or value."""
    return (F.when(doc.isNull(), "sql_null").when(~F.coalesce(has_key(doc, key), F.lit(False)), "absent")
            .when(F.get_json_object(doc, f"$.{key}").isNull(), "json_null").otherwise("value"))


def explode_records(df: DataFrame, doc: str, schema: str) -> DataFrame:
    """Rows of a JSON array of objects, typed by a DDL schema of one element."""
    rest = [c for c in df.columns if c != doc]
    return df.select(*rest, F.inline(F.from_json(F.col(doc), f"array<struct<{schema}>>")))


def json_arrays(df: DataFrame, keys: Sequence[str], order: Sequence[str], element: Column, name: str,
                chunk: int = 1000) -> DataFrame:
    """Ordered JSON arrays per key, cut in chunks so that no array holds an unbounded group."""
    return ordered.in_chunks(df, keys, order, element, name, chunk).withColumn(name, F.to_json(name, KEEP_NULLS))


def matrix_get(matrix: Column, row: int, col: int) -> Column:
    """Element of a nested array, counted from 1."""
    return F.element_at(F.element_at(matrix, row), col)


def valid_event(doc: Column) -> Column:
    """Required fields present, `data` an object, `event_type` not empty."""
    required = [F.coalesce(has_key(doc, k), F.lit(False)) for k in ("event_type", "occurred_at", "data")]
    data_is_object = F.json_object_keys(F.get_json_object(doc, "$.data")).isNotNull()
    typed = F.coalesce(F.get_json_object(doc, "$.event_type") != "", F.lit(False))
    return required[0] & required[1] & required[2] & data_is_object & typed
