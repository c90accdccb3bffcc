"""Nested schemas over VARIANT: objects, arrays of objects and leaves at any depth, each fault told by its path.

A schema is a dict in the manner of JSON Schema: type, properties, required, additionalProperties, items, enum, pattern,
minimum, maximum, minLength, minItems, and $ref into $defs.  It is turned into one Column, so documents are judged on the JVM
in the scan that reads them; arrays are walked by higher-order functions, whatever their length.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FAULT = "struct<path:string,code:string>"
#: Schemas that refer to themselves are followed so far.
DEPTH = 16
_KINDS = {"object": "^OBJECT", "array": "^ARRAY", "string": "^STRING$", "boolean": "^BOOLEAN$", "null": "^VOID$", "number": "^(BIGINT|DECIMAL|DOUBLE|FLOAT)", "integer": "^(BIGINT|DECIMAL|DOUBLE|FLOAT)"}


def _fault(path: Column, code: str) -> Column:
    return F.struct(F.when(path == "", "<root>").otherwise(F.substring(path, 2, 1 << 20)).alias("path"), F.lit(code).alias("code"))


def _is(value: Column, kind: str) -> Column:
    fits = F.schema_of_variant(value).rlike(_KINDS[kind])
    return fits & (F.try_variant_get(value, "$", "DOUBLE") % 1 == 0) if kind == "integer" else fits


def _child(value: Column, name: str) -> Column:
    if "'" in name and '"' in name:
        raise ValueError(f"a path cannot name {name!r}")
    quote = '"' if "'" in name else "'"
    return F.try_variant_get(value, f"$[{quote}{name}{quote}]", "VARIANT")


def _faults(value: Column, path: Column, schema: dict, defs: dict, depth: int) -> list[Column]:
    """Columns of arrays of faults of a value that may be missing (null: nothing to judge)."""
    seen = 0
    while "$ref" in schema:
        schema, seen = defs[schema["$ref"].rpartition("/")[2]], seen + 1
        if seen > DEPTH:
            raise ValueError("a reference leads to itself")
    if depth > DEPTH:
        raise ValueError(f"the schema is deeper than {DEPTH}")
    there = value.isNotNull()
    kinds = [schema["type"]] if isinstance(schema.get("type"), str) else list(schema.get("type", ()))
    one = lambda bad, code, at=path: F.when(there & F.coalesce(bad, F.lit(False)), _fault(at, code))
    cells = []
    if kinds:
        fits = F.lit(False)
        for kind in kinds:
            fits = fits | F.coalesce(_is(value, kind), F.lit(False))
        cells.append(one(~fits, "TYPE"))
    text, number = F.try_variant_get(value, "$", "STRING"), F.try_variant_get(value, "$", "DOUBLE")
    if "enum" in schema:
        own = F.lit(False)
        for x in schema["enum"]:
            own = own | (_is(value, "null") if x is None else _is(value, "boolean") & (text == str(x).lower()) if isinstance(x, bool) else _is(value, "string") & (text == x) if isinstance(x, str) else _is(value, "number") & (number == x))
        cells.append(one(~F.coalesce(own, F.lit(False)), "ENUM"))
    if "pattern" in schema:
        cells.append(one(_is(value, "string") & ~text.rlike(schema["pattern"]), "PATTERN"))
    if "minLength" in schema:
        cells.append(one(_is(value, "string") & (F.length(text) < schema["minLength"]), "MIN_LENGTH"))
    if "minimum" in schema:
        cells.append(one(_is(value, "number") & (number < schema["minimum"]), "MINIMUM"))
    if "maximum" in schema:
        cells.append(one(_is(value, "number") & (number > schema["maximum"]), "MAXIMUM"))
    items = F.try_variant_get(value, "$", "ARRAY<VARIANT>")
    if "minItems" in schema:
        cells.append(one(_is(value, "array") & (F.size(items) < schema["minItems"]), "MIN_ITEMS"))
    for name in schema.get("required", ()):
        cells.append(one(_is(value, "object") & _child(value, name).isNull(), "REQUIRED", F.concat(path, F.lit(f"/{name}"))))
    parts = [F.array_compact(F.array(*cells))] if cells else []
    properties = schema.get("properties", {})
    if schema.get("additionalProperties") is False:
        known = F.array(*[F.lit(n) for n in properties]) if properties else F.array().cast("array<string>")
        more = F.array_except(F.map_keys(F.try_variant_get(value, "$", "MAP<STRING,VARIANT>")), known)
        parts.append(F.when(F.coalesce(_is(value, "object"), F.lit(False)), F.transform(F.array_sort(more), lambda n: _fault(F.concat(path, F.lit("/"), n), "ADDITIONAL"))))
    for name, own in properties.items():
        parts += _faults(F.when(F.coalesce(_is(value, "object"), F.lit(False)), _child(value, name)), F.concat(path, F.lit(f"/{name}")), own, defs, depth + 1)
    if "items" in schema:
        walked = F.transform(items, lambda x, i: _all(_faults(x, F.concat(path, F.lit("/"), i.cast("string")), schema["items"], defs, depth + 1)))
        parts.append(F.when(F.coalesce(_is(value, "array"), F.lit(False)), F.flatten(walked)))
    return parts


def _all(parts: list[Column]) -> Column:
    none = F.array().cast(f"array<{FAULT}>")
    return F.concat(none, *[F.coalesce(p, none) for p in parts])


def envelope_faults(document: Column, schema: dict) -> Column:
    """array<struct<path, code>> of a VARIANT document; empty if it is valid, null if the document itself is null.

    Paths are names and places from 0, joined by slashes; ``<root>`` is the document."""
    return F.when(document.isNotNull(), _all(_faults(document, F.lit(""), schema, schema.get("$defs", {}), 0)))


def envelope_faults_of_text(text: Column, schema: dict) -> Column:
    """The same of JSON text; text that is no JSON has the fault NOT_JSON at its root."""
    parsed = F.try_parse_json(text)
    broken = F.array(_fault(F.lit(""), "NOT_JSON"))
    return F.when(text.isNotNull(), F.when(parsed.isNull(), broken).otherwise(envelope_faults(parsed, schema)))
