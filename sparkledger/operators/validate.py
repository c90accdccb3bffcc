"""Structural validation of raw JSON records against a contract's fields, vocabulary checks, and verdicts.

Raw records stay VARIANT until they are judged, so that unknown keys, explicit nulls and wrong types can be told apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rules import ISSUE, issue

#: JSON types that satisfy a field type; an integer may be printed with a zero fraction.
_VARIANT = {"string": "STRING", "integer": "BIGINT", "number": "DOUBLE", "boolean": "BOOLEAN", "array_string": "ARRAY<STRING>", "object_string": "MAP<STRING,STRING>"}


def _path(*names: str) -> str:
    return "$" + "".join(f"['{n}']" for n in names)


def structural_issues(document: Column, fields: list[dict]) -> Column:
    """array<issue> of a VARIANT record: unknown keys, missing required fields, explicit nulls, types, enums, limits.

    fields: dicts with path (group.name or name), type, and optionally required, enum, pattern, minimum, maximum, min_length,
    min_items."""
    known: dict[str | None, list[str]] = {None: []}
    cells = []
    for f in fields:
        group, _, name = f["path"].rpartition(".")
        known.setdefault(group or None, []).append(name)
        if group and group not in known[None]:
            known[None].append(group)
        at = _path(*f["path"].split("."))
        raw = F.try_variant_get(document, at, "VARIANT")
        given = F.schema_of_variant(raw)
        absent = raw.isNull()
        value = F.try_variant_get(document, at, _VARIANT[f["type"]])
        kind = {"string": given == "STRING", "integer": given.rlike("^(BIGINT|DECIMAL|DOUBLE)") & (F.try_variant_get(document, at, "DOUBLE") % 1 == 0), "number": given.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), "boolean": given == "BOOLEAN", "array_string": given.rlike("^ARRAY<(STRING|VOID)>"), "object_string": given.rlike("^OBJECT")}[f["type"]]
        ok = F.coalesce(kind, F.lit(False))
        path = F.lit(f["path"])
        if f.get("required"):
            cells.append(F.when(absent, issue("SCHEMA_REQUIRED", "error", path)))
        cells.append(F.when(~absent & ~ok, issue("SCHEMA_TYPE", "error", path)))
        if f.get("enum"):
            cells.append(F.when(ok & ~value.isin(*f["enum"]), issue("SCHEMA_ENUM", "error", path)))
        if f.get("pattern"):
            cells.append(F.when(ok & ~value.rlike(f["pattern"]), issue("SCHEMA_PATTERN", "error", path)))
        if "minimum" in f:
            cells.append(F.when(ok & (value < f["minimum"]), issue("SCHEMA_MINIMUM", "error", path)))
        if "maximum" in f:
            cells.append(F.when(ok & (value > f["maximum"]), issue("SCHEMA_MAXIMUM", "error", path)))
        if f["type"] == "string":
            cells.append(F.when(ok & (F.length(value) < f.get("min_length", 1)), issue("SCHEMA_MINLENGTH", "error", path)))
            cells.append(F.when(ok & (F.length(value) > 0) & (F.trim(value) == ""), issue("VALUE_BLANK", "warning", path)))
        if f["type"] == "array_string":
            cells.append(F.when(ok & (F.size(value) < f.get("min_items", 1)), issue("SCHEMA_MINITEMS", "error", path)))
        if f["type"] == "number":
            cells.append(F.when(ok & (F.isnan(value) | (F.abs(value) == float("inf"))), issue("VALUE_NOT_FINITE", "error", path)))
    found = F.array_compact(F.array(*cells)) if cells else F.array().cast(f"array<{ISSUE}>")
    text = F.to_json(document)
    for group, names in known.items():
        keys = F.json_object_keys(text if group is None else F.get_json_object(text, _path(group)))
        extra = F.array_except(F.coalesce(keys, F.array().cast("array<string>")), F.array(*map(F.lit, names)))
        prefix = "" if group is None else f"{group}."
        found = F.concat(found, F.transform(F.array_sort(extra), lambda k: issue("SCHEMA_UNKNOWN_FIELD", "error", F.concat(F.lit(prefix), k))))
    return found


def vocabulary_issues(path: str, codes: list[str], deprecated: dict[str, str] | None = None, severity: str = "warning") -> Column:
    """array<issue> for a code column: unknown codes, and deprecated ones (an open vocabulary passes no codes)."""
    value = F.col(path)
    cells = [F.when(value.isNotNull() & ~value.isin(*codes), issue("VOCAB_UNKNOWN_CODE", severity, F.lit(path)))] if codes else []
    if deprecated:
        cells.append(F.when(value.isin(*deprecated), issue("VOCAB_CODE_DEPRECATED", "warning", F.lit(path))))
    return F.array_compact(F.array(*cells)) if cells else F.array().cast(f"array<{ISSUE}>")


def deprecated_fields(paths: list[str]) -> Column:
    return F.array_compact(F.array(*(F.when(F.col(p).isNotNull(), issue("FIELD_DEPRECATED", "warning", F.lit(p))) for p in paths)))


def valid(issues: str | Column) -> Column:
    return ~F.exists(issues, lambda i: i["severity"] == "error")


def with_own_version(records: DataFrame, version: str, by_version: dict[str, Column]) -> DataFrame:
    """Adds ``issues`` of each record's own declared version; an unknown version is an error of its own."""
    column = F.array(issue("SCHEMA_VERSION_MISMATCH", "error", F.lit(version)))
    for name, issues in by_version.items():
        column = F.when(F.col(version) == name, issues).otherwise(column)
    return records.withColumn("issues", column)
