"""Structural repair: every action on made candidates, and values that stay as they are."""

import json

import pytest

from sparkledger.operators.repair import Form, repaired_candidates, repaired_documents

FORM = Form(
    fields={
        "common.title": {"type": "string", "role": "document"}, "common.year": {"type": "integer", "role": "document"}, "value.total": {"type": "number", "role": "extract"}, "value.share_percent": {"type": "number", "role": "extract"},
        "value.count": {"type": "integer", "role": "extract"}, "value.names": {"type": "array_string", "role": "extract", "vocabulary": "crop"}, "value.crop": {"type": "string", "role": "extract", "vocabulary": "crop"}, "value.done": {"type": "boolean", "role": "extract"},
        "value.label": {"type": "string", "role": "extract"}, "other.label": {"type": "string", "role": "extract"}, "common.record_id": {"type": "string", "role": "computed"},
    },
    known=("common.secret",), evidence={"page": "common.source_page", "quote": "common.source_quote", "section": "common.source_section"}, kinds=("claim", "Method"), links=("supports",),
    vocabularies={"crop": {"RICE": ["rice", "Reis"], "OAT": ["Straße"]}},
)


def repair(spark, *candidates):
    texts = [c if c is None or isinstance(c, str) else json.dumps(c) for c in candidates]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, candidate string")
    return [r.asDict(recursive=True) for r in repaired_candidates(rows, "candidate", FORM).orderBy("n").collect()]


def plain(values):
    return {k: (v["type"], v["text"]) for k, v in values.items()}


def steps(row):
    return [(s["action"], s["key"], s["to"]) for s in row["repairs"]]


def test_fields_are_typed_named_and_placed(spark):
    fields = {
        "value": {"total": "1,234.50", "share_percent": "85 %", "count": 7.0, "names": "rice"}, "crop": " REIS ", "done": "True", "label": "x", "value.label": 5, "common.title": "T", "year": "1,999",
        "common.record_id": "r", "common.secret": "s", "unknown": 1, "a.b": 2, "other.label": "  ", "common.source_quote": " said ", "common.source_page": "3",
    }
    row = repair(spark, {"record_kind": " CLAIM ", "fields": fields, "evidence": {"page": "12"}})[0]
    assert row["kept"] and row["record_kind"] == "claim"
    assert plain(row["fields"]) == {"value.total": ("number", "1234.5"), "value.share_percent": ("number", "85"), "value.count": ("number", "7"), "value.names": ("array", '["RICE"]'), "value.crop": ("string", "RICE"), "value.done": ("boolean", "true"), "value.label": ("string", "5")}
    assert plain(row["overrides"]) == {"common.title": ("string", "T"), "common.year": ("number", "1999")}
    assert plain(row["evidence"]) == {"page": ("number", "12"), "quote": ("string", "said")}
    told = steps(row)
    assert told[0] == ("normalized_record_kind", " CLAIM ", "claim")
    for step in [
        ("coerced_type", "evidence.page", "12"), ("coerced_type", "value.total", "1234.5"), ("coerced_type", "value.share_percent", "85"), ("coerced_type", "value.names", '["rice"]'), ("mapped_vocabulary_label", "value.names", '["RICE"]'),
        ("resolved_bare_field_name", "crop", "value.crop"), ("mapped_vocabulary_label", "value.crop", "RICE"), ("dropped_ambiguous_field_name", "label", None), ("coerced_type", "value.label", "5"), ("document_field_override", "common.title", None),
        ("dropped_field", "common.record_id", "computed_by_pipeline"), ("dropped_field", "common.secret", "not_in_profile"), ("dropped_unknown_field", "unknown", None), ("dropped_unknown_field", "a.b", None), ("dropped_empty_value", "other.label", None), ("moved_to_evidence", "quote", None), ("resolved_bare_field_name", "year", "common.year"),
    ]:
        assert step in told, step
    assert ("moved_to_evidence", "page", None) not in told


def test_evidence_references_and_links(spark):
    many = {"record_kind": "rumour", "evidence": {"common.source_quote": 5, "nope": "x", "section": {"a": 1}, "page": [2]}, "ref": "a b", "links": {"supports": ["r1", " r1", 2, "", {}], "bad": "x"}}
    odd = {"record_kind": 3, "fields": [1], "evidence": "text", "ref": 7, "links": {"supports": {"a": 1}}}
    rows = repair(spark, many, odd, {"links": [1], "evidence": {}, "ref": None}, {})
    assert rows[0]["record_kind"] == "rumour" and plain(rows[0]["evidence"]) == {"quote": ("string", "5"), "page": ("array", "[2]")}
    assert rows[0]["ref"] is None and rows[0]["links"] == {"supports": ["r1", "2"]}
    assert sorted(steps(rows[0])) == sorted([("renamed_evidence_key", "common.source_quote", "quote"), ("coerced_type", "evidence.quote", "5"), ("dropped_unknown_evidence_key", "nope", None), ("dropped_malformed_evidence_value", "evidence.section", None), ("dropped_malformed_ref", "a b", None), ("dropped_unknown_link", "bad", None)])
    assert rows[1]["record_kind"] is None and rows[1]["ref"] == "7" and rows[1]["fields"] == {} and rows[1]["links"] == {}
    assert steps(rows[1]) == [("dropped_malformed_evidence", "evidence", None), ("dropped_malformed_links", "supports", None)]
    assert steps(rows[2]) == [("dropped_malformed_links", "links", None)] and steps(rows[3]) == []


def test_what_is_no_candidate_and_what_stays(spark):
    rows = repair(spark, None, "", "no json", "[1]", {"fields": {"value.count": "12 apples", "value.total": "9" * 39, "value.names": ["Straße", 4, None, ""], "value.crop": "wheat", "value.done": 1}}, "{}")
    for row in rows[:4]:
        assert not row["kept"] and steps(row) == [("dropped_malformed_candidate", None, None)]
    assert plain(rows[4]["fields"]) == {"value.count": ("string", "12 apples"), "value.total": ("string", "9" * 39), "value.names": ("array", '["OAT","4"]'), "value.crop": ("string", "wheat"), "value.done": ("number", "1")}
    empty = spark.createDataFrame([], "candidate string, extra int")
    assert repaired_candidates(empty, "candidate", FORM).count() == 0
    with pytest.raises(ValueError, match="ref"):
        repaired_candidates(spark.createDataFrame([], "candidate string, ref int"), "candidate", FORM)


def test_documents(spark):
    rows = spark.createDataFrame([(1, json.dumps({"title": "T", "common.year": "", "total": 3, "common": {"year": 2001.0}})), (2, None)], "n int, d string")
    got = [r.asDict(recursive=True) for r in repaired_documents(rows, "d", FORM).orderBy("n").collect()]
    assert plain(got[0]["document"]) == {"common.title": ("string", "T"), "common.year": ("number", "2001")}
    assert ("dropped_non_document_field", "value.total", None) in steps(got[0]) and ("dropped_empty_value", "common.year", None) in steps(got[0])
    assert got[1]["document"] == {} and steps(got[1]) == []
