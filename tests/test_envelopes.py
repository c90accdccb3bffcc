"""Nested schemas against documents with one fault each."""

import json

import pytest
from pyspark.sql import functions as F

from sparkledger.operators.envelopes import envelope_faults_of_text

SCHEMA = {
    "type": "object", "required": ["id", "runs"], "additionalProperties": False,
    "properties": {
        "id": {"type": "string", "minLength": 2}, "ok": {"enum": [True, None, 3]},
        "runs": {"type": "array", "minItems": 1, "items": {"type": "object", "required": ["steps"], "properties": {"steps": {"type": "array", "items": {"type": "object", "properties": {"score": {"type": "number", "maximum": 1}, "it's": {"type": ["boolean", "null"]}}}}}}},
    },
}
GOOD = {"id": "ab", "ok": True, "runs": [{"steps": [{"score": 0.5, "it's": None}, {"score": 1}]}, {"steps": []}]}


def test_faults_are_told_by_their_path(spark):
    def changed(**own):
        return json.dumps({**GOOD, **own})

    cases = [
        (json.dumps(GOOD), []), (changed(ok=None), []), (changed(ok=3), []), (changed(ok=False), ["ok ENUM"]), (changed(ok="3"), ["ok ENUM"]), (changed(id="a"), ["id MIN_LENGTH"]), (changed(id=5), ["id TYPE"]), (changed(id=None), ["id TYPE"]), (changed(runs=[]), ["runs MIN_ITEMS"]),
        (changed(runs={}), ["runs TYPE"]), (changed(runs=[1, {"steps": []}, {}]), ["runs/0 TYPE", "runs/2/steps REQUIRED"]), (changed(runs=[{"steps": [{}, {"score": 0}, {"score": "x"}, {"score": 1.5, "it's": 0}]}]), ["runs/0/steps/2/score TYPE", "runs/0/steps/3/score MAXIMUM", "runs/0/steps/3/it's TYPE"]),
        (changed(more=1, extra=2), ["extra ADDITIONAL", "more ADDITIONAL"]), (json.dumps({"id": "ab"}), ["runs REQUIRED"]), ("[]", ["<root> TYPE"]), ("{", ["<root> NOT_JSON"]), (None, None),
    ]
    rows = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(cases)], "k int, t string")
    got = {r["k"]: r["f"] for r in rows.select("k", envelope_faults_of_text(F.col("t"), SCHEMA).alias("f")).collect()}
    for k, (text, want) in enumerate(cases):
        assert (got[k] if got[k] is None else sorted(f"{f['path']} {f['code']}" for f in got[k])) == (want if want is None else sorted(want)), text


def test_references(spark):
    loop = {"$ref": "#/$defs/a", "$defs": {"a": {"$ref": "#/$defs/a"}}}
    with pytest.raises(ValueError, match="itself"):
        envelope_faults_of_text(F.lit("{}"), loop)
    deep = {"$ref": "#/$defs/a", "$defs": {"a": {"type": "object", "properties": {"a": {"$ref": "#/$defs/a"}}}}}
    with pytest.raises(ValueError, match="deeper"):
        envelope_faults_of_text(F.lit("{}"), deep)
