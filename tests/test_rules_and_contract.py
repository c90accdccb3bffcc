"""Rules with a passing, a failing and a missing case each; contracts, releases, differences."""

import json
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import sparkledger.contract
from sparkledger.api import validate_records
from sparkledger.contract.model import ContractError, change_step, checked, compiled, release, resolved
from sparkledger.operators import rules as R

SAMPLE = Path(sparkledger.contract.__file__).parent / "sample"
GOOD = {"common": {"record_id": "rec_" + "0" * 32, "record_kind": "claim", "source_id": "doi:1", "source_page": 1, "source_quote": "it grows"}}


def change(**cells):
    record = json.loads(json.dumps(GOOD))
    for path, value in cells.items():
        group, name = path.split("__")
        if value is ...:
            record[group].pop(name)
        else:
            record.setdefault(group, {})[name] = value
    return record


CASES = [
    (GOOD, set()),
    (change(common__source_id=...), {"SCHEMA_REQUIRED"}),
    (change(common__source_page=None), {"SCHEMA_TYPE", "RULE_S1"}),
    (change(common__source_page=0), {"SCHEMA_MINIMUM"}),
    (change(common__source_page=3.0), set()),
    (change(common__source_page=3.5), {"SCHEMA_TYPE"}),
    (change(common__source_quote=""), {"SCHEMA_MINLENGTH"}),
    (change(common__source_quote="  "), {"VALUE_BLANK"}),
    (change(common__record_kind="rumour"), {"SCHEMA_ENUM"}),
    (change(common__record_id="x"), {"SCHEMA_PATTERN"}),
    (change(common__extra=1), {"SCHEMA_UNKNOWN_FIELD"}),
    (change(common__trait_names=[]), {"SCHEMA_MINITEMS"}),
    (change(common__trait_names="one"), {"SCHEMA_TYPE"}),
    (change(common__review_status="odd"), {"VOCAB_UNKNOWN_CODE"}),
    (change(common__source_quote=...), {"RULE_S1"}),
    (change(common__lower_value=1.0), {"RULE_S2"}),
    (change(common__lower_value=2.0, common__upper_value=1.0), {"RULE_S3"}),
    (change(common__lower_value=1.0, common__upper_value=2.0), set()),
    (change(common__record_grain="unit"), {"RULE_S4"}),
    (change(common__record_grain="evidence"), set()),
    (change(transform__subject="a", transform__object="b"), {"RULE_S5"}),
    (change(transform__subject="a"), set()),
    (change(common__source_id="file:/x"), {"RULE_S6"}),
    (change(common__source_quote="it may grow"), {"RULE_S7"}),
]


def test_invalid_cases(spark):
    raw = spark.createDataFrame([(i, json.dumps(r)) for i, (r, _) in enumerate(CASES)], "i int, raw string").withColumn("record", F.parse_json("raw"))
    judged = validate_records(raw, compiled(SAMPLE)).select("i", "valid", F.transform("issues", lambda x: x["code"]).alias("codes"), F.exists("issues", lambda x: x["severity"] == "error").alias("bad")).collect()
    for r in judged:
        assert set(r["codes"]) == CASES[r["i"]][1], CASES[r["i"]]
        assert r["valid"] != r["bad"]


def test_conditions_on_missing_fields_are_false(spark):
    rows = spark.createDataFrame([(1, "x", None), (2, None, ["may be"])], "i int, a string, b array<string>")
    holds = lambda c: [r["i"] for r in rows.where(R.condition(c, rows.schema)).collect()]
    assert holds({"field": "a", "equals": "x"}) == [1] and holds({"field": "a", "in": ["y"]}) == []
    assert holds({"field": "b", "matches": "may"}) == [2] and holds({"all": []}) == [1, 2] and holds({"any": []}) == []


def test_data_set_rules(spark):
    rows = spark.createDataFrame([(1, "a", "g", 1, ["a", "z"]), (2, "a", "g", 2, ["b"]), (3, None, "h", 1, None), (4, None, "h", None, None)], "o int, k string, g string, v int, l array<string>")
    assert [r["o"] for r in R.repeated_keys(rows, ["k"], ["o"]).collect()] == [2]
    assert [r["o"] for r in R.differs_from_first(rows, ["g"], "v", ["o"]).collect()] == [2]
    assert {(r["o"], tuple(r["links"])) for r in R.dangling(rows, ["o"], "l", rows, "k").collect()} == {(1, ("z",)), (2, ("b",))}


def test_rules_as_json_schema():
    assert R.json_schema({"kind": "required_when", "when": {"field": "a.b", "equals": 1}, "require": ["a.c"]})["if"]["required"] == ["a"]
    assert R.json_schema({"kind": "lte", "fields": ["a", "b"]}) is None


def test_releases_are_pinned(tmp_path):
    contract = compiled(SAMPLE)
    release(contract, tmp_path)
    assert resolved(str(tmp_path)).digest == contract.digest
    with pytest.raises(ContractError):
        release(contract, tmp_path)
    body = tmp_path / "1.0.0" / "contract.json"
    body.write_text(body.read_text().replace("evidence_locator", "other"))
    resolved.cache_clear()
    with pytest.raises(ContractError):
        resolved(str(tmp_path))


def test_change_steps_and_profiles():
    old = compiled(SAMPLE)
    extra = {"path": "common.note", "type": "string"}
    assert change_step(old, old)[0] == "none"
    assert change_step(old, replace(old, fields=(*old.fields, extra)))[0] == "minor"
    assert change_step(old, replace(old, fields=old.fields[1:]))[0] == "major"
    assert change_step(old, replace(old, fields=(*old.fields, extra | {"required": True})))[0] == "major"
    assert {f["path"].split(".")[0] for f in old.selected("base")} == {"common"}
    assert "common.split" not in {f["path"] for f in old.selected("extraction")} and old.profile("extraction")["fill"]
    with pytest.raises(ContractError):
        checked(replace(old, fields=(*old.fields, {"path": "common.record_id", "type": "string"})))


def test_contract_tables(spark):
    tables = compiled(SAMPLE).tables(spark)
    assert tables["rules"].count() == 7 and tables["codes"].where("vocabulary = 'kind'").count() == 3
