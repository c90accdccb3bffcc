"""Verdicts over records: every outcome, earlier codes, and records that would not be valid afterwards."""

import pytest

from sparkledger.operators import verdicts as V

RECORDS = "k string, status string, version int, qc_codes array<string>, note string"
RULES = [{"id": "N", "kind": "required_when", "level": "error", "when": {"field": "status", "equals": "model_verified"}, "require": ["note"]}]


def run(spark, records, tasks, verdicts, **more):
    args = {"verifier": "m2", "run": "r1", "rules": RULES} | more
    return V.verified(spark.createDataFrame(records, RECORDS), spark.createDataFrame(tasks, "task_id string, record_id string, kind string"), spark.createDataFrame(verdicts, "task_id string, verdict string, ord int, reason string"), "k", **args)


def test_outcomes_codes_and_versions(spark):
    records = [
        ("a", "auto_validated", 1, None, "n"), ("b", "auto_validated", None, ["VERIFY_UNCERTAIN", "OLD"], "n"), ("c", "pending_review", 4, ["VERIFY_UNCERTAIN"], "n"), ("d", "expert_approved", 1, None, "n"),
        ("e", "auto_validated", 1, None, None), ("f", "auto_validated", 1, None, "n"), ("g", "auto_validated", 1, None, "n"), ("h", "imported", 1, None, "n"), (None, "auto_validated", 1, None, "n"), ("i", "auto_validated", 2, None, "n"),
    ]
    tasks = [("ta", "a", "record"), ("tb", "b", "record"), ("tb2", "b", "link"), ("tc", "c", "record"), ("td", "d", "record"), ("te", "e", "record"), ("tf", "f", "record"), ("tf2", "f", "link"), ("tg", "g", "record"), ("th", "h", "record")]
    verdicts = [("ta", "not_supported", 1, "old"), ("ta", "supported", 2, None), ("tb", "not_supported", 1, "why"), ("tb2", "not_supported", 1, None), ("tc", "supported", 1, None), ("td", "not_supported", 1, "no"), ("te", "supported", 1, None), ("tf", "supported", 1, None), ("th", "supported", 1, None), ("tg", "perhaps", 1, None), ("tg", None, 2, None), ("zz", "supported", 1, None)]
    done = run(spark, records, tasks, verdicts)
    got = {r["k"]: (r["outcome"], r["status"], r["version"], r["qc_codes"], r["verification_run"], r["errors"]) for r in done.records.collect()}
    assert got == {
        "a": ("promoted", "model_verified", 2, None, "r1", []),
        "b": ("demoted", "pending_review", 2, ["OLD", "VERIFY_FIELD_NOT_SUPPORTED", "VERIFY_LINK_NOT_SUPPORTED"], "r1", []),
        "c": ("confirmed_pending", "pending_review", 5, ["VERIFY_UNCERTAIN"], "r1", []),
        "d": ("skipped_expert_reviewed", "expert_approved", 1, None, None, []),
        "e": ("invalid_after", "auto_validated", 1, None, None, ["RULE_N"]),
        "f": ("partially_verified", "auto_validated", 2, None, "r1", []),
        "g": ("unverified", "auto_validated", 1, None, None, []),
        "h": ("unchanged", "imported", 2, None, "r1", []),
        "i": ("no_tasks", "auto_validated", 2, None, None, []),
        None: ("no_tasks", "auto_validated", 1, None, None, []),
    }
    assert sorted(map(tuple, done.findings.collect())) == [("tb", "b", "record", "not_supported", "why"), ("tb2", "b", "link", "not_supported", None)]
    assert sorted(map(tuple, done.problems.collect())) == [("tg", "unknown_verdict"), ("tg", "unknown_verdict"), ("zz", "unknown_task")]
    counts = {(r["measure"], r["value"]): r["n"] for r in done.report().collect()}
    assert counts["outcome", "no_tasks"] == 2 and counts["before", "auto_validated"] == 7 and counts["after", "model_verified"] == 1


def test_a_verifier_that_extracted_confirms_nothing(spark):
    rows = [("a", "auto_validated", 1, None, "n")]
    done = run(spark, rows, [("ta", "a", "record")], [("ta", "supported", 1, None)], extractor="m2").records.first()
    assert (done["outcome"], done["status"], done["version"]) == ("withheld_same_model", "auto_validated", 2)
    empty = run(spark, rows, [("ta", "a", "record")], [])
    assert empty.records.first()["outcome"] == "unverified" and empty.findings.count() == empty.problems.count() == 0
    with pytest.raises(ValueError, match="outcome"):
        V.verified(spark.sql("SELECT 1 AS k, '' AS outcome"), empty.findings, empty.findings, "k", verifier="m", run="r")


def test_conflicts_of_known_records(spark):
    told = spark.createDataFrame([(1, ["a", "b"], "x"), (2, ["a"], "x"), (3, ["a", "z"], "x"), (4, ["a", None], "x"), (5, ["b", "b"], None), (6, None, "x")], "conflict_id int, record_ids array<string>, reason string")
    known = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    assert sorted(r["conflict_id"] for r in V.conflict_candidates(told, known, "k").collect()) == [1, 5]
