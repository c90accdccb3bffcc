"""Triads, the review fix-point, and outputs that appear together."""

import os
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from sparkledger.operators.triads import oriented, triads
from sparkledger.plans.fill import Context
from sparkledger.plans.review import reviewed
from sparkledger.sources import commit


def test_triads_with_hubs(spark):
    rng = random.Random(3)
    pairs = {tuple(sorted(rng.sample(range(40), 2))) for _ in range(160)}
    pairs |= {(100, n) for n in range(40)} | {(101, n) for n in range(40)} | {(100, 101)}  # two hubs that all know
    given = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in pairs] + [(5, 5), (None, 3), (3, 100), (100, 3)]
    edges = spark.createDataFrame(given, "a int, b int")
    links = {frozenset(p) for p in pairs}
    nodes = sorted({n for p in pairs for n in p})
    want = sorted(t for t in combinations(nodes, 3) if all(frozenset(p) in links for p in combinations(t, 2)))
    assert sorted(map(tuple, triads(edges).collect())) == want
    most = oriented(edges).groupBy("lo").count().agg(F.max("count")).first()[0]
    assert most <= (2 * len(links)) ** 0.5
    assert triads(edges.limit(0)).count() == 0


RULES = [
    {"id": "A", "kind": "required_when", "level": "warning", "blocking": True, "when": {"field": "kind", "equals": "x"}, "require": ["note"]},
    {"id": "B", "kind": "required_when", "level": "warning", "when": {"field": "validation_outcome", "equals": "pending_review"}, "require": ["note"]},
]


def test_review_takes_two_rounds_and_is_stable(spark):
    rows = spark.createDataFrame([(1, "x", None), (2, "x", "n"), (3, None, None)], "k int, kind string, note string")
    got = reviewed(rows, Context(), ["warning_codes", "validation_outcome"], RULES).orderBy("k")
    told = [(r["warning_codes"], r["validation_outcome"], r["review_rounds"], r["review_settled"]) for r in got.collect()]
    # the second warning comes with the first round's outcome; the codes of the second round are those of a third
    assert told == [(["RULE_A", "RULE_B"], "pending_review", 2, True), ([], "machine_extracted", 2, True), ([], "machine_extracted", 2, True)]
    again = reviewed(got.drop("issues", "review_rounds", "review_settled"), Context(), ["warning_codes", "validation_outcome"], RULES).orderBy("k")
    assert [(r["warning_codes"], r["validation_outcome"]) for r in again.collect()] == [t[:2] for t in told]


def test_review_of_records_that_do_not_settle(spark):
    flip = [{"id": "C", "kind": "required_when", "level": "warning", "blocking": True, "when": {"field": "validation_outcome", "equals": "machine_extracted"}, "require": ["note"]}]
    rows = spark.createDataFrame([(1, None)], "k int, note string")
    row = reviewed(rows, Context(), ["warning_codes", "validation_outcome"], flip).first()
    assert row["review_rounds"] == 3 and not row["review_settled"]
    given = spark.createDataFrame([(1, [("DATASET", "warning", None, None, True)])], "k int, pre array<struct<code:string,severity:string,path:string,rule_id:string,blocking:boolean>>")
    row = reviewed(given, Context(), ["warning_codes", "validation_outcome"], [], before="pre").first()
    assert row["warning_codes"] == ["DATASET"] and row["validation_outcome"] == "pending_review"
    with pytest.raises(ValueError, match="second phase"):
        reviewed(rows, Context(), ["record_id"], [])


def test_outputs_appear_together(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    rows = spark.range(100).select("id", F.concat(F.lit("t"), "id").alias("text"), F.array("id").alias("list"))
    first = commit.commit_outputs({"records": (rows, "parquet"), "errors": (rows.limit(0), "json"), "table": (rows, "csv")}, path, facts={"contract": "1.0.0"})
    assert {n: o["rows"] for n, o in first["outputs"].items()} == {"records": 100, "errors": 0, "table": 100}
    assert commit.read_output(spark, path, "records").count() == 100 and commit.read_output(spark, path, "table").count() == 100
    assert commit.committed(spark, path) == first and commit.problems(spark, path) == []
    kept = sorted(os.listdir(f"{tmp_path}/out"))

    bad = rows.withColumn("text", F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="broken"):
        commit.commit_outputs({"records": (rows.limit(5), "parquet"), "errors": (bad, "json")}, path)
    assert sorted(os.listdir(f"{tmp_path}/out")) == kept  # nothing is left of the run that failed
    assert commit.committed(spark, path) == first and commit.read_output(spark, path, "records").count() == 100

    second = commit.commit_outputs({"records": (rows.limit(5), "parquet")}, path)
    assert second["order"] == 2 and commit.read_output(spark, path, "records").count() == 5 and commit.problems(spark, path) == []
    with pytest.raises(FileNotFoundError):
        commit.read_output(spark, path, "errors")
    rows.limit(3).write.mode("append").parquet(f"{path}/{second['run']}/records")
    assert commit.problems(spark, path) == ["records"]
    assert commit.committed(spark, f"{path}/none") is None
    with pytest.raises(ValueError, match="nothing"):
        commit.commit_outputs({}, path)
