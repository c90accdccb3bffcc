"""Dependency order against plain rounds, and the workflow view with every flag on record-shaped rows."""

import random

from pyspark.sql import functions as F

from sparkledger.operators import workflow as W
from sparkledger.operators.graphs import reachable, topological_layers
from sparkledger.plans.store import stored


def plain_layers(nodes, edges):
    deps = {n: {o for s, o in edges if s == n and o in nodes} for n in nodes}
    out, layer = {}, 0
    while ready := [n for n, d in deps.items() if not d]:
        for n in ready:
            out[n] = layer
            del deps[n]
        for d in deps.values():
            d.difference_update(ready)
        layer += 1
    return {n: out.get(n) for n in nodes}


def layers_of(spark, nodes, edges):
    rounds = []

    def store(df):
        rounds.append(1)
        return stored(df, "layers")

    found = topological_layers(spark.createDataFrame([(n,) for n in nodes], "node long"), spark.createDataFrame(edges, "s long, o long"), store).collect()
    assert len(found) == len(nodes) and all(r["cyclic"] == (r["layer"] is None) for r in found)
    return {r["node"]: r["layer"] for r in found}, (len(rounds) - 1) // 2


def test_layers_of_mixed_graphs(spark):
    rng = random.Random(4)
    parts, edges = [], []
    for k in range(14):  # many small graphs in one table: trees, ladders, rings, rings with tails
        base, n = 100 * k, rng.randint(3, 14)
        parts += range(base, base + n)
        for a in range(1, n):
            edges += [(base + a, base + rng.randrange(a)) for _ in range(rng.choice([0, 1, 1, 2]))]
        if k % 3 == 0:
            edges += [(base + rng.randrange(n), base + rng.randrange(n)) for _ in range(2)]
    edges += [(5, 77_777), (5, 77_777), *edges[:10]]
    got, _ = layers_of(spark, parts, edges)
    assert got == plain_layers(parts, edges)


def test_a_long_chain_takes_few_rounds(spark):
    n = 2_000
    got, rounds = layers_of(spark, range(n), [(i, i - 1) for i in range(1, n)])
    assert got == {i: i for i in range(n)} and rounds <= 14
    assert layers_of(spark, [1, 2], [])[0] == {1: 0, 2: 0}


RECORDS = [
    ("bg", "background", None), ("q", "research_question", None), ("q2", "research_question", None), ("obj", "objective", None), ("h1", "hypothesis", None), ("h2", "hypothesis", None), ("cross", None, "method"),
    ("map", None, "method"), ("select", None, "method"), ("idle", None, "method"), ("r1", None, "analysis_result"), ("r2", None, "analysis_result"), ("seen", None, "plot"), ("gap", None, "claim"), ("end", "conclusion", "claim"),
    ("end2", "conclusion", "claim"), ("a", None, "method"), ("b", None, "method"), ("tool", None, "asset"), ("linked", None, "asset"),
]
LINKS = [
    ("h1", "addresses", "q"), ("h1", "addresses", "obj"), ("r1", "tests", "h1"), ("map", "tests", "h1"), ("h2", "addresses", "q"), ("map", "prerequisite", "cross"), ("select", "prerequisite", "cross"), ("r1", "method", "map"), ("r1", "prerequisite", "select"),
    ("end", "evidence", "r1"), ("a", "prerequisite", "b"), ("b", "prerequisite", "a"), ("r2", "prerequisite", "a"), ("gap", "evidence", "gone"), ("linked", "method", "map"), ("linked", "method", "map"),
]


def view_of(spark, sets=("p",)):
    rows = [(s, i, k, role, kind, kind == "plot", f"label {i}") for s in sets for k, (i, role, kind) in enumerate(RECORDS)]
    rows += [(s, "seen", 90, "result", None, False, "again") for s in sets[:0]] + [(sets[0], None, 99, "step", None, False, None)]
    records = spark.createDataFrame(rows, "set string, id string, position int, role string, kind string, is_unit boolean, label string")
    links = spark.createDataFrame([(s, *x) for s in sets for x in LINKS], "set string, id string, type string, target string")
    return W.workflow_view(records, links, lambda df: stored(df, "workflow"))


def test_view_flags_order_branches_and_traces(spark):
    view = view_of(spark, ("p", "other"))
    rows = {r["id"]: r for r in view.nodes.where("`set` = 'p'").collect()}
    assert rows.keys() == {r[0] for r in RECORDS} - {"tool"}
    assert {i: r["stage"] for i, r in rows.items() if i in ("seen", "gap", "linked", "cross", "r1", "end")} == {"seen": "observation", "gap": "statement", "linked": "statement", "cross": "step", "r1": "result", "end": "conclusion"}
    want = {
        "q2": ["QUESTION_UNADDRESSED"], "h2": ["HYPOTHESIS_UNTESTED"], "idle": ["STEP_WITHOUT_OUTPUT"], "r2": ["DEPENDENCY_CYCLE"], "a": ["DEPENDENCY_CYCLE"], "b": ["DEPENDENCY_CYCLE"], "gap": ["UNRESOLVED_LINK"], "end2": ["CONCLUSION_WITHOUT_EVIDENCE"],
    }
    assert {i: r["flags"] for i, r in rows.items() if r["flags"]} == want
    assert {r["id"]: r["flags"] for r in W.workflow_audit(view).where("`set` = 'other'").collect()} == want
    assert {r["id"] for r in view.branch_points().where("`set` = 'p'").collect()} == {"cross", "a"}
    order = [r["id"] for r in view.step_order().where("`set` = 'p'").orderBy("layer", "position").collect()]
    assert order == ["cross", "map", "select", "r1"]
    traces = {(r["hypothesis"], r["relation"], r["record"]) for r in view.traces.where("`set` = 'p'").collect()}
    assert traces == {("h1", "addresses", "q"), ("h1", "addresses", "obj"), ("h1", "tested_by", "r1"), ("h1", "tested_by", "map"), ("h2", "addresses", "q")}
    counts = {(r["what"], r["name"]): r["n"] for r in W.workflow_counts(view).where("`set` = 'p'").collect()}
    assert counts["edge", "prerequisite"] == 6 and counts["total", "links"] == len(LINKS) and counts["total", "links_unresolved"] == 1
    assert counts["flag", "DEPENDENCY_CYCLE"] == 3 and counts["total", "hypotheses"] == 2 and counts["total", "steps_ordered"] == 4 and counts["stage", "step"] == 6


def test_repeated_ids_and_foreign_targets(spark):
    schema = "set string, id string, position int, role string, kind string, is_unit boolean"
    records = spark.createDataFrame([("p", "x", 1, "hypothesis", None, False), ("p", "x", 5, "result", None, False), ("other", "y", 1, "step", None, False)], schema)
    links = spark.createDataFrame([("p", "x", "method", "y")], "set string, id string, type string, target string")
    rows = W.workflow_view(records, links, lambda df: stored(df, "workflow")).nodes.orderBy("id").collect()
    assert [(r["id"], r["position"], r["stage"], r["flags"]) for r in rows] == [("x", 1, "result", ["UNRESOLVED_LINK", "RESULT_WITHOUT_METHOD"]), ("y", 1, "step", ["STEP_WITHOUT_OUTPUT"])]
    empty = W.workflow_view(records.limit(0), links.limit(0), lambda df: stored(df, "workflow"))
    assert empty.nodes.count() == 0 and W.workflow_counts(empty).count() == 0


def test_reachable_from_some_starts(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(8)], "s long, o long")
    got = {(r["start"], r["node"]) for r in reachable(edges, 3, spark.createDataFrame([(2,)], "start long")).collect()}
    assert got == {(2, 3), (2, 4), (2, 5)} and reachable(edges, 2).where(F.col("depth") > 2).count() == 0
