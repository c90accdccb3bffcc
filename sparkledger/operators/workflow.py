"""The research workflow of record sets: nodes and typed links, dependency order, branch points, flags, traces and counts.

A node is a record with a stage: the role that its statement plays, or what its kind says.  A link has one of five types:
``evidence``, ``method``, ``tests``, ``addresses`` and ``prerequisite``.  Everything is told of one record *set* (a paper);
many sets go through the same joins, keyed by (set, id), and no step gathers a set in one place.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graphs import topological_layers

#: The stages that kinds stand for, and the codes of the flags.
KIND_STAGES = {"method": "step", "analysis_result": "result", "claim": "statement", "observation": "observation"}
FLAGS = (
    "UNRESOLVED_LINK", "HYPOTHESIS_UNTESTED", "QUESTION_UNADDRESSED", "CONCLUSION_WITHOUT_EVIDENCE", "RESULT_WITHOUT_METHOD", "STEP_WITHOUT_OUTPUT", "DEPENDENCY_CYCLE",
)


@dataclasses.dataclass
class Workflow:
    """nodes (set, id, position, stage, kind, layer, cyclic, branch, flags, and what records carry beside), edges (set, s,
    type, o, unresolved), traces (set, hypothesis, relation, record)."""

    nodes: DataFrame
    edges: DataFrame
    traces: DataFrame

    def step_order(self) -> DataFrame:
        """Records joined by prerequisites that can be ordered: sorted by layer, then position, each after what it needs."""
        return self.nodes.where("layer IS NOT NULL").select("set", "id", "layer", "position")

    def branch_points(self) -> DataFrame:
        return self.nodes.where("branch").select("set", "id", "position")


def stage_of(role: Column, kind: Column, is_unit: Column) -> Column:
    """The role, else the stage of the kind, else observation where the kind's grain is a unit of observation."""
    by_kind = F.coalesce(*[F.when(kind == k, F.lit(s)) for k, s in KIND_STAGES.items()])
    return F.coalesce(role, by_kind, F.when(is_unit, F.lit("observation")))


def _either(*found: Column) -> Column:
    out = F.lit(False)
    for c in found:
        out = out | F.coalesce(c, F.lit(False))
    return out


def workflow_view(records: DataFrame, links: DataFrame, store: Callable[[DataFrame], DataFrame]) -> Workflow:
    """records (set, id, position, role, kind, is_unit, ...), links (set, id, type, target).

    Records without stage and links are no nodes.  Of records that repeat an id within a set the last one counts, at the
    first one's position; links of all of them count.  A link that leads outside its set's nodes is unresolved and leaves no
    other mark.  Rows without an id are left out."""
    extra = [c for c in records.columns if c not in ("set", "id", "position", "role", "kind", "is_unit")]
    named = records.where("id IS NOT NULL").select("set", "id", "position", "kind", stage_of(F.col("role"), F.col("kind"), F.col("is_unit")).alias("stage"), *extra)
    last = named.groupBy("set", "id").agg(F.min("position").alias("position"), F.max_by(F.struct("stage", "kind", *extra), "position").alias("own"))
    raw = store(links.where("id IS NOT NULL").select("set", F.col("id").alias("s"), "type", F.col("target").alias("o")))
    linked = raw.select("set", F.col("s").alias("id")).distinct().withColumn("linked", F.lit(True))
    rows = last.join(linked, ["set", "id"], "left").where("own.stage IS NOT NULL OR linked")
    nodes = store(rows.select("set", "id", "position", F.coalesce("own.stage", F.lit("statement")).alias("stage"), "own.kind", *[F.col(f"own.{c}").alias(c) for c in extra]))

    ids = nodes.select("set", F.col("id").alias("o"), F.lit(True).alias("held"))
    sources = nodes.select("set", F.col("id").alias("s"))
    edges = raw.join(sources, ["set", "s"], "left_semi").join(ids, ["set", "o"], "left").select("set", "s", "type", "o", F.col("held").isNull().alias("unresolved"))
    edges = store(edges)
    held = edges.where("NOT unresolved")
    has = lambda kind: F.bool_or(F.col("type") == kind)
    incoming = held.groupBy("set", F.col("o").alias("id")).agg(has("tests").alias("_tested"), has("addresses").alias("_addressed"), has("method").alias("_cited"), has("prerequisite").alias("_needed"), F.count_distinct(F.when(F.col("type") == "prerequisite", F.col("s"))).alias("_users"))
    outgoing = edges.groupBy("set", F.col("s").alias("id")).agg(F.bool_or("unresolved").alias("_lost"), *[F.bool_or((F.col("type") == kind) & ~F.col("unresolved")).alias(f"_{kind}") for kind in ("evidence", "method", "prerequisite")])

    needs = held.where("type = 'prerequisite'")
    key = lambda name: F.struct("set", F.col(name).alias("id"))
    ordered = needs.select(key("s").alias("node")).unionByName(needs.select(key("o").alias("node")))
    layers = topological_layers(ordered, needs.select(key("s").alias("s"), key("o").alias("o")), store).select("node.set", "node.id", "layer", "cyclic")

    met = nodes.join(incoming, ["set", "id"], "left").join(outgoing, ["set", "id"], "left").join(layers, ["set", "id"], "left")
    c, stage = F.col, F.col("stage")
    judged = {
        "UNRESOLVED_LINK": _either(c("_lost")),
        "HYPOTHESIS_UNTESTED": (stage == "hypothesis") & ~_either(c("_tested")),
        "QUESTION_UNADDRESSED": stage.isin("research_question", "objective") & ~_either(c("_addressed"), c("_tested")),
        "CONCLUSION_WITHOUT_EVIDENCE": (stage == "conclusion") & ~_either(c("_evidence")),
        "RESULT_WITHOUT_METHOD": (stage == "result") & ~_either(c("_method"), c("_prerequisite")),
        "STEP_WITHOUT_OUTPUT": (stage == "step") & ~_either(c("_cited"), c("_needed")),
        "DEPENDENCY_CYCLE": _either(c("cyclic")),
    }
    flags = F.array_compact(F.array(*[F.when(judged[f], F.lit(f)) for f in FLAGS]))
    view = met.select("set", "id", "position", "stage", "kind", *extra, "layer", _either(c("cyclic")).alias("cyclic"), (F.coalesce("_users", F.lit(0)) > 1).alias("branch"), flags.alias("flags"))
    view = store(view)

    hypotheses = view.where("stage = 'hypothesis'").select("set", "id")
    out = edges.where("type IN ('addresses', 'evidence')").select("set", F.col("s").alias("id"), F.col("type").alias("relation"), F.col("o").alias("record"), "unresolved")
    out = out.where("NOT unresolved").drop("unresolved")
    into = held.where("type IN ('tests', 'addresses')").select("set", F.col("o").alias("id"), F.when(F.col("type") == "tests", "tested_by").otherwise("addressed_by").alias("relation"), F.col("s").alias("record"))
    traces = out.unionByName(into).join(hypotheses, ["set", "id"], "left_semi").select("set", F.col("id").alias("hypothesis"), "relation", "record")
    return Workflow(view, edges, traces)


def workflow_counts(view: Workflow) -> DataFrame:
    """(set, what, name, n): stages, edges by type, flags, links in all and unresolved, hypotheses, ordered steps."""
    row = lambda what, name: F.struct(F.lit(what).alias("what"), name.alias("name"))
    none = F.lit(None).cast("struct<what:string,name:string>")
    of_node = F.concat(
        F.array(row("stage", F.col("stage")), F.when(F.col("stage") == "hypothesis", row("total", F.lit("hypotheses"))).otherwise(none), F.when(F.col("layer").isNotNull(), row("total", F.lit("steps_ordered"))).otherwise(none)),
        F.transform("flags", lambda f: row("flag", f)),
    )
    of_edge = F.array(row("edge", F.col("type")), row("total", F.lit("links")), F.when(F.col("unresolved"), row("total", F.lit("links_unresolved"))).otherwise(none))
    told = view.nodes.select("set", F.explode(F.array_compact(of_node)).alias("r")).unionByName(view.edges.select("set", F.explode(F.array_compact(of_edge)).alias("r")))
    return told.groupBy("set", "r.what", "r.name").agg(F.count(F.lit(1)).alias("n"))


def workflow_audit(view: Workflow) -> DataFrame:
    """(set, id, stage, flags): the flagged records."""
    return view.nodes.where(F.size("flags") > 0).select("set", "id", "stage", "flags")
