"""The workflow of each conversation: turns are records, and what a turn rests on are its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import workflow as W
from ..plans.store import stored
from .registry import Tables, query

_SQL = """
WITH t AS (
  SELECT conv_id, turn, conv_id || '/' || turn AS id, CASE role WHEN 'system' THEN 'background' WHEN 'user' THEN CASE WHEN turn % 3 = 0 THEN 'hypothesis' ELSE 'research_question' END END AS role,
    CASE WHEN role = 'assistant' THEN CASE WHEN turn % 4 = 1 THEN 'analysis_result' ELSE 'method' END ELSE 'claim' END AS kind
  FROM conversations
), n AS (SELECT conv_id, turn, id, coalesce(role, CASE kind WHEN 'analysis_result' THEN 'result' WHEN 'method' THEN 'step' ELSE 'statement' END) AS stage, kind FROM t),
l AS (
  SELECT conv_id, id AS s, 'prerequisite' AS type, conv_id || '/' || (turn - 1) AS o FROM t
  UNION ALL SELECT conv_id, id, 'prerequisite', conv_id || '/0' FROM t WHERE turn % 5 = 0 AND turn > 1
  UNION ALL SELECT conv_id, id, 'prerequisite', conv_id || '/2' FROM t WHERE conv_id % 7 = 0 AND turn = 1
  UNION ALL SELECT conv_id, id, 'tests', conv_id || '/' || (turn - 1) FROM t WHERE turn % 2 = 1
  UNION ALL SELECT conv_id, id, 'addresses', conv_id || '/' || (turn - 2) FROM t WHERE turn % 4 = 3
), e AS (SELECT l.*, n.id IS NULL AS unresolved FROM l LEFT JOIN n ON n.id = l.o),
u AS (SELECT o AS id, bool_or(type = 'tests') AS tested, bool_or(type = 'addresses') AS addressed, bool_or(type = 'prerequisite') AS needed, count(DISTINCT s) FILTER (type = 'prerequisite') AS users FROM e WHERE NOT unresolved GROUP BY 1),
g AS (SELECT s AS id, bool_or(unresolved) AS lost, bool_or(type = 'prerequisite' AND NOT unresolved) AS needs FROM e GROUP BY 1),
c AS (SELECT conv_id, min(turn) AS first, conv_id % 7 = 0 AND bool_or(turn = 1) AND bool_or(turn = 2) AS looped FROM t GROUP BY 1),
v AS (
  SELECT n.conv_id, n.id, n.turn AS position, n.stage, n.kind,
    CASE WHEN (coalesce(needs, false) OR coalesce(needed, false)) AND NOT (looped AND n.turn >= 1) THEN CAST(n.turn - first AS INTEGER) END AS layer,
    looped AND n.turn >= 1 AS cyclic, coalesce(users, 0) > 1 AS branch,
    list_filter([CASE WHEN coalesce(lost, false) THEN 'UNRESOLVED_LINK' END, CASE WHEN stage = 'hypothesis' AND NOT coalesce(tested, false) THEN 'HYPOTHESIS_UNTESTED' END,
      CASE WHEN stage = 'research_question' AND NOT coalesce(tested OR addressed, false) THEN 'QUESTION_UNADDRESSED' END, CASE WHEN stage = 'result' AND NOT coalesce(needs, false) THEN 'RESULT_WITHOUT_METHOD' END,
      CASE WHEN stage = 'step' AND NOT coalesce(needed, false) THEN 'STEP_WITHOUT_OUTPUT' END, CASE WHEN looped AND n.turn >= 1 THEN 'DEPENDENCY_CYCLE' END], lambda x: x IS NOT NULL) AS flags
  FROM n JOIN c USING (conv_id) LEFT JOIN u ON u.id = n.id LEFT JOIN g ON g.id = n.id
)
"""


def _view(spark, sf_dir: str) -> W.Workflow:
    t = Tables(spark, sf_dir).conversations
    turn, node = F.col("turn"), lambda n: F.concat_ws("/", F.col("conv_id"), n)
    role = F.when(F.col("role") == "system", "background").when(F.col("role") == "user", F.when(turn % 3 == 0, "hypothesis").otherwise("research_question"))
    kind = F.when(F.col("role") == "assistant", F.when(turn % 4 == 1, "analysis_result").otherwise("method")).otherwise("claim")
    records = t.select(F.col("conv_id").alias("set"), node(turn).alias("id"), turn.alias("position"), role.alias("role"), kind.alias("kind"), F.lit(False).alias("is_unit"))
    link = lambda on, kind, target: F.when(on, F.struct(F.lit(kind).alias("type"), node(target).alias("target")))
    own = F.array(
        link(F.lit(True), "prerequisite", turn - 1), link((turn % 5 == 0) & (turn > 1), "prerequisite", F.lit(0)), link((F.col("conv_id") % 7 == 0) & (turn == 1), "prerequisite", F.lit(2)),
        link(turn % 2 == 1, "tests", turn - 1), link(turn % 4 == 3, "addresses", turn - 2),
    )
    links = t.select(F.col("conv_id").alias("set"), node(turn).alias("id"), F.explode(F.array_compact(own)).alias("l")).select("set", "id", "l.type", "l.target")
    return W.workflow_view(records, links, lambda df: stored(df, "workflow"))


@query("workflow_view", _SQL + "SELECT conv_id, id, position, stage, kind, layer, cyclic, branch, array_to_string(flags, ',') AS flags FROM v")
def workflow_view(t: Tables) -> DataFrame:
    """Every node with its stage, place in the order of dependencies, branch points and flags."""
    return _view(t.spark, t.sf_dir).nodes.select(F.col("set").alias("conv_id"), "id", "position", "stage", "kind", "layer", "cyclic", "branch", F.array_join("flags", ",").alias("flags"))


@query("workflow_audit", _SQL + "SELECT conv_id, id, stage, array_to_string(flags, ',') AS flags FROM v WHERE len(flags) > 0")
def workflow_audit(t: Tables) -> DataFrame:
    return W.workflow_audit(_view(t.spark, t.sf_dir)).select(F.col("set").alias("conv_id"), "id", "stage", F.array_join("flags", ",").alias("flags"))


@query("workflow_counts", _SQL + "SELECT conv_id, what, name, count(*) AS n FROM (SELECT conv_id, 'stage' AS what, stage AS name FROM v UNION ALL SELECT conv_id, 'total', 'hypotheses' FROM v WHERE stage = 'hypothesis' UNION ALL SELECT conv_id, 'total', 'steps_ordered' FROM v WHERE layer IS NOT NULL UNION ALL SELECT conv_id, 'flag', unnest(flags) FROM v UNION ALL SELECT conv_id, 'edge', type FROM e UNION ALL SELECT conv_id, 'total', 'links' FROM e UNION ALL SELECT conv_id, 'total', 'links_unresolved' FROM e WHERE unresolved) GROUP BY ALL")
def workflow_counts(t: Tables) -> DataFrame:
    return W.workflow_counts(_view(t.spark, t.sf_dir)).withColumnRenamed("set", "conv_id")


@query("workflow_traces", _SQL + "SELECT e.conv_id, h.id AS hypothesis, CASE WHEN e.type = 'tests' THEN 'tested_by' ELSE 'addressed_by' END AS relation, e.s AS record FROM e JOIN v h ON h.id = e.o AND h.stage = 'hypothesis' WHERE e.type IN ('tests', 'addresses') UNION ALL SELECT e.conv_id, h.id, e.type, e.o FROM e JOIN v h ON h.id = e.s AND h.stage = 'hypothesis' WHERE e.type IN ('addresses', 'evidence') AND NOT unresolved")
def workflow_traces(t: Tables) -> DataFrame:
    """What each hypothesis addresses and what tests or addresses it."""
    return _view(t.spark, t.sf_dir).traces.withColumnRenamed("set", "conv_id")
