"""Review fix-point, triads and label covers over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import markers as M
from ..operators.triads import triads_of_kinds
from ..plans.fill import Context
from ..plans.review import reviewed
from ..plans.store import stored
from .registry import Tables, query

#: The second warning reads a review field, the third one the codes that the second leaves: three rounds where all come.
_RULES = [
    {"id": "W1", "kind": "required_when", "level": "warning", "blocking": True, "when": {"field": "kind", "equals": "O"}, "require": ["note"]},
    {"id": "W2", "kind": "required_when", "level": "warning", "when": {"field": "validation_outcome", "equals": "pending_review"}, "require": ["reviewer"]},
    {"id": "W3", "kind": "required_when", "level": "warning", "when": {"field": "warning_codes", "matches": "W2"}, "require": ["checker"]},
]


@query("review_fix_point", """
WITH o AS (
  SELECT o_orderkey, o_orderstatus = 'O' AND o_custkey % 3 = 0 AS a, o_custkey % 2 = 0 AS b, o_orderkey % 5 = 0 AS c FROM orders
), w AS (SELECT o_orderkey, a, a AND b AS two, a AND b AND c AS three FROM o)
SELECT o_orderkey, array_to_string(list_filter([CASE WHEN a THEN 'RULE_W1' END, CASE WHEN two THEN 'RULE_W2' END, CASE WHEN three THEN 'RULE_W3' END], lambda x: x IS NOT NULL), ',') AS codes,
  CASE WHEN a THEN 'pending_review' ELSE 'machine_extracted' END AS outcome, CAST(CASE WHEN three THEN 3 ELSE 2 END AS INTEGER) AS rounds, true AS settled FROM w
""")  # fmt: skip
def review_fix_point(t: Tables) -> DataFrame:
    """Orders as records: warnings that depend on review fields, worked off until nothing changes."""
    records = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("kind"), F.when(F.col("o_custkey") % 3 != 0, "n").alias("note"), F.when(F.col("o_custkey") % 2 != 0, "r").alias("reviewer"), F.when(F.col("o_orderkey") % 5 != 0, "c").alias("checker"))
    rows = reviewed(records, Context(), ["warning_codes", "validation_outcome"], _RULES)
    return rows.select("o_orderkey", F.array_join("warning_codes", ",").alias("codes"), F.col("validation_outcome").alias("outcome"), F.col("review_rounds").alias("rounds"), F.col("review_settled").alias("settled"))


@query("network_triads", """
WITH l AS (SELECT DISTINCT 'p' || l_partkey AS p, 's' || l_suppkey AS s, 'c' || o_custkey AS c FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
ps AS (SELECT DISTINCT p, s FROM l), sc AS (SELECT DISTINCT s, c FROM l), pc AS (SELECT DISTINCT p, c FROM l)
SELECT s AS supplier, count(*) AS triads FROM pc JOIN ps USING (p) JOIN sc USING (s, c) GROUP BY 1
""")  # fmt: skip
def network_triads(t: Tables) -> DataFrame:
    """Triads of part, supplier and customer, told by supplier."""
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey").join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    rows = lines.select(F.col("l_partkey").alias("x"), F.col("l_suppkey").alias("y"), F.col("o_custkey").alias("z"))
    found = triads_of_kinds(rows, lambda df: stored(df, "lines")).groupBy("y").agg(F.count(F.lit(1)).alias("triads"))
    return found.select(F.concat(F.lit("s"), F.col("y").cast("string")).alias("supplier"), "triads")


_LABELS = ["red", "hot", "widget", "bolt", "red widget", "old bolt", "Old"]


@query("label_cover", "SELECT p_partkey, label, CAST(instr(p_name, label) - 1 AS INTEGER) AS start FROM (SELECT p_partkey, p_name, unnest(CASE WHEN p_name IN ('red widget', 'old bolt') THEN [p_name] ELSE list_filter(string_split(p_name, ' '), lambda w: w IN ('red', 'hot', 'widget', 'bolt', 'old')) END) AS label FROM part)")
def label_cover(t: Tables) -> DataFrame:
    """The labels that a name is made of, the longest first, none over another."""
    labels = t.spark.createDataFrame([(x.lower(), x) for x in _LABELS], "label string, form string")
    found = M.phrase_hits(t.part, labels, text_id="p_partkey", text="p_name", phrase_id="label", phrase="form", cover=True)
    return found.select("p_partkey", "label", "start")
