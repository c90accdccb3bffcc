"""Orders as candidates in a foreign shape, repaired."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.repair import Form, repaired_candidates
from .registry import Tables, query

_FORM = Form(
    fields={
        "common.rank": {"type": "string", "role": "document"}, "value.total": {"type": "number", "role": "extract"}, "value.state": {"type": "string", "role": "extract", "vocabulary": "state"},
        "value.names": {"type": "array_string", "role": "extract"}, "value.line": {"type": "integer", "role": "extract"}, "common.record_id": {"type": "string", "role": "computed"},
    },
    evidence={"page": "common.source_page", "quote": "common.source_quote"}, kinds=("claim", "method"), links=("supports",),
    vocabularies={"state": {"OPEN": ["O"], "FINISHED": ["F", "done"]}},
)


def _candidates(t: Tables) -> DataFrame:
    k, who = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    fields = F.to_json(F.struct(
        F.struct(F.concat(F.lit("1,"), F.lpad((F.col("o_custkey") % 1000).cast("string"), 3, "0"), F.lit(".5")).alias("total"), who.alias("names"), F.lit("7").alias("line")).alias("value"),
        F.lower(F.concat(F.lit(" "), F.col("o_orderstatus"))).alias("state"), F.col("o_orderpriority").alias("rank"), F.lit("x").alias("odd"),
        F.when(k % 3 == 0, "id").alias("common.record_id"), F.when(k % 4 == 0, F.concat(F.lit(" said "), who)).alias("common.source_quote"),
    ))
    kind = F.when(k % 3 == 0, " Claim").when(k % 3 == 1, "method").otherwise("rumour")
    page = F.when(k % 5 == 0, F.lit('"12"')).otherwise((k % 90).cast("string"))
    text = F.concat(F.lit('{"record_kind": "'), kind, F.lit('", "fields": '), fields, F.lit(', "evidence": {"common.source_page": '), page, F.lit(', "nope": 1}, "ref": '), F.when(k % 7 == 0, '"a b"').otherwise(F.concat(F.lit('" r'), k.cast("string"), F.lit('"'))), F.lit(', "links": {"supports": ["r1", "r1", 2], "more": "r3"}}'))
    return t.orders.select("o_orderkey", F.when(k % 11 == 0, F.lit("[1, 2]")).otherwise(text).alias("candidate"))


@query("repair_candidates", """
SELECT o_orderkey, kept, CASE WHEN kept THEN CASE o_orderkey % 3 WHEN 0 THEN 'claim' WHEN 1 THEN 'method' ELSE 'rumour' END END AS kind,
  CASE WHEN kept THEN '1' || lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0') || '.5' END AS total, CASE WHEN kept THEN CASE o_orderstatus WHEN 'O' THEN 'OPEN' WHEN 'F' THEN 'FINISHED' ELSE lower(o_orderstatus) END END AS state,
  CASE WHEN kept THEN '["' || o_custkey || '"]' END AS names, CASE WHEN kept THEN '7' END AS line, CASE WHEN kept THEN o_orderpriority END AS rank, CASE WHEN kept THEN CASE WHEN o_orderkey % 5 = 0 THEN '12' ELSE CAST(o_orderkey % 90 AS VARCHAR) END END AS page,
  CASE WHEN kept AND o_orderkey % 4 = 0 THEN 'said ' || o_custkey END AS quote, CASE WHEN kept AND o_orderkey % 7 <> 0 THEN 'r' || o_orderkey END AS ref, CASE WHEN kept THEN 'r1,2' ELSE '' END AS supports,
  CASE WHEN NOT kept THEN 'dropped_malformed_candidate' ELSE array_to_string(list_sort(list_filter([
    'renamed_evidence_key', 'dropped_unknown_evidence_key', 'coerced_type', 'coerced_type', 'coerced_type', 'resolved_bare_field_name', 'resolved_bare_field_name', 'dropped_unknown_field', 'document_field_override', 'dropped_unknown_link',
    CASE WHEN o_orderkey % 3 = 0 THEN 'normalized_record_kind' END, CASE WHEN o_orderkey % 5 = 0 THEN 'coerced_type' END, CASE WHEN o_orderstatus IN ('O', 'F') THEN 'mapped_vocabulary_label' END, CASE WHEN o_orderkey % 3 = 0 THEN 'dropped_field' END,
    CASE WHEN o_orderkey % 4 = 0 THEN 'moved_to_evidence' END, CASE WHEN o_orderkey % 7 = 0 THEN 'dropped_malformed_ref' END], lambda x: x IS NOT NULL)), ',') END AS steps
FROM (SELECT *, o_orderkey % 11 <> 0 AS kept FROM orders)
""")  # fmt: skip
def repair_candidates(t: Tables) -> DataFrame:
    """Each order's candidate after repair, and the steps that were taken."""
    rows = repaired_candidates(_candidates(t), "candidate", _FORM)
    value = lambda place, path: F.try_element_at(place, F.lit(path))["text"]
    supports = F.coalesce(F.array_join(F.try_element_at("links", F.lit("supports")), ","), F.lit(""))
    return rows.select(
        "o_orderkey", "kept", F.col("record_kind").alias("kind"), value("fields", "value.total").alias("total"), value("fields", "value.state").alias("state"), value("fields", "value.names").alias("names"), value("fields", "value.line").alias("line"),
        value("overrides", "common.rank").alias("rank"), value("evidence", "page").alias("page"), value("evidence", "quote").alias("quote"), "ref", supports.alias("supports"), F.array_join(F.array_sort(F.transform("repairs", lambda s: s["action"])), ",").alias("steps"),
    )
