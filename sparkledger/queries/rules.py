"""Rule, validation and vocabulary queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import rules as R
from ..operators import validate as V
from .registry import Tables, query

#: Orders as records in which some fields are missing.
_RECORDS = """SELECT o_orderkey AS key, o_orderstatus AS status, o_orderpriority AS priority, o_totalprice AS price,
  CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END AS cust, CASE WHEN o_custkey % 5 <> 0 THEN o_orderpriority END AS second,
  CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice END AS lo, CASE WHEN o_orderkey % 6 = 0 THEN o_totalprice END AS hi FROM orders"""


def records(t: Tables) -> DataFrame:
    c = F.col
    return t.orders.select(
        c("o_orderkey").alias("key"), c("o_orderstatus").alias("status"), c("o_orderpriority").alias("priority"), c("o_totalprice").alias("price"),
        F.when(c("o_custkey") % 3 != 0, c("o_custkey")).alias("cust"), F.when(c("o_custkey") % 5 != 0, c("o_orderpriority")).alias("second"),
        F.when(c("o_orderkey") % 4 == 0, c("o_totalprice")).alias("lo"), F.when(c("o_orderkey") % 6 == 0, c("o_totalprice")).alias("hi"),
    )


def issue_rows(rows: DataFrame, rules: list[dict], *keys: str) -> DataFrame:
    return rows.select(*keys, F.inline(R.issues(rules, rows.schema))).select(*keys, "rule_id", "code", "severity", "path")


def _sql(source: str, *cases: tuple[str, str, str, str], key: str = "key") -> str:
    return f"WITH r AS ({source}) " + " UNION ALL ".join(f"SELECT {key}, '{i}' AS rule_id, 'RULE_{i}' AS code, '{level}' AS severity, {path} AS path FROM r WHERE {where}" for i, level, path, where in cases)


_URGENT = "status = 'F' AND regexp_matches(priority, '^[12]')"


@query("rule_required_when", _sql(_RECORDS, ("Q1", "error", "'cust'", f"{_URGENT} AND cust IS NULL"), ("Q1", "error", "'second'", f"{_URGENT} AND second IS NULL")))
def rule_required_when(t: Tables) -> DataFrame:
    when = {"all": [{"field": "status", "equals": "F"}, {"field": "priority", "matches": "^[12]"}]}
    return issue_rows(records(t), [{"id": "Q1", "kind": "required_when", "when": when, "require": ["cust", "second"]}], "key")


@query("rule_require_any_when", _sql(_RECORDS, ("Q2", "warning", "'cust'", "status IN ('F', 'P') AND cust IS NULL AND second IS NULL")))
def rule_require_any_when(t: Tables) -> DataFrame:
    return issue_rows(records(t), [{"id": "Q2", "kind": "require_any_when", "level": "warning", "when": {"field": "status", "in": ["F", "P"]}, "require": ["cust", "second"]}], "key")


@query("rule_paired", _sql(_RECORDS, ("Q3", "error", "CASE WHEN lo IS NULL THEN 'lo' ELSE 'hi' END", "(lo IS NULL) <> (hi IS NULL)")))
def rule_paired(t: Tables) -> DataFrame:
    return issue_rows(records(t), [{"id": "Q3", "kind": "paired", "fields": ["lo", "hi"]}], "key")


@query("rule_mutually_exclusive", _sql(_RECORDS, ("Q4", "error", "CASE WHEN lo IS NOT NULL AND hi IS NOT NULL THEN 'hi' ELSE 'second' END", "(lo IS NOT NULL)::INT + (hi IS NOT NULL)::INT + (second IS NOT NULL)::INT > 1")))
def rule_mutually_exclusive(t: Tables) -> DataFrame:
    return issue_rows(records(t), [{"id": "Q4", "kind": "mutually_exclusive", "fields": ["lo", "hi", "second"]}], "key")


@query("rule_lte", "SELECT l_orderkey, l_linenumber, 'Q5' AS rule_id, 'RULE_Q5' AS code, 'warning' AS severity, 'l_discount' AS path FROM lineitem WHERE l_discount > l_tax")
def rule_lte(t: Tables) -> DataFrame:
    return issue_rows(t.lineitem, [{"id": "Q5", "kind": "lte", "level": "warning", "fields": ["l_discount", "l_tax"]}], "l_orderkey", "l_linenumber")


@query("rule_equals_any_field", "SELECT o_orderkey AS key, 'Q6' AS rule_id, 'RULE_Q6' AS code, 'error' AS severity, 'o_orderpriority' AS path FROM orders WHERE (o_custkey % 2 = 0 OR o_custkey % 3 = 0) AND NOT (o_custkey % 2 = 0 AND o_orderpriority = '1-URGENT') AND NOT (o_custkey % 3 = 0 AND o_orderpriority = '5-LOW')")
def rule_equals_any_field(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("key", F.col("o_orderkey")).withColumn("a", F.when(F.col("o_custkey") % 2 == 0, "1-URGENT")).withColumn("b", F.when(F.col("o_custkey") % 3 == 0, "5-LOW"))
    return issue_rows(rows, [{"id": "Q6", "kind": "equals_any_field", "field": "o_orderpriority", "candidates": ["a", "b"]}], "key")


_SECRET = r"(?i)(secret|token|password)[ ]*[:=]"


@query("rule_forbid_pattern", f"SELECT doc_id, 'Q8' AS rule_id, 'RULE_Q8' AS code, 'error' AS severity, 'text' AS path FROM documents WHERE regexp_matches(text, '{_SECRET}') UNION ALL SELECT doc_id, 'Q8', 'RULE_Q8', 'error', 'source' FROM documents WHERE regexp_matches(source, '{_SECRET}')")
def rule_forbid_pattern(t: Tables) -> DataFrame:
    return issue_rows(t.documents, [{"id": "Q8", "kind": "forbid_pattern", "fields": ["text", "source"], "pattern": _SECRET}], "doc_id")


@query("rule_forbid_pattern_any_field", "SELECT p_partkey, 'Q9' AS rule_id, 'RULE_Q9' AS code, 'error' AS severity, unnest(list_filter(['p_name', 'p_brand', 'p_type'], lambda c: (c = 'p_name' AND regexp_matches(p_name, '[3-5]$')) OR (c = 'p_brand' AND regexp_matches(p_brand, '[3-5]$')) OR (c = 'p_type' AND regexp_matches(p_type, '[3-5]$')))) AS path FROM part")
def rule_forbid_pattern_any_field(t: Tables) -> DataFrame:
    return issue_rows(t.part, [{"id": "Q9", "kind": "forbid_pattern", "fields": "*", "pattern": "[3-5]$"}], "p_partkey")


@query("rule_grain_matches_kind", "SELECT o_orderkey, 'Q10' AS rule_id, 'RULE_Q10' AS code, 'error' AS severity, 'o_orderpriority' AS path FROM orders WHERE (o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT') OR (o_orderstatus = 'O' AND o_orderpriority <> '5-LOW')")
def rule_grain_matches_kind(t: Tables) -> DataFrame:
    return issue_rows(t.orders, [{"id": "Q10", "kind": "grain_matches_kind", "field": "o_orderpriority", "kind_field": "o_orderstatus", "grains": {"F": "1-URGENT", "O": "5-LOW"}}], "o_orderkey")


@query("rule_offsets_match_text", "SELECT doc_id, 'Q11' AS rule_id, 'RULE_Q11' AS code, 'warning' AS severity, 'links' AS path FROM documents WHERE length(text) < 9 OR left(text, 9) <> trim(left(text, 9)) OR doc_id % 3 = 0")
def rule_offsets_match_text(t: Tables) -> DataFrame:
    own = F.substring("text", 1, 9)
    mention = F.when(F.col("doc_id") % 3 == 0, F.lit("not there")).otherwise(F.upper(own))
    rows = t.documents.withColumn("links", F.array(F.struct(F.lit(0).alias("start"), F.lit(9).alias("end"), mention.alias("mention"))))
    return issue_rows(rows, [{"id": "Q11", "kind": "offsets_match_text", "level": "warning", "field": "links", "text": "text"}], "doc_id")


@query("rule_unique_within_dataset", "SELECT l_orderkey, l_linenumber, l_partkey, first_part FROM (SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER w AS n, first_value(l_partkey) OVER w AS first_part FROM lineitem WINDOW w AS (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_discount, l_tax)) WHERE n > 1")
def rule_unique_within_dataset(t: Tables) -> DataFrame:
    order = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_discount", "l_tax"]
    found = R.repeated_keys(t.lineitem, ["l_orderkey", "l_linenumber"], order)
    return found.select("l_orderkey", "l_linenumber", "l_partkey", F.col("first_order.l_partkey").alias("first_part"))


@query("rule_single_value_per_group", "WITH f AS (SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS first_value FROM orders GROUP BY 1) SELECT o_orderkey, o_custkey, o_orderpriority, first_value FROM orders JOIN f USING (o_custkey) WHERE o_orderpriority <> first_value")
def rule_single_value_per_group(t: Tables) -> DataFrame:
    return R.differs_from_first(t.orders, ["o_custkey"], "o_orderpriority", ["o_orderkey"]).select("o_orderkey", "o_custkey", "o_orderpriority", "first_value")


@query("rule_references_resolve", "SELECT l_orderkey, string_agg(DISTINCT CAST(l_partkey AS VARCHAR), ',' ORDER BY CAST(l_partkey AS VARCHAR)) AS links FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10) GROUP BY 1")
def rule_references_resolve(t: Tables) -> DataFrame:
    found = R.dangling(t.lineitem, ["l_orderkey"], "l_partkey", t.part.where("p_size > 10"), "p_partkey")
    return found.select("l_orderkey", F.array_join(F.array_sort(F.transform("links", lambda x: x.cast("string"))), ",").alias("links"))


@query("rule_condition_any", f"WITH r AS ({_RECORDS}) SELECT key FROM r WHERE (lo IS NOT NULL OR hi IS NOT NULL) AND (cust IS NOT NULL OR status = 'O')")
def rule_condition_any(t: Tables) -> DataFrame:
    rows = records(t)
    return rows.where(R.condition({"all": [{"any_present": ["lo", "hi"]}, {"any": [{"present": "cust"}, {"field": "status", "equals": "O"}]}]}, rows.schema)).select("key")


@query("validate_structure", """
WITH e AS (SELECT event_id, props, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
SELECT event_id, 'SCHEMA_REQUIRED' AS code, 'm' AS path FROM e UNION ALL
SELECT event_id, 'SCHEMA_MAXIMUM', 'k' FROM e WHERE k > 50 UNION ALL
SELECT event_id, 'SCHEMA_UNKNOWN_FIELD', 'z' FROM e WHERE k % 2 = 0 UNION ALL
SELECT event_id, 'SCHEMA_TYPE', 'n' FROM e WHERE k % 3 = 0""")
def validate_structure(t: Tables) -> DataFrame:
    """Structural checks of the JSON of events; some rows get an unknown key and a null field first."""
    k = F.get_json_object("props", "$.k").cast("long")
    raw = F.concat(F.regexp_replace("props", r"\}\s*$", ""), F.when(k % 2 == 0, ', "z": 1').otherwise(""), F.when(k % 3 == 0, ', "n": null').otherwise(', "n": 1.5'), F.lit("}"))
    fields = [{"path": "k", "type": "integer", "required": True, "maximum": 50}, {"path": "m", "type": "string", "required": True}, {"path": "n", "type": "number"}]
    rows = t.events.select("event_id", F.try_parse_json(raw).alias("doc"))
    return rows.select("event_id", F.inline(V.structural_issues(F.col("doc"), fields))).select("event_id", "code", "path")


@query("validate_vocabulary", "SELECT p_partkey, 'VOCAB_UNKNOWN_CODE' AS code FROM part WHERE p_brand NOT IN ('Brand#11', 'Brand#12', 'Brand#13') UNION ALL SELECT p_partkey, 'VOCAB_CODE_DEPRECATED' FROM part WHERE p_brand = 'Brand#12' UNION ALL SELECT p_partkey, 'FIELD_DEPRECATED' FROM part WHERE p_size > 40")
def validate_vocabulary(t: Tables) -> DataFrame:
    rows = t.part.withColumn("old", F.when(F.col("p_size") > 40, F.col("p_size")))
    found = F.concat(V.vocabulary_issues("p_brand", ["Brand#11", "Brand#12", "Brand#13"], {"Brand#12": "Brand#13"}), V.deprecated_fields(["old"]))
    return rows.select("p_partkey", F.inline(found)).select("p_partkey", "code")


@query("validate_verdict", f"WITH r AS ({_RECORDS}) SELECT status, count(*) AS n, count(*) FILTER (NOT (status = 'F' AND cust IS NULL)) AS n_valid, count(*) FILTER (second IS NULL) AS n_warned FROM r GROUP BY 1")
def validate_verdict(t: Tables) -> DataFrame:
    rows = records(t)
    rules = [{"id": "Q1", "kind": "required_when", "when": {"field": "status", "equals": "F"}, "require": ["cust"]}, {"id": "Q2", "kind": "required_when", "level": "warning", "require": ["second"]}]
    judged = rows.withColumn("issues", R.issues(rules, rows.schema))
    return judged.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.count_if(V.valid("issues")).alias("n_valid"), F.count_if(F.exists("issues", lambda i: i["severity"] == "warning")).alias("n_warned"))


@query("validate_by_version", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN CASE WHEN o_totalprice < 1000 THEN 'RULE_A' ELSE '' END WHEN 'O' THEN CASE WHEN o_custkey % 3 = 0 THEN 'RULE_B' ELSE '' END ELSE 'SCHEMA_VERSION_MISMATCH' END AS codes FROM orders")
def validate_by_version(t: Tables) -> DataFrame:
    """Each record against the rules of its own version (the status stands for it)."""
    rows = t.orders.withColumn("cust", F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey"))).withColumn("low", F.lit(1000.0))
    a = [{"id": "A", "kind": "lte", "fields": ["low", "o_totalprice"]}]
    b = [{"id": "B", "kind": "required_when", "require": ["cust"]}]
    judged = V.with_own_version(rows, "o_orderstatus", {"F": R.issues(a, rows.schema), "O": R.issues(b, rows.schema)})
    return judged.select("o_orderkey", F.array_join(F.transform("issues", lambda i: i["code"]), ",").alias("codes"))
