"""Fourteen declared checks over the test tables, each with rows that fail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.constraints import checked
from .registry import Tables, query

CHECKS = [
    {"id": "C01", "kind": "not_null", "table": "labelled", "column": "quality", "key": "doc_id"},
    {"id": "C02", "kind": "interval", "table": "customer", "column": "c_acctbal", "low": 0.0, "high": 9000.0, "key": "c_custkey"},
    {"id": "C03", "kind": "pattern", "table": "customer", "column": "c_mktsegment", "pattern": "^[A-H]", "key": "c_custkey"},
    {"id": "C04", "kind": "interval", "table": "lineitem", "column": "l_discount", "high": 0.05, "where": "l_returnflag = 'R'", "key": "l_orderkey"},
    {"id": "C05", "kind": "holds", "table": "lineitem", "expression": "l_extendedprice >= 100 * l_quantity", "key": "l_orderkey"},
    {"id": "C06", "kind": "interval", "table": "documents", "column": "n_chars", "low": 100, "high": 5000, "key": "doc_id"},
    {"id": "C07", "kind": "pattern", "table": "documents", "column": "text", "pattern": "the", "where": "lang = 'en'", "key": "doc_id"},
    {"id": "C08", "kind": "unique", "table": "orders", "columns": ["o_custkey", "o_orderstatus"]},
    {"id": "C09", "kind": "unique", "table": "documents", "columns": ["source", "lang", "n_chars"]},
    {"id": "C10", "kind": "foreign_key", "table": "customer", "column": "c_custkey", "to": "orders", "target": "o_custkey"},
    {"id": "C11", "kind": "foreign_key", "table": "documents", "column": "doc_id", "to": "labels", "target": "doc_id"},
    {"id": "C12", "kind": "cardinality", "table": "orders", "column": "o_custkey", "of": "customer", "parent": "c_custkey", "low": 1, "high": 12},
    {"id": "C13", "kind": "cardinality", "table": "lineitem", "column": "l_orderkey", "of": "orders", "parent": "o_orderkey", "low": 2, "where": "l_quantity > 10"},
    {"id": "C14", "kind": "not_null", "table": "customer", "column": "c_name", "where": "c_acctbal > 1000000", "key": "c_custkey"},
]


def _sql(check: dict) -> str:
    kind, table, where = check["kind"], check["table"], f"({check['where']})" if "where" in check else "true"
    table = "(SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id))" if table == "labelled" else table
    if kind == "unique":
        names = check["columns"]
        rows = f"SELECT concat_ws('|', {', '.join(names)}) AS k, count(*) > 1 AS bad, 1 AS n FROM {table} WHERE {where} AND {' AND '.join(f'{c} IS NOT NULL' for c in names)} GROUP BY {', '.join(names)}"
    elif kind == "foreign_key":
        rows = f"SELECT {check['column']} AS k, {check['column']} NOT IN (SELECT {check['target']} FROM {check['to']} WHERE {check['target']} IS NOT NULL) AS bad, 1 AS n FROM {table} WHERE {where} AND {check['column']} IS NOT NULL"
    elif kind == "cardinality":
        rows = f"SELECT p.k, coalesce(c.n, 0) NOT BETWEEN {check.get('low', 0)} AND {check.get('high', 2**62)} AS bad, 1 AS n FROM (SELECT DISTINCT {check['parent']} AS k FROM {check['of']}) p LEFT JOIN (SELECT {check['column']} AS k, count(*) AS n FROM {table} WHERE {where} GROUP BY 1) c ON c.k = p.k"
    else:
        bad = {
            "not_null": f"{check.get('column')} IS NULL", "interval": " OR ".join(f"{check.get('column')} {op} {check[name]}" for op, name in (("<", "low"), (">", "high")) if check.get(name) is not None),
            "pattern": f"NOT regexp_matches({check.get('column')}, '{check.get('pattern')}')", "holds": f"NOT coalesce({check.get('expression')}, false)",
        }[kind]
        held = "true" if kind in ("not_null", "holds") else f"{check['column']} IS NOT NULL"
        rows = f"SELECT {check['key']} AS k, {bad} AS bad, 1 AS n FROM {table} WHERE {where} AND {held}"
    return f"""SELECT '{check['id']}' AS "check", '{kind}' AS kind, count(*) AS applicable, count(*) FILTER (bad) AS failed, CASE WHEN count(*) = 0 THEN 'not_applicable' WHEN count(*) FILTER (bad) > 0 THEN 'fail' ELSE 'pass' END AS status,
  CASE WHEN min(k) FILTER (bad) IS NULL THEN '' WHEN min(k) FILTER (bad) = max(k) FILTER (bad) THEN CAST(min(k) FILTER (bad) AS VARCHAR) ELSE min(k) FILTER (bad) || ',' || max(k) FILTER (bad) END AS examples FROM ({rows})"""


@query("declared_checks", " UNION ALL ".join(_sql(c) for c in CHECKS))
def declared_checks(t: Tables) -> DataFrame:
    """Keys, links, intervals, patterns and numbers, with what applies, what fails and the least and greatest failing key."""
    tables = {name: getattr(t, name) for name in ("customer", "orders", "lineitem", "documents", "labels")}
    tables["labelled"] = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return checked(tables, CHECKS).withColumn("examples", F.array_join("examples", ","))
