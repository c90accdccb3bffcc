"""The extraction flow over documents and benchmark quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evidence as E
from ..plans.extraction import Run, extract
from ..plans.fill import Context
from .registry import Tables, query

_KINDS = {"claim": ["Finding"], "method": ["procedure"]}
_RULES = [{"id": "X1", "kind": "required_when", "level": "warning", "when": {"field": "kind", "equals": "claim"}, "require": ["ref"]}]
_FILLS = ["schema_version", "run_id", "source_part", "grain", "record_id", "confidence", "warning_codes", "validation_outcome"]


def _run(t: Tables) -> Run:
    """Each benchmark text as candidates for the documents that hold it: with a hint that may be off, some twice, some odd."""
    found = E.located_quotes(t.documents, t.benchmark, text_id="doc_id", text="text", quote_id="item_id", quote="text")
    line = E.line_of(F.col("text"), F.col("start"))
    quote = F.get(F.split("text", "\n"), line - 1)
    base = found.select(F.col("doc_id").alias("doc"), "item_id", quote.alias("quote"), line.alias("line"))
    twice = base.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    c = F.col
    kind = F.when(c("item_id") % 3 == 0, "FINDING").when(c("item_id") % 3 == 1, "method").otherwise("rumour")
    rows = twice.select(
        (c("doc") * 1000 + c("item_id") * 2 + c("copy")).alias("candidate"), "doc", kind.alias("kind"), F.concat(F.lit(" "), c("quote")).alias("quote"), (c("line") + c("item_id") % 3).cast("int").alias("hint"), F.when(c("item_id") % 2 == 0, F.concat(F.lit("r"), c("item_id").cast("string"))).alias("ref"),
        F.when(c("copy") == 1, F.concat(F.lit("r"), (c("item_id") % 4).cast("string"))).alias("target"), F.when(c("copy") == 0, "85%").otherwise("0.5").alias("score"), F.lit(None).cast("string").alias("part"), F.concat(F.lit("doc:"), c("doc").cast("string")).alias("source_id"),
    )
    pages = E.pages(t.documents, ["doc_id"], "text", "\n").withColumnRenamed("doc_id", "doc")
    return extract(rows, pages, Context(grains={"claim": "evidence", "method": "unit"}), kinds=_KINDS, rules=_RULES, fills=_FILLS)


_C = """WITH f AS (SELECT doc_id AS doc, item_id, len(string_split(left(d.text, instr(d.text, b.text) - 1), chr(10))) AS line, d.text FROM documents d JOIN benchmark b ON contains(d.text, b.text)),
p AS (SELECT doc_id AS doc, i AS page, replace(lower(trim(regexp_replace(string_split(text, chr(10))[i], '\\s+', ' ', 'g'))), 'ß', 'ss') AS t FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u(i)),
c AS (SELECT doc * 1000 + item_id * 2 + copy AS candidate, doc, item_id, copy, trim(string_split(text, chr(10))[line], ' ') AS quote, line + item_id % 3 AS hint, CASE item_id % 3 WHEN 0 THEN 'claim' WHEN 1 THEN 'method' END AS kind FROM f, (VALUES (0), (1)) v(copy)),
h AS (SELECT candidate, arg_min(page, abs(page - hint) * 2 + CASE WHEN page > hint THEN 1 ELSE 0 END) AS page FROM c JOIN p ON p.doc = c.doc AND page BETWEEN hint - 1 AND hint + 1 AND contains(p.t, replace(lower(regexp_replace(c.quote, '\\s+', ' ', 'g')), 'ß', 'ss')) GROUP BY 1),
j AS (SELECT c.*, h.page, replace(lower(regexp_replace(quote, '\\s+', ' ', 'g')), 'ß', 'ss') AS n, CASE WHEN copy = 1 THEN 'r' || (item_id % 4) END AS target, CASE WHEN item_id % 2 = 0 THEN 'r' || item_id END AS ref, CASE WHEN kind IS NULL THEN 'KIND_UNKNOWN' WHEN h.page IS NULL THEN 'EVIDENCE_QUOTE_NOT_FOUND' END AS code FROM c LEFT JOIN h USING (candidate)),
k AS (SELECT *, min(candidate) OVER (PARTITION BY doc, kind, page, n, coalesce(target, '')) AS first FROM j WHERE code IS NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY doc, kind, page, n ORDER BY candidate) - 1 AS ordinal FROM k WHERE candidate = first),
r AS (SELECT *, 'rec_' || left(sha256('doc:' || doc || chr(31) || kind || chr(31) || page || chr(31) || 'None' || chr(31) || n || chr(31) || ordinal), 32) AS record_id FROM o)
"""


@query("extraction_records", _C + "SELECT candidate, kind, CAST(page AS INTEGER) AS page, CAST(ordinal AS INTEGER) AS ordinal, record_id, CASE kind WHEN 'claim' THEN 'evidence' ELSE 'unit' END AS grain, CASE copy WHEN 0 THEN 0.85 ELSE 0.5 END::DOUBLE AS confidence, CASE WHEN kind = 'claim' AND ref IS NULL THEN 'pending_review' ELSE 'machine_extracted' END AS outcome FROM r")
def extraction_records(t: Tables) -> DataFrame:
    return _run(t).records.select("candidate", "kind", "page", "ordinal", "record_id", "grain", "confidence", F.col("validation_outcome").alias("outcome"))


@query("extraction_rejections", _C + "SELECT candidate, CASE code WHEN 'KIND_UNKNOWN' THEN 'repair' ELSE 'evidence' END AS stage, code FROM j WHERE code IS NOT NULL UNION ALL SELECT candidate, 'duplicate', 'DUPLICATE' FROM k WHERE candidate <> first")
def extraction_rejections(t: Tables) -> DataFrame:
    return _run(t).rejected


@query("extraction_links", _C + ", a AS (SELECT k.doc, k.ref, arg_min(r.record_id, k.candidate) AS target_id FROM k JOIN r ON r.candidate = k.first WHERE k.ref IS NOT NULL GROUP BY 1, 2) SELECT r.record_id, r.target AS ref, a.target_id, CASE WHEN a.target_id IS NULL THEN 'dangling' WHEN a.target_id = r.record_id THEN 'self' ELSE 'linked' END AS state FROM r LEFT JOIN a ON a.doc = r.doc AND a.ref = r.target WHERE r.target IS NOT NULL")
def extraction_links(t: Tables) -> DataFrame:
    return _run(t).links.select("record_id", "ref", "target_id", "state")


@query("extraction_report", _C + "SELECT kind, CASE WHEN kind = 'claim' AND ref IS NULL THEN 'pending_review' ELSE 'machine_extracted' END AS outcome, count(*) AS records FROM r GROUP BY ALL")
def extraction_report(t: Tables) -> DataFrame:
    return _run(t).report.withColumnRenamed("validation_outcome", "outcome")
