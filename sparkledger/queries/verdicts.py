"""Verdicts with codes, versions and a second judgement, over documents and labels as records and verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import review, verdicts
from .registry import Tables, query

#: A verified record must name its language.
_RULES = [{"id": "V1", "kind": "required_when", "level": "error", "when": {"field": "status", "equals": "model_verified"}, "require": ["spoken"]}]


def _inputs(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    c = F.col("doc_id")
    status = F.when(c % 7 == 0, "expert_approved").when(c % 7 == 1, "rejected").when(c % 7 == 2, "pending_review").when(c % 7 == 3, "imported").otherwise("auto_validated")
    qc = F.when(c % 5 == 0, F.array(F.lit("VERIFY_UNCERTAIN"), F.lit("A"))).when(c % 5 == 1, F.array(F.lit("A")))
    records = t.documents.select("doc_id", F.when(c % 9 != 0, F.col("lang")).alias("spoken"), status.alias("status"), F.when(c % 10 != 0, 1).alias("version"), qc.alias("qc_codes"))
    links = t.labels.where("quality = 1").select(c.cast("string").alias("record_id"), F.lit("label").alias("target"))
    tasks = review.tasks(records, links, "doc_id", []).where(F.col("record_id").cast("long") % 8 != 5)
    label = t.labels.select(c.cast("string").alias("record_id"), "quality", "toxic")
    told = F.when(F.col("toxic") == 1, "uncertain").when(F.col("quality") == 1, "supported").otherwise("not_supported")
    n = F.col("record_id").cast("long")
    verdict = F.when((F.col("kind") == "link") & (n % 4 == 0), "not_supported").otherwise(told)
    given = tasks.join(label, "record_id").where(~((F.col("kind") == "link") & (n % 6 == 1))).select("task_id", verdict.alias("verdict"), F.lit(2).alias("ord"), F.concat(F.lit("d"), F.col("record_id")).alias("reason"))
    older = given.select("task_id", F.lit("not_supported").alias("verdict"), F.lit(1).alias("ord"), F.lit("older").alias("reason"))
    odd = t.labels.where("toxic = 1").select(F.explode(F.array(F.struct(F.concat(F.lit("x"), c).alias("task_id"), F.lit("supported").alias("verdict")), F.struct(F.concat(F.lit("y"), c).alias("task_id"), F.lit("maybe").alias("verdict")))).alias("v")).select("v.*", F.lit(3).alias("ord"), F.lit(None).cast("string").alias("reason"))
    return records, tasks, given.unionByName(older).unionByName(odd)


def _verified(t: Tables) -> verdicts.Verified:
    records, tasks, given = _inputs(t)
    return verdicts.verified(records, tasks, given, "doc_id", verifier="m2", extractor="m1", run="run-7", rules=_RULES)


_V = """WITH d AS (
  SELECT d.doc_id, CASE WHEN d.doc_id % 9 <> 0 THEN lang END AS spoken, CASE d.doc_id % 7 WHEN 0 THEN 'expert_approved' WHEN 1 THEN 'rejected' WHEN 2 THEN 'pending_review' WHEN 3 THEN 'imported' ELSE 'auto_validated' END AS s,
    CASE WHEN d.doc_id % 10 <> 0 THEN 1 END AS v, CASE d.doc_id % 5 WHEN 0 THEN ['A', 'VERIFY_UNCERTAIN'] WHEN 1 THEN ['A'] END AS qc, d.doc_id % 8 <> 5 AS has, quality, toxic,
    CASE WHEN quality IS NULL THEN NULL WHEN toxic = 1 THEN 'uncertain' WHEN quality = 1 THEN 'supported' ELSE 'not_supported' END AS rv,
    CASE WHEN quality = 1 AND d.doc_id % 6 <> 1 THEN CASE WHEN d.doc_id % 4 = 0 THEN 'not_supported' WHEN toxic = 1 THEN 'uncertain' ELSE 'supported' END END AS lv
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
), c AS (
  SELECT *, CASE WHEN rv IS NULL AND lv IS NULL THEN [] ELSE list_sort(list_distinct(list_filter([CASE rv WHEN 'uncertain' THEN 'VERIFY_UNCERTAIN' WHEN 'not_supported' THEN 'VERIFY_FIELD_NOT_SUPPORTED' END, CASE lv WHEN 'uncertain' THEN 'VERIFY_UNCERTAIN' WHEN 'not_supported' THEN 'VERIFY_LINK_NOT_SUPPORTED' END], lambda x: x IS NOT NULL))) END AS codes FROM d
), o AS (
  SELECT *, CASE WHEN NOT has THEN 'no_tasks' WHEN s IN ('expert_approved', 'rejected') THEN 'skipped_expert_reviewed' WHEN rv IS NULL AND lv IS NULL THEN 'unverified'
    WHEN len(codes) > 0 THEN CASE s WHEN 'pending_review' THEN 'confirmed_pending' ELSE 'demoted' END WHEN quality = 1 AND lv IS NULL THEN 'partially_verified'
    WHEN s = 'auto_validated' THEN CASE WHEN spoken IS NULL THEN 'invalid_after' ELSE 'promoted' END WHEN s = 'pending_review' THEN 'confirmed_pending' ELSE 'unchanged' END AS outcome FROM c
), r AS (
  SELECT *, outcome NOT IN ('no_tasks', 'skipped_expert_reviewed', 'unverified', 'invalid_after') AS touched,
    CASE WHEN outcome IN ('no_tasks', 'skipped_expert_reviewed', 'unverified', 'invalid_after') THEN s WHEN len(codes) > 0 THEN 'pending_review' WHEN outcome = 'promoted' THEN 'model_verified' ELSE s END AS status FROM o
)
"""


@query("review_verified", _V + """SELECT doc_id, outcome, status, CASE WHEN touched THEN coalesce(v, 1) + 1 ELSE coalesce(v, 0) END AS version, CASE WHEN touched THEN 'run-7' END AS run,
  array_to_string(list_sort(CASE WHEN touched AND len(codes) > 0 THEN list_concat(CASE WHEN list_contains(qc, 'A') THEN ['A'] ELSE [] END, codes) ELSE coalesce(qc, []) END), ',') AS qc, CASE WHEN outcome = 'invalid_after' THEN 'RULE_V1' ELSE '' END AS errors FROM r""")  # fmt: skip
def review_verified(t: Tables) -> DataFrame:
    """Records after a verifier's run: outcome, status, codes, version, and what would not be valid any more."""
    rows = _verified(t).records
    codes = F.coalesce(F.array_join(F.array_sort("qc_codes"), ","), F.lit(""))
    return rows.select("doc_id", "outcome", "status", F.coalesce("version", F.lit(0)).alias("version"), F.col("verification_run").alias("run"), codes.alias("qc"), F.array_join("errors", ",").alias("errors"))


@query("review_findings", _V + """SELECT doc_id, kind, verdict, 'd' || doc_id AS reason FROM (SELECT doc_id, s, has, 'record' AS kind, rv AS verdict FROM r UNION ALL SELECT doc_id, s, has, 'link', lv FROM r)
WHERE has AND verdict IN ('uncertain', 'not_supported') AND s NOT IN ('expert_approved', 'rejected')""")  # fmt: skip
def review_findings(t: Tables) -> DataFrame:
    """Tasks that the verifier objects to, without those of records that an expert decided."""
    return _verified(t).findings.select(F.col("record_id").cast("long").alias("doc_id"), "kind", "verdict", "reason")


@query("review_verdict_problems", "SELECT 'x' || doc_id AS task_id, 'unknown_task' AS problem FROM labels WHERE toxic = 1 UNION ALL SELECT 'y' || doc_id, 'unknown_verdict' FROM labels WHERE toxic = 1")
def review_verdict_problems(t: Tables) -> DataFrame:
    return _verified(t).problems


@query("review_verdict_report", _V + "SELECT 'outcome' AS measure, outcome AS value, count(*) AS n FROM r GROUP BY ALL UNION ALL SELECT 'before', s, count(*) FROM r GROUP BY ALL UNION ALL SELECT 'after', status, count(*) FROM r GROUP BY ALL")
def review_verdict_report(t: Tables) -> DataFrame:
    """Counts of outcomes and of statuses before and after."""
    return _verified(t).report()


@query("review_conflicts", "SELECT item_id AS conflict_id FROM benchmark WHERE item_id % 3 <> 1 AND item_id IN (SELECT doc_id FROM documents) AND (item_id % 3 = 2 OR item_id + 1 IN (SELECT doc_id FROM documents))")
def review_conflicts(t: Tables) -> DataFrame:
    """Told conflicts of records that are all there: two neighbours, one alone (no conflict), or one twice."""
    c = F.col("item_id")
    name = lambda x: x.cast("string")
    ids = F.when(c % 3 == 0, F.array(name(c), name(c + 1))).when(c % 3 == 1, F.array(name(c))).otherwise(F.array(name(c), name(c)))
    told = t.benchmark.select(c.alias("conflict_id"), ids.alias("record_ids"), F.lit("r").alias("reason"))
    return verdicts.conflict_candidates(told, t.documents, "doc_id").select("conflict_id")
