"""A verifier's verdicts over records: status, codes of quality control, version and run, judged anew before they count."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rules as R
from .joins import last_by

# Verdicts, codes and statuses of the record format.
VERDICTS = ("supported", "not_supported", "uncertain")
FIELD, LINK, UNCERTAIN = "VERIFY_FIELD_NOT_SUPPORTED", "VERIFY_LINK_NOT_SUPPORTED", "VERIFY_UNCERTAIN"
AUTO, MODEL, PENDING = "auto_validated", "model_verified", "pending_review"
EXPERT = ("expert_approved", "rejected")


@dataclass
class Verified:
    """records with their new fields and ``outcome``; findings; problems of verdicts."""

    records: DataFrame
    findings: DataFrame
    problems: DataFrame

    def report(self) -> DataFrame:
        """(measure, value, n): outcomes, and statuses before and after, counted in one pass."""
        told = F.array(*(F.struct(F.lit(m).alias("measure"), F.col(c).alias("value")) for m, c in (("outcome", "outcome"), ("before", "status_before"), ("after", "status"))))
        return self.records.select(F.inline(told)).groupBy("measure", "value").agg(F.count(F.lit(1)).alias("n"))


def _outcome(same_model: bool) -> Column:
    status, tasks, answered, codes = F.col("status_before"), F.col("_tasks"), F.col("_answered"), F.col("_codes")
    return (
        F.when(tasks.isNull(), "no_tasks")
        .when(status.isin(*EXPERT), "skipped_expert_reviewed")
        .when(answered == 0, "unverified")
        .when(F.size(codes) > 0, F.when(status == PENDING, "confirmed_pending").otherwise("demoted"))
        .when(answered < tasks, "partially_verified")
        .when(status == AUTO, "withheld_same_model" if same_model else "promoted")
        .when(status == PENDING, "confirmed_pending")
        .otherwise("unchanged")
    )


def verified(records: DataFrame, task_rows: DataFrame, verdicts: DataFrame, key: str, *, verifier: str, run: str, extractor: str | None = None, rules: list[dict] | None = None) -> Verified:
    """Applies verdicts (task_id, verdict, ord, reason) to records (key, status, version, qc_codes, …) through their tasks
    (task_id, record_id, kind).

    Of several verdicts for one task the last counts.  Any objection demotes and leaves its codes, which replace those of an
    earlier run; a run without objection leaves earlier codes standing.  Full support promotes what was validated
    automatically, unless the verifier is the extractor; what an expert decided stays.  A judged record gets the run and its
    next version (a missing one counts as 1), and is judged by the rules again: with an error it stays as it was, its outcome
    is ``invalid_after`` and ``errors`` holds the codes.

    problems: (task_id, problem) of unknown verdicts, which do not count, and of unknown tasks.  Records without a key have no
    tasks.  Further columns stay, but ``outcome``, ``errors``, ``status_before`` and ``verification_run`` are taken."""
    taken = {"outcome", "errors", "status_before", "verification_run"} & set(records.columns)
    if taken:
        raise ValueError(f"columns of the result are there already: {sorted(taken)}")
    fine = F.coalesce(F.col("verdict").isin(*VERDICTS), F.lit(False))
    last = last_by(verdicts.where(fine).select("task_id", "verdict", "reason", "ord"), ["task_id"], "ord")
    unknown = last.join(task_rows.select("task_id"), "task_id", "left_anti").select("task_id", F.lit("unknown_task").alias("problem"))
    problems = verdicts.where(~fine).select("task_id", F.lit("unknown_verdict").alias("problem")).unionByName(unknown)

    judged = task_rows.select("task_id", "record_id", "kind").join(last.drop("ord"), "task_id", "left")
    code = F.when(F.col("verdict") == "uncertain", UNCERTAIN).when(F.col("verdict") == "not_supported", F.when(F.col("kind") == "link", LINK).otherwise(FIELD))
    per_record = judged.groupBy(F.col("record_id").alias("_k")).agg(F.count(F.lit(1)).alias("_tasks"), F.count("verdict").alias("_answered"), F.collect_set(code).alias("_codes"))
    rows = records.withColumnRenamed("status", "status_before").join(per_record, F.col(key).cast("string") == F.col("_k"), "left").withColumn("outcome", _outcome(extractor == verifier))

    touched = ~F.col("outcome").isin("no_tasks", "skipped_expert_reviewed", "unverified")
    objected = touched & (F.size("_codes") > 0)
    status = F.when(objected, PENDING).when(F.col("outcome") == "promoted", MODEL).otherwise(F.col("status_before"))
    earlier = F.coalesce("qc_codes", F.array().cast("array<string>"))
    kept = F.when(objected, F.filter(earlier, lambda c: ~c.isin(FIELD, LINK, UNCERTAIN))).otherwise(earlier)
    codes = F.array_sort(F.array_union(kept, F.col("_codes")))
    after = {"status": status, "qc_codes": F.when(F.size(codes) > 0, codes), "version": F.coalesce("version", F.lit(1)) + 1, "verification_run": F.lit(run)}
    before = {"status": F.col("status_before"), "qc_codes": F.col("qc_codes"), "version": F.col("version"), "verification_run": F.lit(None).cast("string")}
    trial = rows.withColumns({n: F.when(touched, after[n]).otherwise(before[n]) for n in after} | {"_old": F.struct(*(before[n].alias(n) for n in before))})
    errors = F.transform(F.filter(R.issues(rules or [], trial.schema), lambda i: i["severity"] == "error"), lambda i: i["code"]) if rules else F.array().cast("array<string>")
    trial = trial.withColumn("errors", F.when(F.col("outcome").isin("no_tasks", "skipped_expert_reviewed", "unverified"), F.array().cast("array<string>")).otherwise(errors))
    bad = F.size("errors") > 0
    done = trial.withColumns({n: F.when(bad, F.col(f"_old.{n}")).otherwise(F.col(n)) for n in before} | {"outcome": F.when(bad, "invalid_after").otherwise(F.col("outcome"))})

    experts = records.where(F.col("status").isin(*EXPERT)).select(F.col(key).cast("string").alias("record_id"))
    findings = judged.where("verdict <> 'supported'").join(experts, "record_id", "left_anti").select("task_id", "record_id", "kind", "verdict", "reason")
    columns = [*records.columns, "status_before", "outcome", "errors", "verification_run"]
    return Verified(done.select(*(F.col(f"`{c}`") for c in columns)), findings, problems)


def conflict_candidates(conflicts: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """Those of the told conflicts (conflict_id, record_ids, reason) that name two records or more, all of them known.

    A null in the list is no known record.  Ids meet records by a join; no list is compared with all records."""
    members = conflicts.where(F.size("record_ids") >= 2).select("conflict_id", F.explode(F.array_distinct("record_ids")).alias("_k"))
    known = records.select(F.col(key).cast("string").alias("_k"), F.lit(True).alias("_known")).distinct()
    whole = members.join(known, "_k", "left").groupBy("conflict_id").agg(F.bool_and(F.coalesce("_known", F.lit(False))).alias("_all")).where("_all")
    return conflicts.where(F.size("record_ids") >= 2).join(whole.select("conflict_id"), "conflict_id", "left_semi")
