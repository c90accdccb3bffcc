"""Verification tasks, verdicts and human decisions as a state machine over records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import digest
from .joins import last_by


def tasks(records: DataFrame, links: DataFrame, key: str, content: list[str]) -> DataFrame:
    """(task_id, record_id, kind, target): one task for each record and one for each of its links."""
    own = records.select(digest("vt_", 20, F.lit("record"), F.col(key), *map(F.col, content)).alias("task_id"), F.col(key).cast("string").alias("record_id"), F.lit("record").alias("kind"), F.lit(None).cast("string").alias("target"))
    linked = links.select(digest("vt_", 20, F.lit("link"), F.col("record_id"), F.col("target")).alias("task_id"), "record_id", F.lit("link").alias("kind"), "target")
    return own.unionByName(linked)


def applied_verdicts(records: DataFrame, task_rows: DataFrame, verdicts: DataFrame, key: str, *, extractor: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(records with new status, verdicts of unknown tasks).

    verdicts: (task_id, verdict, model, ord); of several for one task the last counts.  An expert's approval stays.  Any
    objection demotes; full support promotes, unless the verifier is the model that extracted; partial coverage changes no
    status but stamps the run; a change counts the version up."""
    last = last_by(verdicts, ["task_id"], "ord")
    unknown = verdicts.join(task_rows.select("task_id"), "task_id", "left_anti")
    judged = task_rows.join(last, "task_id", "left")
    grouped = judged.groupBy("record_id").agg(F.count(F.lit(1)).alias("tasks"), F.count("verdict").alias("seen"), F.count_if(F.col("verdict") == "supported").alias("supported"), F.count_if(F.col("verdict") == "not_supported").alias("objected"), F.max("model").alias("model"))
    rows = records.join(grouped.withColumnRenamed("record_id", "_k"), F.col(key).cast("string") == F.col("_k"), "left").drop("_k")
    same = F.coalesce(F.col("model") == (extractor if extractor is not None else F.lit(None)), F.lit(False))
    seen = F.coalesce("seen", F.lit(0))
    outcome = (
        F.when(F.col("status") == "expert_verified", "kept")
        .when(seen == 0, "untouched")
        .when(F.col("objected") > 0, "demoted")
        .when((F.col("supported") == F.col("tasks")) & same, "withheld")
        .when(F.col("supported") == F.col("tasks"), "promoted")
        .otherwise("partial")
    )
    rows = rows.withColumn("outcome", outcome)
    status = F.when(F.col("outcome") == "demoted", "pending_review").when(F.col("outcome") == "promoted", "model_verified").otherwise(F.col("status"))
    changed = F.col("outcome").isin("demoted", "promoted", "partial", "withheld")
    return rows.withColumn("status", status).withColumn("version", F.col("version") + changed.cast("int")), unknown


def applied_decisions(records: DataFrame, decisions: DataFrame, key: str, *, still_valid: Column) -> tuple[DataFrame, DataFrame]:
    """(records, problems): approve, reject or return; the last two need a note; a record that would not be valid afterwards
    stays as it is.  problems: unknown records, repeated decisions and missing notes."""
    counted = decisions.groupBy("record_id").agg(F.count(F.lit(1)).alias("n"), F.any_value(F.struct("decision", "note")).alias("d"))
    known = records.select(F.col(key).alias("record_id"))
    problem = F.when(F.col("n") > 1, "repeated").when(F.col("d.decision").isin("reject", "return") & (F.coalesce(F.trim("d.note"), F.lit("")) == ""), "note_missing")
    judged = counted.withColumn("problem", problem)
    unknown = counted.join(known, "record_id", "left_anti").select("record_id", F.lit("unknown_record").alias("problem"))
    problems = judged.where("problem IS NOT NULL").select("record_id", "problem").unionByName(unknown)
    rows = records.join(judged.where("problem IS NULL").select(F.col("record_id").alias(key), F.col("d.decision").alias("decision")), key, "left")
    fine = F.col("decision").isNotNull() & still_valid
    status = F.when(fine & (F.col("decision") == "approve"), "expert_verified").when(fine & (F.col("decision") == "reject"), "rejected").when(fine & (F.col("decision") == "return"), "pending_review").otherwise(F.col("status"))
    return rows.withColumn("status", status).withColumn("version", F.col("version") + fine.cast("int")), problems
