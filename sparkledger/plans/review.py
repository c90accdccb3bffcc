"""The fix-point of validation and review fields: review fields depend on warnings, and warnings may depend on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import rules as R
from .fill import RULES, Context

ROUNDS = 3


def _codes(issues: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(F.filter(issues, lambda i: i["severity"] == "warning"), lambda i: i["code"])))


def reviewed(records: DataFrame, context: Context, fields: list[str], rules: list[dict], *, before: str | None = None) -> DataFrame:
    """records with their review fields, ``issues``, ``review_rounds`` and ``review_settled``.

    Issues are found, the named rules of phase 2 fill their fields anew, and issues are found again, until the codes of the
    warnings are those of the round before: two rounds at least and three at most, each record by itself.  A record whose
    codes still change in the last round is not settled.  before names a column of issues that are there from the start (of
    the data set, of the document) and stay.  Review fields that a rule reads but that are not there yet count as missing."""
    names = sorted(fields, key=lambda n: (RULES[n][1], n))
    wrong = [n for n in names if RULES[n][0] != 2]
    if wrong:
        raise ValueError(f"not rules of the second phase: {wrong}")
    given = F.coalesce(F.col(before), F.array().cast(f"array<{R.ISSUE}>")) if before else None
    rows = records
    for name in names:  # so that rules can read them in the first round
        if name not in rows.columns:
            kind = records.limit(0).withColumn("issues", F.array().cast(f"array<{R.ISSUE}>")).select(RULES[name][2](context).alias("x")).schema["x"].dataType
            rows = rows.withColumn(name, F.lit(None).cast(kind))

    def found(frame: DataFrame) -> Column:
        own = R.issues(rules, frame.schema)
        return own if given is None else F.concat(given, own)

    rows = rows.withColumn("issues", found(rows)).withColumn("_codes", F.lit(None).cast("array<string>")).withColumn("_done", F.lit(False)).withColumn("review_rounds", F.lit(0))
    for k in range(1, ROUNDS + 1):
        after = rows
        for name in names:
            after = after.withColumn(f"_new_{name}", RULES[name][2](context))
            after = after.withColumn(name, F.when(F.col("_done"), F.col(name)).otherwise(F.col(f"_new_{name}"))).drop(f"_new_{name}")
        after = after.withColumn("_found", found(after)).withColumn("_now", _codes(F.col("_found")))
        open_ = ~F.col("_done")
        after = after.withColumn("issues", F.when(open_, F.col("_found")).otherwise(F.col("issues"))).withColumn("review_rounds", F.when(open_, F.lit(k)).otherwise(F.col("review_rounds")))
        after = after.withColumn("_done", F.col("_done") | F.coalesce(F.col("_now") == F.col("_codes"), F.lit(False))).withColumn("_codes", F.col("_now"))
        rows = after.drop("_found", "_now")
    return rows.withColumnRenamed("_done", "review_settled").drop("_codes")
