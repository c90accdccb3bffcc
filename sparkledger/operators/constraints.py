"""Declared checks over several tables: what applies, what fails, and examples of failing keys.

A check is a dict of ``id``, ``kind`` and ``table``, and of its kind's own entries:

    not_null     column
    interval     column, low, high (either may be missing)
    pattern      column, pattern
    holds        expression (SQL)
    unique       columns
    foreign_key  column, to (table), target (column)
    cardinality  column, of (table), parent (column), low, high: how many rows each parent has

``key`` names the column by which failing rows are told, ``where`` (SQL) the rows that a check applies to.  All checks of a
table that look at one row at a time are one pass of conditional aggregates; keys, links and numbers are one aggregate or anti
join each.  A null value is only checked by not_null and holds (where a null counts as failed).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW_KINDS = ("not_null", "interval", "pattern", "holds")
_OUT = ["check", "kind", "applicable", "failed", "examples"]


def _judged(check: dict) -> tuple[Column, Column]:
    """(whether a row is checked, whether it fails)."""
    kind, on = check["kind"], F.coalesce(F.expr(check["where"]), F.lit(False)) if "where" in check else F.lit(True)
    if kind == "holds":
        return on, ~F.coalesce(F.expr(check["expression"]), F.lit(False))
    value = F.col(check["column"])
    if kind == "not_null":
        return on, value.isNull()
    if kind == "interval":
        out = F.lit(False)
        if check.get("low") is not None:
            out = out | (value < F.lit(check["low"]))
        if check.get("high") is not None:
            out = out | (value > F.lit(check["high"]))
        return on & value.isNotNull(), out
    return on & value.isNotNull(), ~value.rlike(check["pattern"])


def _examples(least: Column, most: Column) -> Column:
    return F.array_distinct(F.array_compact(F.array(least.cast("string"), most.cast("string"))))


def _told(rows: DataFrame, check: dict, fails: Column, key: Column) -> DataFrame:
    counted = rows.agg(F.count(F.lit(1)).alias("applicable"), F.count_if(fails).alias("failed"), F.min(F.when(fails, key)).alias("a"), F.max(F.when(fails, key)).alias("b"))
    return counted.select(F.lit(check["id"]).alias("check"), F.lit(check["kind"]).alias("kind"), "applicable", "failed", _examples(F.col("a"), F.col("b")).alias("examples"))


def _row_checks(table: DataFrame, checks: list[dict]) -> DataFrame:
    """All checks of single rows of a table, in one pass."""
    aggregates = []
    for k, check in enumerate(checks):
        on, fails = _judged(check)
        key = F.col(check["key"])
        aggregates += [F.count_if(on).alias(f"n{k}"), F.count_if(on & fails).alias(f"f{k}"), F.min(F.when(on & fails, key)).alias(f"a{k}"), F.max(F.when(on & fails, key)).alias(f"b{k}")]
    found = table.agg(*aggregates)
    rows = [F.struct(F.lit(c["id"]).alias("check"), F.lit(c["kind"]).alias("kind"), F.col(f"n{k}").alias("applicable"), F.col(f"f{k}").alias("failed"), _examples(F.col(f"a{k}"), F.col(f"b{k}")).alias("examples")) for k, c in enumerate(checks)]
    return found.select(F.inline(F.array(*rows)))


def _wide_check(tables: dict[str, DataFrame], check: dict) -> DataFrame:
    rows = tables[check["table"]]
    if "where" in check:
        rows = rows.where(check["where"])
    if check["kind"] == "unique":
        keyed = rows.where(" AND ".join(f"`{c}` IS NOT NULL" for c in check["columns"]))
        groups = keyed.groupBy(*check["columns"]).agg(F.count(F.lit(1)).alias("_n"))
        return _told(groups, check, F.col("_n") > 1, F.concat_ws("|", *check["columns"]))
    if check["kind"] == "foreign_key":
        links = rows.where(F.col(check["column"]).isNotNull()).select(F.col(check["column"]).alias("_link")).groupBy("_link").agg(F.count(F.lit(1)).alias("_n"))
        held = tables[check["to"]].select(F.col(check["target"]).alias("_link"), F.lit(True).alias("_held")).where("_link IS NOT NULL").distinct()
        met = links.join(held, "_link", "left")
        lost = F.col("_held").isNull()
        counted = met.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("applicable"), F.coalesce(F.sum(F.when(lost, F.col("_n"))), F.lit(0)).alias("failed"), F.min(F.when(lost, F.col("_link"))).alias("a"), F.max(F.when(lost, F.col("_link"))).alias("b"))
        return counted.select(F.lit(check["id"]).alias("check"), F.lit(check["kind"]).alias("kind"), "applicable", "failed", _examples(F.col("a"), F.col("b")).alias("examples"))
    if check["kind"] == "cardinality":
        parents = tables[check["of"]].select(F.col(check["parent"]).alias("_link")).where("_link IS NOT NULL").distinct()
        counts = rows.where(F.col(check["column"]).isNotNull()).groupBy(F.col(check["column"]).alias("_link")).agg(F.count(F.lit(1)).alias("_n"))
        n = F.coalesce("_n", F.lit(0))
        return _told(parents.join(counts, "_link", "left"), check, ~n.between(check.get("low", 0), check.get("high", 2**62)), F.col("_link"))
    raise ValueError(f"{check['kind']} is not a kind of check")


def checked(tables: dict[str, DataFrame], checks: list[dict]) -> DataFrame:
    """(check, kind, applicable, failed, status, examples): a row for each check; examples are the least and the greatest
    failing key.  status is ``pass``, ``fail``, or ``not_applicable`` where nothing was to check."""
    if len({c["id"] for c in checks}) < len(checks):
        raise ValueError("two checks have one id")
    by_table: dict[str, list[dict]] = {}
    for check in checks:
        if check["kind"] in ROW_KINDS:
            by_table.setdefault(check["table"], []).append(check)
    parts = [_row_checks(tables[name], own) for name, own in by_table.items()]
    parts += [_wide_check(tables, c) for c in checks if c["kind"] not in ROW_KINDS]
    found = reduce(DataFrame.unionByName, [p.select(*_OUT) for p in parts])
    status = F.when(F.col("applicable") == 0, "not_applicable").when(F.col("failed") > 0, "fail").otherwise("pass")
    return found.select("check", "kind", "applicable", "failed", status.alias("status"), "examples")
