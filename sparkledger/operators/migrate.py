"""Migration of foreign documents with full accounting: every leaf is consumed, in conflict, or left over."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import longest_prefix


def mapped_leaves(leaves: DataFrame, mapping: DataFrame, keys: list[str]) -> DataFrame:
    """leaves (keys, path, value) with target and status (exact entry or the longest covering prefix; else unmapped)."""
    slashed = lambda c: F.replace(c, F.lit("."), F.lit("/"))
    met = longest_prefix(leaves.withColumn("path", slashed("path")), "path", mapping.withColumn("source", slashed("source")), "source")
    return met.withColumn("path", F.replace("path", F.lit("/"), F.lit("."))).withColumn("status", F.coalesce("status", F.lit("unmapped"))).select(*keys, "path", "value", "target", "status")


def accounted(leaves: DataFrame, keys: list[str]) -> DataFrame:
    """Adds fate to mapped leaves: consumed, conflict (a target with different values), residue or empty."""
    clash = leaves.where("target IS NOT NULL AND value IS NOT NULL AND value <> ''").groupBy(*keys, "target").agg(F.count_distinct("value").alias("_n"))
    rows = leaves.join(clash, [*keys, "target"], "left")
    fate = F.when(F.col("value").isNull() | (F.col("value") == ""), "empty").when(F.col("target").isNull() | (F.col("status") == "unmapped"), "residue").when(F.col("_n") > 1, "conflict").otherwise("consumed")
    return rows.withColumn("fate", fate).drop("_n")


def migrated(leaves: DataFrame, keys: list[str], targets: list[str]) -> DataFrame:
    """One record for each key with a column for each target, from the consumed leaves."""
    return leaves.where("fate = 'consumed'").groupBy(*keys).pivot("target", targets).agg(F.min("value"))


def projected_back(records: DataFrame, key: str, fields: dict[str, str]) -> DataFrame:
    """The lossy reverse view: (key, path, value) under foreign names."""
    cells = F.array(*(F.struct(F.lit(old).alias("path"), F.col(new).cast("string").alias("value")) for new, old in fields.items()))
    return records.select(key, F.inline(F.filter(cells, lambda c: c["value"].isNotNull())))
