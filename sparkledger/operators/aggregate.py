"""Aggregation of statements across sources: relations, associations, conflicts and confidence, bundles, chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identity import digest


def relations(statements: DataFrame) -> DataFrame:
    """Clusters of statements (subject, predicate, object, direction, paper, complete, package): counts, the set of
    directions, conflicts, and a confidence tier with its reasons.

    Two clusters of one pair of ends conflict if both have directions and the sets differ, or if one predicate is the inverse
    of the other (column inverse, may be null).  Clusters are aggregates, so conflicts compare predicates, not statements."""
    key = ["subject", "predicate", "object"]
    clusters = statements.groupBy(*key).agg(
        F.count(F.lit(1)).alias("evidence"), F.count_distinct("paper").alias("papers"), F.array_sort(F.collect_set("direction")).alias("directions"),
        F.count_if(~F.col("complete")).alias("incomplete"), F.count_if(F.col("package") != "complete").alias("bad_packages"), F.any_value("inverse").alias("inverse"),
    )
    ends = Window.partitionBy("subject", "object")
    # what the clusters of a pair of ends hold: one distinct set of directions is no conflict
    clusters = clusters.withColumn("_sets", F.collect_set(F.when(F.size("directions") > 0, F.array_join("directions", ","))).over(ends)).withColumn("_predicates", F.collect_set("predicate").over(ends))
    own = F.array_join("directions", ",")
    differs = (F.size("directions") > 0) & F.exists("_sets", lambda s: s != own)
    inverse = F.coalesce(F.array_contains("_predicates", F.col("inverse")), F.lit(False))
    conflict = differs | inverse
    tier = F.when(conflict | (F.col("incomplete") > 0) | (F.col("bad_packages") > 0), "C").when(F.col("papers") >= 2, "A").otherwise("B")
    reasons = F.array_compact(F.array(F.when(conflict, "conflict"), F.when(F.col("incomplete") > 0, "incomplete chain"), F.when(F.col("bad_packages") > 0, "package")))
    return clusters.select(digest("rel_", 16, *map(F.col, key)).alias("relation_id"), *key, "evidence", "papers", "directions", conflict.alias("conflict"), tier.alias("confidence"), F.array_join(reasons, ";").alias("basis"))


def associations(rows: DataFrame, key: list[str], context: list[str]) -> DataFrame:
    """Clusters of associations (key, paper, direction, context columns): a cluster conflicts if it holds both directions;
    its tier is C with a conflict or a missing context, else A with two papers, else B."""
    missing = F.count_if(F.coalesce(*(F.when(F.col(c).isNull(), F.lit(1)) for c in context)).isNotNull())
    clusters = rows.groupBy(*key).agg(
        F.count(F.lit(1)).alias("evidence"), F.count_distinct("paper").alias("papers"), F.array_sort(F.collect_set("direction")).alias("directions"),
        F.count_distinct(F.struct(*context)).alias("contexts"), missing.alias("missing"),
    )
    conflict = F.array_contains("directions", "increase") & F.array_contains("directions", "decrease")
    return clusters.withColumn("conflict", conflict).withColumn("confidence", F.when(conflict | (F.col("missing") > 0), "C").when(F.col("papers") >= 2, "A").otherwise("B"))


def agreed(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """For each key the values on which all rows agree, null otherwise."""
    return rows.groupBy(*keys).agg(*(F.when(F.count_distinct(v) == 1, F.max(v)).alias(v) for v in values))


def first_values(rows: DataFrame, keys: list[str], values: list[str], order: str) -> DataFrame:
    """For each key and column the first value that is not null."""
    return rows.groupBy(*keys).agg(*(F.min_by(v, F.when(F.col(v).isNotNull(), F.col(order))).alias(v) for v in values))


def chunks(rows: DataFrame, source: str, page: str, quote: Column, record: str, kind: str) -> DataFrame:
    """Corpus chunks: records of one source, page and quote, with sorted support ids and kinds."""
    keyed = rows.withColumn("_quote", quote)
    grouped = keyed.groupBy(source, page, "_quote").agg(F.array_sort(F.collect_set(record)).alias("support"), F.array_sort(F.collect_set(kind)).alias("kinds"))
    return grouped.select(digest("chunk_", 16, F.col(source), F.col(page), F.col("_quote")).alias("chunk_id"), source, page, "support", "kinds")


def deduplicated(rows: DataFrame, keys: list[Column], order: str) -> DataFrame:
    """rows with kept (whether it is the first of its key) and alias_of (the first one's order value)."""
    # a null part is no empty one, and (null, x) is not (x, null)
    parts = [F.coalesce(F.concat(F.lit("="), k.cast("string")), F.lit("-")) for k in keys]
    keyed = rows.withColumn("_s", F.sha2(F.concat_ws("\x1f", *parts), 256))
    first = keyed.groupBy("_s").agg(F.min(order).alias("alias_of"))
    return keyed.join(first, "_s").withColumn("kept", F.col(order) == F.col("alias_of")).drop("_s")


def ordinals(rows: DataFrame, group: list[str | Column], order: list[str | Column], name: str = "ordinal") -> DataFrame:
    """Numbers the rows of a group from 0."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1)


def coverage(rows: DataFrame, covered: Column, *by: str) -> DataFrame:
    """(by, n, covered, ratio): share of covered rows, half-even to four places, null without rows."""
    total = F.count(F.lit(1))
    return rows.groupBy(*by).agg(total.alias("n"), F.count_if(covered).alias("covered"), F.bround(F.count_if(covered) / F.nullif(total, F.lit(0)), 4).alias("ratio"))


def degrees(edges: DataFrame, source: str, target: str) -> DataFrame:
    """(node, degree): edges at each node; a self loop counts once."""
    ends = edges.select(F.col(source).alias("node")).unionByName(edges.where(F.col(source) != F.col(target)).select(F.col(target).alias("node")))
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def totals(rows: DataFrame, *by: str) -> DataFrame:
    """Counts for every combination of the columns and of their totals."""
    return rows.cube(*by).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().cast("long").alias("level"))


def families(code: Column, prefixes: dict[str, str]) -> Column:
    """The family of a code by the first prefix that fits, else other."""
    out = F.lit("other")
    for prefix, family in reversed(prefixes.items()):
        out = F.when(code.startswith(prefix), family).otherwise(out)
    return out
