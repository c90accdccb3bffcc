"""Joins with the tie rules of the record engine, and differences of two states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def last_by(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key (an aggregate: rows combine before the shuffle)."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*")


def exactly_one(rows: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """rows with the only match of their key in others, and state: none, one or ambiguous (then without a match)."""
    rest = [c for c in others.columns if c != key]
    once = others.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*rest)).alias("_r"))
    joined = rows.join(once, key, "left")
    state = F.when(F.col("_n").isNull(), "none").when(F.col("_n") == 1, "one").otherwise("ambiguous")
    one = F.col("_n") == 1
    return joined.select(*rows.columns, *(F.when(one, F.col(f"_r.{c}")).alias(c) for c in rest), state.alias("state"))


def longest_prefix(rows: DataFrame, path: str, entries: DataFrame, source: str, separator: str = "/") -> DataFrame:
    """rows with the entry whose source equals the path or is its longest ancestor.

    Each distinct path is exploded into itself and its ancestors (as many as it has separators), which makes it an equi join;
    rows take the entry of their path.  A null path has no entry."""
    parts = F.split(F.col("_p"), separator)
    ancestors = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), separator))
    paths = rows.select(F.col(path).alias("_p")).where("_p IS NOT NULL").distinct()
    met = paths.withColumn("_a", F.explode(ancestors)).join(entries.withColumnRenamed(source, "_a"), "_a")
    rest = [c for c in entries.columns if c != source]
    best = met.groupBy("_p").agg(F.max_by(F.struct(F.col("_a").alias(source), *rest), F.length("_a")).alias("_b"))
    return rows.join(best, F.col(path) == F.col("_p"), "left").select(*rows.columns, "_b.*")


def code_of(text: Column, vocabulary: dict[str, list[str]]) -> Column:
    """The code whose label or alias a text is, ignoring case and space; the first code that claims an alias wins."""
    table: dict[str, str] = {}
    for code, aliases in vocabulary.items():
        for a in [code, *aliases]:
            table.setdefault(" ".join(a.split()).lower(), code)
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), F.lower(F.trim(F.regexp_replace(text, r"\s+", " "))))


def pairs_within(rows: DataFrame, group: list[str], key: str, keep: list[str]) -> DataFrame:
    """Pairs (left_*, right_*) of *distinct keys* of a group with left < right.

    rows must hold few keys for each group (predicates of one pair of ends), however many records stand behind them."""
    side = lambda p: rows.select(*group, *(F.col(c).alias(f"{p}_{c}") for c in (key, *keep)))
    return side("left").join(side("right"), group).where(F.col(f"left_{key}") < F.col(f"right_{key}"))


def field_diff(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """(key, change, old_value, new_value) of added, removed and changed keys."""
    both = old.select(key, F.col(value).alias("old_value"), F.lit(1).alias("_o")).join(new.select(key, F.col(value).alias("new_value"), F.lit(1).alias("_n")), key, "full_outer")
    change = F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").when(~F.col("old_value").eqNullSafe(F.col("new_value")), "changed")
    return both.withColumn("change", change).where("change IS NOT NULL").select(key, "change", "old_value", "new_value")


def count_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, gained, lost): difference of two multisets."""
    signed = old.select(*keys, F.lit(-1).alias("_s")).unionByName(new.select(*keys, F.lit(1).alias("_s")))
    total = signed.groupBy(*keys).agg(F.sum("_s").alias("_d")).where("_d <> 0")
    return total.select(*keys, F.greatest("_d", F.lit(0)).alias("gained"), F.greatest(-F.col("_d"), F.lit(0)).alias("lost"))


def release_change(diff: DataFrame, required: str = "Y") -> DataFrame:
    """One row: the semantic-version step that a field diff asks for (major, minor or patch), with its counts."""
    breaking = F.count_if((F.col("change") == "removed") | ((F.col("change") == "added") & (F.col("new_value") == required)))
    added = F.count_if(F.col("change") == "added")
    counted = diff.agg(breaking.alias("breaking"), added.alias("added"), F.count(F.lit(1)).alias("changes"))
    return counted.withColumn("step", F.when(F.col("breaking") > 0, "major").when(F.col("added") > 0, "minor").when(F.col("changes") > 0, "patch").otherwise("none"))
