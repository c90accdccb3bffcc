"""Two-level paths over struct columns: access, unpivot, strings, leaves."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def type_of(schema: T.StructType, path: str) -> T.DataType:
    node: T.DataType = schema
    for name in path.split("."):
        node = node[name].dataType
    return node


def fields(schema: T.StructType) -> Iterator[tuple[str, T.DataType]]:
    """(path, type) of every field, in the order of the schema; groups are structs, other columns stand for themselves."""
    for field in schema:
        if isinstance(field.dataType, T.StructType):
            for inner in field.dataType:
                yield f"{field.name}.{inner.name}", inner.dataType
        else:
            yield field.name, field.dataType


def strings(value: Column, kind: T.DataType) -> Column:
    """Every string inside a value, as an array."""
    none = F.array().cast("array<string>")
    if isinstance(kind, T.StringType):
        return F.when(value.isNotNull(), F.array(value)).otherwise(none)
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StringType):
            return F.coalesce(F.array_compact(value), none)
        return F.coalesce(F.flatten(F.transform(value, lambda x: strings(x, kind.elementType))), none)
    if isinstance(kind, T.MapType):
        return F.coalesce(F.flatten(F.transform(F.map_values(value), lambda x: strings(x, kind.valueType))), none)
    if isinstance(kind, T.StructType) and kind.fields:
        return F.concat(*(strings(value[f.name], f.dataType) for f in kind))
    return none


def with_value(rows: DataFrame, path: str, value: Column) -> DataFrame:
    group, _, name = path.partition(".")
    return rows.withColumn(group, F.col(group).withField(name, value)) if name else rows.withColumn(path, value)


def without(rows: DataFrame, path: str) -> DataFrame:
    """Drops a field; a group that has no value left becomes null."""
    group, _, name = path.partition(".")
    if not name:
        return rows.drop(path)
    rest = [f.name for f in rows.schema[group].dataType if f.name != name]
    if not rest:
        return rows.drop(group)
    empty = F.coalesce(*(F.col(f"{group}.{n}").cast("string") for n in rest)).isNull()
    return rows.withColumn(group, F.when(~empty, F.struct(*(F.col(f"{group}.{n}") for n in rest))))


def unpivot(rows: DataFrame, keys: list[str], paths: list[str]) -> DataFrame:
    """(keys, ordinal, path, value) of the present values of scalar paths, in one pass over the rows."""
    cells = F.array(*(F.struct(F.lit(i).alias("ordinal"), F.lit(p).alias("path"), F.col(p).cast("string").alias("value")) for i, p in enumerate(paths)))
    return rows.select(*keys, F.inline(F.filter(cells, lambda c: c["value"].isNotNull())))


def items(value: Column, kind: T.DataType) -> Column:
    """A scalar or a list as a list without nulls."""
    return F.array_compact(value) if isinstance(kind, T.ArrayType) else F.array_compact(F.array(value))


def leaves(rows: DataFrame, keys: list[str], document: str, depth: int = 4) -> DataFrame:
    """(keys, path, value) of every scalar of a JSON column, read as VARIANT; nesting is followed to a fixed depth."""
    level = rows.select(*keys, F.lit("").alias("path"), F.try_parse_json(F.col(document)).alias("v"))
    found = None
    for _ in range(depth):
        nested = F.schema_of_variant("v").rlike("^(OBJECT|ARRAY)")
        done = level.where(~nested).select(*keys, "path", F.col("v").cast("string").alias("value"))
        found = done if found is None else found.unionByName(done)
        inner = level.where(nested)
        inner.createOrReplaceTempView("_leaves")
        part = inner.sparkSession.sql(f"SELECT {', '.join(f'l.{k}' for k in keys)}, concat(l.path, CASE WHEN l.path = '' THEN '' ELSE '.' END, coalesce(x.key, CAST(x.pos AS STRING))) AS path, x.value AS v FROM _leaves l, LATERAL variant_explode(l.v) x")
        level = part
    return found
