"""Writers: JSON lines, canonical JSON, CSV with nested cells as JSON, sets of views with a manifest."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def canonical_json(text: pd.Series) -> pd.Series:
    """Sorted keys, no spaces; numbers as Python prints them; NaN and infinities are refused."""
    return text.map(lambda t: t if t is None else json.dumps(json.loads(t), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False))


def write_records(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines without missing fields; a value that is not finite stops the job."""
    doubles = [f.name for f in rows.schema if isinstance(f.dataType, T.FloatType | T.DoubleType)]
    for c in doubles:
        bad = F.isnan(c) | (F.abs(F.col(c)) == float("inf"))
        rows = rows.withColumn(c, F.when(bad, F.raise_error(F.lit(f"{c} is not finite"))).otherwise(F.col(c)))
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).write.mode(mode).text(path)


def cells(rows: DataFrame) -> DataFrame:
    """rows with nested columns as JSON text."""
    nested = [f.name for f in rows.schema if isinstance(f.dataType, T.StructType | T.ArrayType | T.MapType)]
    return rows.withColumns({c: F.to_json(c) for c in nested})


def write_csv(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    cells(rows).write.mode(mode).option("header", "true").csv(path)


def write_views(views: dict[str, DataFrame], path: str, mode: str = "errorifexists") -> DataFrame:
    """Writes each view as Parquet and returns the manifest (view, rows, digest): the digest does not depend on order."""
    spark = next(iter(views.values())).sparkSession
    rows = []
    for name, view in views.items():
        view.write.mode(mode).parquet(f"{path}/{name}")
        back = spark.read.parquet(f"{path}/{name}")
        one = back.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64(*[F.col(c).cast("string") if isinstance(back.schema[c].dataType, T.MapType) else F.col(c) for c in back.columns]).cast("decimal(38,0)")), F.lit(0))).first()
        rows.append((name, one[0], str(one[1])))
    manifest = spark.createDataFrame(rows, "view string, rows long, digest string")
    manifest.coalesce(1).write.mode(mode).json(f"{path}/manifest")
    return manifest
