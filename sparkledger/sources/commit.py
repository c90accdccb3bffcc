"""Several outputs that appear together: all data first, the manifest last.

A run writes its outputs into a folder of its own and counts them while they are written; only when all are there, one small
file names them.  Readers go by that file, so a run that fails, or is read while it works, shows nothing, and an older run's
outputs stay as they are.
"""

from __future__ import annotations

import contextlib
import json
import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .writers import cells

_MANIFESTS = "_manifests"


def _folder(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _digest(rows: DataFrame):
    """A sum over rows, which does not depend on their order."""
    flat = [F.to_json(f.name) if isinstance(f.dataType, T.MapType | T.StructType | T.ArrayType) else F.col(f.name) for f in rows.schema]
    return F.coalesce(F.sum(F.xxhash64(*flat).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))


def commit_outputs(outputs: dict[str, tuple[DataFrame, str]], path: str, *, facts: dict | None = None) -> dict:
    """Writes outputs (name: rows and one of parquet, json, csv) under path and returns the manifest.

    Rows and digest of each are observed in the pass that writes it.  If anything fails, what the run wrote is removed, the
    error is raised again, and what path showed before is what it shows."""
    if not outputs:
        raise ValueError("nothing to write")
    spark = next(iter(outputs.values()))[0].sparkSession
    latest = committed(spark, path)
    run = uuid.uuid4().hex
    own, files = _folder(spark, f"{path}/{run}")
    try:
        told = {}
        for name, (rows, kind) in outputs.items():
            seen = Observation()
            made = rows.observe(seen, F.count(F.lit(1)).alias("rows"), _digest(rows).alias("digest"))
            writer = (cells(made) if kind == "csv" else made).write
            if kind == "csv":
                writer = writer.option("header", "true")
            getattr(writer, kind)(f"{path}/{run}/{name}")
            told[name] = {"kind": kind, "rows": seen.get["rows"], "digest": str(seen.get["digest"]), "schema": rows.schema.json() if kind != "csv" else None}
        manifest = {"order": (latest["order"] + 1) if latest else 1, "run": run, "outputs": told, "facts": facts or {}}
        draft, _ = _folder(spark, f"{path}/{run}/_manifest")
        stream = files.create(draft, True)
        stream.write(bytearray(json.dumps(manifest, sort_keys=True), "utf-8"))
        stream.close()
        home, _ = _folder(spark, f"{path}/{_MANIFESTS}")
        files.mkdirs(home)
        if not files.rename(draft, _folder(spark, f"{path}/{_MANIFESTS}/{manifest['order']:012d}-{run}.json")[0]):
            raise OSError(f"the manifest of {path} could not be put in place")
    except BaseException:
        with contextlib.suppress(Exception):
            files.delete(own, True)
        raise
    return manifest


def committed(spark: SparkSession, path: str) -> dict | None:
    """The last manifest under path; null if no run has come to its end there."""
    home, files = _folder(spark, f"{path}/{_MANIFESTS}")
    if not files.exists(home):
        return None
    names = sorted(s.getPath().getName() for s in files.listStatus(home) if s.getPath().getName().endswith(".json"))
    if not names:
        return None
    return json.loads("".join(r[0] for r in spark.read.text(f"{path}/{_MANIFESTS}/{names[-1]}").collect()))


def read_output(spark: SparkSession, path: str, name: str) -> DataFrame:
    """An output of the last run that came to its end."""
    manifest = committed(spark, path)
    if manifest is None or name not in manifest["outputs"]:
        raise FileNotFoundError(f"{path} has no output {name}")
    told = manifest["outputs"][name]
    reader = spark.read.option("header", "true") if told["kind"] == "csv" else spark.read.schema(T.StructType.fromJson(json.loads(told["schema"])))
    return getattr(reader, told["kind"])(f"{path}/{manifest['run']}/{name}")


def problems(spark: SparkSession, path: str) -> list[str]:
    """Outputs of the last run whose rows or digest are not those of its manifest."""
    manifest, wrong = committed(spark, path), []
    for name, told in (manifest or {"outputs": {}})["outputs"].items():
        rows = read_output(spark, path, name)
        n, digest = rows.agg(F.count(F.lit(1)), _digest(rows)).first()
        if n != told["rows"] or (told["kind"] != "csv" and str(digest) != told["digest"]):
            wrong.append(name)
    return wrong
