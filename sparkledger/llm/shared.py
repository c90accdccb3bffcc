"""Session helpers of the pipeline operators: shared storage, table access and Arrow plumbing."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; one of our own only where none is set and all runs on
    this machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if "dir" not in _OWN:
        _OWN["dir"] = "file://" + tempfile.mkdtemp(prefix="sparkledger-")
    return _OWN["dir"]


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a DDL string (the types that these operators use)."""
    simple = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(), T.StringType: pa.string(), T.BooleanType: pa.bool_(), T.BinaryType: pa.binary()}

    def of(t: T.DataType) -> pa.DataType:
        return pa.list_(of(t.elementType)) if isinstance(t, T.ArrayType) else simple[type(t)]

    return pa.schema([(f.name, of(f.dataType)) for f in T.StructType.fromDDL(ddl)])


#: Rows of a batch between Spark and its Python workers, where the session does not name a number of its own: texts may be
#: long, and a batch is held by both.
BATCH_ROWS = 2_000


def _short_batches(spark: SparkSession) -> None:
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(BATCH_ROWS))


def release_memory() -> None:
    """Gives free pages of a worker (Arrow's and numpy's) back to the system, since workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], ddl: str) -> DataFrame:
    """mapInArrow that gives a task's free memory back at its end."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release_memory()

    _short_batches(df.sparkSession)
    return df.mapInArrow(task, ddl)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict]], ddl: str) -> DataFrame:
    """mapInArrow with a function from a batch to dicts of columns."""
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for out in fn(batch):
                    yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, type=f.type) for f, x in zip(schema, (out[f.name] for f in schema), strict=True)], schema=schema)
        release_memory()

    _short_batches(df.sparkSession)
    return df.mapInArrow(run, ddl)


def text_column(df: DataFrame, name: str = "text") -> DataFrame:
    """df with the column as a string (a table without rows may hold it without a type)."""
    return df.withColumn(name, F.col(name).cast("string"))
