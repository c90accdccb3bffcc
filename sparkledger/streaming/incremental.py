"""Incremental ingestion: validation as a stream, repeated versions, first values, and folding by batches."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from ..operators import rules as R


def read_folder(spark: SparkSession, path: str, schema: T.StructType, *, fmt: str = "json", files_per_batch: int = 1000, pattern: str = "*") -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", pattern).format(fmt).load(path)


def validated(stream: DataFrame, rules: list[dict]) -> DataFrame:
    """A stateless stream with ``issues``."""
    return stream.withColumn("issues", R.issues(rules, stream.schema))


def without_repeats(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """The first of each key within a delay; state is dropped behind the watermark."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def window_counts(stream: DataFrame, time: str, width: str, delay: str, *by: str) -> DataFrame:
    """Counts by window and key; late rows within the delay count."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width), *by).agg(F.count(F.lit(1)).alias("n"))


def fold(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Operators of whole-table scope run on each batch; available input is worked off, then the stream ends."""
    return stream.writeStream.foreachBatch(apply).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(rows: DataFrame, keys: list[str], batch: str = "batch") -> DataFrame:
    """Of what an updating stream told in its batches, the last of each key."""
    rest = [c for c in rows.columns if c not in (*keys, batch)]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), batch).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


@contextlib.contextmanager
def state_tables(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, as ``first_values`` needs; the session's own setting comes back."""
    before = spark.conf.get(_STORE[0], None)
    spark.conf.set(*_STORE)
    try:
        yield
    finally:
        spark.conf.unset(_STORE[0]) if before is None else spark.conf.set(_STORE[0], before)


class _FirstValue(StatefulProcessor):
    """Of each group the value of its earliest row, and how many rows differ from it.

    The state is the earliest row and the number of rows of each value; a timer drops it when a group has been idle."""

    def __init__(self, idle_ms: int | None):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", "at long, tie string, value string")
        self.counts = handle.getMapState("counts", "value string", "n long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timers: TimerValues) -> Iterator[pd.DataFrame]:
        own = self.first.get() if self.first.exists() else None
        total = 0
        for part in rows:
            part = part[part["value"].notna()]
            for value, n in part["value"].value_counts().items():
                held = self.counts.getValue((value,))[0] if self.counts.containsKey((value,)) else 0
                self.counts.updateValue((value,), (int(n) + held,))
            for at, tie, value in part.sort_values(["at", "tie"])[["at", "tie", "value"]].head(1).itertuples(index=False):
                if own is None or (at, tie) < (own[0], own[1]):
                    own = (int(at), tie, value)
        if own is None:
            return
        self.first.update(own)
        total = sum(v[0] for v in self.counts.values())
        same = self.counts.getValue((own[2],))[0]
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield pd.DataFrame({"group": [key[0]], "first_value": [own[2]], "rows": [total], "differing": [total - same]})

    def handleExpiredTimer(self, key: tuple, timers: TimerValues, expired: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.first.clear()
        self.counts.clear()
        yield pd.DataFrame({"group": pd.Series([], dtype="object"), "first_value": pd.Series([], dtype="object"), "rows": pd.Series([], dtype="int64"), "differing": pd.Series([], dtype="int64")})

    def close(self) -> None:
        pass


def first_values(stream: DataFrame, group: str, value: str, at: str, tie: str, *, idle_ms: int | None = None) -> DataFrame:
    """(group, first_value, rows, differing), told anew whenever a group gets rows: the value of its earliest row so far, by
    time and then by tie, how many rows have a value, and how many of them have another one.

    Rows may come in any order and however late: an earlier one takes the place of the first.  The last told of each group
    (``latest``) is what a batch over all rows gives.  With idle_ms, a group's state goes when it has had no rows for that
    long; such a stream waits for its timers and does not end by itself.  Rows without a value don't count, rows without a time come last; start the stream inside ``state_tables``."""
    rows = stream.select(F.col(group).cast("string").alias("group"), F.coalesce(F.unix_micros(F.col(at).cast("timestamp")), F.lit((1 << 62))).alias("at"), F.coalesce(F.col(tie).cast("string"), F.lit("")).alias("tie"), F.col(value).cast("string").alias("value"))
    return rows.groupBy("group").transformWithStateInPandas(_FirstValue(idle_ms), "group string, first_value string, rows long, differing long", "Update", "ProcessingTime" if idle_ms is not None else "None")
