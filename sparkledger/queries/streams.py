"""Streams worked off to their end, compared with the batch result."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.store import shared_dir
from ..streaming import incremental as S
from .registry import Tables, query


def _worked_off(t: Tables, make, mode: str = "append") -> DataFrame:
    """Runs the stream over the events and returns what reached its table; of an updating one with the number of the batch."""
    out = f"{shared_dir(t.spark)}/stream-{uuid.uuid4().hex}"
    # a file source reads folders: the folder of the table's files, and of them those of the table
    events = t.events
    schema = T.StructType([T.StructField(f.name, T.TimestampType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType) for f in events.schema])
    first = events.inputFiles()[0]
    folder = first.rsplit("/", 1)[0]
    pattern = "*" if folder.endswith("events.parquet") else "events.parquet"
    source = S.read_folder(t.spark, folder, schema, fmt="parquet", pattern=pattern)
    made = make(source)
    # a batch that is tried again replaces its own folder
    S.fold(made, lambda batch, k: batch.write.mode("overwrite").parquet(f"{out}/rows/batch={k}"), f"{out}/checkpoint", mode).awaitTermination()
    schema = T.StructType([*made.schema.fields, T.StructField("batch", T.LongType())])
    return t.spark.read.schema(schema).parquet(f"{out}/rows").select(*made.columns, *(["batch"] if mode == "update" else []))


@query("stream_validation", "SELECT event_id, 'RULE_E1' AS code FROM events WHERE event_type = 'purchase' AND value < 50")
def stream_validation(t: Tables) -> DataFrame:
    """Record rules on a stream: stateless, so its result is that of the batch."""
    rules = [{"id": "E1", "kind": "lte", "fields": ["least", "value"]}]
    found = _worked_off(t, lambda s: S.validated(s.where("event_type = 'purchase'").withColumn("least", F.lit(50.0)), rules).select("event_id", F.inline("issues")).select("event_id", "code"))
    return found


@query("stream_window_counts", "SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_window_counts(t: Tables) -> DataFrame:
    """Daily counts under a watermark, told anew while a window is open; the last told of each is its count."""
    told = _worked_off(t, lambda s: S.window_counts(s, "ts", "1 day", "1 hour", "event_type").select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n"), "update")
    return S.latest(told, ["day", "event_type"])


@query("stream_first_values", """
WITH e AS (SELECT user_id, event_type, first_value(event_type) OVER (PARTITION BY user_id ORDER BY ts, CAST(event_id AS VARCHAR)) AS f FROM events WHERE event_type IS NOT NULL)
SELECT CAST(user_id AS VARCHAR) AS "group", f AS first_value, count(*) AS rows, count(*) FILTER (event_type <> f) AS differing FROM e GROUP BY ALL
""")  # fmt: skip
def stream_first_values(t: Tables) -> DataFrame:
    """The first type of each user's events, and how many differ, kept as state while rows come in."""
    with S.state_tables(t.spark):
        told = _worked_off(t, lambda s: S.first_values(s, "user_id", "event_type", "ts", "event_id"), "update")
    return S.latest(told, ["group"])
