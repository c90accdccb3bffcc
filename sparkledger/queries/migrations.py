"""Records that a plug-in adds while documents are migrated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.migrators import additional_records
from .registry import Tables, query


@query("migrate_additional", """
WITH r AS (SELECT l_orderkey, l_linenumber AS n, l_returnflag AS f, CAST(l_quantity AS BIGINT) AS q, lag(l_returnflag) OVER w IS DISTINCT FROM l_returnflag AS fresh, row_number() OVER w AS i FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag, CAST(l_quantity AS BIGINT))),
s AS (SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY l_orderkey ORDER BY i) AS run FROM r)
SELECT l_orderkey, f AS state, CAST(min(n) AS INTEGER) AS first, CAST(max(n) AS INTEGER) AS last, count(*) AS members, CAST(sum(q) AS BIGINT) AS amount FROM s GROUP BY l_orderkey, run, f
UNION ALL SELECT l_orderkey, NULL, CAST(min(n) AS INTEGER), CAST(max(n) AS INTEGER), count(*), CAST(sum(q) AS BIGINT) FROM s GROUP BY l_orderkey
""")  # fmt: skip
def migrate_additional(t: Tables) -> DataFrame:
    """Orders as documents of lines: the records that the plug-in for runs adds to each."""
    rows = t.lineitem.select("l_orderkey", F.col("l_linenumber").cast("int").alias("place"), F.col("l_returnflag").alias("state"), F.col("l_quantity").cast("long").alias("amount"))
    return additional_records(rows, "runs", ["l_orderkey"], ["place", "state", "amount"])
