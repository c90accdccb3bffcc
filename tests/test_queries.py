"""Every query against its SQL on the smallest tables, rows as multisets."""

import os

import duckdb
import pandas as pd
import pytest

from sparkledger.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def rows(frame):
    def plain(v):
        if v is None or v is pd.NA or v != v:
            return None
        v = v.item() if hasattr(v, "item") else v
        return round(v, 9) + 0.0 if isinstance(v, float) and v != int(v) else int(v) if isinstance(v, float) else v

    frame = frame[sorted(frame.columns)]
    return sorted((repr([plain(v) for v in r]) for r in frame.itertuples(index=False)))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    want = duck.execute(SQL[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_relation_coding_reads_past_a_prefix(spark, tmp_path):
    pad = "x " * 150
    texts = [f"{pad}this", f"{pad}with", f"this {pad}was", f"this {pad}with", pad, None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(QUERIES["relation_coding"](spark, str(tmp_path)).collect())
    assert [r["status"] for r in got] == ["coded", "coded", "negated", "ambiguous", "no_cue", "no_cue"]
    assert [r["cue"] for r in got] == ["this", "with", None, None, None, None]
    want = duckdb.sql(SQL["relation_coding"].replace("FROM documents", f"FROM '{tmp_path}/documents.parquet/*.parquet'")).fetchall()
    assert sorted(map(repr, want)) == sorted(repr((r["doc_id"], r["status"], r["code"], r["cue"])) for r in got)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
