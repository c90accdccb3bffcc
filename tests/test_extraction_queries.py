"""The extraction queries against their SQL on quotes of any length."""

import duckdb
import pytest

from sparkledger.operators.evidence import page_of_evidence
from sparkledger.queries import QUERIES, SQL

from .test_queries import rows


@pytest.fixture(scope="module")
def long_quotes(spark, tmp_path_factory):
    """Documents that hold lines of 1,999 to 30,000 characters which are benchmark texts, and the links of their candidates."""
    folder = tmp_path_factory.mktemp("long")
    lines = {k: f"item {k} " + "word " * n + "x" * (k % 5) + "." for k, n in enumerate((398, 399, 400, 6000, 500, 2))}
    texts = ["\n".join(["first", lines[k], "between", lines[(k + 1) % 6], "last"]) for k in range(6)] + [None, ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(lines.items()), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    return str(folder), con


def agrees(spark, given, name):
    folder, con = given
    got, want = QUERIES[name](spark, folder).toPandas(), con.execute(SQL[name]).fetchdf()
    assert len(want) and rows(got) == rows(want)


def test_links_of_long_quotes(spark, long_quotes):
    agrees(spark, long_quotes, "extraction_links")


def test_a_policy_may_limit_quotes(spark):
    candidates = spark.createDataFrame([(1, "d", "a" * 2001, 1), (2, "d", "a" * 2000, 1)], "candidate int, doc string, quote string, hint int")
    page = spark.createDataFrame([("d", 1, "a" * 3000)], "doc string, page int, text string")
    codes = lambda **kw: [r["code"] for r in page_of_evidence(candidates, page, ["doc"], **kw).orderBy("candidate").collect()]
    assert codes() == ["EVIDENCE_QUOTE_TOO_LONG", None] and codes(longest=None) == [None, None] and codes(longest=10) == ["EVIDENCE_QUOTE_TOO_LONG"] * 2


def test_records_of_long_quotes(spark, long_quotes):
    agrees(spark, long_quotes, "extraction_records")


def test_rejections_of_long_quotes(spark, long_quotes):
    agrees(spark, long_quotes, "extraction_rejections")


def test_report_of_long_quotes(spark, long_quotes):
    agrees(spark, long_quotes, "extraction_report")
