"""The migrator hook: records that plug-ins add to documents."""

import pytest

from sparkledger.plans import migrators as M


def test_runs_by_document(spark):
    rows = [(1, 2, "b", 5, "x"), (1, 1, "a", 1, "x"), (1, 3, "b", None, "x"), (1, 4, "a", 2, "x"), (None, 1, None, 7, "y"), (None, 2, None, 1, "y"), (2, 9, "c", 3, None)]
    given = spark.createDataFrame(rows, "k int, place int, state string, amount long, members string")
    got = M.additional_records(given, "runs", ["k"], ["place"])
    assert got.columns == ["k", "state", "first", "last", "members", "amount"] and got.schema["k"].dataType.simpleString() == "int"
    told = sorted(map(tuple, got.collect()), key=repr)
    want = [(1, "a", 1, 1, 1, 1), (1, "b", 2, 3, 2, 5), (1, "a", 4, 4, 1, 2), (1, None, 1, 4, 4, 8), (None, None, 1, 2, 2, 8), (None, None, 1, 2, 2, 8), (2, "c", 9, 9, 1, 3), (2, None, 9, 9, 1, 3)]
    assert told == sorted(want, key=repr)
    assert M.additional_records(given.limit(0), "runs", ["k"], ["place"]).count() == 0


def test_a_plug_in_of_the_user_with_two_keys(spark):
    @M.migrator("count_of_test")
    class Count:
        SCHEMA = "n long"

        def __init__(self):
            self.n = 0

        def row(self, row):
            self.n += 1

        def end(self):
            return [(self.n,)]

    rows = spark.createDataFrame([("a", "p"), ("a", "p"), ("a", "q"), ("b", None)], "k string, part string")
    got = M.additional_records(rows, "count_of_test", ["k", "part"], [])
    assert sorted(map(tuple, got.collect()), key=repr) == [("a", "p", 2), ("a", "q", 1), ("b", None, 1)]
    spark.udtf.register("added_counts", M.table_function(Count))
    rows.createOrReplaceTempView("rows_of_test")
    assert sorted(map(tuple, spark.sql("SELECT * FROM added_counts(TABLE(rows_of_test), 'k', '')").collect())) == [("a", 3), ("b", 1)]


def test_wrong_calls(spark):
    rows = spark.createDataFrame([(1, 2, "a", 1)], "n int, place int, state string, amount long")
    with pytest.raises(Exception, match="columns of the table"):
        M.additional_records(rows, "runs", ["k"], ["place"]).collect()
    with pytest.raises(Exception, match="columns of the table"):
        M.additional_records(rows, "runs", ["state"], ["place"]).collect()
    with pytest.raises(KeyError):
        M.load_migrator("unknown")
    assert M.load_migrator("sparkledger.plans.migrators:RunRecords") is M.RunRecords
