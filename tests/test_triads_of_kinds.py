"""Triads of three kinds of nodes: all of them, with hubs, nulls and repeats, and without shuffling pairs."""

import random
from functools import partial

import pytest

from sparkledger.operators.triads import triads_of_kinds
from sparkledger.plans.store import stored
from sparkledger.queries import QUERIES

keep = partial(stored, name="rows")


def brute(rows):
    xy, xz, yz = ({(r[a], r[b]) for r in rows if r[a] is not None and r[b] is not None} for a, b in ((0, 1), (0, 2), (1, 2)))
    return sorted((x, y, z) for x, y in xy for z in {z for k, z in xz if k == x} if (y, z) in yz)


@pytest.mark.parametrize(("cell_links", "pairs"), [(10**6, 10**6), (50, 10**6), (7, 3), (200, 20)])
def test_triads_of_kinds(spark, cell_links, pairs):
    rng = random.Random(5)
    rows = [(rng.randrange(30), rng.randrange(20) - 5, rng.randrange(60) * 10**15) for _ in range(400)] + [(0, 1, 0)] * 5
    rows += [(100, rng.randrange(20), rng.randrange(60) * 10**15) for _ in range(200)]  # hubs of each kind
    rows += [(rng.randrange(30), 100, rng.randrange(60)) for _ in range(200)] + [(rng.randrange(30), rng.randrange(20), -7) for _ in range(200)]
    rows += [(None, 3, 5), (4, None, 5), (4, 3, None), (None, None, 5), (4, None, None), (77, 78, None), (None, 78, 79), (77, None, 79)]
    given = spark.createDataFrame(rows, "x long, y long, z long")
    assert sorted(map(tuple, triads_of_kinds(given, keep, cell_links, pairs).collect())) == brute(rows)


def test_no_triads(spark):
    none = spark.createDataFrame([(1, 2, None), (None, 2, 3), (1, None, 3), (4, None, None)], "x long, y long, z long")
    assert sorted(map(tuple, triads_of_kinds(none, keep).collect())) == [(1, 2, 3)]
    assert triads_of_kinds(none.limit(0), keep).count() == 0 and triads_of_kinds(none.where("z IS NULL"), keep).count() == 0


def shuffled(spark):
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_the_query_shuffles_no_pairs(spark, tmp_path):
    """20 parts of 40 suppliers and 40 customers each: 32,000 pairs of 1,600 lines."""
    lines = [(40 * p + k, p, (k * 7 + p) % 40) for p in range(20) for k in range(40)] * 2
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(o, o % 40) for o in range(800)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    before, threshold = shuffled(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the tables were large
    try:
        got = QUERIES["network_triads"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    moved = shuffled(spark) - before
    want = brute([(p, s, o % 40) for o, p, s in set(lines)])
    assert {r["supplier"]: r["triads"] for r in got} == {f"s{s}": sum(t[1] == s for t in want) for s in range(40)}
    assert moved < 6 * len(lines)
