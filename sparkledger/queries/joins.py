"""Join, difference and vocabulary queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import joins as J
from .registry import Tables, query


@query("join_links", "SELECT l_orderkey, l_linenumber, p_name, s_name FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey")
def join_links(t: Tables) -> DataFrame:
    """Record links resolved to both of their targets; dimension sides are broadcast by their size, if at all."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    named = lines.join(t.part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey")).join(t.supplier.select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    return named.select("l_orderkey", "l_linenumber", "p_name", "s_name")


@query("join_dangling", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def join_dangling(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey").join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")


@query("join_membership", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def join_membership(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey").join(t.orders.where("o_orderpriority = '1-URGENT'"), F.col("c_custkey") == F.col("o_custkey"), "left_semi")


@query("join_external_targets", "SELECT CAST(o_custkey AS VARCHAR) AS node, 'record' AS kind FROM orders GROUP BY o_custkey UNION ALL SELECT DISTINCT CAST(o_orderkey + 1 AS VARCHAR), 'external' FROM orders WHERE o_orderkey + 1 NOT IN (SELECT o_custkey FROM orders)")
def join_external_targets(t: Tables) -> DataFrame:
    """Nodes of the records, and those that are only targets of links."""
    nodes = t.orders.select(F.col("o_custkey").alias("node")).distinct()
    targets = t.orders.select((F.col("o_orderkey") + 1).alias("node")).distinct()
    outside = targets.join(nodes, "node", "left_anti")
    return nodes.withColumn("kind", F.lit("record")).unionByName(outside.withColumn("kind", F.lit("external"))).withColumn("node", F.col("node").cast("string"))


@query("join_last_verdict", "WITH v AS (SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS verdict FROM orders GROUP BY 1) SELECT c_custkey, coalesce(verdict, 'pending') AS verdict FROM customer LEFT JOIN v ON o_custkey = c_custkey")
def join_last_verdict(t: Tables) -> DataFrame:
    """Verdicts by task; of several the last one counts."""
    last = J.last_by(t.orders.select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], "o_orderkey")
    return t.customer.join(last, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("o_orderstatus", F.lit("pending")).alias("verdict"))


@query("join_first_match", "SELECT c_custkey, o_orderkey FROM customer JOIN (SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON o_custkey = c_custkey")
def join_first_match(t: Tables) -> DataFrame:
    first = t.orders.where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.min("o_orderkey").alias("o_orderkey"))
    return t.customer.join(first, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "o_orderkey")


@query("join_exactly_one", "WITH m AS (SELECT o_custkey, count(*) AS n, any_value(o_orderkey) AS k FROM orders WHERE o_orderpriority = '2-HIGH' GROUP BY 1) SELECT c_custkey, CASE WHEN n = 1 THEN k END AS o_orderkey, CASE WHEN n IS NULL THEN 'none' WHEN n = 1 THEN 'one' ELSE 'ambiguous' END AS state FROM customer LEFT JOIN m ON o_custkey = c_custkey")
def join_exactly_one(t: Tables) -> DataFrame:
    """Context of a unit row: one parent is taken, none and several are states of their own."""
    parents = t.orders.where("o_orderpriority = '2-HIGH'").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return J.exactly_one(t.customer.select("c_custkey"), parents, "c_custkey")


@query("join_longest_prefix", "WITH e AS (SELECT * FROM (VALUES ('https:', 'any'), ('https://site1.example', 'one'), ('http:', 'plain')) v(source, target) UNION ALL SELECT DISTINCT regexp_extract(url, '^https?://[^/]+', 0), 'host' FROM pages WHERE contains(url, '/en/')), m AS (SELECT page_id, url, source, target, row_number() OVER (PARTITION BY page_id ORDER BY length(source) DESC) AS k FROM pages JOIN e ON url = source OR starts_with(url, source || '/')) SELECT p.page_id, m.source, m.target FROM pages p LEFT JOIN m ON m.page_id = p.page_id AND k = 1")
def join_longest_prefix(t: Tables) -> DataFrame:
    """Foreign paths to the mapping entry that covers them best."""
    fixed = t.spark.createDataFrame([("https:", "any"), ("https://site1.example", "one"), ("http:", "plain")], "source string, target string")
    hosts = t.pages.where("contains(url, '/en/')").select(F.regexp_extract("url", "^https?://[^/]+", 0).alias("source"), F.lit("host").alias("target")).distinct()
    return J.longest_prefix(t.pages.select("page_id", "url"), "url", fixed.unionByName(hosts), "source").select("page_id", "source", "target")


@query("join_vocabulary", "SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'high' WHEN o_orderpriority IN ('2-HIGH', '5-LOW') THEN CASE o_orderpriority WHEN '2-HIGH' THEN 'high' ELSE 'low' END END AS code FROM orders")
def join_vocabulary(t: Tables) -> DataFrame:
    """Labels and aliases to codes; the first code that claims an alias wins."""
    return t.orders.select("o_orderkey", J.code_of(F.concat(F.lit(" "), F.lower("o_orderpriority")), {"high": ["1-Urgent", "2-HIGH"], "low": ["5-low", "1-urgent"]}).alias("code"))


@query("join_alias_hop", "WITH f AS (SELECT text, min(doc_id) AS kept FROM documents GROUP BY 1) SELECT l.doc_id AS label, f.kept AS target FROM labels l JOIN documents d ON d.doc_id = l.doc_id JOIN f ON f.text = d.text WHERE l.quality = 1")
def join_alias_hop(t: Tables) -> DataFrame:
    """A reference to a duplicate candidate resolves to the one that was kept."""
    keyed = t.documents.select("doc_id", F.sha2("text", 256).alias("key"))
    kept = keyed.groupBy("key").agg(F.min("doc_id").alias("target"))
    alias = keyed.join(kept, "key").select("doc_id", "target")
    return t.labels.where("quality = 1").join(alias, "doc_id").select(F.col("doc_id").alias("label"), "target")


@query("join_override", "SELECT d.doc_id, coalesce(l.quality, -1) AS quality, CASE WHEN l.doc_id IS NULL THEN 'raw' ELSE 'verified' END AS origin FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def join_override(t: Tables) -> DataFrame:
    """Verified records replace raw ones."""
    joined = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality", F.lit("verified").alias("origin")), "doc_id", "left")
    return joined.select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("origin", F.lit("raw")).alias("origin"))


@query("join_pairs", "WITH k AS (SELECT l_partkey, l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL) SELECT a.l_partkey, a.l_suppkey, a.l_returnflag AS left_flag, b.l_returnflag AS right_flag, a.n AS left_n, b.n AS right_n FROM k a JOIN k b ON a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey AND a.l_returnflag < b.l_returnflag")
def join_pairs(t: Tables) -> DataFrame:
    """Pairs of predicates of one pair of ends: aggregated first, so only distinct keys meet."""
    keyed = t.lineitem.groupBy("l_partkey", "l_suppkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    pairs = J.pairs_within(keyed, ["l_partkey", "l_suppkey"], "l_returnflag", ["n"])
    return pairs.select("l_partkey", "l_suppkey", F.col("left_l_returnflag").alias("left_flag"), F.col("right_l_returnflag").alias("right_flag"), "left_n", "right_n")


_OLD = "SELECT o_custkey AS k, max(o_orderpriority) AS v FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' GROUP BY 1"
_NEW = "SELECT o_custkey AS k, max(o_orderpriority) AS v FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY 1"


def _halves(t: Tables) -> tuple[DataFrame, DataFrame]:
    return t.orders.where("o_orderdate < TIMESTAMP '1996-01-01'"), t.orders.where("o_orderdate >= TIMESTAMP '1996-01-01'")


def _states(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The orders before a day and those from it on, as two states of the customers."""
    state = lambda part: part.groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderpriority").alias("v"))
    return tuple(state(part) for part in _halves(t))


@query("diff_fields", f"SELECT coalesce(o.k, n.k) AS k, CASE WHEN o.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' ELSE 'changed' END AS change, o.v AS old_value, n.v AS new_value FROM ({_OLD}) o FULL JOIN ({_NEW}) n ON o.k = n.k WHERE o.v IS DISTINCT FROM n.v")
def diff_fields(t: Tables) -> DataFrame:
    return J.field_diff(*_states(t), "k", "v")


@query("diff_release_step", f"WITH d AS (SELECT CASE WHEN o.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' ELSE 'changed' END AS change, n.v AS nv FROM ({_OLD}) o FULL JOIN ({_NEW}) n ON o.k = n.k WHERE o.v IS DISTINCT FROM n.v) SELECT *, CASE WHEN breaking > 0 THEN 'major' WHEN added > 0 THEN 'minor' WHEN changes > 0 THEN 'patch' ELSE 'none' END AS step FROM (SELECT count(*) FILTER (change = 'removed' OR (change = 'added' AND nv = '1-URGENT')) AS breaking, count(*) FILTER (change = 'added') AS added, count(*) AS changes FROM d)")
def diff_release_step(t: Tables) -> DataFrame:
    return J.release_change(J.field_diff(*_states(t), "k", "v"), required="1-URGENT")


@query("diff_multisets", "SELECT o_orderpriority, o_orderstatus, greatest(sum(s), 0)::BIGINT AS gained, greatest(-sum(s), 0)::BIGINT AS lost FROM (SELECT o_orderpriority, o_orderstatus, CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN -1 ELSE 1 END AS s FROM orders) GROUP BY ALL HAVING sum(s) <> 0")
def diff_multisets(t: Tables) -> DataFrame:
    return J.count_diff(*_halves(t), ["o_orderpriority", "o_orderstatus"])


@query("diff_except_all", "SELECT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal >= 4500 EXCEPT ALL SELECT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal < 4500")
def diff_except_all(t: Tables) -> DataFrame:
    side = lambda which: t.customer.where(which).select("c_nationkey", "c_mktsegment")
    return side("c_acctbal >= 4500").exceptAll(side("c_acctbal < 4500"))


@query("set_operations", "SELECT s_nationkey AS k, 'both' AS side FROM supplier INTERSECT SELECT c_nationkey, 'both' FROM customer WHERE c_acctbal > 5000 UNION ALL SELECT * FROM (SELECT c_nationkey, 'only' FROM customer WHERE c_acctbal > 5000 EXCEPT SELECT s_nationkey, 'only' FROM supplier)")
def set_operations(t: Tables) -> DataFrame:
    rich, makers = t.customer.where("c_acctbal > 5000").select(F.col("c_nationkey").alias("k")), t.supplier.select(F.col("s_nationkey").alias("k"))
    return makers.intersect(rich).withColumn("side", F.lit("both")).unionByName(rich.subtract(makers).withColumn("side", F.lit("only")))
