"""Relation coding, packages, searches and report rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import label
from ..operators import derive as D
from ..operators import relations as X
from ..operators.joins import last_by
from .registry import SQL, Tables, query

_HAS = lambda cue: f"contains(' ' || lower(regexp_replace(text, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' ', ' {cue} ')"
_NEG = "regexp_matches(lower(text), '(^|\\W)(was)($|\\W)')"


@query("relation_coding", f"WITH m AS (SELECT doc_id, {_HAS('this')} AS a, {_HAS('with')} AS b, {_HAS('of')} AS c, {_NEG} AS n FROM documents) SELECT doc_id, CASE WHEN NOT coalesce(a OR b OR c, false) THEN 'no_cue' WHEN n THEN 'negated' WHEN a AND b THEN 'ambiguous' ELSE 'coded' END AS status, CASE WHEN n OR (a AND b) OR NOT (a OR b OR c) THEN NULL WHEN a THEN 'points' WHEN b OR c THEN 'joins' END AS code, CASE WHEN n OR (a AND b) OR NOT (a OR b OR c) THEN NULL WHEN a THEN 'this' WHEN b THEN 'with' WHEN c THEN 'of' END AS cue FROM m")
def relation_coding(t: Tables) -> DataFrame:
    """The longest cue of a whole text names the predicate; equal length with another code is ambiguous."""
    found = X.predicate_match(F.col("text"), {"points": ["this"], "joins": ["with", "of"]}, negations=["was"])
    return t.documents.select("doc_id", found.alias("m")).select("doc_id", "m.status", "m.code", "m.cue")


#: The name under which whole texts were coded before relation_coding read them.
query("relation_coding_whole", SQL["relation_coding"])(relation_coding)

_WORD = lambda w: f"'(?is)^(|.*?[^A-Za-z0-9]){w}([^A-Za-z0-9]|$)'"
_AT = lambda w: f"CASE WHEN regexp_matches(text, {_WORD(w)}) THEN 1 + length(regexp_extract(text, {_WORD(w)}, 1)) ELSE 0 END"


@query("relation_context", f"WITH p AS (SELECT doc_id, text, {_AT('the')} AS a, {_AT('of')} AS b FROM documents) SELECT doc_id, substr(text, least(a + 3, b + 2)::INT, (greatest(a, b) - least(a + 3, b + 2))::INT) AS context FROM p WHERE a > 0 AND b > 0 AND greatest(a, b) >= least(a + 3, b + 2)")
def relation_context(t: Tables) -> DataFrame:
    """The text between two anchored ends."""
    return t.documents.select("doc_id", X.between(F.col("text"), F.lit("the"), F.lit("of")).alias("context")).where("context IS NOT NULL")


@query("cited_items", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'figure ' || p_size || ',table S' || (p_size % 7) || ',table S' || (p_size % 7 + 1) ELSE 'figure ' || p_size END AS items FROM part")
def cited_items(t: Tables) -> DataFrame:
    size = F.col("p_size").cast("string")
    text = F.concat(F.lit("see Fig. "), size, F.when(F.col("p_size") % 3 == 0, F.concat(F.lit(" and Tables S"), (F.col("p_size") % 7).cast("string"), F.lit("–S"), (F.col("p_size") % 7 + 1).cast("string"))).otherwise(""), F.lit(", fig "), size)
    return t.part.select("p_partkey", F.array_join(X.cited_items(text), ",").alias("items"))


@query("package_status", "SELECT p_partkey, CASE WHEN p_size % 11 = 0 THEN 'not_submitted' WHEN p_size % 5 = 0 THEN 'unverified' WHEN p_size % 2 = 0 THEN 'partial' ELSE 'complete' END AS status FROM part")
def package_status(t: Tables) -> DataFrame:
    """Completeness of the material that a paper cites."""
    c = F.col("p_size")
    cited = X.cited_items(F.concat(F.lit("Fig. 1 and Fig. "), (c + 1).cast("string")))
    held = F.when(c % 2 == 0, F.array(F.lit("figure 1"))).otherwise(F.array(F.lit("figure 1"), F.concat(F.lit("figure "), (c + 1).cast("string"))))
    return t.part.select("p_partkey", X.package_status(cited, held, submitted=c % 11 != 0, verified=c % 5 != 0).alias("status"))


@query("network_search", "SELECT p_partkey FROM part WHERE p_size > 20 AND contains(lower(p_name || ' ' || p_brand || ' ' || p_type), 'brand#1')")
def network_search(t: Tables) -> DataFrame:
    """A facet and a substring over several fields, ignoring case."""
    return t.part.where(F.col("p_size") > 20).where(F.contains(label(F.concat_ws(" ", "p_name", "p_brand", "p_type")), F.lit("brand#1"))).select("p_partkey")


@query("manifest_join", "WITH d AS (SELECT sha256(text) AS digest, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1), m AS (SELECT l.doc_id AS run, sha256(text) AS digest FROM labels l JOIN documents USING (doc_id)) SELECT d.doc_id, d.copies, count(m.run) AS runs, CASE WHEN count(m.run) = 0 THEN 'no_run' ELSE 'run' END AS state FROM d LEFT JOIN m USING (digest) GROUP BY ALL")
def manifest_join(t: Tables) -> DataFrame:
    """Files and runs by the digest of the file; files without a run stay."""
    keyed = t.documents.select("doc_id", F.sha2("text", 256).alias("digest"))
    files = keyed.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
    runs = keyed.join(t.labels.select("doc_id"), "doc_id").groupBy("digest").agg(F.count(F.lit(1)).alias("runs"))
    joined = files.join(runs, "digest", "left")
    return joined.select("doc_id", "copies", F.coalesce("runs", F.lit(0)).alias("runs"), F.when(F.col("runs").isNull(), "no_run").otherwise("run").alias("state"))


@query("case_loader", "WITH l AS (SELECT l_partkey, arg_max(l_suppkey, (l_orderkey, l_linenumber, l_suppkey, l_shipdate)) AS supplier, count(*) AS n FROM lineitem GROUP BY 1) SELECT p_partkey, supplier, coalesce(n, 0) AS n, CASE WHEN supplier IS NULL THEN 'unlisted' ELSE 'listed' END AS origin FROM part LEFT JOIN l ON l_partkey = p_partkey")
def case_loader(t: Tables) -> DataFrame:
    """Records by id with the last one winning, joined to their papers; papers that are not listed are added."""
    lines = t.lineitem.select("l_partkey", F.col("l_suppkey").alias("supplier"), F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate").alias("o"))
    last = last_by(lines, ["l_partkey"], "o").join(lines.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n")), "l_partkey").select("l_partkey", "supplier", "n", F.lit("listed").alias("origin"))
    rows = t.part.select("p_partkey").join(last, F.col("p_partkey") == F.col("l_partkey"), "left")
    return rows.select("p_partkey", "supplier", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("origin", F.lit("unlisted")).alias("origin"))


@query("sample_per_kind", "SELECT o_orderstatus, o_orderpriority, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1, 2")
def sample_per_kind(t: Tables) -> DataFrame:
    """The first record of every source and kind."""
    return t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.min("o_orderkey").alias("o_orderkey"))


@query("first_triple_per_predicate", "SELECT p, arg_min(s, s) AS s, arg_min(o, s) AS o FROM (SELECT 'priority' AS p, CAST(o_orderkey AS VARCHAR) AS s, o_orderpriority AS o FROM orders UNION ALL SELECT 'status', CAST(o_orderkey AS VARCHAR), o_orderstatus FROM orders) GROUP BY 1")
def first_triple_per_predicate(t: Tables) -> DataFrame:
    roles = D.Roles(key="o_orderkey", source="o_custkey", values=["priority", "status"])
    found = D.triples(t.orders.withColumnsRenamed({"o_orderpriority": "priority", "o_orderstatus": "status"}), roles)
    return found.groupBy("p").agg(F.min_by(F.struct("s", "o"), "s").alias("x")).select("p", "x.s", "x.o")


@query("review_queue", "SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderpriority < '3' THEN 0 ELSE 1 END, o_totalprice, o_orderkey) AS INTEGER) AS place FROM orders WHERE o_orderstatus = 'P'")
def review_queue(t: Tables) -> DataFrame:
    """What waits for review in each paper: in scope first."""
    w = Window.partitionBy("o_custkey").orderBy(F.when(F.col("o_orderpriority") < "3", 0).otherwise(1), "o_totalprice", "o_orderkey")
    return t.orders.where("o_orderstatus = 'P'").select("o_orderkey", F.row_number().over(w).alias("place"))


@query("inherited_context", "WITH p AS (SELECT c_custkey, c_nationkey, c_mktsegment FROM customer), n AS (SELECT c_nationkey, count(*) AS k, any_value(c_mktsegment) AS seg FROM customer WHERE c_acctbal > 9500 GROUP BY 1) SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment WHEN k = 1 THEN seg END AS segment, CASE WHEN k IS NULL THEN 'none' WHEN k = 1 THEN 'one' ELSE 'ambiguous' END AS state FROM p LEFT JOIN n USING (c_nationkey)")
def inherited_context(t: Tables) -> DataFrame:
    """A unit row takes what it lacks from its only parent."""
    from ..operators.joins import exactly_one

    parents = t.customer.where("c_acctbal > 9500").select("c_nationkey", F.col("c_mktsegment").alias("parent_segment"))
    rows = t.customer.select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("segment"))
    found = exactly_one(rows, parents, "c_nationkey")
    return found.select("c_custkey", F.coalesce("segment", "parent_segment").alias("segment"), "state")


@query("run_report", "SELECT c_nationkey, c_mktsegment, count(*) AS candidates, count(*) FILTER (c_acctbal > 0) AS records, count(*) FILTER (c_acctbal <= 0) AS rejected, count(*) = count(*) FILTER (c_acctbal > 0) + count(*) FILTER (c_acctbal <= 0) AS balanced FROM customer GROUP BY 1, 2")
def run_report(t: Tables) -> DataFrame:
    """Counts of a run, and whether candidates are records plus rejections."""
    n, kept, out = F.count(F.lit(1)), F.count_if(F.col("c_acctbal") > 0), F.count_if(F.col("c_acctbal") <= 0)
    return t.customer.groupBy("c_nationkey", "c_mktsegment").agg(n.alias("candidates"), kept.alias("records"), out.alias("rejected"), (n == kept + out).alias("balanced"))
