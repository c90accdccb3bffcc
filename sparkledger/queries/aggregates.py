"""Aggregation, window, ordering and dashboard queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import label, normalized
from ..operators import aggregate as A
from ..operators.joins import last_by
from .registry import Tables, query


def _statements(t: Tables) -> DataFrame:
    """Lines as statements: a brand stands in a relation (the line status) to a part type."""
    lines = t.lineitem.join(t.part.select("p_partkey", "p_brand", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    direction = F.when(F.col("l_returnflag") == "A", "increase").when(F.col("l_returnflag") == "R", "decrease")
    return lines.select(
        F.col("p_brand").alias("subject"), F.col("l_linestatus").alias("predicate"), F.concat(F.col("p_type"), F.col("l_partkey").cast("string")).alias("object"), direction.alias("direction"), F.col("l_suppkey").alias("paper"),
        (F.col("l_quantity") > 1).alias("complete"), F.when(F.col("l_tax") > 0.07, "partial").otherwise("complete").alias("package"), F.lit(None).cast("string").alias("inverse"),
    )


_STATEMENTS = "s AS (SELECT p_brand AS subject, l_linestatus AS predicate, p_type || l_partkey AS object, CASE l_returnflag WHEN 'A' THEN 'increase' WHEN 'R' THEN 'decrease' END AS direction, l_suppkey AS paper, l_quantity > 1 AS complete, CASE WHEN l_tax > 0.07 THEN 'partial' ELSE 'complete' END AS package FROM lineitem JOIN part ON p_partkey = l_partkey)"
_CLUSTERS = f"WITH {_STATEMENTS}, c AS (SELECT subject, predicate, object, count(*) AS evidence, count(DISTINCT paper) AS papers, coalesce(string_agg(DISTINCT direction, ',' ORDER BY direction), '') AS directions, count(*) FILTER (NOT complete) AS inc, count(*) FILTER (package <> 'complete') AS bad FROM s GROUP BY ALL), f AS (SELECT c.*, EXISTS (SELECT 1 FROM c o WHERE o.subject = c.subject AND o.object = c.object AND o.predicate <> c.predicate AND c.directions <> '' AND o.directions <> '' AND o.directions <> c.directions) AS conflict FROM c)"


@query("aggregate_relations", _CLUSTERS + " SELECT 'rel_' || left(sha256(subject || chr(31) || predicate || chr(31) || object), 16) AS relation_id, subject, predicate, object, evidence, papers, directions, conflict, CASE WHEN conflict OR inc > 0 OR bad > 0 THEN 'C' WHEN papers >= 2 THEN 'A' ELSE 'B' END AS confidence, array_to_string(list_filter([CASE WHEN conflict THEN 'conflict' END, CASE WHEN inc > 0 THEN 'incomplete chain' END, CASE WHEN bad > 0 THEN 'package' END], lambda x: x IS NOT NULL), ';') AS basis FROM f")
def aggregate_relations(t: Tables) -> DataFrame:
    """Relations across papers with conflicts and confidence."""
    return A.relations(_statements(t)).withColumn("directions", F.array_join("directions", ","))


@query("aggregate_associations", "SELECT p_type, p_brand, count(*) AS evidence, count(DISTINCT l_suppkey) AS papers, coalesce(string_agg(DISTINCT d, ',' ORDER BY d), '') AS directions, count(DISTINCT (l_shipmode, l_linestatus)) AS contexts, count(*) FILTER (l_shipmode IS NULL) AS missing, bool_or(coalesce(d = 'increase', false)) AND bool_or(coalesce(d = 'decrease', false)) AS conflict, CASE WHEN (bool_or(coalesce(d = 'increase', false)) AND bool_or(coalesce(d = 'decrease', false))) OR count(*) FILTER (l_shipmode IS NULL) > 0 THEN 'C' WHEN count(DISTINCT l_suppkey) >= 2 THEN 'A' ELSE 'B' END AS confidence FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 'increase' WHEN 'R' THEN 'decrease' END AS d, CASE WHEN l_linenumber < 7 THEN l_linenumber END AS l_shipmode FROM lineitem WHERE l_quantity > 45) JOIN part ON p_partkey = l_partkey GROUP BY 1, 2")
def aggregate_associations(t: Tables) -> DataFrame:
    lines = t.lineitem.where("l_quantity > 45").join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    direction = F.when(F.col("l_returnflag") == "A", "increase").when(F.col("l_returnflag") == "R", "decrease")
    rows = lines.select("p_type", "p_brand", direction.alias("direction"), F.col("l_suppkey").alias("paper"), F.when(F.col("l_linenumber") < 7, F.col("l_linenumber")).alias("study"), "l_linestatus")
    return A.associations(rows, ["p_type", "p_brand"], ["study", "l_linestatus"]).withColumn("directions", F.array_join("directions", ","))


@query("aggregate_confidence_counts", _CLUSTERS + " SELECT CASE WHEN conflict OR inc > 0 OR bad > 0 THEN 'C' WHEN papers >= 2 THEN 'A' ELSE 'B' END AS confidence, conflict, count(*) AS n FROM f GROUP BY ALL")
def aggregate_confidence_counts(t: Tables) -> DataFrame:
    return A.relations(_statements(t)).groupBy("confidence", "conflict").agg(F.count(F.lit(1)).alias("n"))


@query("bundle_agreed_values", "SELECT o_custkey, CASE WHEN count(DISTINCT o_orderstatus) = 1 THEN max(o_orderstatus) END AS status, CASE WHEN count(DISTINCT o_orderpriority) = 1 THEN max(o_orderpriority) END AS priority FROM orders GROUP BY 1")
def bundle_agreed_values(t: Tables) -> DataFrame:
    """Document values on which all records of a source agree."""
    return A.agreed(t.orders.withColumnsRenamed({"o_orderstatus": "status", "o_orderpriority": "priority"}), ["o_custkey"], ["status", "priority"])


@query("bundle_index", "SELECT o_custkey, o_orderstatus, count(*) AS n, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS records FROM orders GROUP BY ALL")
def bundle_index(t: Tables) -> DataFrame:
    """Records by source and kind, in order."""
    return t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda x: x.cast("string")), ",").alias("records"))


@query("sources_first_values", "SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS first_priority, arg_min(o_totalprice, o_orderkey) FILTER (o_totalprice > 200000) AS first_price FROM orders GROUP BY 1")
def sources_first_values(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", F.col("o_orderpriority").alias("first_priority"), F.when(F.col("o_totalprice") > 200000, F.col("o_totalprice")).alias("first_price"))
    return A.first_values(rows, ["o_custkey"], ["first_priority", "first_price"], "o_orderkey")


@query("corpus_chunks", "WITH l AS (SELECT doc_id, source, lang, i AS page, string_split(text, chr(10))[i] AS q FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u(i)), n AS (SELECT *, replace(lower(trim(regexp_replace(q, '\\s+', ' ', 'g'))), 'ß', 'ss') AS k FROM l) SELECT 'chunk_' || left(sha256(source || chr(31) || page || chr(31) || k), 16) AS chunk_id, source, CAST(page AS INTEGER) AS page, string_agg(DISTINCT CAST(doc_id AS VARCHAR), ',' ORDER BY CAST(doc_id AS VARCHAR)) AS support, string_agg(DISTINCT lang, ',' ORDER BY lang) AS kinds FROM n GROUP BY source, page, k")
def corpus_chunks(t: Tables) -> DataFrame:
    lines = t.documents.select(F.col("doc_id").cast("string").alias("doc_id"), "source", "lang", F.posexplode(F.split("text", "\n")).alias("page", "q")).withColumn("page", F.col("page") + 1)
    found = A.chunks(lines, "source", "page", normalized(F.col("q")), "doc_id", "lang")
    return found.withColumn("support", F.array_join("support", ",")).withColumn("kinds", F.array_join("kinds", ","))


@query("candidates_deduplicated", "SELECT doc_id, min(doc_id) OVER (PARTITION BY text, lang) AS alias_of, doc_id = min(doc_id) OVER (PARTITION BY text, lang) AS kept FROM documents")
def candidates_deduplicated(t: Tables) -> DataFrame:
    return A.deduplicated(t.documents, [F.col("text"), F.col("lang")], "doc_id").select("doc_id", "alias_of", "kept")


@query("candidates_ordinals", "SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_totalprice, o_orderkey) - 1 AS INTEGER) AS ordinal FROM orders")
def candidates_ordinals(t: Tables) -> DataFrame:
    return A.ordinals(t.orders, ["o_custkey", "o_orderstatus"], ["o_totalprice", "o_orderkey"]).select("o_orderkey", "ordinal")


@query("relation_coverage", "SELECT l_returnflag, count(*) AS n, count(*) FILTER (l_tax < 0.03) AS covered, round_even(count(*) FILTER (l_tax < 0.03) / count(*), 4) AS ratio FROM lineitem GROUP BY 1")
def relation_coverage(t: Tables) -> DataFrame:
    return A.coverage(t.lineitem, F.col("l_tax") < 0.03, "l_returnflag")


@query("network_degrees", "WITH e AS (SELECT DISTINCT 'c' || c_nationkey AS a, CASE WHEN c_nationkey % 5 = 0 THEN 'c' || c_nationkey ELSE c_mktsegment END AS b FROM customer) SELECT node, count(*) AS degree FROM (SELECT a AS node FROM e UNION ALL SELECT b FROM e WHERE a <> b) GROUP BY 1")
def network_degrees(t: Tables) -> DataFrame:
    a = F.concat(F.lit("c"), F.col("c_nationkey").cast("string"))
    edges = t.customer.select(a.alias("a"), F.when(F.col("c_nationkey") % 5 == 0, a).otherwise(F.col("c_mktsegment")).alias("b")).distinct()
    return A.degrees(edges, "a", "b")


@query("counts_with_totals", "SELECT o_orderstatus, o_orderpriority, count(*) AS n, grouping_id(o_orderstatus, o_orderpriority) AS level FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def counts_with_totals(t: Tables) -> DataFrame:
    return A.totals(t.orders, "o_orderstatus", "o_orderpriority")


@query("warning_families", "SELECT CASE WHEN o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' THEN 'urgent' WHEN o_orderpriority LIKE '4%' THEN 'informational' ELSE 'other' END AS family, count(*) AS n FROM orders GROUP BY 1")
def warning_families(t: Tables) -> DataFrame:
    return t.orders.groupBy(A.families(F.col("o_orderpriority"), {"1": "urgent", "2": "urgent", "4": "informational"}).alias("family")).agg(F.count(F.lit(1)).alias("n"))


@query("dimension_last_wins", "SELECT l_partkey, arg_max(l_suppkey, (l_shipdate, l_orderkey, l_linenumber, l_suppkey)) AS supplier FROM lineitem GROUP BY 1")
def dimension_last_wins(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_partkey", F.col("l_suppkey").alias("supplier"), F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey").alias("o"))
    return last_by(rows, ["l_partkey"], "o").select("l_partkey", "supplier")


@query("status_matrix", "PIVOT (SELECT o_orderpriority AS priority, o_orderstatus FROM orders) ON o_orderstatus IN ('F', 'O', 'P') USING count(*) GROUP BY priority")
def status_matrix(t: Tables) -> DataFrame:
    """Acceptance matrix: one column for each status."""
    return t.orders.withColumnRenamed("o_orderpriority", "priority").groupBy("priority").pivot("o_orderstatus", ["F", "O", "P"]).count().na.fill(0)


@query("paper_summary", "SELECT o_custkey, count(*) AS runs, count(*) FILTER (o_orderstatus = 'F') AS finished, CASE WHEN count(*) FILTER (o_orderstatus = 'P') > 0 THEN 'pending' WHEN count(*) = count(*) FILTER (o_orderstatus = 'F') THEN 'done' ELSE 'open' END AS status FROM orders GROUP BY 1")
def paper_summary(t: Tables) -> DataFrame:
    n, done, wait = F.count(F.lit(1)), F.count_if(F.col("o_orderstatus") == "F"), F.count_if(F.col("o_orderstatus") == "P")
    return t.orders.groupBy("o_custkey").agg(n.alias("runs"), done.alias("finished"), F.when(wait > 0, "pending").when(n == done, "done").otherwise("open").alias("status"))


@query("previous_run", "SELECT o_orderkey, max(CASE WHEN o_orderpriority <> p THEN k END) AS previous FROM (SELECT a.o_orderkey, a.o_orderpriority, b.o_orderpriority AS p, b.o_orderkey AS k FROM orders a LEFT JOIN orders b ON a.o_custkey = b.o_custkey AND b.o_orderkey < a.o_orderkey) GROUP BY 1")
def previous_run(t: Tables) -> DataFrame:
    """The last earlier run of a paper with another part set: changes of value are marked once and carried forward."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    before = F.lag("o_orderpriority").over(w)
    changed = F.when(before != F.col("o_orderpriority"), F.lag("o_orderkey").over(w))
    rows = t.orders.select("o_custkey", "o_orderkey", changed.alias("c"))
    return rows.select("o_orderkey", F.last("c", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("previous"))


@query("top_by_frequency", "SELECT event_type, n FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1) ORDER BY n DESC, event_type LIMIT 3")
def top_by_frequency(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "event_type").limit(3)


@query("top_per_group", "SELECT l_partkey, l_orderkey, l_linenumber, CAST(k AS INTEGER) AS k FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_suppkey, l_discount, l_tax) AS k FROM lineitem) WHERE k <= 6")
def top_per_group(t: Tables) -> DataFrame:
    w = Window.partitionBy("l_partkey").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_suppkey", "l_discount", "l_tax")
    return t.lineitem.withColumn("k", F.row_number().over(w)).where("k <= 6").select("l_partkey", "l_orderkey", "l_linenumber", "k")


@query("relations_ranked", _CLUSTERS + " SELECT subject, predicate, object, evidence, CAST(row_number() OVER (ORDER BY evidence DESC, subject, predicate, object) AS INTEGER) AS place FROM f ORDER BY place LIMIT 50")
def relations_ranked(t: Tables) -> DataFrame:
    """The most supported relations (a report of fifty)."""
    top = A.relations(_statements(t)).select("subject", "predicate", "object", "evidence").orderBy(F.desc("evidence"), "subject", "predicate", "object").limit(50)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("evidence"), "subject", "predicate", "object")))


@query("evidence_sorted", "SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY year(o_orderdate) DESC, o_orderpriority DESC, o_orderkey DESC) AS evidence FROM orders GROUP BY 1")
def evidence_sorted(t: Tables) -> DataFrame:
    """Evidence inside a relation, latest first."""
    item = F.struct(F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("title"), F.col("o_orderkey").alias("k"))
    return t.orders.groupBy("o_custkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(item), asc=False), lambda x: x["k"].cast("string")), ",").alias("evidence"))


@query("facet_counts", "SELECT p_brand, count(*) AS n, CAST(rank() OVER (ORDER BY count(*) DESC, p_brand) AS INTEGER) AS place FROM part WHERE contains(lower(p_name || ' ' || p_type), 'a') GROUP BY 1")
def facet_counts(t: Tables) -> DataFrame:
    """Facets of a search: substring over several fields, ignoring case; facets are few, so one task ranks them."""
    hits = t.part.where(F.contains(label(F.concat_ws(" ", "p_name", "p_type")), F.lit("a")))
    counted = hits.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("place", F.rank().over(Window.orderBy(F.desc("n"), "p_brand")))


@query("induced_subgraph", "WITH e AS (SELECT DISTINCT l_partkey AS a, l_suppkey AS b FROM lineitem WHERE l_quantity = 50) SELECT 'part' AS kind, p_partkey AS id FROM part WHERE p_partkey IN (SELECT a FROM e) UNION ALL SELECT 'supplier', s_suppkey FROM supplier WHERE s_suppkey IN (SELECT b FROM e)")
def induced_subgraph(t: Tables) -> DataFrame:
    """Nodes at the visible edges."""
    edges = t.lineitem.where("l_quantity = 50").select("l_partkey", "l_suppkey").distinct()
    parts = t.part.join(edges, F.col("p_partkey") == F.col("l_partkey"), "left_semi").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"))
    return parts.unionByName(t.supplier.join(edges, F.col("s_suppkey") == F.col("l_suppkey"), "left_semi").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id")))


@query("trait_groups", "SELECT p_type, count(DISTINCT l_suppkey) AS papers, count(DISTINCT p_brand) AS loci, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS kinds FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1")
def trait_groups(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag").join(t.part.select("p_partkey", "p_type", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return lines.groupBy("p_type").agg(F.count_distinct("l_suppkey").alias("papers"), F.count_distinct("p_brand").alias("loci"), F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("kinds"))


@query("case_checks", "SELECT c_nationkey, count(*) AS applicable, count(*) FILTER (c_acctbal > 0) AS passed, string_agg(c_mktsegment, ',' ORDER BY c_custkey) FILTER (c_acctbal > 9900) AS evidence FROM customer GROUP BY 1")
def case_checks(t: Tables) -> DataFrame:
    """Checks that passed of those that apply, and the evidence of each case."""
    item = F.when(F.col("c_acctbal") > 9900, F.struct("c_custkey", "c_mktsegment"))
    grouped = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("applicable"), F.count_if(F.col("c_acctbal") > 0).alias("passed"), F.array_sort(F.collect_list(item)).alias("e"))
    return grouped.select("c_nationkey", "applicable", "passed", F.when(F.size("e") > 0, F.array_join(F.transform("e", lambda x: x["c_mktsegment"]), ",")).alias("evidence"))


@query("mapping_coverage", "SELECT CASE WHEN url LIKE '%example%' THEN 'mapped' ELSE 'unmapped' END AS status, count(*) AS n, round_even(count(*) / (SELECT count(*) FROM pages), 4) AS share FROM pages GROUP BY 1")
def mapping_coverage(t: Tables) -> DataFrame:
    rows = t.pages.select(F.when(F.col("url").like("%example%"), "mapped").otherwise("unmapped").alias("status"))
    counted = rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("share", F.bround(F.col("n") / F.sum("n").over(Window.partitionBy()), 4))
