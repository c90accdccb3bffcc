"""Derived views, graphs, audits, reviews and migrations over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import derive as D
from ..operators import graphs as G
from ..operators import migrate as M
from ..operators import review as R
from ..operators.paths import leaves
from ..plans.store import stored
from .registry import Tables, query

_ROLES = D.Roles(key="key", source="source", mentions={"customer": ("customer", None), "status": ("status", "status_id")}, links=["link"], values=["priority", "price"], subject="customer", predicate="predicate", object="status", qualifiers=["priority"])


def _records(t: Tables) -> DataFrame:
    c = F.col
    return t.orders.select(
        c("o_orderkey").alias("key"), F.concat(F.lit("nation-"), (c("o_custkey") % 25).cast("string")).alias("source"), F.concat(F.lit("Customer "), c("o_custkey").cast("string")).alias("customer"), c("o_orderstatus").alias("status"),
        F.concat(F.lit("st:"), c("o_orderstatus")).alias("status_id"), F.when(c("o_orderkey") % 3 == 0, c("o_orderkey") + 1).alias("link"), c("o_orderpriority").alias("priority"), c("o_custkey").alias("price"), F.when(c("o_orderkey") % 2 == 0, "has").otherwise("is-in").alias("predicate"),
    )


_R = "r AS (SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderkey AS k, 'nation-' || (o_custkey % 25) AS source, 'Customer ' || o_custkey AS customer, o_orderstatus AS status, 'st:' || o_orderstatus AS status_id, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey + 1 AS VARCHAR) END AS link, o_orderpriority AS priority, CAST(o_custkey AS VARCHAR) AS price, CASE WHEN o_orderkey % 2 = 0 THEN 'has' ELSE 'is-in' END AS predicate FROM orders)"
_ENTITY = "'ent_' || left(sha256('customer' || chr(31) || lower(customer)), 16)"
_CODED = "CASE predicate WHEN 'has' THEN 'P1' ELSE predicate END"


@query("derive_entities", f"WITH {_R} SELECT key AS record_id, 'customer' AS field, 0 AS position, 'customer' AS entity_type, customer AS mention, CAST(NULL AS VARCHAR) AS entity_id FROM r UNION ALL SELECT key, 'status', 0, 'status', status, status_id FROM r")
def derive_entities(t: Tables) -> DataFrame:
    return D.entities(_records(t), _ROLES)


@query("derive_links", f"WITH {_R} SELECT key AS record_id, 'link' AS field, link AS target FROM r WHERE link IS NOT NULL")
def derive_links(t: Tables) -> DataFrame:
    return D.links(_records(t), _ROLES)


@query("derive_values", f"WITH {_R} SELECT key AS record_id, 'priority' AS field, 0 AS position, priority AS value FROM r UNION ALL SELECT key, 'price', 0, price FROM r")
def derive_values(t: Tables) -> DataFrame:
    return D.values(_records(t), _ROLES)


@query("derive_statements", f"WITH {_R} SELECT 'stmt_' || left(sha256(key || chr(31) || customer || chr(31) || {_CODED} || chr(31) || status_id || chr(31) || 'priority=' || priority), 24) AS statement_id, key AS record_id, customer AS subject, {_CODED} AS predicate, status_id AS object, CASE predicate WHEN 'has' THEN 'ontology' ELSE 'verbatim' END AS predicate_status, 'priority=' || priority AS qualifiers, source AS source_id FROM r")
def derive_statements(t: Tables) -> DataFrame:
    return D.statements(_records(t), _ROLES, {"has": "P1"})


@query("derive_triples", f"WITH {_R} SELECT key AS s, 'priority' AS p, priority AS o, 'literal' AS o_kind, key AS record_id FROM r UNION ALL SELECT key, 'price', price, 'literal', key FROM r UNION ALL SELECT key, 'link', link, 'iri', key FROM r WHERE link IS NOT NULL UNION ALL SELECT key, 'customer', {_ENTITY}, 'id', key FROM r UNION ALL SELECT key, 'status', status_id, 'id', key FROM r UNION ALL SELECT {_ENTITY}, 'label', customer, 'literal', key FROM r UNION ALL SELECT status_id, 'label', status, 'literal', key FROM r UNION ALL SELECT {_ENTITY}, 'type', 'customer', 'literal', key FROM r UNION ALL SELECT status_id, 'type', 'status', 'literal', key FROM r UNION ALL SELECT customer, {_CODED}, status_id, 'id', key FROM r")
def derive_triples(t: Tables) -> DataFrame:
    return D.triples(_records(t), _ROLES, {"has": "P1"})


@query("derive_graph_nodes", f"WITH {_R} SELECT key AS id, 'record' AS kind FROM r UNION ALL SELECT DISTINCT source, 'source' FROM r UNION ALL SELECT DISTINCT {_ENTITY}, 'entity' FROM r UNION ALL SELECT DISTINCT status_id, 'entity' FROM r UNION ALL SELECT DISTINCT link, 'external' FROM r WHERE link IS NOT NULL AND link NOT IN (SELECT key FROM r)")
def derive_graph_nodes(t: Tables) -> DataFrame:
    return D.graph(_records(t), _ROLES)[0]


@query("derive_graph_edges", f"WITH {_R} SELECT key AS s, 'from' AS p, source AS o, 'provenance' AS kind FROM r UNION ALL SELECT key, 'customer', {_ENTITY}, 'mention' FROM r UNION ALL SELECT key, 'status', status_id, 'mention' FROM r UNION ALL SELECT key, 'link', link, 'link' FROM r WHERE link IS NOT NULL")
def derive_graph_edges(t: Tables) -> DataFrame:
    return D.graph(_records(t), _ROLES)[1]


@query("derive_sources", f"WITH {_R} SELECT source, arg_min(priority, k) AS priority, arg_min(link, k) AS link FROM r GROUP BY 1")
def derive_sources(t: Tables) -> DataFrame:
    """First value of each column for each source."""
    from ..operators.aggregate import first_values

    rows = _records(t).withColumn("link", F.col("link").cast("string"))
    return first_values(rows, ["source"], ["priority", "link"], "key")


@query("qa_cloze", "WITH l AS (SELECT doc_id, i, string_split(text, chr(10))[i] AS line FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u(i)), a AS (SELECT *, regexp_extract(line, '[0-9]+', 0) AS answer, doc_id || '/' || (i - 1) AS key FROM l), h AS (SELECT *, instr(line, answer) - 1 AS start FROM a WHERE answer <> '' AND length(trim(line, ' ')) - length(answer) >= 20) SELECT 'qa_' || left(sha256(key || chr(31) || start || chr(31) || (start + length(answer))), 16) AS qa_id, key, left(line, start) || '____' || substr(line, start + length(answer) + 1) AS question, answer, CAST(start AS INTEGER) AS start, CAST(start + length(answer) AS INTEGER) AS \"end\" FROM h")
def qa_cloze(t: Tables) -> DataFrame:
    """Questions from lines with a number: the number is masked."""
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line")).select(F.concat_ws("/", "doc_id", "i").alias("key"), "line")
    return D.cloze(lines, "key", "line", F.regexp_extract("line", "[0-9]+", 0))


def _turns(t: Tables) -> DataFrame:
    return t.conversations.select(F.concat_ws("/", "conv_id", "turn").alias("node"), "conv_id", "turn", "role")


def _turn_edges(t: Tables) -> DataFrame:
    return _turns(t).select(F.col("node").alias("s"), F.concat_ws("/", "conv_id", F.col("turn") - 1).alias("o"), F.when(F.col("role") == "assistant", "evidence").otherwise("method").alias("kind"))


_T = "t AS (SELECT conv_id || '/' || turn AS node, conv_id, turn, role, conv_id || '/' || (turn - 1) AS prev, CASE role WHEN 'assistant' THEN 'evidence' ELSE 'method' END AS kind FROM conversations)"


@query("graph_reachable", f"WITH {_T}, e AS (SELECT node AS s, prev AS o FROM t), a AS (SELECT s AS start, o AS node, 1 AS depth FROM e UNION ALL SELECT x.s, y.o, 2 FROM e x JOIN e y ON x.o = y.s UNION ALL SELECT x.s, z.o, 3 FROM e x JOIN e y ON x.o = y.s JOIN e z ON y.o = z.s) SELECT start, node, min(depth) AS depth FROM a GROUP BY ALL")
def graph_reachable(t: Tables) -> DataFrame:
    return G.reachable(_turn_edges(t))


@query("graph_chains", f"WITH {_T}, e AS (SELECT node AS s, prev AS o, kind FROM t) SELECT s AS start, s || '>' || o AS path, kind AS kinds FROM e UNION ALL SELECT x.s, x.s || '>' || x.o || '>' || y.o, x.kind || ',' || y.kind FROM e x JOIN e y ON x.o = y.s UNION ALL SELECT x.s, x.s || '>' || x.o || '>' || y.o || '>' || z.o, x.kind || ',' || y.kind || ',' || z.kind FROM e x JOIN e y ON x.o = y.s JOIN e z ON y.o = z.s")
def graph_chains(t: Tables) -> DataFrame:
    return G.chains(_turn_edges(t)).select("start", F.array_join("path", ">").alias("path"), F.array_join("kinds", ",").alias("kinds"))


@query("graph_chain_report", f"WITH {_T}, e AS (SELECT node AS s, prev AS o, kind FROM t), p AS (SELECT s, 1 AS d, kind AS first, kind = 'method' AS m FROM e UNION ALL SELECT x.s, 2, x.kind, x.kind = 'method' OR y.kind = 'method' FROM e x JOIN e y ON x.o = y.s UNION ALL SELECT x.s, 3, x.kind, x.kind = 'method' OR y.kind = 'method' OR z.kind = 'method' FROM e x JOIN e y ON x.o = y.s JOIN e z ON y.o = z.s), g AS (SELECT s, count(*) AS paths, max(d) AS deepest, bool_or(first = 'evidence') AS he, bool_or(m) AS hm FROM p GROUP BY 1) SELECT t.node AS start, paths, deepest, he AS has_evidence, hm AS has_method, he AND hm AS complete FROM t JOIN g ON g.s = t.node")
def graph_chain_report(t: Tables) -> DataFrame:
    return G.chain_report(_turns(t).select(F.col("node").alias("start")), G.chains(_turn_edges(t)), evidence="evidence", method="method")


@query("graph_argument_audit", f"WITH {_T}, el AS (SELECT node AS record, CASE role WHEN 'user' THEN 'claim' WHEN 'assistant' THEN 'data' ELSE 'warrant' END AS element FROM t), e AS (SELECT node AS s, prev AS o FROM t), n AS (SELECT s, o FROM e UNION SELECT x.s, y.o FROM e x JOIN e y ON x.o = y.s UNION SELECT x.s, z.o FROM e x JOIN e y ON x.o = y.s JOIN e z ON y.o = z.s), c AS (SELECT record, record AS at FROM el UNION ALL SELECT s, o FROM n), a AS (SELECT c.record, bool_or(x.element = 'claim') AS claim, bool_or(x.element = 'data') AS data, bool_or(x.element = 'warrant') AS warrant FROM c JOIN el x ON x.record = c.at GROUP BY 1) SELECT a.record, el.element = 'claim' AS own_claim, a.claim AS chain_claim, el.element = 'data' AS own_data, a.data AS chain_data, el.element = 'warrant' AS own_warrant, a.warrant AS chain_warrant, array_to_string(list_filter([CASE WHEN NOT a.claim THEN 'NO_CLAIM' END, CASE WHEN NOT a.data THEN 'NO_DATA' END, CASE WHEN NOT a.warrant THEN 'NO_WARRANT' END, CASE WHEN NOT EXISTS (SELECT 1 FROM t p WHERE p.node = t.prev) THEN 'UNRESOLVED_LINK' END], lambda x: x IS NOT NULL), ',') AS flags FROM a JOIN el ON el.record = a.record JOIN t ON t.node = a.record")
def graph_argument_audit(t: Tables) -> DataFrame:
    element = F.when(F.col("role") == "user", "claim").when(F.col("role") == "assistant", "data").otherwise("warrant")
    return G.argument_audit(_turns(t).select(F.col("node").alias("record"), element.alias("element")), _turn_edges(t), ["claim", "data", "warrant"])


@query("graph_workflow_layers", f"WITH {_T}, f AS (SELECT conv_id, min(turn) FILTER (turn % 5 = 4) AS cut FROM t GROUP BY 1) SELECT node, CASE WHEN cut IS NULL OR turn < cut THEN CAST(turn - min(turn) OVER (PARTITION BY conv_id) AS INTEGER) END AS layer, cut IS NOT NULL AND turn >= cut AS cyclic FROM t JOIN f USING (conv_id)")
def graph_workflow_layers(t: Tables) -> DataFrame:
    """Order of steps; every fifth turn of a conversation depends on itself, so it and what follows has no layer."""
    loops = _turns(t).where("turn % 5 = 4").select(F.col("node").alias("s"), F.col("node").alias("o"))
    return G.topological_layers(_turns(t).select("node"), _turn_edges(t).select("s", "o").unionByName(loops), lambda df: stored(df, "layers"))


@query("graph_workflow_flags", f"WITH {_T}, i AS (SELECT prev AS node, count(*) AS n FROM t GROUP BY 1) SELECT t.node, role AS stage, coalesce(i.n, 0) AS dependants, NOT EXISTS (SELECT 1 FROM t p WHERE p.node = t.prev) AS unresolved FROM t LEFT JOIN i ON i.node = t.node")
def graph_workflow_flags(t: Tables) -> DataFrame:
    """Steps with their stage, how many depend on them, and whether their prerequisite is missing."""
    edges = _turn_edges(t)
    counts = edges.groupBy(F.col("o").alias("node")).agg(F.count(F.lit(1)).alias("dependants"))
    lost = edges.join(_turns(t).select(F.col("node").alias("o")), "o", "left_anti").select(F.col("s").alias("node"), F.lit(True).alias("lost"))
    rows = _turns(t).join(counts, "node", "left").join(lost, "node", "left")
    return rows.select("node", F.col("role").alias("stage"), F.coalesce("dependants", F.lit(0)).alias("dependants"), F.coalesce("lost", F.lit(False)).alias("unresolved"))


@query("graph_hypothesis_traces", f"WITH {_T}, e AS (SELECT node AS s, prev AS o FROM t), n AS (SELECT s, o, 1 AS d FROM e UNION ALL SELECT x.s, y.o, 2 FROM e x JOIN e y ON x.o = y.s UNION ALL SELECT x.s, z.o, 3 FROM e x JOIN e y ON x.o = y.s JOIN e z ON y.o = z.s) SELECT s AS start, string_agg(o, ',' ORDER BY d, o) AS records FROM n JOIN t ON t.node = n.s AND t.role = 'user' GROUP BY 1")
def graph_hypothesis_traces(t: Tables) -> DataFrame:
    starts = _turns(t).where("role = 'user'").select(F.col("node").alias("start"))
    return G.hypothesis_traces(starts, _turn_edges(t)).select("start", F.array_join("records", ",").alias("records"))


@query("network_cross_layer", "WITH e AS (SELECT p_brand AS brand, s_nationkey AS nation, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL) SELECT CASE WHEN n >= 5 THEN 'shown' ELSE 'few_papers' END AS reason, count(*) AS edges, sum(n)::BIGINT AS evidence FROM e GROUP BY 1")
def network_cross_layer(t: Tables) -> DataFrame:
    """Edges between layers that are shown, and what is hidden, by reason."""
    lines = t.lineitem.select("l_partkey", "l_suppkey").join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    edges = lines.groupBy("p_brand", "s_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return edges.groupBy(F.when(F.col("n") >= 5, "shown").otherwise("few_papers").alias("reason")).agg(F.count(F.lit(1)).alias("edges"), F.sum("n").alias("evidence"))


def _tasks(t: Tables) -> tuple[DataFrame, DataFrame]:
    docs = t.documents.select("doc_id", "lang", F.when(F.col("doc_id") % 7 == 0, "expert_verified").otherwise("extracted").alias("status"), F.lit(1).alias("version"))
    linked = t.labels.where("quality = 1").select(F.col("doc_id").cast("string").alias("record_id"), F.lit("label").alias("target"))
    return docs, R.tasks(docs, linked, "doc_id", ["lang"])


_VT = "vt_' || left(sha256('"
_TASKS = f"tk AS (SELECT '{_VT}record' || chr(31) || doc_id || chr(31) || lang), 20) AS task_id, CAST(doc_id AS VARCHAR) AS record_id, 'record' AS kind, CAST(NULL AS VARCHAR) AS target FROM documents UNION ALL SELECT '{_VT}link' || chr(31) || doc_id || chr(31) || 'label'), 20), CAST(doc_id AS VARCHAR), 'link', 'label' FROM labels WHERE quality = 1)"


@query("review_tasks", f"WITH {_TASKS} SELECT * FROM tk")
def review_tasks(t: Tables) -> DataFrame:
    return _tasks(t)[1]


def _verdicts(t: Tables, task_rows: DataFrame) -> DataFrame:
    label = t.labels.select(F.col("doc_id").cast("string").alias("record_id"), "quality", "toxic")
    verdict = F.when(F.col("toxic") == 1, "uncertain").when(F.col("quality") == 1, "supported").otherwise("not_supported")
    model = F.when(F.col("record_id").cast("long") % 5 == 0, "m1").otherwise("m2")
    real = task_rows.join(label, "record_id").select("task_id", verdict.alias("verdict"), model.alias("model"), F.lit(2).alias("ord"))
    older = real.select("task_id", F.lit("not_supported").alias("verdict"), F.lit("m2").alias("model"), F.lit(1).alias("ord"))
    stray = t.labels.where("toxic = 1").select(F.concat(F.lit("vt_x"), F.col("doc_id").cast("string")).alias("task_id"), F.lit("supported").alias("verdict"), F.lit("m2").alias("model"), F.lit(1).alias("ord"))
    return real.unionByName(older).unionByName(stray)


@query("review_verdicts", f"""WITH {_TASKS}, j AS (SELECT tk.record_id, l.doc_id IS NOT NULL AS seen, CASE WHEN toxic = 1 THEN 'uncertain' WHEN quality = 1 THEN 'supported' ELSE 'not_supported' END AS v FROM tk LEFT JOIN labels l ON CAST(l.doc_id AS VARCHAR) = tk.record_id),
g AS (SELECT record_id, count(*) AS n, count(*) FILTER (seen) AS seen, count(*) FILTER (seen AND v = 'supported') AS s, count(*) FILTER (seen AND v = 'not_supported') AS o FROM j GROUP BY 1),
q AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'kept' WHEN seen = 0 THEN 'untouched' WHEN o > 0 THEN 'demoted' WHEN s = n AND doc_id % 5 = 0 THEN 'withheld' WHEN s = n THEN 'promoted' ELSE 'partial' END AS outcome FROM documents JOIN g ON record_id = CAST(doc_id AS VARCHAR))
SELECT doc_id, outcome, CASE WHEN outcome = 'demoted' THEN 'pending_review' WHEN outcome = 'promoted' THEN 'model_verified' WHEN doc_id % 7 = 0 THEN 'expert_verified' ELSE 'extracted' END AS status, CASE WHEN outcome IN ('kept', 'untouched') THEN 1 ELSE 2 END AS version FROM q""")
def review_verdicts(t: Tables) -> DataFrame:
    docs, task_rows = _tasks(t)
    rows, _ = R.applied_verdicts(docs, task_rows, _verdicts(t, task_rows), "doc_id", extractor=F.lit("m1"))
    return rows.select("doc_id", "outcome", "status", "version")


@query("review_unknown_verdicts", "SELECT 'vt_x' || doc_id AS task_id FROM labels WHERE toxic = 1")
def review_unknown_verdicts(t: Tables) -> DataFrame:
    docs, task_rows = _tasks(t)
    return R.applied_verdicts(docs, task_rows, _verdicts(t, task_rows), "doc_id")[1].select("task_id")


def _decisions(t: Tables) -> tuple[DataFrame, DataFrame]:
    docs, _ = _tasks(t)
    rows = t.labels.select("doc_id", F.when(F.col("toxic") == 1, "reject").when(F.col("quality") == 1, "approve").otherwise("return").alias("decision"), F.when(F.col("doc_id") % 3 > 0, "seen").alias("note"))
    twice = rows.where("doc_id % 11 = 0")
    return R.applied_decisions(docs, rows.unionByName(twice).unionByName(rows.where("doc_id % 13 = 0").withColumn("doc_id", -F.col("doc_id") - 1)).withColumnRenamed("doc_id", "record_id"), "doc_id", still_valid=F.col("lang") != "de")


_DEC = "c AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'reject' WHEN quality = 1 THEN 'approve' ELSE 'return' END AS d, CASE WHEN doc_id % 11 = 0 THEN 'repeated' WHEN NOT (toxic = 0 AND quality = 1) AND doc_id % 3 = 0 THEN 'note_missing' END AS problem FROM labels)"


@query("review_decisions", f"WITH {_DEC} SELECT x.doc_id, CASE WHEN d IS NULL OR problem IS NOT NULL OR lang = 'de' THEN CASE WHEN x.doc_id % 7 = 0 THEN 'expert_verified' ELSE 'extracted' END WHEN d = 'approve' THEN 'expert_verified' WHEN d = 'reject' THEN 'rejected' ELSE 'pending_review' END AS status, CASE WHEN d IS NULL OR problem IS NOT NULL OR lang = 'de' THEN 1 ELSE 2 END AS version FROM documents x LEFT JOIN c ON c.doc_id = x.doc_id")
def review_decisions(t: Tables) -> DataFrame:
    return _decisions(t)[0].select("doc_id", "status", "version")


@query("review_decision_problems", f"WITH {_DEC}, o AS (SELECT -doc_id - 1 AS record_id, CASE WHEN d <> 'approve' AND doc_id % 3 = 0 THEN 'note_missing' END AS problem FROM c WHERE doc_id % 13 = 0) SELECT doc_id AS record_id, problem FROM c WHERE problem IS NOT NULL UNION ALL SELECT record_id, problem FROM o WHERE problem IS NOT NULL UNION ALL SELECT record_id, 'unknown_record' FROM o")
def review_decision_problems(t: Tables) -> DataFrame:
    return _decisions(t)[1]


def _foreign(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.to_json(F.struct(F.struct(F.col("o_orderstatus").alias("state"), F.col("o_orderpriority").alias("rank")).alias("info"), F.struct(F.col("o_custkey").alias("who"), F.when(F.col("o_orderkey") % 4 == 0, "F").otherwise("").alias("state2")).alias("more"))).alias("doc"))


def _accounted(t: Tables) -> DataFrame:
    mapping = t.spark.createDataFrame([("info.state", "status", "mapped"), ("info", "misc", "mapped"), ("more.state2", "status", "mapped")], "source string, target string, status string")
    return M.accounted(M.mapped_leaves(leaves(_foreign(t), ["o_orderkey"], "doc"), mapping, ["o_orderkey"]), ["o_orderkey"])


_LEAVES = "f AS (SELECT o_orderkey, unnest([{'path': 'info.state', 'value': o_orderstatus, 'target': 'status'}, {'path': 'info.rank', 'value': o_orderpriority, 'target': 'misc'}, {'path': 'more.who', 'value': CAST(o_custkey AS VARCHAR), 'target': NULL}, {'path': 'more.state2', 'value': CASE WHEN o_orderkey % 4 = 0 THEN 'F' ELSE '' END, 'target': 'status'}], recursive := true), o_orderkey % 4 = 0 AND o_orderstatus <> 'F' AS clash FROM orders), a AS (SELECT o_orderkey, path, value, target, CASE WHEN value = '' THEN 'empty' WHEN target IS NULL THEN 'residue' WHEN target = 'status' AND clash THEN 'conflict' ELSE 'consumed' END AS fate FROM f)"


@query("migrate_accounting", f"WITH {_LEAVES} SELECT * FROM a")
def migrate_accounting(t: Tables) -> DataFrame:
    """Every leaf of foreign documents: consumed, in conflict, empty or left over."""
    return _accounted(t).select("o_orderkey", "path", "value", "target", "fate")


@query("migrate_records", f"WITH {_LEAVES} SELECT o_orderkey, min(value) FILTER (target = 'status') AS status, min(value) FILTER (target = 'misc') AS misc FROM a WHERE fate = 'consumed' GROUP BY 1")
def migrate_records(t: Tables) -> DataFrame:
    return M.migrated(_accounted(t), ["o_orderkey"], ["status", "misc"])


@query("migrate_back", "SELECT o_orderkey, unnest([{'path': 'info.state', 'value': o_orderstatus}, {'path': 'info.rank', 'value': o_orderpriority}], recursive := true) FROM orders")
def migrate_back(t: Tables) -> DataFrame:
    """The lossy reverse projection."""
    return M.projected_back(t.orders, "o_orderkey", {"o_orderstatus": "info.state", "o_orderpriority": "info.rank"})


@query("migrate_relation_evidence", "WITH r AS (SELECT o_custkey, arg_min(o_orderkey, o_orderkey) AS k FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) SELECT c_custkey, k, CAST(row_number() OVER (PARTITION BY c_nationkey, k IS NULL ORDER BY c_custkey) - 1 AS INTEGER) AS repeat FROM customer LEFT JOIN r ON o_custkey = c_custkey")
def migrate_relation_evidence(t: Tables) -> DataFrame:
    """A conclusion takes the evidence of its first usable relation; repeats of a place are numbered."""
    first = t.orders.where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.min("o_orderkey").alias("k"))
    rows = t.customer.join(first, F.col("c_custkey") == F.col("o_custkey"), "left")
    n = F.row_number().over(Window.partitionBy("c_nationkey", F.col("k").isNull()).orderBy("c_custkey")) - 1
    return rows.select("c_custkey", "k", n.alias("repeat"))


