"""Bounded traversal, chains, audits and topological layers over link tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEPTH = 3


def reachable(edges: DataFrame, depth: int = DEPTH, starts: DataFrame | None = None) -> DataFrame:
    """(start, node, depth): nodes within so many steps, each at its least depth (visited set, breadth first); from the
    given starts (start), or from all."""
    first = edges if starts is None else edges.join(starts.select(F.col("start").alias("s")), "s", "left_semi")
    level = first.select(F.col("s").alias("start"), F.col("o").alias("node")).distinct().where("start <> node").withColumn("depth", F.lit(1))
    found = level
    for d in range(2, depth + 1):
        step = level.join(edges.withColumnRenamed("s", "node"), "node").select("start", F.col("o").alias("node")).where("start <> node").distinct()
        level = step.join(found, ["start", "node"], "left_anti").withColumn("depth", F.lit(d))
        found = found.unionByName(level)
    return found


def chains(edges: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(start, path, kinds): every path from a start up to a depth, without repeating a record on one path."""
    level = edges.where("s <> o").select(F.col("s").alias("start"), F.array("s", "o").alias("path"), F.array("kind").alias("kinds"))
    found = level
    for _ in range(depth - 1):
        level = level.withColumn("s", F.element_at("path", -1)).join(edges, "s").where(~F.array_contains("path", F.col("o"))).select("start", F.concat("path", F.array("o")).alias("path"), F.concat("kinds", F.array("kind")).alias("kinds"))
        found = found.unionByName(level)
    return found


def chain_report(claims: DataFrame, paths: DataFrame, *, evidence: str, method: str) -> DataFrame:
    """(start, paths, deepest, has_evidence, has_method, complete): evidence counts on the first step, a method anywhere."""
    grouped = paths.groupBy("start").agg(F.count(F.lit(1)).alias("paths"), F.max(F.size("kinds")).alias("deepest"), F.bool_or(F.get("kinds", F.lit(0)) == evidence).alias("has_evidence"), F.bool_or(F.array_contains("kinds", F.lit(method))).alias("has_method"))
    joined = claims.select("start").join(grouped, "start", "left")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    return joined.select("start", F.coalesce("paths", F.lit(0)).alias("paths"), F.coalesce("deepest", F.lit(0)).alias("deepest"), yes("has_evidence").alias("has_evidence"), yes("has_method").alias("has_method"), (yes("has_evidence") & yes("has_method")).alias("complete"))


def argument_audit(elements: DataFrame, edges: DataFrame, names: list[str], depth: int = DEPTH) -> DataFrame:
    """(record, own_<name>, chain_<name>, flags): argument elements of a record itself and of what it reaches.

    elements: (record, element); flags name what a claim lacks, and links that lead nowhere."""
    near = reachable(edges, depth).select(F.col("start").alias("record"), F.col("node"))
    inherited = near.join(elements.withColumnRenamed("record", "node"), "node").select("record", "element")
    own = elements.groupBy("record").agg(F.collect_set("element").alias("own"))
    more = inherited.groupBy("record").agg(F.collect_set("element").alias("chain"))
    lost = edges.join(elements.select(F.col("record").alias("o")).distinct(), "o", "left_anti").select(F.col("s").alias("record")).distinct().withColumn("lost", F.lit(True))
    none = F.array().cast("array<string>")
    rows = own.join(more, "record", "left").join(lost, "record", "left").withColumn("chain", F.array_union("own", F.coalesce("chain", none)))
    flags = F.array_compact(F.array(*(F.when(~F.array_contains("chain", n), F.lit(f"NO_{n.upper()}")) for n in names), F.when(F.col("lost"), F.lit("UNRESOLVED_LINK"))))
    has: Column
    cols = []
    for n in names:
        has = F.array_contains("own", n)
        cols += [has.alias(f"own_{n}"), F.array_contains("chain", n).alias(f"chain_{n}")]
    return rows.select("record", *cols, F.array_join(flags, ",").alias("flags"))


def topological_layers(nodes: DataFrame, edges: DataFrame, store) -> DataFrame:
    """(node, layer, cyclic): the layer is the length of the longest dependency path; nodes on a cycle or behind one have none.

    edges (s, o): s needs o; edges to nodes outside the table do not block.  The graph of open nodes is contracted: a node
    without open needs is settled, and one with a single need o is the function max(bound, layer(o) + weight), which is put
    in place of the node wherever it is needed itself.  Such functions compose to one of their kind, so what a chain hangs on
    is twice as far away after each round, and a chain of n steps takes about log2(n) rounds.  A dependency on itself, or a
    path longer than there are nodes, is a cycle.  Each round goes to a table (store: a function that writes and rereads)."""
    kept = nodes.select("node").where("node IS NOT NULL").distinct()
    inside = edges.join(kept.select(F.col("node").alias("o")), "o", "left_semi").join(kept.select(F.col("node").alias("s")), "s", "left_semi")
    # a row is a need (o, w), or none (o is null); bound: what the node's layer is at least; dead: it hangs on a cycle
    needs = inside.groupBy("s", "o").agg(F.lit(1).cast("long").alias("w")).select(F.col("s").alias("node"), "o", "w", F.lit(0).cast("long").alias("bound"), (F.col("s") == F.col("o")).alias("dead"))
    free = kept.join(needs.select("node").distinct(), "node", "left_anti")
    settled = [free.select("node", F.lit(0).alias("layer"))]
    # nodes that need nothing are settled from the start, so the rounds carry open ones alone
    met = needs.join(free.select(F.col("node").alias("o"), F.lit(True).alias("_free")), "o", "left")
    state = store(met.select("node", F.when(F.col("_free").isNull(), F.col("o")).alias("o"), F.when(F.col("_free").isNull(), F.col("w")).alias("w"), F.when(F.col("_free"), F.col("w")).otherwise(F.lit(0)).cast("long").alias("bound"), "dead"))
    longest = state.select("node").distinct().count()
    rows_left = longest
    while rows_left:
        own = state.groupBy("node").agg(F.count("o").alias("needs"), F.max("o").alias("q"), F.max("w").alias("wq"), F.max("bound").alias("bound"), F.bool_or("dead").alias("dead"))
        own = store(own)
        settled.append(own.where("NOT dead AND needs = 0").select("node", F.col("bound").cast("int").alias("layer")))
        settled.append(own.where("dead").select("node", F.lit(None).cast("int").alias("layer")))
        open_nodes = own.where("NOT dead AND needs > 0")
        gone = own.where("dead OR needs = 0")
        # a need of a node that leaves with this round is not handed on
        single = own.where("NOT dead AND needs = 1").join(gone.select(F.col("node").alias("q")), "q", "left_anti").select(own.columns)
        known = gone.unionByName(single).select(F.col("node").alias("o"), F.col("needs").alias("_n"), F.col("q").alias("_q"), F.col("wq").alias("_w"), F.col("bound").alias("_b"), F.col("dead").alias("_d"))
        rows = state.where("o IS NOT NULL").select("node", "o", "w").join(open_nodes.select("node"), "node", "left_semi").join(known, "o", "left")
        put, lost = F.coalesce(F.col("_n") == 1, F.lit(False)) & ~F.coalesce("_d", F.lit(False)), F.coalesce("_d", F.lit(False))
        target = F.when(F.col("_n").isNull(), F.col("o")).when(put, F.col("_q"))
        weight = F.when(F.col("_n").isNull(), F.col("w")).when(put, F.col("w") + F.col("_w"))
        rows = rows.select("node", target.alias("o"), weight.alias("w"), F.when(F.col("_n").isNotNull() & ~lost, F.col("w") + F.col("_b")).otherwise(F.lit(0)).alias("bound"), lost.alias("dead"), F.col("_n").isNotNull().alias("moved"))
        rows = rows.withColumn("dead", F.col("dead") | F.coalesce((F.col("o") == F.col("node")) | (F.col("w") > longest), F.lit(False)))
        after = rows.unionByName(open_nodes.select("node", F.lit(None).cast(dict(state.dtypes)["o"]).alias("o"), F.lit(None).cast("long").alias("w"), "bound", "dead", F.lit(False).alias("moved")))
        after = store(after.groupBy("node", "o").agg(F.max("w").alias("w"), F.max("bound").alias("bound"), F.bool_or("dead").alias("dead"), F.bool_or("moved").alias("moved")))
        rows_left, moved = after.agg(F.count(F.lit(1)), F.bool_or("moved")).first()
        if not moved and gone.isEmpty():  # what is open needs open nodes that no round can settle
            settled.append(open_nodes.select("node", F.lit(None).cast("int").alias("layer")))
            break
        state = after
    found = settled[0]
    for more in settled[1:]:
        found = found.unionByName(more)
    return found.select("node", "layer", F.col("layer").isNull().alias("cyclic"))


def hypothesis_traces(starts: DataFrame, edges: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(start, records): what a hypothesis reaches, in order of depth and id."""
    return reachable(edges, depth, starts).groupBy("start").agg(F.transform(F.array_sort(F.collect_list(F.struct("depth", "node"))), lambda x: x["node"]).alias("records"))
