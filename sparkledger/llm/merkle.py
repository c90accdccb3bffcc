"""A Merkle manifest of a dataset: a leaf for each row, a tree for each source, a tree over the sources, a proof for each row.

A leaf is the digest of the row's fields; three consecutive nodes become one until a single one remains.  The leaves of all
sources stand in one order (source, doc_id), so a tree is a stretch of that order and a *superblock* is a stretch of
``SUPER`` = 3^7 leaves of one tree, whose subtree has one root of its own.

* The order comes from one range partitioning; a row's place is its place inside its partition plus what partitions before
  it hold.  A hot source is cut into superblocks like any other.
* Upwards: superblocks are reduced to their roots, these are the leaves of the next stage, until each tree has one node
  (three stages for 10^10 leaves).  The trees' roots then go through the same stages as one tree.
* Downwards (the subtree exchange): nodes of a stage and the outer nodes that their proofs need (one row for each
  superblock) are cogrouped by superblock in ``applyInPandas``; one call finishes the local reduction, joins local and outer
  proof and, at the leaves, folds the proof again from the row as it is found.

Small trees share a group (superblocks that begin in the same stretch), so many small sources are no many small groups, and
no group has more than a few times ``SUPER`` rows.

Defined cases: a null field is ``-``; rows without an id come first and are never tampered with; equal ids are ordered by
their leaf, rows that are equal in all fields by their place in the table; a null source is a source of its own and the
first; an empty table gives an empty manifest; other columns take no part, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import release_memory, shuffle_width, stored

ARITY = 3
SUPER = ARITY**7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _digest(values: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[_field(v) for v in values]).cast("binary"), 256))


def without_breaks(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """The damage that a query looks for: (whether the row is touched, its text without line breaks)."""
    touched = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.lit(False))
    return touched, F.translate(text.cast("string"), "\n", "")


def leaves(docs: DataFrame, damage: Callable[[Column, Column], tuple[Column, Column]] | None = None) -> DataFrame:
    """(doc_id, source, leaf, found, at): found is the leaf of the row as it is found later, null where it is the same."""
    fields = [F.col(x) for x in FIELDS]
    touched, text = (F.lit(False), fields[-1]) if damage is None else damage(fields[0], fields[-1])
    found = F.when(touched, _digest([*fields[:-1], text]))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), _digest(fields).alias("leaf"), found.alias("found"), F.monotonically_increasing_id().alias("at"))


def _in_order(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with part and i, starts): part is a stretch of the order by keys, i a row's place in it, starts (part, start) the
    number of rows before it.  There are as many parts as shuffle partitions, which bounds starts."""
    spark = rows.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            at = pa.array(range(n, n + batch.num_rows), type=pa.int64())
            n += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * batch.num_rows, type=pa.int32()), at], names=[*batch.schema.names, "part", "i"])
        release_memory()

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", part int, i long"
    placed = stored(rows.repartitionByRange(shuffle_width(spark), *keys).sortWithinPartitions(*keys).mapInArrow(count, ddl), "placed")
    sizes, before, starts = dict(placed.groupBy("part").count().collect()), 0, []
    for part in sorted(sizes):
        starts.append((part, before))
        before += sizes[part]
    return placed, spark.createDataFrame(starts, "part int, start long")


def _forest(placed: DataFrame, starts: DataFrame) -> tuple[DataFrame, int]:
    """(leaves with tree, n, pos; leaves of the largest tree): tree is where a source begins in the order, n its leaves."""
    runs = placed.groupBy("part", "source").agg(F.min("i").alias("first"), F.count(F.lit(1)).alias("rows")).join(F.broadcast(starts), "part")
    runs = stored(runs.select("part", "source", "first", "rows", (F.col("start") + F.col("first")).alias("begin")), "runs")
    trees = runs.groupBy("source").agg(F.min("begin").alias("tree"), F.sum("rows").alias("n")).withColumnRenamed("source", "of")
    known = stored(runs.join(trees, F.col("source").eqNullSafe(F.col("of"))).select("part", F.col("source").alias("of"), "first", "begin", "tree", "n"), "trees")
    # the key has the part too, so a hot source is spread over the parts that hold it
    met = placed.join(known.withColumnRenamed("part", "in"), (F.col("part") == F.col("in")) & F.col("source").eqNullSafe(F.col("of")))
    largest = known.agg(F.max("n")).first()[0] or 0
    # ids go through pandas as text: a column of numbers with nulls would become floating point there
    return met.select(F.col("doc_id").cast("string").alias("doc_id"), "found", "tree", "n", (F.col("begin") + F.col("i") - F.col("first") - F.col("tree")).alias("pos"), F.col("leaf").alias("h")), largest


def _keyed(nodes: DataFrame, size: int, stage: int, block: str | None = None) -> DataFrame:
    """nodes with sb, the group of their superblock; block names a column with the superblock's number in its tree."""
    number = F.col(block) if block else F.floor(F.col("pos") / size)
    begin = F.floor(F.col("tree") / size**stage)
    return nodes.withColumn("sb", F.floor((begin + number * size) / size))


def _hash(parts: str) -> str:
    return hashlib.sha256(parts.encode()).hexdigest()


def _subtree(nodes: list[str], n: int, size: int) -> list[list[str]]:
    """The levels of a superblock's subtree in a tree of n nodes: the nodes first, the root last."""
    levels, left = [nodes], n
    while left > 1 and ARITY ** len(levels) <= size:
        below = levels[-1]
        levels.append([_hash("".join(below[i : i + ARITY])) for i in range(0, len(below), ARITY)])
        left = -(-left // ARITY)
    return levels


def _proof(levels: list[list[str]], i: int) -> list[str]:
    """What stands left and right of node i, and of each node above it, in its run: two texts for each level."""
    out = []
    for level in levels[:-1]:
        lo = i - i % ARITY
        out += ["".join(level[lo:i]), "".join(level[i + 1 : lo + ARITY])]
        i //= ARITY
    return out


def fold(leaf: str, proof: list[str]) -> str:
    """The root that a leaf and its proof lead to."""
    for left, right in zip(proof[::2], proof[1::2], strict=True):
        leaf = _hash(left + leaf + right)
    return leaf


def _superblocks(nodes: pd.DataFrame, size: int) -> Iterator[tuple[int, int, int, pd.DataFrame, list[list[str]]]]:
    """(tree, n, number, rows in order, levels) of each superblock of a group."""
    nodes = nodes.sort_values(["tree", "pos"], kind="stable")
    for (tree, n, number), rows in nodes.groupby([nodes.tree, nodes.n, nodes.pos // size], sort=False):
        yield tree, n, number, rows, _subtree([h.hex() for h in rows.h], n, size)


def _upwards(nodes: DataFrame, largest: int, size: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """(nodes of each stage, (tree, h) of the trees that end with it)."""

    def reduced(group: pd.DataFrame) -> pd.DataFrame:
        out = [(tree, -(-n // size), number, bytes.fromhex(levels[-1][0])) for tree, n, number, _, levels in _superblocks(group, size)]
        return pd.DataFrame(out, columns=["tree", "n", "pos", "h"])

    stages, ended = [_keyed(nodes, size, 0)], []
    while True:
        up = stages[-1].select("sb", "tree", "n", "pos", "h").groupBy("sb").applyInPandas(reduced, "tree long, n long, pos long, h binary")
        up = stored(up, "superblocks")
        ended.append(up.where("n = 1").select("tree", "h"))
        if largest <= size ** len(stages):
            return stages, ended
        stages.append(_keyed(up.where("n > 1"), size, len(stages)))


_OUTER = "tree long, block long, path array<string>, subroot string, root string"


def _exchange(nodes: DataFrame, outer: DataFrame, size: int, stage: int, finish: Callable[[pd.DataFrame, Iterator[tuple]], pd.DataFrame], ddl: str) -> DataFrame:
    """Cogroups nodes and outer nodes by superblock; finish gets (row, proof, subroot, root) of all nodes of a group."""

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        outside = {(t, b): (list(p), s, r) for t, b, p, s, r in zip(right.tree, right.block, right.path, right.subroot, right.root, strict=True)}

        def proofs() -> Iterator[tuple]:
            for tree, _, number, rows, levels in _superblocks(left, size):
                path, subroot, root = outside[tree, number]
                for i, row in enumerate(rows.itertuples(index=False)):
                    yield row, _proof(levels, i) + path, subroot, root

        return finish(proofs())

    return nodes.groupBy("sb").cogroup(_keyed(outer, size, stage, "block").groupBy("sb")).applyInPandas(meet, ddl)


def _downwards(stages: list[DataFrame], tops: list[DataFrame], size: int, finish: Callable[[Iterator[tuple]], pd.DataFrame], ddl: str) -> DataFrame:
    """From the last stage to the first; tops: the outer nodes of the trees that end with each stage."""

    def inner(found: Iterator[tuple]) -> pd.DataFrame:
        return pd.DataFrame([(row.tree, row.pos, path, subroot, root) for row, path, subroot, root in found], columns=["tree", "block", "path", "subroot", "root"])

    outer = tops[-1]
    for stage in range(len(stages) - 1, 0, -1):
        below = _exchange(stages[stage].select("sb", "tree", "n", "pos", "h"), outer, size, stage, inner, _OUTER)
        outer = stored(below.unionByName(tops[stage - 1]), "outer")
    return _exchange(stages[0], outer, size, 0, finish, ddl)


def _over_sources(ended: list[DataFrame], size: int) -> list[DataFrame]:
    """The outer nodes of each tree's root, by the stage with which the tree ends."""
    all_trees = reduce(DataFrame.unionByName, [e.withColumn("stage", F.lit(k)) for k, e in enumerate(ended)])
    placed, starts = _in_order(all_trees, ["tree"])
    count = placed.count()
    nodes = placed.join(F.broadcast(starts), "part").select(F.lit(0).cast("long").alias("tree"), F.lit(count).cast("long").alias("n"), (F.col("start") + F.col("i")).alias("pos"), "h", F.col("tree").alias("of"), "stage")

    def tell(found: Iterator[tuple]) -> pd.DataFrame:
        return pd.DataFrame([(row.of, 0, path, row.h.hex(), root, row.stage) for row, path, _, root in found], columns=["tree", "block", "path", "subroot", "root", "stage"])

    stages, tops = _upwards(nodes, count, size)
    outer = [t.select("tree", F.lit(0).cast("long").alias("block"), F.array().cast("array<string>").alias("path"), F.lit(None).cast("string").alias("subroot"), F.lower(F.hex("h")).alias("root")) for t in tops]
    paths = stored(_downwards(stages, outer, size, tell, f"{_OUTER}, stage int"), "paths")
    return [paths.where(F.col("stage") == k).drop("stage") for k in range(len(ended))]


_ROW = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def manifest(docs: DataFrame, *, damage: Callable[[Column, Column], tuple[Column, Column]] | None = None, keep_proofs: bool = False, size: int = SUPER) -> DataFrame:
    """A row for each row of docs: its leaf, its tree's root (subroot), the root of all, the digest of its proof, and the root
    that the row leads to as it is found after ``damage`` (verified: whether that is the root).

    With ``keep_proofs`` the proof comes too, as an array of what stands left and right at each level (see ``fold``).  size, a
    power of three, is that of a superblock; results don't depend on it."""
    placed, starts = _in_order(stored(leaves(docs, damage), "leaves"), ["source", "doc_id", "leaf", "at"])
    nodes, largest = _forest(placed, starts)
    stages, ended = _upwards(nodes, largest, size)
    tops = _over_sources(ended, size)

    def rows(found: Iterator[tuple]) -> pd.DataFrame:
        out = []
        for row, proof, subroot, root in found:
            leaf = row.h.hex()
            again = fold(leaf if row.found is None else row.found.hex(), proof)
            out.append((row.doc_id, leaf, subroot, root, _hash("".join(proof)), again, again == root, *([proof] if keep_proofs else [])))
        return pd.DataFrame(out, columns=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", *(["proof"] if keep_proofs else [])])

    made = _downwards(stages, tops, size, rows, _ROW + (", proof array<string>" if keep_proofs else ""))
    return made.withColumn("doc_id", F.col("doc_id").cast("long"))
