"""Triads: triples of nodes of which each two are linked, from a list of edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Links of y and z that a cell of ``triads_of_kinds`` has, about: its task holds them in memory while the lists pass by.
CELL_LINKS = 1_000_000
#: Pairs that a task tries at once, and of a single list before the links of its cell are looked through instead.
PAIRS = 250_000


def oriented(edges: DataFrame) -> DataFrame:
    """(lo, hi): each link of (a, b) once, from the node of fewer links to the one of more (ties by the node itself)."""
    links = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("d"))
    both = links.join(degree.select(F.col("node").alias("a"), F.col("d").alias("da")), "a").join(degree.select(F.col("node").alias("b"), F.col("d").alias("db")), "b")
    first = (F.col("da") < F.col("db")) | ((F.col("da") == F.col("db")) & (F.col("a") < F.col("b")))
    return both.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("lo"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("hi"))


def triads(edges: DataFrame, store=None) -> DataFrame:
    """(x, y, z), x < y < z: every triad of the links (a, b) once; repeated, reversed and self links don't matter.

    Links lead from nodes of few links to nodes of many, so a node has at most sqrt(2 * links) outgoing ones whatever its
    degree: a hub's neighbours are never paired with each other.  Pairs of outgoing links are closed by a third link."""
    out = oriented(edges)
    out = store(out) if store else out
    one, two = out.select("lo", F.col("hi").alias("m")), out.select("lo", F.col("hi").alias("n"))
    wedges = one.join(two, "lo").where("m < n")
    third = out.select(F.least("lo", "hi").alias("m"), F.greatest("lo", "hi").alias("n"))
    return wedges.join(third, ["m", "n"]).select(F.array_sort(F.array("lo", "m", "n")).alias("t")).select(F.col("t")[0].alias("x"), F.col("t")[1].alias("y"), F.col("t")[2].alias("z"))


def _cell(z: Column, bounds: list[float], first: int = 0) -> Column:
    """How many bounds are below z, by halving."""
    if not bounds:
        return F.lit(first)
    mid = len(bounds) // 2
    return F.when(z <= F.lit(bounds[mid]), _cell(z, bounds[:mid], first)).otherwise(_cell(z, bounds[mid + 1 :], first + mid + 1))


def _places(sorted_values: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each value in the sorted ones, and whether it is there."""
    if not len(sorted_values):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return at, sorted_values[at] == values


class _Links:
    """The distinct links (y, z) of a cell, as sorted numbers, with a table of flags by their last bits that most others fail."""

    def __init__(self, y: np.ndarray, z: np.ndarray):
        self.y, self.z = np.unique(y), np.unique(z)
        self.keys = np.unique(np.searchsorted(self.z, z) * len(self.y) + np.searchsorted(self.y, y))
        self.flags = np.zeros(1 << max(10, (16 * len(self.keys)).bit_length()), bool)
        self.flags[self.keys & (len(self.flags) - 1)] = True

    def closed(self, x: np.ndarray, ys: np.ndarray, n_ys: np.ndarray, zs: np.ndarray, n_zs: np.ndarray, pairs: int) -> Iterator[tuple[np.ndarray, ...]]:
        """(x, y, z) of lists: each x has n_ys of the ys and n_zs of the zs, and those pairs count that are links."""
        rows = np.arange(len(x))
        (yi, known_y), (zi, known_z) = _places(self.y, ys), _places(self.z, zs)
        of_y, of_z, yi, zi = np.repeat(rows, n_ys)[known_y], np.repeat(rows, n_zs)[known_z], yi[known_y], zi[known_z]
        n_y, n_z = np.bincount(of_y, minlength=len(x)), np.bincount(of_z, minlength=len(x))
        many = n_y * n_z > max(pairs, len(self.keys))
        for r in np.flatnonzero(many):
            has_y, has_z = np.zeros(len(self.y), bool), np.zeros(len(self.z), bool)
            has_y[yi[of_y == r]], has_z[zi[of_z == r]] = True, True
            for k in range(0, len(self.keys), pairs):
                b, a = np.divmod(self.keys[k : k + pairs], len(self.y))
                hit = has_y[a] & has_z[b]
                yield np.full(hit.sum(), x[r]), self.y[a[hit]], self.z[b[hit]]
        few = ~many[of_z]
        of_z, zi, first = of_z[few], zi[few], np.cumsum(n_y) - n_y
        n = n_y[of_z]
        ends, start = np.cumsum(n), 0
        while start < len(n):
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] - n[start] + pairs, "right")))
            own, times = of_z[start:stop], n[start:stop]
            last = np.cumsum(times)
            at = np.repeat(first[own] - (last - times), times) + np.arange(last[-1])
            keys = np.repeat(zi[start:stop] * len(self.y), times) + yi[at]
            hit = np.flatnonzero(self.flags[keys & (len(self.flags) - 1)])
            hit = hit[_places(self.keys, keys[hit])[1]]
            entry = np.searchsorted(last, hit, "right")
            yield x[own[entry]], self.y[yi[at[hit]]], self.z[zi[start:stop][entry]]
            start = stop


def _close(cell_links: int, pairs: int):
    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ys, zs, waiting, links = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0, None
        for batch in batches:
            own = np.asarray(batch["links"])
            linked, lists = batch.filter(pa.array(own)), batch.filter(pa.array(~own))
            if len(linked):
                ys.append(np.asarray(linked["y"]))
                zs.append(np.asarray(linked["z"]))
                waiting += len(linked)
                if waiting > 2 * cell_links:  # repeated links of a few nodes
                    known = _Links(np.concatenate(ys), np.concatenate(zs))
                    z, y = np.divmod(known.keys, len(known.y))
                    ys, zs, waiting = [known.y[y]], [known.z[z]], 0
            if len(lists):
                if links is None:
                    links = _Links(np.concatenate(ys), np.concatenate(zs))
                    ys, zs = [], []
                sizes = [np.asarray(lists[c].value_lengths()) for c in ("ys", "zs")]
                for found in links.closed(np.asarray(lists["x"]), np.asarray(lists["ys"].flatten()), sizes[0], np.asarray(lists["zs"].flatten()), sizes[1], pairs):
                    if len(found[0]):
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["x", "y", "z"])

    return close


def triads_of_kinds(rows: DataFrame, store, cell_links: int = CELL_LINKS, pairs: int = PAIRS) -> DataFrame:
    """(x, y, z), once each: triples of which each two stand together in a row of (x, y, z), which are longs of three kinds.

    Pairs of y and z are never shuffled: z is cut into ranges of about ``cell_links`` rows, and a task has one range.  It holds the
    links of y and z in that range and reads the lists of each x: all its y, and its z in the range.  So a list of y is sent
    once for each range that x has a z in, and all pairs of a list are tried where the links are.  Of an x with more pairs than
    the range has links, the links are looked through instead.  x should be the kind whose nodes have the fewest pairs, and z one
    of which neighbours have much in common, if there is any; nulls are linked with nothing."""
    rows = store(rows.select(*(F.col(c).cast("long").alias(c) for c in "xyz")))
    n = rows.where("y IS NOT NULL AND z IS NOT NULL").count()
    cells = -(-n // cell_links)
    bounds = sorted(set(rows.approxQuantile("z", [i / cells for i in range(1, cells)], 0.1 / cells))) if cells > 1 else []
    rows = rows.withColumn("cell", F.when(F.col("z").isNotNull(), _cell(F.col("z"), bounds)))
    sets = rows.where("x IS NOT NULL").repartition("x").groupBy("x", "cell").agg(F.collect_set("y").alias("ys"), F.collect_set("z").alias("zs"))
    all_ys = F.array_distinct(F.flatten(F.collect_list("ys").over(Window.partitionBy("x"))))
    lists = sets.withColumn("ys", all_ys).where((F.size("ys") > 0) & (F.size("zs") > 0))
    empty = F.array().cast("array<long>")  # not null: Arrow's writer goes back over a run of null lists at each of its rows
    links = rows.where("y IS NOT NULL AND cell IS NOT NULL").select("cell", F.lit(True).alias("links"), "y", "z", empty.alias("ys"), empty.alias("zs"))
    dealt = links.unionByName(lists.withColumn("links", F.lit(False)), allowMissingColumns=True).repartitionById(len(bounds) + 1, F.col("cell"))
    return dealt.sortWithinPartitions(F.desc("links")).drop("cell").mapInArrow(_close(cell_links, pairs), "x long, y long, z long")
