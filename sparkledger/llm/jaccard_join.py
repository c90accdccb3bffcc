"""Exact set-similarity join of documents by word shingles, with prefix filters under several global token orders.

A document's set is its distinct shingles (hashed to 64 bits).  Two sets link at a Jaccard similarity of at least
``percent`` / 100.  Such a pair shares a token among the first ``n - ceil(t * n) + 1`` tokens of both sets under *any* global
order of tokens, so:

1. ``profiles``: one scan gives each row its set size and a digest of its set (equal sets form a *class*, joined further on
   as one), and tokens that are frequent within a task's texts.  The frequent tokens of all tasks are summed, and the
   heaviest (at most ``MAX_HEAVY``, a table of proven size) are broadcast.
2. All orders put rare tokens first, by that weight, and differ in the hash that orders tokens of one weight.  Prefix tokens
   under the first order are dealt to buckets by token (a token of very many sets to several).  Classes that meet in a
   bucket, and pass the length and position filters, are candidates; in a bucket of more than ``SMALL`` classes only those
   with one of its ``HUBS`` hubs are.  Hubs are the members of the least class digests, so the buckets of one group of near
   copies mostly agree on them.
3. The filters of the further orders are intersected before any text moves: each class has a *fingerprint*, its counts of
   tokens in ranges of each further order, about a range for four tokens.  Two sets cannot share more tokens of a range than the smaller count,
   so pairs whose bound is too low under one of the orders go.  What is left must share a prefix token under every further
   order, and goes to verification, an exact intersection of the two sets, computed from the texts.
4. Links are contracted to components.  Where a large bucket still holds several components, its pairs across components
   that pass all filters are contracted to groups, and each group is verified as in step 5, so every link between different
   components is found and the components are exact.
5. A link never leaves a component, so all links are found by verifying every pair of classes inside each component that
   passes the length filter: a component is cut into blocks, and each pair of blocks is a cell with the texts of its members.
   ``links_of_documents`` counts them; ``class_links`` lists them.  Components alone need no such turn.

Defined cases: a text without words (or null) has an empty set and links with nothing; a row with a null id has its set
counted but no component; repeated rows and repeated ids are rows of their own (a component is a property of the text);
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytetext as B
from .components import connected_components
from .shared import arrow_schema, map_arrow, shuffle_width, stored, text_column

SHINGLE = 5
PERCENT = 80
ORDERS = 3
SMALL = 32
HUBS = 4
#: Members of a large bucket that one task compares with as many others in the second turn.
BLOCK = 2_000
#: The column of a row's own key where ids are repeated or missing.
ROW = "__jaccard_row"
#: Sets of one bucket of a very frequent prefix token, and how many of its sets go to all of its buckets.
BUCKET = 10_000
SHOWN = 16
#: A fingerprint has a power of two of ranges for each further order, one for so many tokens or fewer, within these limits;
#: a count is a byte, and its highest value means "or more".
RANGE_TOKENS = 4
RANGES = (32, 2_048)
#: Classes and tokens of one block of a component, when all of its links are looked for.
LINK_BLOCK = 1_024
LINK_TOKENS = 2_000_000
#: Bytes of a table of common tokens; beyond it they are counted set by set.
COMMON_BYTES = 1 << 24
#: Bits for each id of the table by which texts that no pair needs are left out of a shuffle, and the most in all (32 MB).
ID_BITS = 8
MAX_BITS = 28
#: Buckets are dealt to at least so many tasks.
MIN_TASKS = 64
MAX_HEAVY = 200_000
#: A token is told to the others once so many sets of one task hold it.
LOCAL = 4
#: Shingles that a task counts at a time.
COUNTED = 2_000_000

WORD = B.lut(excluded=bytes([32, *range(9, 14)]))
_CODES = B.byte_codes(1)[B.fold_ascii()]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted sets) for slices of a string column."""
    data, offsets = B.utf8_buffers(column)
    for lo, hi in B.row_slices(offsets):
        part = data[offsets[lo] : offsets[hi]]
        words = B.Words(part, offsets[lo : hi + 1] - offsets[lo], WORD)
        hashed = words.hashes(part, _CODES)
        grams = B.gram_hashes(hashed, SHINGLE)
        sets = []
        for a, b in zip(words.rows[:-1].tolist(), words.rows[1:].tolist(), strict=True):
            if b - a >= SHINGLE:
                own = np.sort(grams[a : b - SHINGLE + 1])
                sets.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
            else:
                sets.append(np.array([B.short_hash(hashed[a:b])], dtype=np.uint64) if b > a else np.zeros(0, dtype=np.uint64))
        yield lo, sets


def class_of(own: np.ndarray) -> int:
    """A digest of a set."""
    return int(_signed(B.mix64(np.array([B.mix64(own ^ np.uint64(0x51ED270B)).sum(dtype=np.uint64) ^ np.uint64(len(own))], dtype=np.uint64)))[0])


def profiles(docs: DataFrame) -> DataFrame:
    """Rows of two kinds: a document's (doc_id, n, class), and with n = -1 a token's (token as class, count as doc_id)."""
    ddl = "doc_id long, n long, class long"
    schema = arrow_schema(ddl)

    def counted(sets: list[np.ndarray]) -> pa.RecordBatch:
        tokens, counts = np.unique(np.concatenate(sets), return_counts=True)
        keep = counts >= LOCAL
        return pa.RecordBatch.from_arrays([pa.array(counts[keep]), pa.array(np.full(int(keep.sum()), -1)), pa.array(_signed(tokens[keep]))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()
        for batch in batches:
            for lo, sets in shingle_sets(batch.column(1)):
                classes = [class_of(s) for s in sets]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(sets)), pa.array([len(s) for s in sets], type=pa.int64()), pa.array(classes, type=pa.int64())], schema=schema)
                for s, c in zip(sets, classes, strict=True):
                    if len(s) and c not in seen:
                        seen.add(c)
                        held.append(s)
                        size += len(s)
                if size >= COUNTED:
                    yield counted(held)
                    held, size, seen = [], 0, set()
        if held:
            yield counted(held)

    return map_arrow(docs, run, ddl)


def heavy_tokens(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, weights) of the heaviest tokens: whole levels of weight from the top, MAX_HEAVY tokens at most."""
    summed = rows.where("n = -1").groupBy("class").agg(F.sum("doc_id").alias("w")).withColumn("level", F.floor(F.log2("w") * 4).cast("int"))
    levels = sorted(((r[0], r[1]) for r in summed.groupBy("level").count().collect()), reverse=True)
    total, least = 0, None
    for level, count in levels:
        if (total := total + count) > MAX_HEAVY:
            break
        least = level
    if least is None:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    found = summed.where(F.col("level") >= least).select("class", "level").toArrow()
    tokens = found.column("class").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], found.column("level").to_numpy().astype(np.int64)[order]


def _keys(own: np.ndarray, order: int) -> np.ndarray:
    """The hash by which an order ranks tokens of one weight."""
    return B.mix64(own ^ B.mix64(np.array([order + 77], dtype=np.uint64))[0])


def fingerprint(own: np.ndarray) -> np.ndarray:
    """A set's counts of tokens in the ranges of each further order; finer for larger sets."""
    ranges = min(RANGES[1], max(RANGES[0], 1 << (-(-len(own) // RANGE_TOKENS) - 1).bit_length()))
    shift = np.uint64(65 - ranges.bit_length())
    counts = [np.bincount((_keys(own, k) >> shift).astype(np.int64), minlength=ranges) for k in range(1, ORDERS)]
    return np.minimum(np.concatenate(counts), 255).astype(np.uint8)


class Prints:
    """A column of fingerprints."""

    def __init__(self, column: pa.Array | pa.ChunkedArray):
        self.data, offsets = B.utf8_buffers(column)
        self.start, self.length = offsets[:-1], np.diff(offsets)

    def rows(self, at: np.ndarray, length: int) -> np.ndarray:
        return self.data[self.start[at][:, None] + np.arange(length)].reshape(len(at), ORDERS - 1, -1)


def _folded(counts: np.ndarray, ranges: int) -> np.ndarray:
    """Counts in fewer ranges, each of neighbours."""
    return counts.reshape(*counts.shape[:2], ranges, -1).sum(axis=3, dtype=np.uint16) if counts.shape[2] > ranges else counts


def plausible(na: np.ndarray, nb: np.ndarray, left: Prints, a: np.ndarray, right: Prints, b: np.ndarray) -> np.ndarray:
    """Whether the sets at places a and b, of the sizes na and nb, may be similar under every further order."""
    need = -(-PERCENT * (na + nb) // (100 + PERCENT))
    out = np.ones(len(a), dtype=bool)
    kind = left.length[a] * (1 << 20) + right.length[b]
    for k in np.unique(kind).tolist():
        x, y = k >> 20, k & ((1 << 20) - 1)
        ranges = min(x, y) // (ORDERS - 1)
        places = np.flatnonzero(kind == k)
        for lo in range(0, len(places), 1_000):
            at = places[lo : lo + 1_000]
            one, two = left.rows(a[at], x), right.rows(b[at], y)
            room = np.minimum(_folded(one, ranges), _folded(two, ranges)).sum(axis=2, dtype=np.int64).min(axis=1)
            out[at] = (room >= need[at]) | (one == 255).any(axis=(1, 2)) | (two == 255).any(axis=(1, 2))
    return out


class Order:
    """Global token orders: by weight, then by a hash of each order's own."""

    def __init__(self, heavy: tuple[np.ndarray, np.ndarray]):
        self.tokens, self.weights = heavy

    def sets_of(self, tokens: np.ndarray) -> np.ndarray:
        """About how many sets hold each token, as far as it is heavy."""
        if not len(self.tokens):
            return np.zeros(len(tokens))
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, 2.0 ** ((self.weights[at] + 1) / 4), 0.0)

    def prefix(self, own: np.ndarray, order: int) -> np.ndarray:
        """The prefix tokens of a set, in order."""
        n = len(own)
        p = n - -(-PERCENT * n // 100) + 1
        key = _keys(own, order)
        if len(self.tokens):
            at = np.minimum(np.searchsorted(self.tokens, own), len(self.tokens) - 1)
            weight = np.where(self.tokens[at] == own, self.weights[at] + 1, 0)
            # weight in the top bits: one sort of 64-bit keys
            key = (key >> np.uint64(10)) | (weight.astype(np.uint64) << np.uint64(54))
        first = np.argpartition(key, p - 1)[:p] if p < n else np.arange(n)
        return own[first[np.argsort(key[first])]]


_ENTRY = "token long, part int, doc_id long, class long, n int, pos int"


def prefix_entries(docs: DataFrame, order: Order) -> DataFrame:
    """A row for each prefix token under the first order; copies of a set are left out where a task sees them.

    A token of more than ``BUCKET`` sets has several parts, numbered from 1.  Each set goes to one of them, by its digest,
    and the sets of the least digests go to all, so the parts agree on their hubs.  Other tokens have part 0 alone."""
    shared = docs.sparkSession.sparkContext.broadcast(order)
    schema = arrow_schema(_ENTRY)
    bucket = BUCKET

    def parts(tokens: np.ndarray, cls: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, parts) of the entries of one set."""
        place = np.arange(len(tokens))
        held = shared.value.sets_of(tokens)
        if held.max(initial=0) <= bucket:
            return place, np.zeros(len(tokens), dtype=np.int64)
        digest = B.mix64(np.array([cls], dtype=np.int64).view(np.uint64))[0]
        many = np.maximum(1, np.ceil(held / bucket)).astype(np.int64)
        shown = (many > 1) & (float(digest) / 2.0**64 * held < SHOWN)
        times = np.where(shown, many, 1)
        where = np.repeat(place, times)
        nth = np.arange(len(where)) - np.repeat(np.cumsum(times) - times, times)
        own = (digest % many.astype(np.uint64)).astype(np.int64)
        return where, np.where(many[where] > 1, 1 + np.where(shown[where], nth, own[where]), 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, sets in shingle_sets(batch.column(1)):
                cols: list[list] = [[], [], [], [], [], []]
                for i, own in enumerate(sets):
                    if len(own) and (c := class_of(own)) not in seen:
                        seen.add(c)
                        tokens = shared.value.prefix(own, 0)
                        where, part = parts(tokens, c)
                        k = len(where)
                        for col, x in zip(cols, (_signed(tokens)[where], part, np.full(k, ids[lo + i]), np.full(k, c), np.full(k, len(own)), where), strict=True):
                            col.append(x)
                if len(seen) > 1_000_000:
                    seen.clear()
                if cols[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), type=f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return map_arrow(docs, run, _ENTRY)


def _passes(na, nb, pa_, pb) -> np.ndarray:
    """Length and position filters for classes with na <= nb."""
    need = -(-PERCENT * (na + nb) // (100 + PERCENT))
    return (100 * na >= PERCENT * nb) & (1 + np.minimum(na - pa_ - 1, nb - pb - 1) >= need)


class _Bucketed:
    """Entries of one partition, sorted by bucket, length and class, with copies of a class dropped."""

    def __init__(self, table: pa.Table):
        col = {c: table.column(c).to_numpy() for c in ("token", "part", "doc_id", "class", "n", "pos")}
        order = np.lexsort((col["doc_id"], col["class"], col["n"], col["part"], col["token"]))
        token, cls, part = col["token"][order], col["class"][order], col["part"][order]
        keep = np.concatenate([[True], (token[1:] != token[:-1]) | (part[1:] != part[:-1]) | (cls[1:] != cls[:-1])])
        order = order[keep]
        self.token, self.doc, self.cls = col["token"][order], col["doc_id"][order], col["class"][order]
        self.n, self.pos = col["n"][order].astype(np.int64), col["pos"][order].astype(np.int64)
        self.part = part = col["part"][order]
        self.cell = np.where(part == 0, self.token, _signed(B.mix64(self.token.view(np.uint64) + part.astype(np.uint64))))
        self.starts = np.flatnonzero(np.concatenate([[True], (self.token[1:] != self.token[:-1]) | (part[1:] != part[:-1])])) if len(order) else np.zeros(0, dtype=np.int64)
        self.sizes = np.diff(np.concatenate([self.starts, [len(order)]]))

    def hubs(self, at: int, m: int) -> np.ndarray:
        """Places of the HUBS members of least digest of the bucket that begins at a place and has m members."""
        digest = B.mix64(self.cls[at : at + m].view(np.uint64))
        return at + np.argpartition(digest, HUBS)[:HUBS] if m > HUBS else np.arange(at, at + m)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Those of the index pairs that pass the filters, as rows (class, doc, class, doc, cell) by class."""
        swap = self.n[a] > self.n[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        keep = _passes(self.n[a], self.n[b], self.pos[a], self.pos[b])
        a, b = a[keep], b[keep]
        swap = self.cls[a] > self.cls[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        return np.stack([self.cls[a], self.doc[a], self.cls[b], self.doc[b], self.cell[a]], axis=1)


#: token: that of a member of a large bucket, where b is null; else a number of the bucket in which the pair met.
_FOUND = "a long, a_doc long, b long, b_doc long, token long, n int, pos int, hub boolean"


def _distinct(rows: np.ndarray) -> np.ndarray:
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 4], rows[:, 2], rows[:, 0]))]
    return rows[np.concatenate([[True], (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 2] != rows[:-1, 2])])]


def _candidates(entries: DataFrame, width: int) -> DataFrame:
    """Candidate pairs, and (with a null b) the members of large buckets for the second turn."""
    schema = arrow_schema(_FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        bucket = _Bucketed(pa.Table.from_batches(held))
        found = [np.zeros((0, 5), dtype=np.int64)]
        whole = bucket.part[bucket.starts] == 0
        large = (bucket.sizes > SMALL) | ~whole
        for m in np.unique(bucket.sizes[(bucket.sizes > 1) & ~large]).tolist():
            at = bucket.starts[(bucket.sizes == m) & ~large]
            i, j = np.triu_indices(m, 1)
            for k in range(0, len(at), max(1, 1_000_000 // len(i))):
                own = at[k : k + max(1, 1_000_000 // len(i))]
                found.append(_distinct(bucket.pairs((own[:, None] + i).ravel(), (own[:, None] + j).ravel())))
        large = np.flatnonzero(large)
        for k in large.tolist():
            at, m = int(bucket.starts[k]), int(bucket.sizes[k])
            hubs = bucket.hubs(at, m)
            a, b = np.repeat(hubs, m), np.tile(np.arange(at, at + m), len(hubs))
            found.append(bucket.pairs(a[a != b], b[a != b]))
            if len(found) > 500:
                found = [_distinct(np.concatenate(found))]
        rows = _distinct(np.concatenate(found))
        blank = pa.nulls(len(rows), pa.int32())
        if len(rows):
            yield pa.RecordBatch.from_arrays([*(pa.array(rows[:, c]) for c in range(5)), blank, blank, blank.cast(pa.bool_())], schema=schema)
        for k in large.tolist():
            s = slice(int(bucket.starts[k]), int(bucket.starts[k] + bucket.sizes[k]))
            none = pa.nulls(s.stop - s.start, pa.int64())
            hub = np.zeros(s.stop - s.start, dtype=bool)
            if whole[k]:  # the hubs of a part were compared with the sets of that part alone
                hub[bucket.hubs(s.start, s.stop - s.start) - s.start] = True
            yield pa.RecordBatch.from_arrays([pa.array(bucket.cls[s]), pa.array(bucket.doc[s]), none, none, pa.array(bucket.token[s]), pa.array(bucket.n[s].astype(np.int32)), pa.array(bucket.pos[s].astype(np.int32)), pa.array(hub)], schema=schema)

    return map_arrow(entries.repartition(width, "token", "part"), run, _FOUND)


def _by_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows whose id may be in ids, rows whose id is not): a bit table of ids (doc_id, a stored table) is broadcast.

    The table has ID_BITS bits for each id, but never more than 2 ** MAX_BITS; beyond that it only tells apart less."""
    bits = min(MAX_BITS, max(16, int(ids.count() * ID_BITS - 1).bit_length()))
    own = F.col(id_col).cast("long")
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << bits))
    word, bit = (lambda c: F.shiftright(place(c), 15)), (lambda c: F.pmod(place(c), F.lit(1 << 15)))
    given = ids.where("doc_id IS NOT NULL")
    table = given.select(word(F.col("doc_id")).alias("__word"), bit(F.col("doc_id")).alias("bit")).groupBy("__word").agg(F.bitmap_construct_agg("bit").alias("__bits"))
    byte = F.conv(F.hex(F.substring("__bits", F.shiftright(bit(own), 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(own.isNotNull() & (byte.bitwiseAND(F.pow(F.lit(2), F.pmod(place(own), F.lit(8))).cast("int")) != 0), F.lit(False))
    told = docs.join(F.broadcast(table), word(own) == F.col("__word"), "left").withColumn("__hit", hit)
    return told.where("__hit").select(*docs.columns), told.where("NOT __hit").select(*docs.columns)


def _needed(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs without most rows whose doc_id is not in ids."""
    return _by_ids(docs, ids)[0]


def _fingerprints(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, doc_id, n, print) of classes (class, doc_id), a stored table of one document for each class."""
    ddl = "class long, doc_id long, n int, print binary"

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, own in shingle_sets(batch.column(1)):
                yield pa.RecordBatch.from_arrays([pa.array([class_of(s) for s in own], type=pa.int64()), batch.column(0).slice(lo, len(own)), pa.array([len(s) for s in own], type=pa.int32()), pa.array([fingerprint(s).tobytes() for s in own], type=pa.binary())], names=["class", "doc_id", "n", "print"])

    found = map_arrow(_needed(docs, classes).select("doc_id", "text"), prints, ddl)
    return found.hint("merge").join(classes, ["class", "doc_id"], "left_semi").dropDuplicates(["class"])


def _plausible(pairs: DataFrame, prints: DataFrame) -> DataFrame:
    """Those of the pairs (a, b, token) whose fingerprints let them pass, with a document of each: (a, a_doc, b, b_doc, token)."""
    side = lambda x: prints.select(F.col("class").alias(x), F.col("doc_id").alias(f"{x}_doc"), F.col("n").cast("long").alias(f"{x}_n"), F.col("print").alias(f"{x}_print"))
    # one plan at every size: few pairs would else be broadcast, and rows shuffled only beyond that
    rows = pairs.hint("merge").join(side("a"), "a").hint("merge").join(side("b"), "b").select("a", "a_doc", "b", "b_doc", "token", "a_n", "b_n", "a_print", "b_print")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = np.arange(batch.num_rows)
                keep = plausible(batch.column(5).to_numpy(), batch.column(6).to_numpy(), Prints(batch.column(7)), at, Prints(batch.column(8)), at)
                yield batch.select(list(range(5))).filter(pa.array(keep))

    return map_arrow(rows, run, "a long, a_doc long, b long, b_doc long, token long")


class _Prefixes:
    """Whether two sets share a prefix token under every order but the first; prefixes of recent sets are kept."""

    def __init__(self, order: Order):
        self.order, self.memory = order, {}

    def of(self, cls: int, own: np.ndarray) -> list[np.ndarray]:
        if cls not in self.memory:
            if len(self.memory) > 20_000:
                self.memory.clear()
            self.memory[cls] = [self.order.prefix(own, k) for k in range(1, ORDERS)]
        return self.memory[cls]

    def similar(self, a: int, x: np.ndarray, b: int, y: np.ndarray) -> bool:
        """The filters of the further orders together, then the exact intersection."""
        if not all(len(np.intersect1d(p, q, assume_unique=True)) for p, q in zip(self.of(a, x), self.of(b, y), strict=True)):
            return False
        common = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * common >= PERCENT * (len(x) + len(y) - common)


def _across(members: DataFrame, prints: DataFrame, width: int) -> DataFrame:
    """(u, v): edges that connect classes as do all pairs of different components that meet in a large bucket and pass all
    filters (the hubs' pairs were looked at before).  A class has one edge in a bucket at most.

    A bucket is cut into blocks of about BLOCK members, and each pair of blocks is a cell of its own with the fingerprints
    of its members, so a task holds a bounded number of them however large the bucket."""
    split = members.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1").select("token", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    open_ = members.join(split, "token").hint("merge").join(prints.select("class", "print"), "class")
    cells = open_.withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select("token", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "class", "component", F.col("n").cast("long").alias("n"), F.col("pos").cast("long").alias("pos"), "hub", "print")
    schema = arrow_schema("u long, v long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        col = {c: table.column(c).to_numpy() for c in table.column_names if c != "print"}
        prints = Prints(table.column("print"))
        order_ = np.lexsort((~col["hub"], col["class"], col["n"], col["hi"], col["lo"], col["token"]))
        key = np.stack([col["token"], col["lo"], col["hi"]])[:, order_]
        edges = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0), [True]]))
        told: set[tuple[int, int]] = set()
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            at = order_[a:b]
            at = at[np.concatenate([[True], col["class"][at][1:] != col["class"][at][:-1]])]
            n, pos, cls, own, hub, comp = (col[c][at] for c in ("n", "pos", "class", "own", "hub", "component"))
            ends = np.searchsorted(n, n * 100 // PERCENT, side="right")
            one = col["lo"][at[0]] == col["hi"][at[0]]
            group = np.arange(len(at))
            for i in np.flatnonzero(~hub).tolist():
                j = np.arange(i + 1, ends[i])
                j = j[~hub[j] & (comp[j] != comp[i]) & (group[j] != group[i]) & _passes(n[i], n[j], pos[i], pos[j]) & (one | (own[j] != own[i]))]
                if len(j):
                    j = j[plausible(np.full(len(j), n[i]), n[j], prints, np.full(len(j), at[i]), prints, at[j])]
                if len(j):
                    met = np.unique(group[j])
                    group[np.isin(group, met)] = group[i]
            # the least class stands for its group, so the buckets of one group of texts mostly tell the same edges
            order = np.lexsort((cls, group))
            first = np.concatenate([[True], group[order][1:] != group[order][:-1]])
            least = cls[order][np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
            told.update((u, v) for u, v in zip(cls[order][~first].tolist(), least[~first].tolist(), strict=True))
        if told:
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in told], type=pa.int64()) for k in (0, 1)], schema=schema)

    return map_arrow(cells.repartition(width, "token", "lo", "hi"), run, "u long, v long")


def _verified(pairs: DataFrame, docs: DataFrame, order: Order, width: int) -> DataFrame:
    """(u, v): those of the pairs (a, a_doc, b, b_doc, token), a stored table, whose texts share a prefix token under every
    further order and reach the similarity.

    A pair is verified in one of the bounded cells (told by token) in which it met, so a text goes to a cell once, however
    many pairs of the cell it has."""
    once = stored(pairs.groupBy("a", "b").agg(F.min("a_doc").alias("a_doc"), F.min("b_doc").alias("b_doc"), F.min("token").alias("cell")), "pairs")
    ends = once.select("cell", F.explode(F.array(F.struct(F.col("a").alias("class"), F.col("a_doc").alias("doc_id")), F.struct(F.col("b").alias("class"), F.col("b_doc").alias("doc_id")))).alias("end")).select("cell", "end.*").distinct()
    ends = stored(ends, "ends")
    texts = ends.hint("merge").join(_needed(docs, ends.select("doc_id").distinct()), "doc_id").select("cell", F.col("class").alias("a"), F.lit(None).cast("long").alias("b"), "text")
    rows = texts.unionByName(once.select("cell", "a", "b", F.lit(None).cast("string").alias("text")))
    shared = docs.sparkSession.sparkContext.broadcast(order)
    schema = arrow_schema("u long, v long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, sets, wanted = _Prefixes(shared.value), {}, []
        for batch in batches:
            told = batch.column(2).is_valid()
            wanted.append(batch.filter(told))
            given = batch.filter(pc.invert(told))
            cls = given.column(1).to_pylist()
            for lo, own in shingle_sets(given.column(3)):
                for c, s in zip(cls[lo : lo + len(own)], own, strict=True):
                    if c not in sets and len(s) and class_of(s) == c:  # else another row of a repeated id
                        sets[c] = s
        for batch in wanted:
            found = [(a, b) for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True) if a in sets and b in sets and filters.similar(a, sets[a], b, sets[b])]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], type=pa.int64()) for k in (0, 1)], schema=schema)

    return map_arrow(rows.repartition(width, "cell"), run, "u long, v long")


def similar_classes(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, component) of the classes that links reach, for docs (doc_id, text) and their stored profiles."""
    spark = docs.sparkSession
    order = Order(heavy_tokens(rows))
    keyed = docs.where(F.col("doc_id").isNotNull())
    width = max(MIN_TASKS, shuffle_width(spark))
    found = stored(_candidates(prefix_entries(keyed, order), width), "candidates")
    members = found.where(F.col("b").isNull()).select("token", F.col("a_doc").alias("doc_id"), F.col("a").alias("class"), "n", "pos", "hub")
    met = found.where(F.col("b").isNotNull()).groupBy("a", "b").agg(F.min("a_doc").alias("a_doc"), F.min("b_doc").alias("b_doc"), F.min("token").alias("token"))
    pairs = stored(met, "met")
    ends = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("class"), F.col("a_doc").alias("doc_id")), F.struct(F.col("b").alias("class"), F.col("b_doc").alias("doc_id")))).alias("end")).select("end.*")
    classes = stored(ends.unionByName(members.select("class", "doc_id")).groupBy("class").agg(F.min("doc_id").alias("doc_id")), "classes")
    prints = stored(_fingerprints(keyed, classes), "prints")
    links = stored(_verified(stored(_plausible(pairs.select("a", "b", "token"), prints), "plausible"), keyed, order, width), "links")
    components = stored(connected_components(links), "components")
    placed = members.drop("doc_id").join(components.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    apart = stored(_across(stored(placed, "members"), prints, width), "apart")
    if apart.isEmpty():
        return components
    more = stored(_within(prints.select("class", F.col("doc_id").alias("least"), F.col("n").cast("long").alias("n"), F.lit(1).cast("long").alias("copies")), stored(connected_components(apart), "groups"), keyed, width, "joined"), "across")
    return components if more.isEmpty() else stored(connected_components(links.unionByName(more)), "components")


class _Common:
    """Numbers of common tokens of sets, by a bit for each token that two or more of them hold; where that table would be
    too large, by marks of one set's tokens."""

    def __init__(self, sets: list[np.ndarray]):
        flat = np.concatenate(sets)
        _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
        shared = np.cumsum(count > 1) - 1
        keep = count[code] > 1
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[keep]
        code = shared[code[keep]]
        self.total = int(shared[-1]) + 1
        self.edge = np.searchsorted(row, np.arange(len(sets) + 1))
        self.code, self.bits = code, None
        width = max(1, (self.total + 63) // 64)
        if len(sets) * width * 8 <= COMMON_BYTES:
            self.bits = np.zeros((len(sets), width), dtype=np.uint64)
            # tokens of a set come in the order of their codes, so those of one word follow each other
            at = row * width + (code >> 6)
            if len(at):
                first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                self.bits.ravel()[at[first]] = np.bitwise_or.reduceat(np.uint64(1) << (code & 63).astype(np.uint64), first)

    def of(self, i: int, j: np.ndarray) -> np.ndarray:
        """How many tokens set i has in common with each of the sets j (a run of places in ascending order)."""
        if self.bits is not None:
            return np.bitwise_count(self.bits[j] & self.bits[i]).sum(axis=1, dtype=np.int64)
        mark = np.zeros(self.total, dtype=bool)
        mark[self.code[self.edge[i] : self.edge[i + 1]]] = True
        out = np.empty(len(j), dtype=np.int64)
        for k, x in enumerate(j.tolist()):
            out[k] = np.count_nonzero(mark[self.code[self.edge[x] : self.edge[x + 1]]])
        return out


def _cell_links(n: np.ndarray, left: np.ndarray, right: np.ndarray, sets: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """(i, places linked with i): all links of a cell, members by length; left is right in a cell of one block."""
    common = _Common(sets)
    one = left is right
    sizes = n[right]
    for k, i in enumerate(left.tolist()):
        lo = k + 1 if one else int(np.searchsorted(sizes, -(-PERCENT * n[i] // 100), side="left"))
        hi = int(np.searchsorted(sizes, n[i] * 100 // PERCENT, side="right"))
        if lo >= hi:
            continue
        j = right[lo:hi]
        met = common.of(i, j)
        j = j[100 * met >= PERCENT * (n[i] + n[j] - met)]
        if len(j):
            yield i, j


def _within(classes: DataFrame, components: DataFrame, docs: DataFrame, width: int, what: str) -> DataFrame:
    """All links between different classes, for classes (class, least, n, copies): ``listed`` gives pairs (u, v), ``joined``
    as many of them as connect the classes of each cell, ``counted`` (class, links) with the rows that each class links
    with, in parts to be summed."""
    members = stored(classes.join(components.withColumnRenamed("node", "class"), "class"), "members")
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / LINK_BLOCK), F.ceil(F.sum("n") / LINK_TOKENS)).cast("int")
    split = members.groupBy("component").agg(parts.alias("blocks")).where("blocks > 1")
    placed = stored(members.join(split, "component", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumnRenamed("least", "doc_id"), "placed")
    own = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    cells = placed.hint("merge").join(_needed(docs, placed.select("doc_id")), "doc_id").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select("component", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "class", "n", "copies", "text")
    ddl = "class long, links long" if what == "counted" else "u long, v long"
    schema = arrow_schema(ddl)

    def cell(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.take(pc.sort_indices(table, sort_keys=[("n", "ascending"), ("class", "ascending")]))
        sets = [x for _, own in shingle_sets(table.column("text").combine_chunks()) for x in own]
        cls = table.column("class").to_numpy()
        # rows of a repeated id may have another text, and equal rows are one class
        at, seen = [], set()
        for k, (c, x) in enumerate(zip(cls.tolist(), sets, strict=True)):
            if c not in seen and len(x) and class_of(x) == c:
                seen.add(c)
                at.append(k)
        n, cls, copies, own, lo, hi = (table.column(c).to_numpy()[at] for c in ("n", "class", "copies", "own", "lo", "hi"))
        if len(at) < 2:
            return
        left = right = np.arange(len(at))
        if lo[0] != hi[0]:
            left, right = np.flatnonzero(own == lo[0]), np.flatnonzero(own == hi[0])
        links, group = np.zeros(len(at), dtype=np.int64), np.arange(len(at))
        for i, j in _cell_links(n, left, right, [sets[k] for k in at]) if len(left) and len(right) else ():
            if what == "joined":
                _, first = np.unique(group[j], return_index=True)
                j = j[first[group[j[first]] != group[i]]]  # one link to each group of texts that are not joined yet
                group[np.isin(group, group[j])] = group[i]
            if what != "counted":
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(cls[i], cls[j])), pa.array(np.maximum(cls[i], cls[j]))], schema=schema)
            else:
                links[i] += copies[j].sum()
                links[j] += copies[i]
        if (some := np.flatnonzero(links)).size:
            yield pa.RecordBatch.from_arrays([pa.array(cls[some]), pa.array(links[some])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        col = [table.column(c).to_numpy() for c in ("component", "lo", "hi")]
        order = np.lexsort(col[::-1])
        key = np.stack(col)[:, order]
        edges = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0), [True]]))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield from cell(table.take(pa.array(order[a:b])))

    return map_arrow(cells.repartition(width, "component", "lo", "hi"), run, ddl)


def _classes(rows: DataFrame) -> DataFrame:
    """(class, least, n, copies): each class's least id, set size and number of rows with an id."""
    return rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("least"), F.max("n").alias("n"), F.count(F.lit(1)).alias("copies"))


def class_links(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(u, v): every link between two different classes, once, u < v; copies of one class are not listed."""
    plain = text_column(docs, text_col).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = stored(profiles(plain), "profiles")
    keyed = plain.where(F.col("doc_id").isNotNull())
    return _within(_classes(rows), similar_classes(plain, rows), keyed, max(MIN_TASKS, shuffle_width(docs.sparkSession)), "listed")


def component_of_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: component_id is the least id among all rows that links reach."""
    return _of_documents(docs, id_col, text_col, False)


def links_of_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """component_of_documents with n_links: the number of other rows with an id that each row with an id links with."""
    return _of_documents(docs, id_col, text_col, True)


def _of_documents(docs: DataFrame, id_col: str, text_col: str, counted: bool) -> DataFrame:
    plain = text_column(docs, text_col).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = stored(profiles(plain), "profiles")
    components = similar_classes(plain, rows)
    own = rows.where("n >= 0")
    classes = _classes(rows)
    labelled = classes.hint("merge").join(components.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    final = labelled.hint("merge").join(least, "component").select("class", "component_id", "copies")
    out = ["doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")]
    if counted:
        keyed = plain.where(F.col("doc_id").isNotNull())
        links = stored(_within(classes, components, keyed, max(MIN_TASKS, shuffle_width(docs.sparkSession)), "counted"), "links")
        final = final.join(links.groupBy("class").agg(F.sum("links").alias("links")), "class", "left")
        out.append(F.when(F.col("doc_id").isNotNull(), F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    # texts without words are all of one class: they have nothing to meet
    blank = own.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), *([F.when(F.col("doc_id").isNotNull(), F.lit(0).cast("long")).alias("n_links")] if counted else []))
    return own.where("n > 0").join(final, "class", "left").select(*out).unionByName(blank)


def one_of_each_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component kept, that of the least id (rows without an id come last; then the least digest
    of the text).  Rows without words are components of their own, but equal ones of one id become one."""
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id")).groupBy("doc_id").count()
    if not ids.where("count > 1 OR doc_id IS NULL").isEmpty():
        return _one_row_of_each_group(docs, id_col, text_col)
    found = stored(component_of_documents(docs, id_col=id_col, text_col=text_col), "components")
    dropped = stored(found.where(F.col("component_id") < F.col("doc_id")).select("doc_id"), "dropped")
    maybe, kept = _by_ids(docs, dropped, id_col)  # most texts need no shuffle
    left = maybe.hint("merge").join(dropped.select(F.col("doc_id").alias("__dropped")), F.col(id_col).cast("long") == F.col("__dropped"), "left_anti")
    return kept.unionByName(left)


def _one_row_of_each_group(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """one_of_each_group where ids are repeated or missing: the join runs on a key of each row's own."""
    keyed = stored(text_column(docs, text_col).withColumn(ROW, F.monotonically_increasing_id()), "documents")
    found = component_of_documents(keyed, id_col=ROW, text_col=text_col).withColumnRenamed("doc_id", ROW)
    own = keyed.select(ROW, F.col(id_col).cast("long").alias("own_id"), F.sha2(F.col(text_col).cast("binary"), 256).alias("digest"))
    placed = stored(found.join(own, ROW), "components")
    first = F.min(F.struct(F.col("own_id").isNull().alias("last"), "own_id", "digest", ROW))[ROW].alias(ROW)
    kept = placed.where("n_shingles > 0").groupBy("component_id").agg(first).select(ROW)
    wordless = placed.where("n_shingles = 0")
    kept = kept.unionByName(wordless.where("own_id IS NULL").select(ROW)).unionByName(wordless.where("own_id IS NOT NULL").groupBy("own_id", "digest").agg(F.min(ROW).alias(ROW)).select(ROW))
    return keyed.join(kept, ROW, "left_semi").select(*docs.columns)
