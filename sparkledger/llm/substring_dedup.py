"""Removal of repeated substrings of whole texts, by two-stage suffix sorting of the places where repeats can be.

A byte goes if it is covered by a ``WINDOW``-byte string that also starts anywhere else.  Suffixes of the whole corpus are
not sorted together; what must meet is brought together by content:

1. Every window selects an anchor in itself (see ``anchors``); a *context* is a run of windows with one anchor and the bytes
   that they cover.  Equal windows lie in contexts of equal anchor.  A task that sees a context twice settles it there and
   then (all its windows are repeated); otherwise one row for each context goes to its anchor.
2. Per anchor, contexts with two different occurrences are settled likewise, a lone context is dropped, and different
   contexts of one anchor are to be compared.
3. The bytes of these, from their texts, are gathered by anchor.  A task joins the contexts of many anchors, sorts their
   suffixes in two stages and computes adjacent common prefixes; windows in a stretch of common prefixes of at least
   ``WINDOW`` bytes that holds two occurrences are repeated.  Common prefixes are of bytes.
4. An anchor with more than ``CROWD`` different contexts (a passage in very many documents differs at its edges) would make
   one task's share grow with the corpus.  Its windows are compared by their 128-bit digests instead, in an aggregation
   that is combined before the shuffle.
5. Removed ranges are merged for each text and cut out of it.

What rests on a hash: a text is known by 64 bits of its SHA-256 up to step 5 and by all of it from there; in step 2, contexts
of one anchor are equal if 64 bits of theirs are; the digests of step 4.

Equal texts are one text with copies: they are removed whole (if they have a window at all).

Defined cases: a null text is empty; texts under ``WINDOW`` bytes stay; null and repeated ids are rows like any other (only
the text counts); extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytetext as B
from .anchors import GRAM, WINDOW, gram_hashes, runs
from .shared import arrow_schema, map_batches, shuffle_width, stored, text_column
from .suffix_sort import adjacent_prefixes, suffix_array

#: Contexts whose rows a task holds before it sends them.
HELD = 1_000_000
#: Bytes of contexts that are sorted at a time (whole anchors).
SORTED = 1 << 19
#: An anchor is crowded if its contexts, at their longest, fill more than one such sort.
CROWD = SORTED // (2 * WINDOW - GRAM + 1)
#: Windows of a block of a crowded anchor.
STEP = 16

_CODES = B.byte_codes(55)


def _texts(column: pa.Array) -> Iterator[tuple[int, np.ndarray, str]]:
    """(owner, bytes, sha256) of each row."""
    data, offsets = B.utf8_buffers(column)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        part = data[a:b]
        digest = hashlib.sha256(part).digest()
        yield int.from_bytes(digest[:8], "little", signed=True), part, digest.hex()


def profiles(docs: DataFrame) -> DataFrame:
    """(doc_id, owner, n_bytes, sha): owner is a digest of the text."""

    def find(batch: pa.RecordBatch):
        rows = [(owner, len(part), sha) for owner, part, sha in _texts(batch.column(1))]
        yield {"doc_id": batch.column(0), "owner": [r[0] for r in rows], "n_bytes": [r[1] for r in rows], "sha": [r[2] for r in rows]}

    return map_batches(docs, find, "doc_id long, owner long, n_bytes long, sha string")


def _context_hashes(part: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    up, down = B.powers(len(part))
    sums = np.zeros(len(part) + 1, dtype=np.uint64)
    np.cumsum(_CODES[part] * up[: len(part)], out=sums[1:])
    ends = last + WINDOW
    return B.mix64((sums[ends] - sums[first]) * down[first] + (ends - first).astype(np.uint64))


def _merged(owner: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of bytes, those of one owner that touch or overlap joined."""
    if not len(owner):
        return owner, lo, hi
    order = np.lexsort((lo, owner))
    owner, lo, hi = owner[order], lo[order], hi[order]
    fresh = np.concatenate([[True], owner[1:] != owner[:-1]])
    group = np.cumsum(fresh) - 1
    span = int(hi.max()) + 1
    reach = np.maximum.accumulate(hi + group * span) - group * span
    start = np.concatenate([[True], fresh[1:] | (lo[1:] > reach[:-1])])
    at = np.flatnonzero(start)
    return owner[at], lo[at], reach[np.concatenate([at[1:], [len(owner)]]) - 1]


#: anchor and context are null in a row that only tells a removed range (lo, hi) of an owner.
_ROW = "anchor long, context long, owner long, lo long, hi long"


def _rows(anchor, context, owner, lo, hi) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()) for x in (anchor, context, owner, lo, hi)], names=["anchor", "context", "owner", "lo", "hi"])


def _removed(owner, lo, hi) -> pa.RecordBatch:
    owner, lo, hi = _merged(owner, lo, hi)
    none = pa.nulls(len(owner), pa.int64())
    return _rows(none, none, owner, lo, hi)


def _settle(cols: list[np.ndarray]) -> tuple[pa.RecordBatch, np.ndarray]:
    """(removed ranges, places of one row for each context) of rows (anchor, context, owner, lo, hi)."""
    anchor, context, owner, lo, hi = cols
    order = np.lexsort((lo, owner, context, anchor))
    a, c, o, s = anchor[order], context[order], owner[order], lo[order]
    new_context = np.concatenate([[True], (a[1:] != a[:-1]) | (c[1:] != c[:-1])])
    new_place = np.concatenate([[True], new_context[1:] | (o[1:] != o[:-1]) | (s[1:] != s[:-1])])
    group = np.cumsum(new_context) - 1
    many = np.bincount(group, weights=new_place) > 1
    gone = order[many[group] & new_place]
    return _removed(owner[gone], lo[gone], hi[gone]), order[new_context]


def context_rows(docs: DataFrame) -> DataFrame:
    """One row for each context that a task meets, and the ranges that the task settles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], [], [], [], []]
        size, seen = 0, set()

        def send() -> Iterator[pa.RecordBatch]:
            cols = [np.concatenate(c) for c in held]
            gone, one = _settle(cols)
            if gone.num_rows:
                yield gone
            for k in range(0, len(one), 100_000):
                yield _rows(*(c[one[k : k + 100_000]] for c in cols))

        for batch in batches:
            for owner, part, _ in _texts(batch.column(0)):
                if len(part) < WINDOW or owner in seen:
                    continue
                seen.add(owner)
                anchor, first, last = runs(part)
                for col, x in zip(held, (anchor.view(np.int64), _context_hashes(part, first, last).view(np.int64), np.full(len(first), owner), first, last + WINDOW), strict=True):
                    col.append(x)
                size += len(first)
                if size >= HELD:
                    yield from send()
                    held, size = [[], [], [], [], []], 0
            if len(seen) > 1_000_000:
                seen.clear()
        if size:
            yield from send()

    return docs.select("text").mapInArrow(run, _ROW)


_OPEN = f"{_ROW}, crowd boolean"


def _to_compare(rows: DataFrame) -> DataFrame:
    """Removed ranges (null anchor), and one row for each context of an anchor that has several."""
    schema = arrow_schema(_OPEN)

    def tagged(batch: pa.RecordBatch, crowd) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(crowd, type=pa.bool_())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            mask = batch.column(0).is_null()
            told = batch.filter(mask)
            if told.num_rows:
                yield tagged(told, np.zeros(told.num_rows, dtype=bool))
            if told.num_rows < batch.num_rows:
                held.append(batch.filter(pc.invert(mask)))
        if not held:
            return
        table = pa.Table.from_batches(held)
        cols = [table.column(k).to_numpy() for k in range(5)]
        gone, one = _settle(cols)
        if gone.num_rows:
            yield tagged(gone, np.zeros(gone.num_rows, dtype=bool))
        anchor = cols[0][one]  # sorted
        edge = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1], [True]]))
        count = np.repeat(np.diff(edge), np.diff(edge))
        one, count = one[count > 1], count[count > 1]
        if len(one):
            yield tagged(_rows(*(c[one] for c in cols)), count > CROWD)

    spread = F.coalesce("anchor", F.xxhash64("owner", "lo"))
    return rows.repartition(shuffle_width(rows.sparkSession), spread).mapInArrow(run, _OPEN)


def _with_bytes(contexts: DataFrame, docs: DataFrame) -> DataFrame:
    """(anchor, owner, lo, crowd, bytes): contexts cut from their texts."""

    def texts(batch: pa.RecordBatch):
        seen, owners, keep = set(), [], []
        for i, (owner, part, _) in enumerate(_texts(batch.column(0))):
            if len(part) >= WINDOW and owner not in seen:
                seen.add(owner)
                owners.append(owner)
                keep.append(i)
        yield {"owner": owners, "body": batch.column(0).take(pa.array(keep, type=pa.int64())).cast(pa.binary())}

    def cut(batch: pa.RecordBatch):
        anchor, lo, crowd, out, owner = [], [], [], [], []
        seen: set[tuple[int, int]] = set()
        for own, rows, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            for r in rows:
                if (own, r["lo"]) in seen:
                    continue  # another copy of the text
                seen.add((own, r["lo"]))
                anchor.append(r["anchor"])
                lo.append(r["lo"])
                crowd.append(r["crowd"])
                owner.append(own)
                out.append(body[r["lo"] : r["hi"]])
        yield {"anchor": anchor, "owner": owner, "lo": lo, "crowd": crowd, "bytes": out}

    bodies = map_batches(docs.select("text"), texts, "owner long, body binary")
    wanted = contexts.groupBy("owner").agg(F.collect_list(F.struct("anchor", "lo", "hi", "crowd")).alias("rows"))
    return map_batches(wanted.join(bodies, "owner").select("owner", "rows", "body"), cut, "anchor long, owner long, lo long, crowd boolean, bytes binary")


_RANGE = "owner long, lo long, hi long"


def repeated_windows(pieces: list[bytes], place: np.ndarray) -> list[tuple[int, int, int]]:
    """(piece, first, last) of runs of windows that occur at two different places; place tells equal occurrences."""
    lengths = np.array([len(p) for p in pieces])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    t = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    order = suffix_array(t, WINDOW)
    stretch = np.cumsum(adjacent_prefixes(t, order, WINDOW) < WINDOW) - 1
    piece = np.searchsorted(starts, order, side="right") - 1
    inside = order - starts[piece]
    valid = inside + WINDOW <= lengths[piece]
    order, stretch, piece, inside = order[valid], stretch[valid], piece[valid], inside[valid]
    if not len(order):
        return []
    # occurrences of a stretch: pieces of one owner and place are one occurrence if they start at the same byte
    byte = place[piece] + inside
    by = np.lexsort((byte, stretch))
    s, b = stretch[by], byte[by]
    fresh = np.concatenate([[True], (s[1:] != s[:-1]) | (b[1:] != b[:-1])])
    many = np.bincount(s, weights=fresh) > 1
    hit = np.sort(starts[piece[many[stretch]]] + inside[many[stretch]])
    if not len(hit):
        return []
    at = np.searchsorted(starts, hit, side="right") - 1
    first = np.concatenate([[True], (np.diff(hit) > 1) | (np.diff(at) > 0)])
    edge = np.flatnonzero(first)
    ends = np.concatenate([edge[1:], [len(hit)]]) - 1
    return [(int(p), int(a), int(z)) for p, a, z in zip(at[edge], hit[edge] - starts[at[edge]], hit[ends] - starts[at[ends]], strict=True)]


def _sorted_ranges(items: DataFrame) -> DataFrame:
    """Removed ranges from the suffix order of each anchor's contexts."""
    schema = arrow_schema(_RANGE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        table = table.take(pc.sort_indices(table, sort_keys=[("anchor", "ascending"), ("owner", "ascending"), ("lo", "ascending")]))
        anchor, owner, lo = (table.column(c).to_numpy() for c in ("anchor", "owner", "lo"))
        same = np.concatenate([[False], (anchor[1:] == anchor[:-1]) & (owner[1:] == owner[:-1]) & (lo[1:] == lo[:-1])])
        rows = np.flatnonzero(~same)
        bodies = table.column("bytes")
        at = 0
        while at < len(rows):
            end, size = at, 0
            while end < len(rows) and (size < SORTED or anchor[rows[end]] == anchor[rows[end - 1]]):
                size += 270
                end += 1
            own = rows[at:end]
            pieces = bodies.take(pa.array(own)).to_pylist()
            # places: a number for each owner, wide enough for its bytes
            _, number = np.unique(owner[own], return_inverse=True)
            found = repeated_windows(pieces, (number.astype(np.int64) << 32) + lo[own])
            if found:
                p, a, z = (np.array(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in _merged(owner[own[p]], lo[own[p]] + a, lo[own[p]] + z + WINDOW)], schema=schema)
            at = end

    return items.repartition(shuffle_width(items.sparkSession), "anchor").mapInArrow(run, _RANGE)


def _crowd_ranges(items: DataFrame) -> DataFrame:
    """Removed ranges of the windows of crowded anchors, by digests.

    A context's windows are cut into blocks by their offset from the anchor, so equal windows fall into equal blocks.  The
    bytes that all windows of a block share are its core: a block whose core is nowhere else has no repeated window.  Of
    the others, blocks that are equal as a whole are settled together, and the windows of one block of each kind are compared
    one by one.  All groups are aggregates that combine before the shuffle."""

    def cut(batch: pa.RecordBatch):
        out: list[list] = [[], [], [], [], []]
        for anchor, own, lo, raw in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            n = len(raw) - WINDOW + 1
            place = int(np.argmax(gram_hashes(np.frombuffer(raw, dtype=np.uint8)).view(np.int64) == anchor))
            for j in range((place - n + 1) // STEP, place // STEP + 1):
                s0, s1 = max(0, place - STEP * j - STEP + 1), min(n - 1, place - STEP * j)
                at = place - STEP * j
                core = hashlib.blake2b(raw[at : at + WINDOW - STEP + 1], digest_size=16, salt=j.to_bytes(2, "big")).digest()
                body = raw[s0 : s1 + WINDOW]
                whole = hashlib.blake2b(body, digest_size=16, salt=(place - s0).to_bytes(2, "big")).digest()
                for col, x in zip(out, (core, whole, own, lo + s0, body), strict=True):
                    col.append(x)
        yield dict(zip(("core", "whole", "owner", "lo", "body"), out, strict=True))

    def windows(batch: pa.RecordBatch):
        for own, lo, raw in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            n = len(raw) - WINDOW + 1
            yield {"w": [hashlib.blake2b(raw[k : k + WINDOW], digest_size=16).digest() for k in range(n)], "owner": np.full(n, own), "lo": np.arange(lo, lo + n)}

    place = F.struct("owner", "lo")
    differ = (F.min(place).alias("p"), F.max(place).alias("q"))
    blocks = stored(map_batches(items.select("anchor", "owner", "lo", "bytes"), cut, "core binary, whole binary, owner long, lo long, body binary"), "blocks")
    shared = blocks.join(blocks.groupBy("core").agg(*differ).where("p <> q").select("core"), "core", "left_semi")
    kinds = stored(shared.groupBy("whole").agg(*differ, F.min_by("body", place).alias("body")), "kinds")
    settled = blocks.join(kinds.where("p <> q").select("whole"), "whole", "left_semi").select("owner", "lo", (F.col("lo") + F.length("body")).alias("hi"))
    rows = stored(map_batches(kinds.select("p.owner", "p.lo", "body"), windows, "w binary, owner long, lo long"), "windows")
    many = rows.groupBy("w").agg(*differ).where("p <> q").select("w")
    single = rows.join(many, "w", "left_semi").select("owner", "lo", (F.col("lo") + WINDOW).alias("hi"))
    return settled.unionByName(single)


def removed_ranges(docs: DataFrame) -> DataFrame:
    """(owner, ranges) of texts with removed bytes: array<struct<lo, hi>>, not merged; texts with copies may be missing."""
    found = stored(_to_compare(context_rows(docs)), "contexts")
    items = stored(_with_bytes(found.where(F.col("anchor").isNotNull()), docs), "items")
    ranges = found.where(F.col("anchor").isNull()).select("owner", "lo", "hi")
    ranges = ranges.unionByName(_sorted_ranges(items.where("NOT crowd"))).unionByName(_crowd_ranges(items.where("crowd")))
    return ranges.groupBy("owner").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))


def kept(raw: bytes, ranges: list) -> tuple[int, int, bytes]:
    """(removed bytes, removed runs, rest) of a text."""
    lo, hi = np.array([r["lo"] for r in ranges]), np.array([r["hi"] for r in ranges])
    _, lo, hi = _merged(np.zeros(len(lo), dtype=np.int64), lo, hi)
    out, at = [], 0
    for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
        out.append(raw[at:a])
        at = b
    return int((hi - lo).sum()), len(lo), b"".join([*out, raw[at:]])


def deduplicated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    plain = text_column(docs, text_col).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = stored(profiles(plain), "profiles")
    copies = rows.groupBy("sha").count().where("count > 1").select("sha", F.lit(True).alias("copied"))
    rows = rows.join(copies, "sha", "left")
    whole = F.col("copied").isNotNull() & (F.col("n_bytes") >= WINDOW)
    wanted = rows.where("copied IS NULL").select("sha", "owner").join(removed_ranges(plain), "owner").select("sha", "ranges")

    def cut(batch: pa.RecordBatch):
        out: list[list] = [[], [], [], []]
        for sha, ranges, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            n, spans, rest = kept(text.encode(), ranges)
            for col, x in zip(out, (sha, n, spans, hashlib.sha256(rest).hexdigest()), strict=True):
                col.append(x)
        yield dict(zip(("sha", "n", "spans", "rest"), out, strict=True))

    # texts meet their ranges by their digest, which one text alone has here, so ids may be repeated or missing
    joined = plain.select(F.sha2("text", 256).alias("sha"), "text").join(wanted, "sha").select("sha", "ranges", "text")
    done = rows.join(map_batches(joined, cut, "sha string, n long, spans long, rest string"), "sha", "left")
    empty = F.sha2(F.lit(""), 256)
    return done.select("doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n", F.lit(0))).alias("n_removed"), F.when(whole, 1).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"), F.when(whole, empty).otherwise(F.coalesce("rest", "sha")).alias("kept_sha256"))
