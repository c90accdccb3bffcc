"""Best-fit packing of token pieces into sequences, certified by dual-feasible-function bounds.

1. ``token_pieces`` tokenises whole texts (no shuffle) and cuts only documents longer than a sequence; all pieces but the
   first of such a document fill a sequence.
2. ``pack`` deals the other pieces into groups of about ``group_rows`` rows.  Each group runs best-fit decreasing and
   compares its bin count with the largest of a family of dual-feasible-function bounds; a group at its bound is
   *certified*.  A certified group gives up only its emptiest sequence, any other group all its sequences with a gap; what
   is given up is exchanged between groups (dealt anew into as many groups as it fills) and packed again, until one group
   is left or a round settles less than a tenth of its rows; then the last places stand.  Every round is a table in the shared folder, so a lost executor repeats a part of one round only.
3. ``sequences`` joins ids and places to token sequences.

Rows carry lengths and checksums, never ids, through the exchange.  A group holds ``group_rows`` rows however the lengths
are distributed: rows are dealt by a hash of all their columns, so one frequent length, document or source is spread.

Defined cases: a null text is empty (its only token is the end token); rows with a null or repeated id are packed like any
other; equal rows are interchangeable; an empty table gives no sequences.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytetext as B
from .shared import arrow_schema, map_arrow, map_batches, stored, text_column
from .token_units import UnitEncoder

GROUP_ROWS = 16_384
#: A round goes on if at least this share of its rows found a place in a sequence that stays.
SETTLED = 0.1


def token_pieces(docs: DataFrame, tokenizer: str, *, seq_len: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids) with ids as little-endian unsigned 32-bit numbers; the first piece may be shorter."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batch: pa.RecordBatch):
        encoder = UnitEncoder.of(tokenizer, "byte", False)
        column = batch.column(1)
        _, offsets = B.utf8_buffers(column)
        for lo, hi in B.row_slices(offsets):
            own, piece, start, ids = [], [], [], []
            for i, text in enumerate(column.slice(lo, hi - lo).to_pylist()):
                raw = encoder.ids(text or "") + end
                n = len(raw) // 4
                first = n if n <= seq_len else (n - 1) % seq_len + 1
                for k, at in enumerate([0, *range(first, n, seq_len)]):
                    own.append(i)
                    piece.append(k)
                    start.append(at)
                    ids.append(raw[at * 4 : (first if k == 0 else at + seq_len) * 4])
            yield {"doc_id": batch.column(0).slice(lo, hi - lo).take(pa.array(own, type=pa.int64())), "piece": piece, "start": start, "length": np.array([len(x) // 4 for x in ids], dtype=np.int64), "ids": ids}

    return map_batches(text_column(docs, text_col).select(F.col(id_col).cast("long").alias("doc_id"), text_col), cut, "doc_id long, piece int, start long, length long, ids binary")


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset, bins): lengths, in descending order, go to the fullest bin that takes them.

    Open bins are kept by their free room in ``capacity + 1`` stacks with a bit mask of those not empty, so a step costs the
    same however many bins are open.
    """
    where, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, bins = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if fits := mask >> n:
            room = n + ((fits & -fits).bit_length() - 1)
            at = stacks[room].pop()
            if not stacks[room]:
                mask ^= 1 << room
        else:
            at, room, bins = bins, capacity, bins + 1
        where[i], offset[i] = at, capacity - room
        if left := room - n:
            stacks[left].append(at)
            mask |= 1 << left
    return where, offset, bins


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The largest of the dual-feasible-function bounds: volume, Martello and Toth's thresholds, Fekete and Schepers'
    rounding.  All are computed from the counts of the lengths."""
    counts = np.bincount(lengths, minlength=capacity + 1)[: capacity + 1].astype(np.int64)
    sizes = np.arange(capacity + 1)
    best = -(-int((counts * sizes).sum()) // capacity)
    used = np.flatnonzero(counts)
    for t in used[used <= capacity // 2].tolist():  # sizes over capacity - t count whole, those under t not at all
        value = np.where(sizes > capacity - t, capacity, np.where(sizes >= t, sizes, 0))
        best = max(best, -(-int((counts * value).sum()) // capacity))
    for k in range(1, 20):  # u_k: x if x * (k + 1) is whole, else floor((k + 1) * x) / k
        scaled = sizes * (k + 1)
        value = np.where(scaled % capacity == 0, sizes * k, scaled // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (capacity * k)))
    return best


_ROW = "doc_id long, piece int, start long, length long, crc long"


def _round(rows: DataFrame, groups: int, turn: int, capacity: int, last: bool) -> DataFrame:
    """Packs each group; ``open`` marks rows that go to the next round."""
    ddl = f"{_ROW}, sequence_id long, offset long, open boolean, bound long"
    schema = arrow_schema(ddl)

    def pack_group(table: pa.Table, group: int) -> pa.RecordBatch:
        n = table.num_rows
        key = [table.column(c).to_numpy() for c in ("crc", "start", "piece", "doc_id")]
        length = table.column("length").to_numpy()
        order = np.lexsort([*(np.nan_to_num(k.astype(np.float64), nan=-1) if k.dtype.kind == "f" else k for k in key), -length])
        table, length = table.take(pa.array(order)), length[order]
        where, offset, bins = best_fit_decreasing(length, capacity)
        bound = lower_bound(length, capacity)
        fill = np.bincount(where, weights=length, minlength=bins).astype(np.int64)
        give = np.zeros(bins, dtype=bool)
        if not last:
            if bins > bound:
                give = fill < capacity
            elif fill.min() < capacity:
                give[int(fill.argmin())] = True
        base = (turn << 52) + (group << 24)
        certified = np.full(n, bound if bins == bound else -bound, dtype=np.int64)
        return pa.RecordBatch.from_arrays([*(table.column(c).combine_chunks() for c in ("doc_id", "piece", "start", "length", "crc")), pa.array(base + where), pa.array(offset), pa.array(give[where]), pa.array(certified)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            table = pa.Table.from_batches(held)
            group = table.column("grp").to_numpy()
            for g in np.unique(group).tolist():
                yield pack_group(table.filter(pa.array(group == g)), g)

    keyed = rows.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "start", "length", "crc", F.lit(turn)), F.lit(groups)))
    return map_arrow(keyed.repartition(groups, "grp"), run, ddl)


def pack(pieces: DataFrame, *, seq_len: int = 1024, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Places for (doc_id, piece, start, length, crc): adds sequence_id and offset.  Every length is from 1 to seq_len."""
    cols = ["doc_id", "piece", "start", "length", "crc"]
    whole = pieces.where(F.col("length") == seq_len).select(*cols, (F.monotonically_increasing_id() + F.lit(1 << 61)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rows = pieces.where(F.col("length") < seq_len).select(*cols)
    left, turn, done = rows.count(), 0, [whole]
    groups = max(1, math.ceil(left / group_rows))
    while left:
        packed = stored(_round(rows, groups, turn, seq_len, groups == 1), f"pack-{turn}")
        done.append(packed.where(~F.col("open")).select(*cols, "sequence_id", "offset"))
        if groups == 1:
            break
        rows, before, turn = packed.where("open").select(*cols), left, turn + 1
        left = rows.count()
        if left > (1 - SETTLED) * before:
            done.append(packed.where("open").select(*cols, "sequence_id", "offset"))
            break
        groups = math.ceil(left / group_rows)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def sequences(pieces: DataFrame, places: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token sequences, from ``token_pieces`` and ``pack`` (ids of repeated documents must be equal)."""
    parts = places.join(pieces.select("doc_id", "piece", "ids").dropDuplicates(["doc_id", "piece"]), ["doc_id", "piece"])
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return parts.groupBy("sequence_id").agg(F.aggregate(ordered, F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids"))


def packed_documents(docs: DataFrame, tokenizer: str, *, seq_len: int = 1024, end_id: int = 2, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of all documents."""
    pieces = token_pieces(docs, tokenizer, seq_len=seq_len, end_id=end_id)
    held = stored(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("crc")), "pieces")
    return pack(held, seq_len=seq_len, group_rows=group_rows).withColumnRenamed("crc", "ids_crc32")


def digest(raw: bytes) -> int:
    return zlib.crc32(raw)
