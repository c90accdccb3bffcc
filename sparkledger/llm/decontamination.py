"""Benchmark decontamination: a broadcast hash set of normalised test n-grams against every window of training tokens.

Windows are ``n`` consecutive words of an item; an item with fewer words, but not none, is one window of its own length.
Each task holds the windows' 64-bit hashes, sorted, scans its texts' rolling hashes by vectorised search, and compares the
words of every hit with the window's words, so a hash collision reports nothing.

The set is broadcast only in blocks whose size is checked: items are counted first, and they are dealt into blocks of at
most ``block_windows`` windows (about 150 bytes each).  One block is the usual case; with more, each block is scanned by a
pass of its own and the hits of each row are merged by a key of the row's own, so the result is the same at any benchmark
size, for repeated and null ids too.

Defined cases: a null text has no words; an item without words has no window; repeated items count once for each item id;
rows with a null item id count like any other (shown as an empty string); repeated documents give repeated rows; documents
with a null id are scanned too; an empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytetext as B
from .shared import map_batches, stored, text_column

N = 13
BLOCK_WINDOWS = 200_000
#: The column by which rows meet their hits when there are several blocks.
ROW = "__decontamination_row"

WORD = B.lut(allowed=bytes([*range(48, 58), *range(97, 123), *range(65, 91), *range(128, 256)]))
_FOLD = B.fold_ascii()
_CODES = B.byte_codes(13)[_FOLD]


def _words(text: str) -> list[bytes]:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    words = B.Words(data, np.array([0, len(data)]), WORD)
    folded = _FOLD[data].tobytes()
    return [folded[a:b] for a, b in zip(words.starts.tolist(), words.ends.tolist(), strict=True)]


def item_windows(benchmark: DataFrame, *, n: int = N, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, size, window): the distinct windows of each item, words joined by a space."""

    def cut(batch: pa.RecordBatch):
        item, size, window = [], [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = _words(text or "")
            k = min(n, len(words))
            for w in {b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)} if k else ():
                item.append(key or "")
                size.append(k)
                window.append(w)
        yield {"item": item, "size": size, "window": window}

    return map_batches(text_column(benchmark, text_col).select(F.col(id_col).cast("string"), text_col), cut, "item string, size int, window binary").distinct()


class _Index:
    """A block of windows: for each size, sorted hashes with the items of each window."""

    def __init__(self, rows: list[tuple[str, int, bytes]]):
        by: dict[int, dict[bytes, list[str]]] = {}
        for item, size, window in rows:
            by.setdefault(size, {}).setdefault(window, []).append(item)
        self.sizes = {}
        for size, windows in sorted(by.items()):
            texts = list(windows)
            joined = b" ".join(texts)
            data = np.frombuffer(joined, dtype=np.uint8)
            words = B.Words(data, np.array([0, len(data)]), WORD)
            grams = B.gram_hashes(words.hashes(data, _CODES), size)[::size]
            order = np.argsort(grams, kind="stable")
            self.sizes[size] = grams[order], [texts[i] for i in order], [windows[texts[i]] for i in order]

    def hits(self, data: np.ndarray, words: B.Words, rows: int) -> tuple[np.ndarray, list[set[str]]]:
        """Word marks over the slice, and each row's items."""
        marks = np.zeros(len(words.starts) + 1, dtype=np.int32)
        items: list[set[str]] = [set() for _ in range(rows)]
        hashed = words.hashes(data, _CODES)
        folded = None
        for size, (grams, texts, owners) in self.sizes.items():
            own = B.gram_hashes(hashed, size)
            if not len(own):
                continue
            at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            places = np.flatnonzero(grams[at] == own)
            if not len(places):
                continue
            row = np.searchsorted(words.rows, places, side="right") - 1
            keep = places + size <= words.rows[row + 1]
            for p, r in zip(places[keep].tolist(), row[keep].tolist(), strict=True):
                folded = _FOLD[data].tobytes() if folded is None else folded
                text = b" ".join([folded[words.starts[i] : words.ends[i]] for i in range(p, p + size)])
                k = int(at[p])
                while k < len(grams) and grams[k] == own[p]:
                    if texts[k] == text:
                        marks[p] += 1
                        marks[p + size] -= 1
                        items[r].update(owners[k])
                        break
                    k += 1
        return np.cumsum(marks)[:-1] > 0, items


def _runs(marked: np.ndarray) -> np.ndarray:
    """(start, end) of the runs of true values, flat."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    return edge


def _scan(docs: DataFrame, rows: list[tuple[str, int, bytes]]) -> DataFrame:
    """(doc_id, n_words, runs, items): runs of hit words as a flat list of starts and ends."""
    shared = docs.sparkSession.sparkContext.broadcast(rows)
    held: dict[str, _Index] = {}

    def find(batch: pa.RecordBatch) -> Iterator[dict]:
        if "index" not in held:
            held["index"] = _Index(shared.value)
        data, offsets = B.utf8_buffers(batch.column(1))
        for lo, hi in B.row_slices(offsets):
            part = data[offsets[lo] : offsets[hi]]
            words = B.Words(part, offsets[lo : hi + 1] - offsets[lo], WORD)
            marked, items = held["index"].hits(part, words, hi - lo)
            at = words.rows
            runs = [_runs(marked[at[i] : at[i + 1]]).tolist() if items[i] else [] for i in range(hi - lo)]
            yield {"doc_id": batch.column(0).slice(lo, hi - lo), "n_words": np.diff(at).astype(np.int64), "runs": runs, "items": [sorted(x) for x in items]}

    return map_batches(docs, find, "doc_id long, n_words long, runs array<long>, items array<string>")


def contamination(docs: DataFrame, benchmark: DataFrame, *, n: int = N, id_col: str = "doc_id", text_col: str = "text", block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """(doc_id, n_words, runs, items, n_hit) of every document; runs: flat starts and ends of hit words, items: sorted ids."""
    spark = docs.sparkSession
    windows = stored(item_windows(benchmark, n=n), "windows")
    blocks = max(1, math.ceil(windows.count() / block_windows))
    plain = text_column(docs, text_col).select(F.col(id_col).cast("long").alias("doc_id"), text_col)
    hit_words = F.coalesce(F.aggregate(F.transform("runs", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0))
    if blocks == 1:
        return _scan(plain, [tuple(r) for r in windows.select("item", "size", "window").collect()]).withColumn("n_hit", hit_words)
    keyed = stored(plain.withColumn(ROW, F.monotonically_increasing_id()), "documents")
    merged = _merged(keyed, windows, blocks, text_col).withColumn("n_hit", hit_words)
    return keyed.select(ROW, "doc_id").join(merged, ROW).drop(ROW)


def _union(runs: list[int]) -> list[int]:
    """Flat runs in any order as ascending runs that neither overlap nor touch."""
    out: list[int] = []
    for a, b in sorted(zip(runs[::2], runs[1::2], strict=True)):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _merged(keyed: DataFrame, windows: DataFrame, blocks: int, text_col: str) -> DataFrame:
    """(ROW, n_words, runs, items) of every row of a stored table with a key, from one pass for each block of windows."""
    dealt = windows.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(blocks)))
    parts = None
    for k in range(blocks):
        rows = [tuple(r) for r in dealt.where(F.col("block") == k).select("item", "size", "window").collect()]
        part = _scan(keyed.select(F.col(ROW).alias("doc_id"), text_col), rows)
        parts = part if parts is None else parts.unionByName(part)
    merged = parts.groupBy("doc_id").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("runs")).alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def unite(batch: pa.RecordBatch) -> Iterator[dict]:
        yield {ROW: batch.column(0), "n_words": batch.column(1), "runs": [_union(r) for r in batch.column(2).to_pylist()], "items": batch.column(3)}

    return map_batches(merged, unite, f"{ROW} long, n_words long, runs array<long>, items array<string>")


def report(found: DataFrame, *, share: int = 20) -> DataFrame:
    """Per document: counts, the digest of its items, and whether share * n_hit >= n_words with a hit."""
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), ((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))).alias("contaminated"))


def remove_spans(text: str, runs: list[int]) -> str:
    """The text without its hit words (and what stands between words of one run)."""
    raw = text.encode()
    data = np.frombuffer(raw, dtype=np.uint8)
    words = B.Words(data, np.array([0, len(data)]), WORD)
    out, at = [], 0
    for a, b in zip(runs[::2], runs[1::2], strict=True):
        out.append(raw[at : words.starts[a]])
        at = int(words.ends[b - 1])
    return b"".join([*out, raw[at:]]).decode()


def cleaned(docs: DataFrame, benchmark: DataFrame, *, n: int = N, share: int = 20, spans: bool = False, id_col: str = "doc_id", text_col: str = "text", block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """docs without contaminated documents or, with ``spans``, with the hit words of these taken out.  All columns stay.

    Each row is judged by its own text, whatever its id.  With one block of windows the scan is a map over the documents, so
    nothing is joined back: flags and texts leave the same task."""
    spark = docs.sparkSession
    windows = stored(item_windows(benchmark, n=n), "windows")
    blocks = max(1, math.ceil(windows.count() / block_windows))
    if blocks > 1:
        return _cleaned_by_blocks(docs, windows, blocks, share, spans, text_col)
    shared = spark.sparkContext.broadcast([tuple(r) for r in windows.select("item", "size", "window").collect()])
    place = docs.columns.index(text_col)
    held: dict[str, _Index] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.setdefault("index", _Index(shared.value))
        for batch in batches:
            data, offsets = B.utf8_buffers(batch.column(place))
            for lo, hi in B.row_slices(offsets):
                part = data[offsets[lo] : offsets[hi]]
                words = B.Words(part, offsets[lo : hi + 1] - offsets[lo], WORD)
                marked, items = index.hits(part, words, hi - lo)
                at = words.rows
                n_hit = np.add.reduceat(np.append(marked, 0), at[:-1]) if len(at) > 1 else np.zeros(0)
                n_hit = np.where(np.diff(at) > 0, n_hit, 0)
                bad = (n_hit > 0) & (n_hit * share >= np.diff(at))
                rows = batch.slice(lo, hi - lo)
                if spans and bad.any():
                    texts = rows.column(place).to_pylist()
                    texts = [remove_spans(t, _runs(marked[at[i] : at[i + 1]]).tolist()) if bad[i] else t for i, t in enumerate(texts)]
                    rows = rows.set_column(place, rows.schema.field(place), pa.array(texts, type=rows.schema.field(place).type))
                yield rows if spans else rows.filter(pa.array(~bad))

    return docs.mapInArrow(run, docs.schema)


def _cleaned_by_blocks(docs: DataFrame, windows: DataFrame, blocks: int, share: int, spans: bool, text_col: str) -> DataFrame:
    keyed = stored(text_column(docs, text_col).withColumn(ROW, F.monotonically_increasing_id()), "documents")
    hit = F.aggregate(F.transform("runs", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda a, x: a + x)
    bad = stored(_merged(keyed, windows, blocks, text_col).where((hit > 0) & (hit * share >= F.col("n_words"))).select(ROW, "runs"), "contaminated")
    if not spans:
        return keyed.join(bad.select(ROW), ROW, "left_anti").select(*docs.columns)
    place = docs.columns.index(text_col)
    runs = f"{ROW}_runs"
    schema = keyed.drop(ROW).schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(batch.num_columns - 1).to_pylist()
            texts = [remove_spans(t, r) if r is not None else t for t, r in zip(batch.column(place).to_pylist(), own, strict=True)]
            field = batch.schema.field(place)
            yield batch.set_column(place, field, pa.array(texts, type=field.type)).select(list(range(batch.num_columns - 1)))

    return keyed.join(bad.withColumnRenamed("runs", runs), ROW, "left").select(*docs.columns, runs).mapInArrow(cut, schema)


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
