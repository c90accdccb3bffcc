"""Licence scans: MinHash bands over overlapping text windows retrieve templates, exact containment verifies them.

Texts and templates are runs of lower-cased ASCII-alphanumeric or non-ASCII words; shingles are five words (a shorter
template is one shingle).  A template of m words is looked for in windows of ``m + s`` words, one every ``s`` words, with
``s = max(1, m // 4)``: an occurrence always lies inside a window.  A window that holds a share ``c`` of a template's
shingles has a Jaccard similarity to it of at least ``c * x / (x + s)`` (x: shingles of the template), which is 0.4 or more
for ``c = 0.8``; ``BANDS`` bands of one MinHash value miss such a pair with a probability under ``0.6 ** BANDS`` (8e-12).
Retrieved pairs are verified by exact containment of shingles, so nothing is reported by chance.

A window without any shingle of any template cannot share a MinHash value with one; such windows are skipped before their
signatures are computed, which changes no result.  Templates are a parameter whose number and size are checked, so what a
task holds is bounded; documents are scanned whole by a map without a shuffle.

Defined cases: a null text has no words; overlapping windows of one template that match are one span, from the first to the
last matched shingle; null or repeated ids and repeated rows are scanned like any other; an empty table gives an empty
result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytetext as B
from .shared import map_batches, text_column

SHINGLE = 5
BANDS = 50
CONTAINMENT = 0.8
MAX_TEMPLATES, MAX_TEMPLATE_WORDS = 10_000, 20_000

WORD = B.lut(allowed=bytes([*range(48, 58), *range(97, 123), *range(65, 91), *range(128, 256)]))
_CODES = B.byte_codes(9)[B.fold_ascii()]
_SEEDS = B.mix64(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _shingles(words: np.ndarray) -> np.ndarray:
    return B.gram_hashes(words, min(SHINGLE, len(words))) if len(words) else np.zeros(0, dtype=np.uint64)


def _signature(shingles: np.ndarray) -> np.ndarray:
    """BANDS MinHash values of one set."""
    return B.mix64(shingles[None, :] ^ _SEEDS[:, None]).min(axis=1)


class Index:
    """Templates by window class, with the bands of each."""

    def __init__(self, templates: dict[str, str]):
        if len(templates) > MAX_TEMPLATES:
            raise ValueError(f"more than {MAX_TEMPLATES} templates")
        self.classes: dict[int, dict] = {}
        every = []
        for name, text in sorted(templates.items()):
            data = np.frombuffer(text.encode(), dtype=np.uint8)
            words = B.Words(data, np.array([0, len(data)]), WORD)
            hashed = words.hashes(data, _CODES)
            if len(hashed) > MAX_TEMPLATE_WORDS:
                raise ValueError(f"{name} is longer than {MAX_TEMPLATE_WORDS} words")
            if not len(hashed):
                continue
            own = np.unique(_shingles(hashed))
            kind = self.classes.setdefault(len(hashed), {"names": [], "sets": [], "bands": [{} for _ in range(BANDS)]})
            for band, value in zip(kind["bands"], _signature(own).tolist(), strict=True):
                band.setdefault(value, []).append(len(kind["names"]))
            kind["names"].append(name)
            kind["sets"].append(own)
            every.append(own)
        self.sizes = sorted({min(SHINGLE, m) for m in self.classes})
        self.every = np.unique(np.concatenate(every)) if every else np.zeros(0, dtype=np.uint64)

    def matches(self, hashed: np.ndarray, known: dict[int, np.ndarray], grams: dict[int, np.ndarray]) -> list[tuple[str, int, int, float]]:
        """(template, first word, end word, containment) of one row; known: places of shingles that a template has."""
        found: dict[str, list[list]] = {}
        n = len(hashed)
        for m, kind in self.classes.items():
            k = min(SHINGLE, m)
            at = known[k]
            if not len(at) or n < k:
                continue
            step = max(1, m // 4)
            size = m + step
            first = np.maximum(0, -(-(at + k - size) // step))
            last = at // step
            starts = np.unique(np.concatenate([np.arange(a, b + 1) for a, b in zip(first.tolist(), last.tolist(), strict=True)])) * step
            for w in starts[starts < n].tolist():
                own = grams[k][w : min(w + size, n) - k + 1]
                if not len(own):
                    continue
                near = {i for band, value in zip(kind["bands"], _signature(own).tolist(), strict=True) for i in band.get(value, ())}
                for i in sorted(near):
                    inside = np.isin(own, kind["sets"][i])
                    share = len(np.unique(own[inside])) / len(kind["sets"][i])
                    if share >= CONTAINMENT:
                        places = np.flatnonzero(inside)
                        span = [w + int(places[0]), w + int(places[-1]) + k, share]
                        spans = found.setdefault(kind["names"][i], [])
                        if spans and spans[-1][1] > span[0]:
                            spans[-1] = [spans[-1][0], max(spans[-1][1], span[1]), max(spans[-1][2], share)]
                        else:
                            spans.append(span)
        return sorted((a, name, b, s) for name, spans in found.items() for a, b, s in spans)


def scan(docs: DataFrame, templates: dict[str, str], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, template, first_word, end_word, containment): arrays of each document's matches, by place and name."""
    held: dict[str, Index] = {}
    Index(templates)  # checks the sizes before anything is sent

    def find(batch: pa.RecordBatch):
        if "index" not in held:
            held["index"] = Index(templates)
        index = held["index"]
        data, offsets = B.utf8_buffers(batch.column(1))
        for lo, hi in B.row_slices(offsets):
            part = data[offsets[lo] : offsets[hi]]
            words = B.Words(part, offsets[lo : hi + 1] - offsets[lo], WORD)
            hashed = words.hashes(part, _CODES)
            grams = {k: B.gram_hashes(hashed, k) for k in index.sizes}
            known = {}
            for k, g in grams.items():
                near = np.minimum(np.searchsorted(index.every, g), max(len(index.every) - 1, 0))
                known[k] = np.flatnonzero(index.every[near] == g) if len(index.every) else np.zeros(0, dtype=np.int64)
            found = []
            for i in range(hi - lo):
                a, b = int(words.rows[i]), int(words.rows[i + 1])
                own = {k: p[np.searchsorted(p, a) : np.searchsorted(p, b)] - a for k, p in known.items()}
                own = {k: p[p + k <= b - a] for k, p in own.items()}
                found.append(index.matches(hashed[a:b], own, {k: g[a : max(a, b - k + 1)] for k, g in grams.items()}) if any(map(len, own.values())) else [])
            yield {"doc_id": batch.column(0).slice(lo, hi - lo), "template": [[x[1] for x in f] for f in found], "first_word": [[x[0] for x in f] for f in found], "end_word": [[x[2] for x in f] for f in found], "containment": [[x[3] for x in f] for f in found]}

    plain = text_column(docs, text_col).select(F.col(id_col).cast("long").alias("doc_id"), text_col)
    return map_batches(plain, find, "doc_id long, template array<string>, first_word array<long>, end_word array<long>, containment array<double>")


def summary(scanned: DataFrame) -> DataFrame:
    """(doc_id, n_matches, templates, spans): distinct template names and all spans (name:first:end, in words)."""
    spans = F.transform(F.arrays_zip("template", "first_word", "end_word"), lambda s: F.concat_ws(":", s["template"], s["first_word"].cast("string"), s["end_word"].cast("string")))
    return scanned.select("doc_id", F.size("template").cast("long").alias("n_matches"), F.array_join(F.array_sort(F.array_distinct("template")), ",").alias("templates"), F.array_join(spans, ",").alias("spans"))
