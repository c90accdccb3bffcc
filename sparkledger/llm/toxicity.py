"""Toxic passages by maximum-scoring segments over token log-odds, and a calibrated score for each text.

* A word is a run of letters, digits and non-ASCII characters of the lower-cased text.  Its log-odds come from the labelled
  texts that hold it, with Dirichlet priors in a chain: the whole word is smoothed towards its prefix of six bytes, that one
  towards five, four, and the share of toxic texts at the end of the chain, so rare and new words lean on what is known of
  their stems.  Counts are kept by count-min: two tables of ``2 ** BITS`` slots each, of fixed size, the smaller count counts;
  a collision must happen in both tables to be seen.
* A word's score is the growth of its log-odds over the average text's, less their standard deviation and less ``DRIFT``, so an ordinary text drifts downwards.
  One linear scan (Ruzzo and Tompa) finds all maximal-scoring segments of a text; those with an expected number of chance
  occurrences under one are its significant passages.
* Extreme-value calibration: lambda solves ``sum p(s) exp(lambda s) = 1`` over the scores of clean texts; a segment's value is
  ``lambda S - ln(words)``; the values of a text's significant segments are joined by the sum statistics of Karlin and
  Altschul; a Gumbel distribution fitted to clean texts turns this into a tail probability, and a logistic curve over its
  logarithm, fitted to labelled texts that the counts have not seen, gives the score.

Word counts, score distribution and calibration cover all labelled rows; nothing is sampled.  What comes to the driver are
tables of fixed size.

Defined cases: a null or empty text scores like a text without any segment; a null id is not held out and not learned from;
an id with several labels is toxic if one of them says so; null labels are none; without labels of both kinds every text
has the smoothed share of toxic labels as its score; repeated rows give repeated rows; an empty table gives an empty result.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytetext as B
from .shared import map_arrow, map_batches, stored, text_column

BITS = 20
SIZE = 1 << BITS
PREFIXES = (4, 5, 6)
#: How many texts a link of the chain of priors counts for.
PRIOR = 2.0
#: A word's log-odds count less so many of their standard deviations.
DEVIATIONS = 1.0
DRIFT = 1.0
FOLDS, HELD = 3, 1
#: One in so many labelled ids is kept for the score distribution and the calibration.
PARTS = 5
THRESHOLD = 0.7
SLICE_BYTES = 1 << 18
_WORD = B.lut(excluded=bytes(x for x in range(128) if not chr(x).isalnum()))
_CODES = B.byte_codes(11)
_SECOND = np.uint64(0x9E3779B97F4A7C15)
#: Bins of word scores and of calibration values.
SCORE_BINS, SCORE_STEP = 4096, 1 / 128
VALUE_BINS, VALUE_STEP = 8192, 1 / 16
#: The value of a text without any segment, below all others.
NOTHING = -VALUE_BINS // 4 * VALUE_STEP


class Tokens:
    """The words of a slice of texts and the keys of each: its prefixes, shortest first, and itself."""

    def __init__(self, texts: pa.Array):
        self.lower = pc.utf8_lower(texts.fill_null(""))
        data, offsets = B.utf8_buffers(self.lower)
        words = B.Words(data, offsets, _WORD)
        self.starts, self.ends, self.rows = words.starts, words.ends, words.rows
        up, down = B.powers(len(data))
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_CODES[data] * up[: len(data)], out=sums[1:])

        def keys(ends: np.ndarray, salt: int) -> np.ndarray:
            return B.mix64((sums[ends] - sums[self.starts]) * down[self.starts] + np.uint64(salt))

        # a prefix has keys of its own, so that "idio" as a word and as a prefix are two things
        self.keys = [keys(np.minimum(self.starts + n, self.ends), n) for n in PREFIXES] + [keys(self.ends, 0)]

    def __len__(self) -> int:
        return len(self.starts)


def _slots(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (keys >> np.uint64(64 - BITS)).astype(np.int64), SIZE + (B.mix64(keys ^ _SECOND) >> np.uint64(64 - BITS)).astype(np.int64)


@dataclasses.dataclass
class Counts:
    """toxic and clean: labelled texts that hold a slot's keys, for two tables of slots one behind the other."""

    toxic: np.ndarray
    clean: np.ndarray
    share: float

    def log_odds(self, tokens: Tokens) -> np.ndarray:
        """Of each word, over the average text's."""
        share = np.full(len(tokens), self.share)
        for keys in tokens.keys:
            a, b = _slots(keys)
            toxic, clean = np.minimum(self.toxic[a], self.toxic[b]), np.minimum(self.clean[a], self.clean[b])
            one, none = toxic + PRIOR * share, clean + PRIOR * (1 - share)
            share = one / (one + none)
        return np.log(one / none) - math.log(self.share / (1 - self.share)) - DEVIATIONS * np.sqrt(1 / (one + 1) + 1 / (none + 1))


@dataclasses.dataclass
class Model:
    """decay: the lambda of the score distribution; place, width: of the Gumbel distribution; slope, shift: of the logistic curve."""

    counts: Counts | None
    prior: float
    decay: float = 1.0
    place: float = 0.0
    width: float = 1.0
    slope: float = 1.0
    shift: float = 0.0


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row's id falls into the fold that is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(text, toxic, part) of the rows that may be learned from; part 0 is for calibration.

    Texts outside the held-out fold move by their id once, at every size alike (labels grow with the texts, so they are never
    sent to all tasks); the result is a table, since it is read three times."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("labelled_id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("toxic"))
    rows = text_column(docs, text_col).where(~held_out(id_col)).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    met = rows.join(known.hint("merge"), F.col("id") == F.col("labelled_id"))
    return stored(met.select("text", "toxic", F.pmod(F.xxhash64("id"), F.lit(PARTS)).cast("int").alias("part")), "labelled")


def count_words(rows: DataFrame) -> Counts | None:
    """Of (text, toxic): in how many texts of each kind each slot's keys occur."""
    kinds = dict(rows.groupBy("toxic").count().collect())
    if len(kinds) < 2:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 2 * SIZE), dtype=np.int64)
        for batch in batches:
            column, toxic = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            _, offsets = B.utf8_buffers(column)
            for lo, hi in B.row_slices(offsets, SLICE_BYTES):
                tokens = Tokens(column.slice(lo, hi - lo))
                row = np.repeat(np.arange(hi - lo, dtype=np.uint64), np.diff(tokens.rows))
                for keys in tokens.keys:
                    for slots in _slots(keys):
                        once = np.unique((row << np.uint64(BITS + 1)) | slots.astype(np.uint64))
                        kind = toxic[lo + (once >> np.uint64(BITS + 1)).astype(np.int64)]
                        slot = (once & np.uint64(2 * SIZE - 1)).astype(np.int64)
                        for k in (0, 1):
                            own, n = np.unique(slot[kind == k], return_counts=True)
                            counts[k, own] += n
        for k in (0, 1):
            slot = np.flatnonzero(counts[k])
            for at in range(0, len(slot), 1 << 16):
                own = slot[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(own), type=pa.int32()), pa.array(own), pa.array(counts[k][own])], names=["kind", "slot", "n"])

    found = map_arrow(rows.select("text", "toxic"), run, "kind int, slot long, n long").groupBy("kind", "slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((2, 2 * SIZE), dtype=np.float32)
    out[found.column("kind").to_numpy(), found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return Counts(out[1], out[0], kinds[1] / (kinds[0] + kinds[1]))


def maximal_segments(places: list[int], scores: list[float], drops: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last, score) of a run of words, in one linear scan.

    Given are the words with a positive score only; drops[i] is the (negative or zero) sum of the words before the i-th one
    and after the one before it."""
    found: list[tuple[int, int, float, float, int]] = []  # first, last, sum before, sum up to the end, link
    total = 0.0
    for place, score, drop in zip(places, scores, drops, strict=True):
        total += drop
        first, before = place, total
        total += score
        while True:
            # the nearest segment that begins lower; links skip those that begin higher, so each is passed once
            k = len(found) - 1
            while k >= 0 and found[k][2] >= before:
                k = found[k][4]
            if k < 0 or found[k][3] >= total:
                break
            first, before = found[k][0], found[k][2]
            del found[k:]
        found.append((first, place, before, total, k))
    return [(a, b, after - before) for a, b, before, after, _ in found]


def segments(scores: np.ndarray, words: np.ndarray) -> list[tuple[int, int, float]]:
    """Maximal-scoring segments of one text's word scores.  The k-th occurrence of a word in the text counts for 1/k of its
    positive score, so a long run of one doubtful word is no passage."""
    places = np.flatnonzero(scores > 0)
    if not len(places):
        return []
    sums = np.concatenate([[0.0], np.cumsum(np.minimum(scores, 0.0))])
    seen: dict[int, int] = {}
    own = scores[places].tolist()
    for k, word in enumerate(words[places].tolist()):
        seen[word] = seen.get(word, 0) + 1
        own[k] /= seen[word]
    return maximal_segments(places.tolist(), own, np.diff(sums[places], prepend=0.0).tolist())


def joint_value(scores: list[float], decay: float, words: int) -> float:
    """-ln of how often chance gives a text's significant segments together (sum statistics); of its best segment at least."""
    if not scores:
        return NOTHING
    values = sorted((decay * s - math.log(words) for s in scores), reverse=True)
    best = total = values[0]
    for r, x in enumerate(values[1:], 2):
        if x <= 0:
            break
        total += x
        best = max(best, total - (r - 1) * math.log(max(total, 1.0)) + math.lgamma(r + 1) + math.lgamma(r))
    return best


def _values(model: Model, texts: pa.Array) -> Iterator[tuple[int, Tokens, np.ndarray, list[tuple[int, int, float]]]]:
    """(row, tokens, the row's word scores, its segments)."""
    tokens = Tokens(texts)
    scores = model.counts.log_odds(tokens) - DRIFT
    for i in range(len(texts)):
        own = scores[tokens.rows[i] : tokens.rows[i + 1]]
        yield i, tokens, own, segments(own, tokens.keys[-1][tokens.rows[i] : tokens.rows[i + 1]])


def _binned(rows: DataFrame, model: Model, what: str) -> np.ndarray:
    """kind x bin: the words' scores or the texts' joint values of labelled rows, counted in bins of fixed width."""
    size = SCORE_BINS if what == "scores" else VALUE_BINS
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, size), dtype=np.int64)
        for batch in batches:
            column, toxic = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            _, offsets = B.utf8_buffers(column)
            for lo, hi in B.row_slices(offsets, SLICE_BYTES):
                for i, _, own, found in _values(shared.value, column.slice(lo, hi - lo)):
                    if what == "scores":
                        at = np.clip(own / SCORE_STEP + SCORE_BINS // 2, 0, SCORE_BINS - 1).astype(np.int64)
                        counts[toxic[lo + i]] += np.bincount(at, minlength=size)
                    else:
                        value = joint_value([s for _, _, s in found], shared.value.decay, len(own))
                        counts[toxic[lo + i], _value_bin(value)] += 1
        kind, at = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(kind.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(counts[kind, at])], names=["kind", "bin", "n"])

    found = map_arrow(rows.select("text", "toxic"), run, "kind int, bin int, n long").groupBy("kind", "bin").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((2, size))
    out[found.column("kind").to_numpy(), found.column("bin").to_numpy()] = found.column("n").to_numpy()
    return out


def _value_bin(value: float) -> int:
    return min(VALUE_BINS - 1, max(0, int(value / VALUE_STEP) + VALUE_BINS // 4))


def decay_of(counts: np.ndarray) -> float:
    """lambda of a score histogram; a single word more at the largest score keeps it finite where clean texts have no
    positive one."""
    scores = (np.arange(SCORE_BINS) - SCORE_BINS // 2) * SCORE_STEP
    counts = counts.copy()
    counts[SCORE_BINS // 2 + int(math.log(99) / SCORE_STEP)] += 1
    p = counts / counts.sum()
    if p @ scores >= 0:
        return 0.05
    lo, hi = 1e-6, 50.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if p @ np.exp(np.minimum(mid * scores, 700.0)) > 1 else (mid, hi)
    return (lo + hi) / 2


def tail(value: float, place: float, width: float) -> float:
    """-ln of the chance that a clean text's value is at least this one, by a Gumbel distribution; at most 60."""
    z = (value - place) / width
    if z > 30:
        return min(60.0, z)
    return min(60.0, -math.log(max(-math.expm1(-math.exp(-z)), 1e-300)))


def fit_curve(x: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """(slope, shift) of the logistic curve of kind 1 over x, for n[kind] rows at each x; targets are smoothed as Platt does."""
    clean, toxic = n.sum(axis=1)
    low, high = 1 / (clean + 2), (toxic + 1) / (toxic + 2)
    weight, target = n.sum(axis=0), n[0] * low + n[1] * high
    w = np.array([1.0, math.log((toxic + 1) / (clean + 1))])
    design = np.stack([x, np.ones_like(x)])

    def loss(v: np.ndarray) -> float:
        z = v @ design
        return float((weight * np.logaddexp(0, z) - target * z).sum() + 1e-6 * v @ v)

    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(w @ design, -500, 500)))
        gradient = design @ (weight * p - target) + 2e-6 * w
        hessian = (design * (weight * p * (1 - p) + 1e-9)) @ design.T + 2e-6 * np.eye(2)
        step, scale, now = np.linalg.solve(hessian, gradient), 1.0, loss(w)
        while scale > 1e-6 and loss(w - scale * step) > now:
            scale /= 2
        w = w - scale * step
        if np.abs(scale * step).max() < 1e-9:
            break
    return max(float(w[0]), 0.0), float(w[1])


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Counts from four fifths of the labelled ids, score distribution and calibration from the last fifth."""
    rows = labelled(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col)
    seen = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    prior = (seen[1] + 1) / (seen[0] + 2)
    model = Model(count_words(rows.where("part <> 0")), prior)
    if model.counts is None:
        return model
    kept = rows.where("part = 0")
    model.decay = decay_of(_binned(kept, model, "scores")[0])
    bins = _binned(kept, model, "values")
    values = (np.arange(VALUE_BINS) - VALUE_BINS // 4 + 0.5) * VALUE_STEP
    clean = bins[0]
    if not clean.sum() or not bins[1].sum():
        return Model(None, prior)
    chance, at = clean[1:], values[1:]  # clean texts with a segment
    if chance.sum():
        mean = float(chance @ at / chance.sum())
        model.width = max(math.sqrt(float(chance @ (at - mean) ** 2 / chance.sum()) * 6) / math.pi, 0.5)
        model.place = mean - 0.5772156649 * model.width
    used = np.flatnonzero(bins.sum(axis=0))
    x = np.array([tail(v, model.place, model.width) for v in values[used]])
    model.slope, model.shift = fit_curve(x, bins[:, used])
    return model


def probability(model: Model, scores: list[float], words: int) -> float:
    if model.counts is None:
        return model.prior
    x = tail(joint_value(scores, model.decay, words), model.place, model.width)
    z = model.slope * x + model.shift
    return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every row, from its text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        column = batch.column(2)
        _, offsets = B.utf8_buffers(column)
        for lo, hi in B.row_slices(offsets, SLICE_BYTES):
            if shared.value.counts is None:
                scores = [shared.value.prior] * (hi - lo)
            else:
                scores = [probability(shared.value, [s for _, _, s in found], len(own)) for _, _, own, found in _values(shared.value, column.slice(lo, hi - lo))]
            yield {"id": batch.column(0).slice(lo, hi - lo), "held_out": batch.column(1).slice(lo, hi - lo), "score": scores, "predicted": [int(s >= THRESHOLD) for s in scores]}

    plain = text_column(docs, text_col).select(F.col(id_col).cast("long").alias("id"), held_out(id_col).alias("held_out"), text_col)
    return map_batches(plain, run, "id long, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col)


def passages(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, end, value, passage): every significant segment of every text, in code points of the lower-cased text,
    value being -ln of the number of such segments that chance gives in a text of its length."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        column = batch.column(1)
        _, offsets = B.utf8_buffers(column)
        for lo, hi in B.row_slices(offsets, SLICE_BYTES) if shared.value.counts is not None else ():
            out: dict[str, list] = {"id": [], "start": [], "end": [], "value": [], "passage": []}
            for i, tokens, own, found in _values(shared.value, column.slice(lo, hi - lo)):
                if not found:
                    continue
                data, offs = B.utf8_buffers(tokens.lower)
                for a, b, s in found:
                    value = shared.value.decay * s - math.log(len(own))
                    if value <= 0:
                        continue
                    first, last = int(tokens.starts[tokens.rows[i] + a]), int(tokens.ends[tokens.rows[i] + b])
                    start = len(bytes(data[offs[i] : first]).decode())
                    passage = bytes(data[first:last]).decode()
                    for name, x in zip(out, (batch.column(0)[lo + i].as_py(), start, start + len(passage), value, passage), strict=True):
                        out[name].append(x)
            yield out

    plain = text_column(docs, text_col).select(F.col(id_col).cast("long").alias("id"), text_col)
    return map_batches(plain, run, "id long, start long, end long, value double, passage string").withColumnRenamed("id", id_col)


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Trains on the labelled rows outside the held-out fold and scores all rows."""
    return score(docs, train(docs, labels))
