"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

* Features are hashed n-grams of 1 to 3 code points of the lower-cased text (``2 ** BITS`` slots); a text's vector is its
  n-gram frequencies times the inverse document frequency.  Document frequencies come from every training document.
* Weights are fitted with follow-the-regularised-leader (per-coordinate rates, L1 and L2 penalties) on a sample of at most
  ``sample_rows`` labelled training documents, the same for each language as far as it has them; the sample is chosen by a
  hash of the id, and its texts are read whole.  A fifth of the sample is kept for the temperature, found by a line
  search on its log loss.
* Prediction is a map over whole texts: the table of weights (languages x slots) is of fixed size and is broadcast.

Defined cases: a null text or one without letters is ``und`` with score 0; a null id is not held out and not learned from;
an unlabelled document is predicted but not learned from; more than ``MAX_LANGUAGES`` labels are an error; if nothing can be learned all texts are ``und``; repeated rows
give repeated rows; an empty table gives an empty result.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytetext as B
from .shared import map_batches, release_memory, text_column

BITS = 16
ORDERS = (1, 2, 3)
#: A slot as it is sent to the driver.
_SLOT = np.dtype("<u2" if BITS <= 16 else "<u4")
SAMPLE_ROWS = 4_000
#: The table of weights has a row for each language, so a training table of more languages than these is refused.
MAX_LANGUAGES = 1_000
#: The learner looks at the document frequencies of slots that at least so many training documents hold.
MIN_DOCS = 2
FOLDS = 5
UNKNOWN = "und"
#: Text bytes that a task looks at together.
SLICE_BYTES = 1 << 18


@dataclasses.dataclass
class Model:
    """weights: languages x slots, already times the inverse document frequency; bias: one for each language."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


def _slots(points: np.ndarray, n: int) -> np.ndarray:
    """Hashed slots of the runs of n code points (one for each start)."""
    if n == 1:
        h = points * np.uint32(0x9E3779B1)
    else:
        count = len(points) - n + 1
        if count <= 0:
            return np.zeros(0, dtype=np.uint32)
        h = points[:count] * np.uint32(0x85EBCA77)
        for k in range(1, n):
            h = (h ^ points[k : k + count]) * np.uint32(0x9E3779B1 + 2 * k)
    h = h ^ (h >> np.uint32(15))
    return (h * np.uint32(0xC2B2AE3D)) >> np.uint32(32 - BITS)


def _points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all rows and each row's offsets; runs of anything but letters are one space."""
    lower = pc.utf8_lower(texts.fill_null(""))
    clean = pc.replace_substring_regex(lower, pattern=r"[^\pL]+", replacement=" ")
    lengths = pc.utf8_length(clean).to_numpy(zero_copy_only=False)
    raw, _ = B.utf8_buffers(clean)
    points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
    return points, np.concatenate([[0], np.cumsum(lengths)])


def _row_slots(points: np.ndarray) -> np.ndarray:
    return np.concatenate([_slots(points, n) for n in ORDERS])


def _in_slices(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    column = batch.column(at)
    _, offsets = B.utf8_buffers(column)
    for lo, hi in B.row_slices(offsets, SLICE_BYTES):
        yield lo, hi, *_points(column.slice(lo, hi - lo))


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """In how many documents each slot occurs, over all documents; each task sends one table of fixed size.

    The tables are summed by slot block on the executors, and only the sums (one table) come to the driver."""
    size, block = 1 << BITS, 1 << (BITS - 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(size, dtype=np.int64), 0
        flag = np.zeros(size, dtype=bool)
        for batch in batches:
            for lo, hi, points, offs in _in_slices(batch, 0):
                for i in range(hi - lo):
                    own = points[offs[i] : offs[i + 1]]
                    if len(own) < size:
                        slots = _row_slots(own)
                        flag[slots] = True
                        if len(slots) < size // 8:
                            hit = slots[flag[slots]]
                            hit = np.unique(hit)
                            seen[hit] += 1
                            flag[hit] = False
                            continue
                    else:
                        flag[_row_slots(own)] = True
                    seen += flag
                    flag[:] = False
                total += hi - lo
        release_memory()
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(range(size // block)) + [-1], type=pa.int32()), pa.array([*seen.reshape(-1, block).tolist(), [total]], type=pa.list_(pa.int64()))], names=["block", "counts"])

    sent = docs.select(text_col).mapInArrow(run, "block int, counts array<long>")
    summed = sent.select("block", F.posexplode("counts").alias("pos", "n")).groupBy("block", "pos").agg(F.sum("n").alias("n")).where("n > 0").toArrow()
    out = np.zeros(size, dtype=np.int64)
    at, pos, n = (summed.column(c).to_numpy() for c in ("block", "pos", "n"))
    own = at >= 0
    out[at[own] * block + pos[own]] = n[own]
    return out, int(n[~own].sum())


def _sample(docs: DataFrame, idf: np.ndarray, sample_rows: int, counts: dict[str, int], id_col: str, text_col: str, label_col: str) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(label, slots, values) of at most sample_rows documents; the lowest id hashes of each language."""
    languages = sorted(counts)
    each = max(1, sample_rows // len(languages))
    # of a hash of 40 bits, the part in which twice the rows that are wanted are to be expected: one scan for all languages
    part = docs.sparkSession.createDataFrame([(k, min(1 << 40, int((1 << 40) * (2 * each + 100) / n))) for k, n in counts.items()], "pick_lang string, part long")
    own = docs.select(F.col(id_col).alias("pick"), F.col(label_col).cast("string").alias("pick_lang")).withColumn("h", F.xxhash64("pick", F.lit(8)))
    few = own.join(F.broadcast(part), "pick_lang").where(F.pmod("h", F.lit(1 << 40)) < F.col("part"))
    picked = few.withColumn("nth", F.row_number().over(Window.partitionBy("pick_lang").orderBy(F.pmod("h", F.lit(1 << 40)), "h", "pick"))).where(F.col("nth") <= each).select("pick")
    # at most sample_rows ids: a proven bound for the broadcast
    ids = docs.sparkSession.sparkContext.broadcast({r[0] for r in picked.distinct().collect()})
    index = {x: i for i, x in enumerate(languages)}

    def vectors(batch: pa.RecordBatch):
        keep = np.array([x in ids.value for x in batch.column(0).to_pylist()], dtype=bool)
        batch = batch.filter(pa.array(keep))
        labels = [index[x] for x in batch.column(2).to_pylist()]
        for lo, hi, points, offs in _in_slices(batch, 1):
            slots, counts = [], []
            for i in range(hi - lo):
                s, c = np.unique(_row_slots(points[offs[i] : offs[i + 1]]), return_counts=True)
                slots.append(s.astype(_SLOT).tobytes())
                counts.append(c.astype("<u2" if c.max(initial=0) < 1 << 16 else "<u8").tobytes())
            yield {"id": batch.column(0).slice(lo, hi - lo), "label": labels[lo:hi], "slots": slots, "counts": counts}

    plain = docs.select(F.col(id_col).alias("id"), text_col, label_col)
    rows = map_batches(plain, vectors, "id long, label int, slots binary, counts binary").dropDuplicates(["id"])
    told, out = rows.toArrow().sort_by("id"), []
    for label, slots, counts in zip(*(told.column(c).to_pylist() for c in ("label", "slots", "counts")), strict=True):
        at = np.frombuffer(slots, dtype=_SLOT)
        c = np.frombuffer(counts, dtype=f"<u{len(counts) // len(at)}" if len(at) else "<u2").astype(np.int64)
        out.append((label, at, c * idf[at] / max(1, int(c.sum()))))
    return out


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=0))
    return e / e.sum(axis=0)


def fit_ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int, *, alpha: float = 2.0, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-4, epochs: int = 3, seed: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) by follow-the-regularised-leader, proximal form, one step for each row."""
    size = 1 << BITS
    z, n = np.zeros((classes, size + 1)), np.zeros((classes, size + 1))

    def weights(at: np.ndarray) -> np.ndarray:
        zz, nn = z[:, at], n[:, at]
        return np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(nn)) / alpha + l2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            label, slots, values = rows[k]
            at, x = np.append(slots.astype(np.int64), size), np.append(values, 1.0)
            w = weights(at)
            error = _softmax(w @ x)
            error[label] -= 1
            g = error[:, None] * x
            sigma = (np.sqrt(n[:, at] + g * g) - np.sqrt(n[:, at])) / alpha
            z[:, at] += g - sigma * w
            n[:, at] += g * g
    w = weights(np.arange(size + 1))
    return w[:, :size], w[:, size]


def calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss (golden-section search on its logarithm).

    Labels are smoothed by the rule of succession, so a sample without an error does not drive the temperature to zero."""
    if not len(labels):
        return 1.0
    classes, count = logits.shape
    off = 1.0 / (count + classes)
    target = np.full(logits.shape, off)
    target[labels, np.arange(count)] = 1 - off * (classes - 1)

    def loss(t: float) -> float:
        return float(-(target * np.log(np.maximum(_softmax(logits / np.exp(t)), 1e-300))).sum(axis=0).mean())

    lo, hi, g = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """A model from the labelled rows of docs (all of which may be learned from)."""
    usable = text_column(docs, text_col).where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull() & F.col(label_col).isNotNull())
    counts = dict(usable.groupBy(F.col(label_col).cast("string")).count().limit(MAX_LANGUAGES + 1).collect())
    languages = sorted(counts)
    if not languages:
        return None
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} different values of {label_col}")
    seen, total = document_frequencies(usable, text_col)
    idf = np.where(seen >= MIN_DOCS, np.log((1 + total) / (1 + seen)) + 1, 0.0)
    rows = _sample(usable, idf, sample_rows, counts, id_col, text_col, label_col)
    fit, held = [r for i, r in enumerate(rows) if i % 5], [r for i, r in enumerate(rows) if not i % 5]
    weights, bias = fit_ftrl(fit or held, len(languages))
    logits = np.array([weights[:, s] @ v + bias for _, s, v in held]).T if held else np.zeros((len(languages), 0))
    temperature = calibrate(logits, np.array([r[0] for r in held], dtype=np.int64))
    del rows, fit, held
    release_memory()  # of the driver, which learns again in each run
    return Model(languages, np.ascontiguousarray((weights * idf).T.astype(np.float32)), bias, temperature)


def _logits(model: Model, points: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """languages x rows: mean weight of each row's n-grams, of all orders together."""
    rows = len(offs) - 1
    total, grams = np.zeros((rows, len(model.languages))), np.zeros(rows)
    for n in ORDERS:
        slots = _slots(points, n)
        sums = np.zeros((len(slots) + 1, len(model.languages)))
        np.cumsum(model.weights[slots], axis=0, out=sums[1:], dtype=np.float64)
        ends = np.maximum(offs[1:] - n + 1, offs[:-1])
        starts = np.minimum(offs[:-1], len(slots))
        ends = np.minimum(np.maximum(ends, starts), len(slots))
        total += sums[ends] - sums[starts]
        grams += ends - starts
    return (total / np.maximum(grams, 1)[:, None] + model.bias).T


def held_out(id_col: str = "doc_id"):
    """Whether a row's id falls into the fold that is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _predict_batch(model: Model | None, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    points, offs = _points(texts)
    letters = np.concatenate([[0], np.cumsum(points != 32)])
    has = letters[offs[1:]] > letters[offs[:-1]]
    if model is None:
        return [UNKNOWN] * len(has), np.zeros(len(has))
    p = _softmax(_logits(model, points, offs) / model.temperature)
    best = p.argmax(axis=0)
    return [model.languages[b] if h else UNKNOWN for b, h in zip(best.tolist(), has.tolist(), strict=True)], np.where(has, p.max(axis=0), 0.0)


def predict(docs: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, lang_pred, score) of every row, from its text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch):
        column = batch.column(2)
        _, offsets = B.utf8_buffers(column)
        for lo, hi in B.row_slices(offsets, SLICE_BYTES):
            language, score = _predict_batch(shared.value, column.slice(lo, hi - lo))
            yield {"id": batch.column(0).slice(lo, hi - lo), "held_out": batch.column(1).slice(lo, hi - lo), "lang_pred": language, "score": score}

    plain = text_column(docs, text_col).select(F.col(id_col).cast("long").alias("id"), held_out(id_col).alias("held_out"), text_col)
    return map_batches(plain, run, "id long, held_out boolean, lang_pred string, score double").withColumnRenamed("id", id_col)


def recognised(docs: DataFrame, model: Model | None, *, min_score: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs whose text has a language with at least min_score; all columns stay, and nothing is joined."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = B.utf8_buffers(batch.column(place))
            for lo, hi in B.row_slices(offsets, SLICE_BYTES):
                language, score = _predict_batch(shared.value, batch.column(place).slice(lo, hi - lo))
                keep = [x != UNKNOWN and s >= min_score for x, s in zip(language, score.tolist(), strict=True)]
                yield batch.slice(lo, hi - lo).filter(pa.array(keep, type=pa.bool_()))
        release_memory()

    return docs.mapInArrow(run, docs.schema)


def learned_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return docs.where(~held_out(id_col))


def identify(docs: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Trains on the rows outside the held-out fold and predicts all rows."""
    return predict(docs, train(learned_rows(docs), sample_rows=sample_rows))
