"""Whitening of embeddings by Chebyshev-filtered subspace iteration over distributed passes.

The covariance V of the vectors is never formed.  A pass multiplies a thin matrix Q (dimensions x subspace) by it: each task
adds XᵀXQ of its centred rows, and the sums of all tasks come to the driver, a table of fixed size.  On the driver only thin
matrices are held.

* A short Lanczos run bounds the spectrum from below; the unwanted part is what lies between that bound and the least Ritz
  value of the subspace.
* A round applies the Chebyshev polynomial of degree ``DEGREE`` on the unwanted part by its three-term recurrence (a pass for
  each degree), so that part is damped and the wanted part grows; QR and a Rayleigh-Ritz step (one more pass) follow.
* Rounds end when the residual ``|Vq - eq|`` of every wanted component is certified: at most ``TOLERANCE`` times the largest
  eigenvalue, or, within a thousand times of that, no longer falling, which is where rounding stands.  After ``ROUNDS`` rounds
  the subspace is doubled; one as wide as the vectors is exact after a single pass.

Vectors are quantised to integers ``floor(scale * c) + shift``, whose sums and squared deviations are exact.

Defined cases: rows whose vector is null or holds null or non-finite entries are left out; a shorter vector counts as ending
in zeros; rows of one id are rows of their own, a null id stays; entries beyond ``2^52 / scale`` are refused with an error;
directions without spread (eigenvalue under ``RANK`` times the largest) are no components, so equal vectors give no rows; a
squared deviation that no long holds is null; an empty table gives an empty result.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import map_arrow, stored

COMPONENTS, DEGREE, LANCZOS, ROUNDS = 32, 8, 10, 30
TOLERANCE, RANK = 2e-14, 1e-10
SCALE, SHIFT = 64, 1_000_000
#: Bytes of a matrix that a task looks at together.
SLICE_BYTES = 1 << 22


@dataclasses.dataclass
class Table:
    """The quantised vectors: rows (vec_id, x), x the bytes of width numbers of kind, without the shift."""

    rows: DataFrame
    count: int
    width: int
    kind: str
    peak: int


@dataclasses.dataclass
class Whitening:
    """components: width x k unit eigenvectors, values: their eigenvalues, falling; sums: exact, of x without the shift."""

    sums: list[int]
    count: int
    components: np.ndarray
    values: np.ndarray
    trace: float
    passes: int
    residual: float


def quantised(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> Table:
    """A table in the shared folder, so that the passes read numbers of fixed width and nothing else."""
    raw = F.col(vector_col).cast("array<double>")
    finite = F.forall(raw, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    kept = vectors.where(raw.isNotNull() & finite).select(F.col(id_col).cast("long").alias("vec_id"), raw.alias("v"))
    count, width, peak = kept.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(F.greatest(F.array_max("v"), -F.array_min("v")))).first()
    width, peak = width or 0, int(np.floor(scale * (peak or 0.0))) + 1
    if peak >= 1 << 52:
        raise ArithmeticError("entries are too large to be quantised exactly")
    kind = "<i4" if peak < 1 << 31 else "<f8"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            lengths = np.diff(lists.offsets.to_numpy())
            made = np.zeros((len(lengths), width), dtype=kind)
            made[np.arange(width) < lengths[:, None]] = np.floor(scale * lists.flatten().to_numpy())
            offsets = pa.array(np.arange(len(lengths) + 1) * made.itemsize * width, type=pa.int32())
            packed = pa.Array.from_buffers(pa.binary(), len(lengths), [None, offsets.buffers()[1], pa.py_buffer(made.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), packed], names=["vec_id", "x"])

    return Table(stored(map_arrow(kept, pack, "vec_id long, x binary"), "vectors"), count, width, kind, peak)


def _matrices(column: pa.Array, width: int, kind: str) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, rows x width) in slices of a column of packed rows."""
    size = np.dtype(kind).itemsize * width
    step = max(1, SLICE_BYTES // size)
    first = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset] if len(column) else 0
    flat = np.frombuffer(column.buffers()[2], dtype=np.uint8)[first : first + size * len(column)].view(kind).reshape(-1, width) if len(column) else np.zeros((0, width))
    for lo in range(0, len(flat), step):
        yield lo, flat[lo : lo + step]


def _summed(table: Table, measure: Callable[[np.ndarray], np.ndarray], exact: bool = False) -> list:
    """The sum of measure(rows x width) over all rows: added in each task, then by place on the executors."""
    width, kind = table.width, table.kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, m in _matrices(batch.column(0), width, kind):
                own = measure(m)
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], type=pa.list_(pa.int64() if exact else pa.float64()))], names=["v"])

    sent = map_arrow(table.rows.select("x"), run, "v array<long>" if exact else "v array<double>").select(F.posexplode("v").alias("place", "v"))
    value = F.col("v").cast("decimal(38,0)") if exact else F.col("v")
    found = sent.groupBy("place").agg(F.sum(value).alias("v")).toArrow().sort_by("place")
    return [int(x) for x in found.column("v").to_pylist()] if exact else found.column("v").to_numpy()


def _centred(sums: list[int], count: int) -> Callable[[np.ndarray], np.ndarray]:
    """Rows minus their mean: the whole part is taken off as an integer, so nothing is lost by the size of the numbers."""
    whole = [(2 * s + count) // (2 * count) for s in sums]
    near, rest = np.array(whole, dtype=np.float64), np.array([(s - count * w) / count for s, w in zip(sums, whole, strict=True)])
    return lambda m: (m - near) - rest


def _lower_bound(apply: Callable[[np.ndarray], np.ndarray], start: np.ndarray) -> float:
    """A bound that (safely, as in Zhou and Saad) no eigenvalue is under: least Ritz value of a Lanczos run less its residual."""
    basis, alphas, betas = [start / np.linalg.norm(start)], [], []
    for _ in range(LANCZOS):
        w = apply(basis[-1][:, None])[:, 0]
        alphas.append(float(w @ basis[-1]))
        for q in [*basis, *basis]:
            w = w - (w @ q) * q
        betas.append(float(np.linalg.norm(w)))
        if betas[-1] <= 1e-12 * max(alphas):
            break
        basis.append(w / betas[-1])
    t = np.diag(alphas) + np.diag(betas[: len(alphas) - 1], 1) + np.diag(betas[: len(alphas) - 1], -1)
    return max(0.0, float(np.linalg.eigvalsh(t)[0]) - betas[-1])


def chebyshev_filter(apply: Callable[[np.ndarray], np.ndarray], q: np.ndarray, low: float, high: float, top: float, degree: int = DEGREE) -> np.ndarray:
    """The polynomial that is small on [low, high] and large above, applied to q; scaled to 1 at top against overflow."""
    half, middle = (high - low) / 2, (high + low) / 2
    first = half / (top - middle)
    sigma = first
    now = (apply(q) - middle * q) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        q, now = now, 2 * (apply(now) - middle * now) * (following / half) - (sigma * following) * q
        sigma = following
    return now


def top_components(apply: Callable[[np.ndarray], np.ndarray], width: int, wanted: int, *, guard: int | None = None, rounds: int = ROUNDS, seed: int = 12) -> tuple[np.ndarray, np.ndarray, float]:
    """(components, values, largest residual over the largest value) of the symmetric, positive semi-definite ``apply``."""
    wanted = min(wanted, width)
    size = min(width, wanted + (max(8, wanted // 2) if guard is None else guard))
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.normal(size=(width, size)))[0] if size < width else np.eye(width)
    low = _lower_bound(apply, rng.normal(size=width)) if size < width else 0.0
    done, before = 0, np.inf
    while True:
        vq = apply(q)
        h = q.T @ vq
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        worst = float(np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max()) / max(float(values[0]), 1e-300) if wanted else 0.0
        settled = worst <= TOLERANCE or (worst <= 1000 * TOLERANCE and worst > before / 2)
        if settled or size == width or values[0] <= 0:
            return q[:, :wanted], values[:wanted], worst
        done, before = done + 1, worst
        if done % rounds == 0:
            size = min(width, 2 * size)
            q = np.linalg.qr(np.hstack([q, rng.normal(size=(width, size - q.shape[1]))]))[0] if size < width else np.eye(width)
            before = np.inf
            continue
        high = float(values[-1])
        if high - low <= 1e-9 * float(values[0]):
            low = max(0.0, high - 1e-9 * float(values[0]))
            high = low + 1e-9 * float(values[0])
        q = chebyshev_filter(apply, q, low, high, max(float(values[0]), high * (1 + 1e-9)))
        q = np.linalg.qr(q / np.linalg.norm(q, axis=0))[0]


def fit(table: Table, components: int = COMPONENTS, **options: int) -> Whitening:
    """The leading components of the covariance (divisor: number of rows) of all rows."""
    n, width = table.count, table.width
    if not n or not width:
        return Whitening([0] * width, n, np.zeros((width, 0)), np.zeros(0), 0.0, 0, 0.0)
    sums = _summed(table, lambda m: m.astype(np.int64).sum(axis=0), exact=True)
    centred = _centred(sums, n)
    trace = float(_summed(table, lambda m: np.array([np.square(centred(m)).sum()]))[0]) / n
    passes, context = 2, table.rows.sparkSession.sparkContext

    def apply(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        shared = context.broadcast(q)

        def measure(m: np.ndarray) -> np.ndarray:
            x = centred(m)
            return (x.T @ (x @ shared.value)).ravel()

        out = _summed(table, measure).reshape(q.shape) / n
        shared.destroy()
        return out

    if trace <= 0:
        return Whitening(sums, n, np.zeros((width, 0)), np.zeros(0), 0.0, passes, 0.0)
    found, values, residual = top_components(apply, width, components, **options)
    keep = values > RANK * values[0]
    found, values = found[:, keep], values[keep]
    found = found * np.where(found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])] < 0, -1.0, 1.0)
    return Whitening(sums, n, found, values, trace, passes, residual)


def _projection(fitted: Whitening) -> Callable[[np.ndarray], np.ndarray]:
    centred, matrix = _centred(fitted.sums, fitted.count), fitted.components / np.sqrt(fitted.values)
    return lambda m: centred(m) @ matrix


def identity_error(table: Table, fitted: Whitening) -> float:
    """The largest entry of the whitened rows' covariance minus the identity, measured on all rows."""
    k = len(fitted.values)
    if not k:
        return 0.0
    project = _projection(fitted)

    def measure(m: np.ndarray) -> np.ndarray:
        w = project(m)
        return np.concatenate([(w.T @ w).ravel(), w.sum(axis=0)])

    total = _summed(table, measure) / fitted.count
    mean = total[k * k :]
    return float(np.abs(total[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def whitened(table: Table, fitted: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened): the squared deviation of a row times the square of the number of rows, exact, and its
    whitened components."""
    n, sums, width, kind = fitted.count, fitted.sums, table.width, table.kind
    if not len(fitted.values):
        return table.rows.where("false").select("vec_id", F.lit(0).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
    project, k = _projection(fitted), len(fitted.values)
    short = width * (2 * n * table.peak) ** 2 < 1 << 63

    def deviations(m: np.ndarray) -> list[int | None]:
        if short:
            return np.square(n * m.astype(np.int64) - np.array(sums, dtype=np.int64)).sum(axis=1).tolist()
        exact = (sum((n * int(x) - s) ** 2 for x, s in zip(row, sums, strict=True)) for row in m.tolist())
        return [d if d < 1 << 63 else None for d in exact]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, m in _matrices(batch.column(1), width, kind):
                w = project(m)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * k, type=pa.int32()), pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(m)), pa.array(deviations(m), type=pa.int64()), lists], names=["vec_id", "deviation", "whitened"])

    return map_arrow(table.rows.select("vec_id", "x"), run, "vec_id long, deviation long, whitened array<double>")


def report(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each vector and component, with what the fit explains and how white it came out."""
    table = quantised(vectors)
    fitted = fit(table, components)
    error = identity_error(table, fitted)
    share = F.array(*[F.lit(float(v) / fitted.trace) for v in fitted.values]) if len(fitted.values) else F.array().cast("array<double>")
    rows = whitened(table, fitted).select("vec_id", F.lit(fitted.count).cast("long").alias("n"), "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return rows.select("vec_id", (F.col("place") + 1).cast("int").alias("component"), "n", "deviation", "whitened", F.get(share, F.col("place")).alias("explained"), F.lit(error).alias("identity_error"))

