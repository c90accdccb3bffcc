"""Toxicity, whitening and the Merkle manifest against plain Python."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkledger.llm import merkle, toxicity, whitening

from .fixtures import documents, frame, with_extra, words

# --- Merkle manifest ---------------------------------------------------------------------------------------------------------


def plain_manifest(rows):
    """By the definition: whole levels, no superblocks."""

    def digest(*parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def field(x):
        return "-" if x is None else f"{len(str(x).encode())}:{x}"

    def leaf(r, text):
        return digest(field(r[0]), field(r[3]), field(r[2]), field(r[4]), field(text))

    def tree(nodes):
        """The root and each node's siblings (left, right), level by level."""
        proofs, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
        while len(level) > 1:
            for p, i in zip(proofs, at, strict=True):
                lo = i - i % 3
                p.append(("".join(level[lo:i]), "".join(level[i + 1 : lo + 3])))
            level, at = [digest(*level[i : i + 3]) for i in range(0, len(level), 3)], [i // 3 for i in at]
        return level[0], proofs

    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        own = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees.append((own, *tree([leaf(r, r[1]) for r in own])))
    root, over = tree([t[1] for t in trees]) if trees else (None, [])
    out = []
    for (own, subroot, proofs), above in zip(trees, over, strict=True):
        for r, p in zip(own, proofs, strict=True):
            path = p + above
            touched = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[1] is not None
            now = leaf(r, r[1].replace("\n", "") if touched else r[1])
            for a, b in path:
                now = digest(a, now, b)
            out.append((r[0], leaf(r, r[1]), subroot, root, digest(*[a + b for a, b in path]), now, now == root))
    return out


def test_manifest_against_the_definition(spark):
    rng = random.Random(1)
    rows = [(a, b, c, rng.choice(["hot"] * 5 + ["b", None, "ä", "z"]), n) for a, b, c, _, n in documents()]
    rows += [(1000 + i, f"line {i}\nnext" if i % 3 else None, None, "hot" if i % 2 else f"own {i}", i) for i in range(150)]
    want = sorted(plain_manifest(rows), key=repr)
    got = merkle.manifest(with_extra(frame(spark, rows)), damage=merkle.without_breaks)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    # small superblocks: several stages of subtrees, and of the tree over the sources
    got = merkle.manifest(frame(spark, rows), damage=merkle.without_breaks, keep_proofs=True, size=9).collect()
    assert sorted((tuple(r)[:7] for r in got), key=repr) == want
    assert all(merkle.fold(r["leaf"], r["proof"]) == r["root"] for r in got)
    assert any(not r["verified"] for r in got) and any(r["verified"] for r in got)


def test_manifest_of_few_rows(spark):
    rows = [(7, "a\nb", "x", "s", 3)]
    assert list(map(tuple, merkle.manifest(frame(spark, rows), damage=merkle.without_breaks).collect())) == plain_manifest(rows)
    assert merkle.manifest(frame(spark, []), damage=merkle.without_breaks).count() == 0


# --- whitening ---------------------------------------------------------------------------------------------------------------


def vector_rows(n=400, d=20, seed=2):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(d, d)) * np.linspace(3, 0.2, d)
    return [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(n, d)) @ mix)]


def check_whitening(rows, got, k):
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    centred = np.array([[c - s / n for c, s in zip(r, sums, strict=True)] for r in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    by = {(r["vec_id"], r["component"]): r for r in got}
    assert len(by) == len(got) == n * k
    for c in range(k):
        own = np.array([by[i, c + 1]["whitened"] for i, _ in rows])
        want = centred @ vectors[:, c] / math.sqrt(values[c])
        assert np.abs(own * np.sign(own @ want) - want).max() < 1e-9
        assert by[rows[0][0], c + 1]["explained"] == pytest.approx(values[c] / values.sum(), rel=1e-9)
    for (i, _), r in zip(rows, x, strict=True):
        assert by[i, 1]["deviation"] == sum((n * c - s) ** 2 for c, s in zip(r, sums, strict=True)) and by[i, 1]["n"] == n
    assert max(r["identity_error"] for r in got) < 1e-9


def test_whitening_against_a_full_decomposition(spark):
    rows = vector_rows()
    bad = [(900, None), (901, [1.0, None] * 10), (902, [float("nan")] * 20), (903, [float("inf")] * 20)]
    table = with_extra(spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>"))
    check_whitening(rows, whitening.report(table, components=5).collect(), 5)  # a subspace of 13 of 20: filtered
    check_whitening(rows, whitening.report(table).collect(), 20)  # as wide as the vectors


def test_filtered_iteration_is_certified_and_damps():
    rng = np.random.default_rng(3)
    basis = np.linalg.qr(rng.normal(size=(60, 60)))[0]
    spectrum = np.sort(rng.uniform(1, 2, 60))[::-1] + np.linspace(1, 0, 60)
    v = (basis * spectrum) @ basis.T
    found, values, residual = whitening.top_components(lambda q: v @ q, 60, 6)
    assert residual <= 1000 * whitening.TOLERANCE and np.allclose(values, spectrum[:6], rtol=1e-12)
    assert np.allclose(np.abs(np.sum(found * basis[:, :6], axis=0)), 1, atol=1e-10)
    filtered = whitening.chebyshev_filter(lambda q: v @ q, basis, spectrum[-1], spectrum[10], spectrum[0])
    grown = np.abs(np.sum(filtered * basis, axis=0))
    assert grown[10:].max() < grown[9] < grown[0] and grown[10:].max() < 1e-2 * grown[0]
    # equal eigenvalues, and a subspace that must be doubled
    assert np.allclose(whitening.top_components(lambda q: 3 * q, 60, 6)[1], 3)
    tight = np.diag(np.concatenate([np.full(30, 2.0), 2 - 1e-6 * np.arange(1, 31)]))
    found, values, residual = whitening.top_components(lambda q: tight @ q, 60, 4, guard=2, rounds=2)
    assert residual <= 1000 * whitening.TOLERANCE and np.allclose(values, 2, rtol=1e-12)


def test_whitening_of_special_tables(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.report(spark.createDataFrame([], schema)).count() == 0
    assert whitening.report(spark.createDataFrame([(1, [0.5, 0.5])] * 3, schema)).count() == 0  # no spread
    flat = [(i, [float(i), 2.0 * i, 1.0]) for i in range(10)]  # one direction of three
    got = whitening.report(spark.createDataFrame(flat, schema)).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 10
    ragged = [(1, [1.0]), (2, [0.0, 2.0]), (2, [3.0, 1.0]), (None, [])]
    full = [(0, [1.0, 0.0]), (1, [0.0, 2.0]), (2, [3.0, 1.0]), (3, [0.0, 0.0])]
    a, b = (sorted((r["component"], r["deviation"], round(abs(r["whitened"]), 9)) for r in whitening.report(spark.createDataFrame(x, schema)).collect()) for x in (ragged, full))
    assert a == b
    large = [(i, [float(i % 7) * 1e9, float(i)]) for i in range(60)]
    assert {r["deviation"] for r in whitening.report(spark.createDataFrame(large, schema)).collect()} == {None}


# --- toxicity ----------------------------------------------------------------------------------------------------------------


def toxic_rows(n=900, seed=5):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        own = words(rng, rng.randint(20, 150))
        toxic = i % 6 == 0
        for _ in range(rng.randint(2, 5) if toxic else 0):
            own.insert(rng.randrange(len(own)), rng.choice(["vilewort", "Rotter", "grubscum" + rng.choice("abc") * 3]))
        rows.append((i, " ".join(own), "aa", "s", None))
        if i % 10 < 7:
            labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_toxicity(spark):
    rows, labels = toxic_rows()
    extra = [(5000, None, "aa", "s", None), (5001, "", None, None, None), (None, rows[0][1], None, None, None), (5002, "vilewort " * 30000, "aa", "s", 1), rows[1], rows[1]]
    docs = with_extra(frame(spark, rows + extra))
    marks = spark.createDataFrame([*labels, (labels[0][0], 0), (labels[1][0], None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows + extra)
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    by = {r["doc_id"]: r for r in got}
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 900]
    right = sum(r["predicted"] == (r["doc_id"] % 6 == 0) for r in held)
    assert len(held) > 200 and right / len(held) > 0.97
    assert by[5000]["score"] == by[5001]["score"] < 0.5 and by[5002]["predicted"] == 1
    found = toxicity.passages(docs, model).where("doc_id = 6").collect()
    text = rows[6][1].lower()
    assert found and all(text[r["start"] : r["end"]] == r["passage"] and r["value"] > 0 for r in found)
    assert {w for r in found for w in r["passage"].split()} & {"vilewort", "rotter", "grubscumaaa", "grubscumbbb", "grubscumccc"}


def test_word_counts_and_log_odds_against_plain_python(spark):
    rows, labels = toxic_rows(120)
    known = dict(labels)
    table = spark.createDataFrame([(rows[i][1], t) for i, t in labels], "text string, toxic int")
    counts = toxicity.count_words(table)
    import pyarrow as pa

    share = sum(known.values()) / len(known)
    assert counts.share == pytest.approx(share)
    texts = {i: set(rows[i][1].lower().split()) for i in known}
    for word in ["vilewort", "rotter", "grubscumaaa", sorted(texts[labels[3][0]])[0], "unseenword"]:
        odds = share
        for n in (*toxicity.PREFIXES, None):
            hits = [known[i] for i in texts if any(w[:n] == word[:n] for w in texts[i])]
            one, none = sum(hits) + toxicity.PRIOR * odds, len(hits) - sum(hits) + toxicity.PRIOR * (1 - odds)
            odds = one / (one + none)
        want = math.log(one / none) - math.log(share / (1 - share)) - toxicity.DEVIATIONS * math.sqrt(1 / (one + 1) + 1 / (none + 1))
        assert float(counts.log_odds(toxicity.Tokens(pa.array([word])))[0]) == pytest.approx(want, abs=1e-4)


def plain_segments(scores):
    """Maximal-scoring segments by their recursive definition: the best one, then those left and right of it."""

    def best(lo, hi):
        top = None
        for a in range(lo, hi):
            total = 0
            for b in range(a, hi):
                total += scores[b]
                if total > 0 and (top is None or total > top[2]):
                    top = (a, b, total)
        return top

    def split(lo, hi):
        top = best(lo, hi) if lo < hi else None
        return [] if top is None else [*split(lo, top[0]), top, *split(top[1] + 1, hi)]

    return split(0, len(scores))


def test_maximal_segments_against_their_definition():
    rng = random.Random(7)
    for _ in range(300):
        scores = [rng.choice([-3.25, -1.5, -0.5, 1.125, 2.75, 4.0625]) + rng.randint(0, 999) / 4096 for _ in range(rng.randint(0, 25))]
        got = toxicity.segments(np.array(scores), np.arange(len(scores), dtype=np.uint64))
        assert [(a, b, pytest.approx(s)) for a, b, s in plain_segments(scores)] == got
    long = np.where(np.arange(200_000) % 2, 1.0, -0.9)
    assert len(toxicity.segments(long, np.arange(200_000, dtype=np.uint64))) >= 1  # one scan, whatever the text's length


def test_calibration_parts():
    scores = np.zeros(toxicity.SCORE_BINS)
    scores[toxicity.SCORE_BINS // 2 - 128] = 9e6  # -1
    scores[toxicity.SCORE_BINS // 2 + 128] = 1e6  # +1
    assert toxicity.decay_of(scores) == pytest.approx(math.log(9), abs=1e-2)  # 0.9 exp(-x) + 0.1 exp(x) = 1, smoothed by one word
    assert toxicity.tail(0.0, 0.0, 1.0) == pytest.approx(-math.log(1 - math.exp(-1)))
    assert toxicity.tail(40.0, 0.0, 1.0) == 40.0
    x = np.array([0.0, 5.0, 10.0])
    slope, shift = toxicity.fit_curve(x, np.array([[900.0, 50, 1], [10, 50, 90]]))
    p = 1 / (1 + np.exp(-(slope * x + shift)))
    assert p[0] < 0.05 and 0.2 < p[1] < 0.8 and p[2] > 0.9


def test_toxicity_without_labels(spark):
    docs = frame(spark)
    marks = "doc_id long, toxic int"
    none = toxicity.assess(docs, spark.createDataFrame([], marks)).collect()
    assert {r["score"] for r in none} == {0.5} and {r["predicted"] for r in none} == {0}
    assert toxicity.assess(docs, spark.createDataFrame([(2, 1), (4, 1)], marks)).count() == len(documents())
    assert toxicity.assess(frame(spark, []), spark.createDataFrame([], marks)).count() == 0
    assert toxicity.passages(docs, toxicity.Model(None, 0.5)).where(F.col("value") > 0).count() == 0
