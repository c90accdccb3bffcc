"""What the pipeline asks of the driver, and what a worker remembers."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from sparkledger.llm import components, language_id, token_units
from sparkledger.llm.token_units import UnitEncoder

from .fixtures import DOC_SCHEMA


def test_star_rounds_end_without_a_confirming_one(spark, monkeypatch):
    """One node between all others is told apart in one round; the plan of a round broadcasts nothing."""
    rounds, plans, keep = [], [], components.stored

    def stored(df, name):
        rounds.append(name)
        out = keep(df, name)
        if name == "stars":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(components, "stored", stored)
    edges = spark.createDataFrame([(k, 0) for k in range(1, 9)], "u long, v long")
    got = {r["node"]: r["component"] for r in components.connected_components(edges).collect()}
    assert got == {k: 0 for k in range(9)}
    assert rounds.count("stars") == 1
    assert not any("BroadcastExchange" in p for p in plans)


def test_components_of_mixed_graphs(spark):
    rng = random.Random(5)
    pairs = [(k, k + 1) for k in range(100, 140)] + [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(80)] + [(400, 401), (401, 400), (500, 500)]
    least = {k: k for p in pairs if p[0] != p[1] for k in p}
    for _ in range(len(least)):
        for a, b in pairs:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    got = components.connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()
    assert {r["node"]: r["component"] for r in got} == least and len(got) == len(least)


def test_the_learned_sample_comes_to_the_driver_as_counts(spark, monkeypatch):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(300)) for _ in range(30)] + ["aaa " * 30_000]
    docs = spark.createDataFrame([(i, t, "xy"[i % 2], "s", len(t)) for i, t in enumerate(texts)], DOC_SCHEMA)
    sent, keep = [], type(docs).toArrow

    def to_arrow(df):
        sent.append(keep(df))
        return sent[-1]

    monkeypatch.setattr(type(docs), "toArrow", to_arrow)
    idf = np.random.default_rng(1).random(1 << language_id.BITS)
    got = language_id._sample(docs, idf, 100, {"x": 16, "y": 15}, "doc_id", "text", "lang")
    assert len(got) == len(texts)
    for text, (_, slots, values) in zip(texts, got, strict=True):
        own = language_id._row_slots(language_id._points(pa.array([text]))[0])
        s, c = np.unique(own, return_counts=True)
        assert (slots == s).all() and (values == c * idf[s] / len(own)).all()
    assert sum(t.nbytes for t in sent) < 6 * sum(len(s) for _, s, _ in got)


def test_a_worker_remembers_more_units(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = UnitEncoder(path, "byte", False)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = ["".join(f" {a}{b}{c}{d}" for c in letters for d in letters[:20]) for a in letters for b in letters]
    first = [encoder.ids(t) for t in texts]
    tok = Tokenizer.from_file(path)
    assert all(i == np.array(tok.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for i, t in zip(first[:3], texts[:3], strict=True))
    monkeypatch.setattr(encoder, "_learn", None)
    assert [encoder.ids(t) for t in texts[:10]] == first[:10]


def _counting(encoder: UnitEncoder) -> list[str]:
    """What the encoder asks its model from now on."""
    asked, model = [], encoder.model

    class Model:
        def tokenize(self, core):
            asked.append(core)
            return model.tokenize(core)

    encoder.model = Model()
    return asked


def _whole_ids(tok: Tokenizer, text: str) -> bytes:
    return np.array(tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_letters_are_learned_once_whatever_follows_them():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, tok = UnitEncoder(path, "byte", False), Tokenizer.from_file(path)
    asked = _counting(encoder)
    text = "A ciónado ciónado, ciónado### ciónado%%%. ciónado'\nciónado!\nciónado"
    assert encoder.ids(text) == _whole_ids(tok, text)
    assert len([a for a in asked if a.endswith("nado")]) == 2  # after a space and after a line feed


def test_units_that_are_met_again_outlive_a_full_memory(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, tok = UnitEncoder(path, "byte", False), Tokenizer.from_file(path)
    monkeypatch.setattr(token_units, "MEMORY_UNITS", 40)
    asked = _counting(encoder)
    for a in "abcdefghijklmnopqrstuvwxyz":
        text = "In often" + "".join(f" {a}{b}x" for b in "abcdefghij")
        assert encoder.ids(text) == _whole_ids(tok, text)
    assert asked.count("Ġoften") == 1
    assert len(encoder.units) + len(encoder.units.older) <= 40


def test_ids_of_odd_texts_are_those_of_the_whole_tokenizer(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, tok = UnitEncoder(path, "byte", False), Tokenizer.from_file(path)
    monkeypatch.setattr(token_units, "MEMORY_UNITS", 60)
    bits = ["a", "Word", "é", "İ", "ªº", "²", "9", "don't", "'s", "'", "''", "#", ",", ".", "_", "…", "日本", "\u00a0", "\u0301", "\u2003", "\t", "\r", " ", " ", " ", "  ", "\n", "\n\n", "<|endoftext|>", "\x00", "😀"]
    rng = np.random.default_rng(3)
    texts = ["", " ", "\n", "\n\n", "a ", " a", "a\n", "\na", "a\n b", "\n ", *("".join(bits[k] for k in rng.integers(0, len(bits), n)) for n in rng.integers(1, 14, 4000))]
    for text in texts:
        assert encoder.ids(text) == _whole_ids(tok, text), text
