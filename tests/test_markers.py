"""Phrases, cue forms, predicate codes and markers on record-shaped rows."""

import random
import re

from pyspark.sql import functions as F

from sparkledger.operators import markers as M


def plain_hits(text, phrase):
    words = phrase.split()
    if not words:
        return []
    pattern = r"\s+".join(map(re.escape, words))
    pattern = (r"(?<![A-Za-z0-9])" if words[0][0].isascii() and words[0][0].isalnum() else "") + pattern + (r"(?![A-Za-z0-9])" if words[-1][-1].isascii() and words[-1][-1].isalnum() else "")
    return [(m.start(), m.start() + len(m[1])) for m in re.finditer(f"(?=({pattern}))", text, re.IGNORECASE)]


def test_phrase_hits_against_patterns(spark):
    rng = random.Random(2)
    alphabet = ["a", "B", "ab", "é", "Σ", "ς", " ", "  ", "\n\t", "-", "1", "qPH7", "."]
    texts = ["".join(rng.choice(alphabet) for _ in range(60)) for _ in range(40)] + ["", "İab ab", "x" * 50_000 + " ab"]
    phrases = ["ab", "a b", "qph7", "QPH7.1", "é", "σ", "-", "a  B", "ab ab", " ", "b."]
    docs = spark.createDataFrame([*enumerate(texts), (900, None)], "id long, body string")
    asked = spark.createDataFrame([*[(f"p{k}", p) for k, p in enumerate(phrases)], ("p0", "ab"), ("same", "AB"), ("none", None)], "name string, phrase string")
    want = sorted((i, f"p{k}", *hit) for i, t in enumerate(texts) for k, p in enumerate(phrases) for hit in plain_hits(t, p))
    want = sorted(want + [(i, "same", a, b) for i, n, a, b in want if n == "p0"])
    names = {"text_id": "id", "text": "body", "phrase_id": "name", "phrase": "phrase"}
    assert sorted(map(tuple, M.phrase_hits(docs, asked, **names).collect())) == want
    # a vocabulary in several parts
    assert sorted(map(tuple, M.phrase_hits(docs, asked, **names, vocabulary_bytes=60).collect())) == want
    assert M.phrase_hits(docs, asked.limit(0), **names).count() == M.phrase_hits(docs.limit(0), asked, **names).count() == 0


def test_longest_phrases_cover_a_label(spark):
    docs = spark.createDataFrame([(1, "grain size and grain size number control")], "id long, body string")
    asked = spark.createDataFrame([("gs", "grain size"), ("gsn", "grain size number"), ("n", "number"), ("nc", "number control"), ("c", "control")], "name string, phrase string")
    got = M.phrase_hits(docs, asked, text_id="id", text="body", phrase_id="name", phrase="phrase", cover=True).orderBy("start").collect()
    assert [r["name"] for r in got] == ["gs", "gsn", "c"]


def test_cue_forms():
    assert M.cue_forms("controls") == ["controls", "controlling"] and M.cue_forms("mediates") == ["mediates", "mediating"]
    assert M.cue_forms("maps") == ["maps"] and M.cue_forms("passes over") == ["passes over"] and M.cue_forms("processes")[1] == "processing"
    assert M.cue_forms("located in") == ["located in", "located within", "mapped in"] and M.cue_forms("associated with")[1] == "related to"
    assert M.cue_forms("shows") == ["shows", "showing"] and M.cue_forms("across") == ["across"]


VOCABULARY = [
    {"code": "controls", "cues": ["controls", "调控"], "subject_types": ["gene"], "object_types": ["trait"]},
    {"code": "controlled", "cues": ["controlled by", "受"]},
    {"code": "within", "cues": ["located in"], "subject_types": ["gene", "qtl"]},
    {"code": "other", "cues": ["affects"]},
    {"code": "same", "cues": ["alters!"]},
]


def codes(spark, rows, **options):
    schema = "k int, said string, around string, s array<string>, o array<string>"
    frame = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], schema)
    got = M.predicate_codes(frame, VOCABULARY, mention="said", context="around", subject_types="s", object_types="o", **options).orderBy("k").collect()
    return [(r["code"], r["reason"]) for r in got]


def test_predicate_codes(spark):
    rows = [
        ("directly controls", None, ["gene"], ["trait"]),
        ("controlling", None, [], None),  # an untyped end passes
        ("controls", None, ["trait"], ["gene"]),  # a typed one must fit
        ("was controlled by", None, ["trait"], ["gene"]),
        ("controls", "but did not", ["gene"], ["trait"]),
        ("controls mainly by", None, ["gene"], ["trait"]),  # an agent follows: not the cue's own voice
        ("located  WITHIN", None, ["qtl"], None),
        ("mapped in", None, ["trait"], None),
        ("affects and alters!", None, None, None),  # both cues have seven characters
        ("uncontrols", None, ["gene"], None),
        ("被调控", None, ["gene"], ["trait"]),
        ("调控", None, ["gene"], ["trait"]),
        ("  ", None, None, None),
        (None, "not", None, None),
        ("fails to affect", None, None, None),
        ("不同 affects", None, None, None),
        ("controls", None, ["qtl"], ["trait"]),
    ]
    want = [
        ("controls", None), ("controls", None), (None, "no_cue"), ("controlled", None), (None, "negated"), (None, "no_cue"), ("within", None), (None, "no_cue"), (None, "ambiguous"), (None, "no_cue"), (None, "no_cue"), ("controls", None),
        (None, None), (None, None), (None, "negated"), ("other", None), (None, "no_cue"),
    ]
    assert codes(spark, rows) == want
    assert codes(spark, rows[-1:], stand_in={"controls": {"qtl": "gene"}}) == [("controls", None)]


def test_entity_markers(spark):
    quotes = {
        1: "The QTL qDTS1-2  and HTR2 raise plant\nheight.", 2: "HTR2 precursors fall; HTR2 rises.", 3: "A gene of PH and qPH7.1", 4: "no mention", 5: None,
    }
    mentions = [
        (1, "common.qtl", 0, "qDTS1-2", "qtl"), (1, "common.gene", 1, "HTR2", "gene"), (1, "common.gene", 2, "htr2", "gene"), (1, "common.trait", 3, "plant height", "trait"), (2, "common.gene", 0, "HTR2", "gene"), (3, "common.trait", 0, "PH", "trait"),
        (3, "common.gene", 1, "  ", "gene"), (4, "common.gene", 0, "X1", "gene"), (5, "common.gene", 0, "X1", "gene"), (3, "common.qtl", 2, "qPH7.1", "qtl"),
    ]
    ends = [
        (1, "subject", "relation.subject", "the QTL qDTS1-2"), (1, "object", "relation.object", "Plant Height"), (2, "subject", "relation.subject", "HTR2 precursors"), (3, "subject", "relation.subject", "PH"), (3, "object", "relation.object", "PH"),
        (4, "object", "relation.object", "a locus"), (4, "subject", "relation.subject", " "),
    ]
    got = M.entity_markers(
        spark.createDataFrame(mentions, "record int, field string, place int, mention string, entity_type string"), spark.createDataFrame(list(quotes.items()), "record int, quote string"),
        spark.createDataFrame(ends, "record int, role string, field string, text string"),
    )
    rows = {(r["record"], r["field"], r["mention"]): r for r in got.collect()}
    told = {k: (r["start"], r["end"], r["role"]) for k, r in rows.items()}
    assert told == {
        (1, "common.qtl", "qDTS1-2"): (8, 15, "subject"),  # wrapped by its type noun and a determiner
        (1, "common.gene", "HTR2"): (21, 25, None), (1, "common.trait", "plant height"): (32, 44, "object"), (2, "common.gene", "HTR2"): (0, 4, None),
        (2, "relation.subject", "HTR2 precursors"): (0, 15, "subject"),  # another thing: a marker of its own
        (3, "common.trait", "PH"): (10, 12, "subject"), (3, "common.qtl", "qPH7.1"): (17, 23, None), (3, "relation.object", "PH"): (10, 12, "object"), (4, "common.gene", "X1"): (None, None, None),
        (4, "relation.object", "a locus"): (None, None, "object"), (5, "common.gene", "X1"): (None, None, None),
    }
    assert got.where(F.col("entity_type").isNull()).count() == 3
