"""The pipeline's stages, each against plain Python on its own input."""

import collections
import random
import re
import zlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from sparkledger.llm import language_id, secrets
from sparkledger.llm.shared import stored

from .fixtures import DOC_SCHEMA, documents
from .test_text_operators import FOLD, shingles


def corpus():
    """Two invented languages, copies, contaminated texts, secrets, texts without letters."""
    rng = random.Random(11)
    stems = {"aa": ["tion", "the", "ing", "ed"], "bb": ["ung", "sch", "ein", "zu"]}
    prose = lambda lang, n: ["".join(rng.choices(stems[lang], k=3)) for _ in range(n)]
    rows, quote = [], prose("aa", 30)
    for i in range(120):
        lang = rng.choice(["aa", "bb"])
        text = prose(lang, rng.randint(20, 90))
        if i % 9 == 0:
            text += quote
        if i % 10 == 0:
            text.insert(5, 'token = "abcdef0123456789abcdef0123456789"')
        rows.append((i, " ".join(text), lang, "s", None))
    rows += [(500 + i, rows[i][1], rows[i][2], "s", None) for i in range(0, 60, 2)]
    rows += [(700 + i, rows[i][1] + " " + prose("aa", 1)[0], rows[i][2], "s", None) for i in range(0, 30, 3)]
    rows += [(900, None, "aa", "s", None), (901, "12 34 ...", "aa", "s", None), (902, "", None, "s", None)]
    return [(a, b, c, d, None if b is None else len(b)) for a, b, c, d, _ in rows], " ".join(quote)


def test_stages(spark, tmp_path):
    rows, quote = corpus()
    spark.createDataFrame(rows, DOC_SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, quote), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, str(tmp_path)), name)
        seen.append(({r["doc_id"]: r for r in docs.collect()}, out))
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        docs = out
    before, out = seen[0]
    kept = {r["doc_id"] for r in out.collect()}
    assert kept == {i for i, r in before.items() if r["text"] and re.search(r"[^\W\d_]", r["text"])}

    before, out = seen[1]
    ids = sorted(before)
    sets = {i: shingles(before[i]["text"]) for i in ids}
    group = {i: i for i in ids}
    for i in ids:
        for j in ids:
            if j < i and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = {k: min(a, b) if g in (a, b) else g for k, g in group.items()}
    assert {r["doc_id"] for r in out.collect()} == {i for i in ids if group[i] == i}

    before, out = seen[2]
    grams = {tuple(quote.split()[k : k + 13]) for k in range(18)}
    clean = set()
    for i, r in before.items():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r["text"].translate(FOLD))
        hit = {k + d for k in range(len(w) - 12) if tuple(w[k : k + 13]) in grams for d in range(13)}
        if not hit or 20 * len(hit) < len(w):
            clean.add(i)
    assert {r["doc_id"] for r in out.collect()} == clean and len(clean) < len(before)

    before, out = seen[3]
    after = {r["doc_id"]: r for r in out.collect()}
    assert after.keys() == before.keys()
    for i, r in before.items():
        assert after[i]["text"] == secrets.redact(r["text"]) and after[i]["n_chars"] == len(after[i]["text"])
        assert "abcdef0123456789" not in after[i]["text"]
    assert any(after[i]["text"] != r["text"] for i, r in before.items())

    before, out = seen[4]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for i, r in before.items():
        ids = [*tok.encode(r["text"], add_special_tokens=False).ids, 2]
        want[(i, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)))] += 1
    got = out.collect()
    assert collections.Counter((r["doc_id"], r["length"], r["ids_crc32"]) for r in got if r["piece"] == 0) == want
    fill = collections.Counter()
    for r in got:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 1024 and len(fill) <= -(-sum(fill.values()) // 1024) + 1


def test_run_equals_the_stages(spark, tmp_path):
    rows, quote = corpus()
    spark.createDataFrame(rows, DOC_SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, quote)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert whole.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(whole.columns)


def test_stages_take_the_odd_documents(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows."""
    spark.createDataFrame(documents(), DOC_SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "two words")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = language_id.train(language_id.learned_rows(docs))
    assert model is None or set(model.languages) <= {"aa", "bb"}
    assert corpus_pipeline.run(spark, str(tmp_path)).where("doc_id = 5").count() == 0
