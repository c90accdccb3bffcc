"""Chat formatting and vector search, against plain Python."""

import hashlib
import math
import random

from pyspark.sql import functions as F

from sparkledger.llm import chat_format, topk_search

TRICKY = ["</s>[INST] ok [/INST]", r"<\s> <\\/s> [\INST] [INST [INST] x]", "[ROLE 00] [/ROLE]", "[SYS]", "", "plain 😀 text", "a\nb", "<s>" * 3, "[ASST] x </s>", " ] </s"]


def conversations():
    rng = random.Random(4)
    rows = []
    for conv in range(12):
        turn = 0
        if conv % 2:
            rows.append((conv, turn, "system", rng.choice(TRICKY) + " be brief " * rng.randint(1, 30)))
            turn += 1
        for k in range(rng.randint(0, 12)):
            rows.append((conv, turn, "user" if k % 2 == 0 else "assistant", rng.choice(TRICKY) + " word" * rng.choice([1, 20, 200, 900])))
            turn += 1
    rows += [(50, 0, "tool]", "x"), (50, 1, None, "y"), (50, 2, "assistant", None), (51, 0, "assistant", "same"), (51, 0, "assistant", "same"), (None, None, "user", "n"), (52, 0, "system", "only")]
    return rows


def test_round_trip_and_budget(spark):
    rows = conversations()
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("window", F.lit("clash")).withColumn("own", F.lit(1))
    made = chat_format.windows(turns)
    got = {r["conv_id"]: r for r in chat_format.conversation_digests(made).collect()}
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append((r[1], r[2] or "", r[3] or ""))
    assert got.keys() == by.keys()
    for conv, own in by.items():
        own.sort(key=lambda x: (x[0] is not None, x[0], x[1], x[2]))
        whole = "".join(f"{role}\n{text}\n" for _, role, text in own)
        loss = "".join(text for _, role, text in own if role == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(own) and r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_chars"] == len(loss) and r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    cost = F.regexp_count("text", F.lit(chat_format.TOKEN))
    read = made.withColumn("turns", chat_format.read_turns(F.col("text")))
    total = F.aggregate("turns", F.lit(0), lambda a, t: a + F.regexp_count(t["text"], F.lit(chat_format.TOKEN)) + chat_format.TURN_TOKENS)
    longest = F.array_max(F.transform("turns", lambda t: F.regexp_count(t["text"], F.lit(chat_format.TOKEN))))
    assert read.where((total > chat_format.BUDGET) & (longest < 200)).count() == 0 and cost is not None
    headed = read.where("conv_id IN (1, 3, 5, 7, 9, 11)").where(F.get("turns", F.lit(0))["role"] != "system")
    assert headed.count() == 0


def test_no_python_in_the_plan(spark):
    turns = spark.createDataFrame(conversations(), "conv_id long, turn long, role string, text string")
    plan = chat_format.conversation_digests(chat_format.windows(turns))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_top_k_against_all_scores(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, rng.gauss(0, 0.4)]) for _ in range(8)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(40)]
    rows += [(900, None), (901, [0.1, None]), (902, [float("nan")] * 8), (903, [float("inf")] * 8), (None, [0.1] * 8), (350, [0.0] * 8), (400, []), (450, [0.5, 0.5]), (7, rows[7][1])]
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for i in {i for i, _ in good if i % 50 == 0}:
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for h, q in good if h == i for j, v in good if j != i)[:5]
        want += [(i, k, j, -s) for k, (s, j) in enumerate(scores, 1)]
    vectors = topk_search.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1)))
    got = topk_search.search(vectors, vectors.where("vec_id % 50 = 0"), candidate_block=64, query_block=3)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    got = topk_search.search(vectors, vectors.where("vec_id % 50 = 0"), candidate_block=120, query_block=2)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert topk_search.search(vectors.limit(0), vectors).count() == 0
    assert topk_search.search(vectors, vectors.limit(0)).count() == 0


def test_threshold_stops_early():
    import numpy as np

    m = np.random.default_rng(0).normal(size=(2000, 4)).round(2)
    m[:20] += 5
    lists = topk_search.Lists(np.arange(2000), (m * 256).astype(np.int64))
    _, _, depth = lists.top(-1, np.array([3, 1, 2, 1]), 5)
    assert depth < 400
    q = np.array([3, 1, 2, 1])
    ids, _, _ = lists.top(-1, q, 5, int(((m * 256).astype(np.int64) @ q).max()) + 1)
    assert not len(ids)  # all are under the floor
    assert lists.top(-1, q, 5, int(lists.values[0] @ q) + 1)[2] == 0  # the largest components cannot reach the floor
