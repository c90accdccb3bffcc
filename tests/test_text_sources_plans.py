"""Text functions, readers and writers, the command line, and invariants of the plans."""

import json

import pytest
from pyspark.sql import functions as F

from sparkledger import cli
from sparkledger.functions import text, units
from sparkledger.operators import aggregate, evidence, graphs, joins, migrate
from sparkledger.operators.paths import leaves, with_value, without
from sparkledger.plans.store import stored
from sparkledger.sources import readers, writers

from .test_rules_and_contract import GOOD, SAMPLE


def one(spark, column, value="x", kind="string"):
    return spark.createDataFrame([(value,)], f"t {kind}").select(column.alias("r")).first()["r"]


def test_normalisers(spark):
    t = "Straße  ﬁne­ly trans-\n lated “A–B”"
    assert one(spark, text.normalized_exact("t"), t) == 'strasse finely translated "a-b"'
    plain = "Straße and  Grün-\nkohl\tB"
    assert one(spark, text.normalized(F.col("t")), plain) == one(spark, text.normalized_exact("t"), plain) == "strasse and grünkohl b"
    mapped = one(spark, text.normalized_with_map("t"), "A  ﬁß")
    assert mapped["text"] == "a fiss" and list(mapped["places"]) == [0, 1, 3, 3, 4, 4]


def test_spans_numbers_and_locators(spark):
    span = one(spark, text.first_span(F.col("t"), F.lit("WORLD")), "hello 😀 World")
    assert (span["start"], span["end"]) == (8, 13)
    for needle, t, want in (("PH", "qPH7.1 and ph", (11, 13)), ("heat stress", "İ heat \n Stress", (2, 15)), ("a+b", "xa+b a+b", (5, 8)), ("(x)", "f(x)y", (1, 4)), ("é1", "café1 É1", (3, 5)), ("ph", "a_PH", (2, 4)), ("PH", "qPH7", None), (" ", "a b", None)):
        span = one(spark, text.first_span(F.col("t"), F.lit(needle)), t)
        assert (span and (span["start"], span["end"])) == want, (needle, t)
    assert one(spark, text.span_matches(F.col("t"), F.lit(0), F.lit(5), F.lit("HELLO")), "hello x")
    assert not one(spark, text.span_matches(F.col("t"), F.lit(0), F.lit(6), F.lit("hello")), "hello x")
    for t, found in (("it is 4.0 here", True), ("it is 14", False), ("4.5", False), ("end 4.", True)):
        assert one(spark, text.number_printed(F.col("t"), F.lit(4.0)), t) is found
    made = text.locator(page=F.lit(2), section=F.col("t"))
    assert one(spark, made, "a=b;c%") == "page=2;section=a%3Db%3Bc%25"
    assert one(spark, text.locator_parts(made), "a=b;c%") == {"page": "2", "section": "a=b;c%"}


@pytest.mark.parametrize(("raw", "lo", "hi"), [("1,200.5", 1200.5, 1200.5), ("3 - 5", 3.0, 5.0), ("-2", -2.0, -2.0), ("about 3", None, None), ("5 to 3", None, None), ("+5", 5.0, 5.0), ("−5", -5.0, -5.0), ("3—5", 3.0, 5.0), ("１２～１３", 12.0, 13.0), ("1e400", None, None), ("-5–-3", -5.0, -3.0), ("1,000-2,000", None, None), (None, None, None), ("0.00000000001", 1e-11, 1e-11), ("1,234,567,890,123,456", 1234567890123456.0, 1234567890123456.0), ("1,2,3", None, None)])
def test_raw_values(spark, raw, lo, hi):
    found = one(spark, units.raw_value(F.col("t")), raw)
    assert (found and (found["lo"], found["hi"])) == ((lo, hi) if lo is not None else None)


def test_raw_values_with_exponents(spark):
    for raw, want in (("1.5e-8", (1.5e-8, 1.5e-8)), ("1e400", None), ("1e2 to 2e2", (100.0, 200.0))):
        found = one(spark, units.raw_value(F.col("t"), exponents=True), raw)
        assert (found and (found["lo"], found["hi"])) == want


def test_values_with_and_without_units(spark):
    known = spark.createDataFrame([("kg", "g", 1000.0, 0.0)], "alias string, canonical string, factor double, shift double")
    rows = spark.createDataFrame([(1, "2", "kg"), (2, "2 - 3", None), (3, "2", " "), (4, "2", "lb"), (5, None, "kg"), (6, "3 to 2", "kg")], "k int, v string, u string")
    got = units.normalized_values(rows, known, F.col("v"), F.col("u")).orderBy("k").collect()
    assert [(r["lo"], r["hi"], r["canonical"], r["reason"]) for r in got] == [
        (2000.0, 2000.0, "g", None), (2.0, 3.0, None, None), (2.0, 2.0, None, None), (None, None, None, "unknown_unit"), (None, None, "g", "no_raw_value"), (None, None, "g", "unparsed_value"),
    ]


def test_number_spans(spark):
    cases = [
        ("23.50 g", 23.5, (0, 5)), ("123.5", 23.5, None), ("23.51", 23.5, None), ("8.6 then 8", 8.0, (9, 10)), ("1,536", 536.0, None), ("1,536", 1.0, None), ("is 4.00.", 4.0, (3, 7)), ("é 4, 5", 4.0, (2, 3)), ("4,5", 4.0, None), ("0.0", 0.0, (0, 3)),
        ("10000000", 1e7, (0, 8)), ("x", 1.0, None), (None, 1.0, None),
    ]
    for t, number, want in cases:
        span = one(spark, text.number_span(F.col("t"), F.lit(number)), t)
        assert (span and (span["start"], span["end"])) == want, (t, number)


def test_normalised_columns_are_exact_over_all_of_unicode(spark):
    signs = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    rows = [(k, "".join(signs[k : k + 1])) for k in range(len(signs)) if k < 0x3100 or k % 97 == 0 or 0xF800 <= k < 0xFFFF]
    rows = [(k, f) for k, c in rows for f in (f"A{c}-\n {c}b", f" {c}{c}")]
    rows += [(0, "ﬁne ς Ⅳ"), (0, "e\u0301-\n a"), (0, "x-\ny-\nz"), (0, None), (0, "")]
    frame = spark.createDataFrame(rows, "k int, t string").repartition(8)
    wrong = frame.select("t", text.normalized(F.col("t")).alias("a"), text.normalized_exact("t").alias("b")).where(~F.col("a").eqNullSafe(F.col("b")))
    assert wrong.limit(5).collect() == []
    assert one(spark, text.normalized(F.col("t")), "ﬁne ς Ⅳ") == "fine σ iv"


def test_instants(spark):
    assert one(spark, units.instant_utc(F.col("t")), "2024-01-01T01:00:00+02:00") == "2023-12-31T23:00:00Z"
    assert one(spark, units.instant_utc(F.col("t")), "2024-01-01T01:00:00") is None


def test_quotes_of_every_length(spark):
    texts = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta"), (2, "beta"), (3, None), (4, "")], "d int, text string")
    quotes = spark.createDataFrame([(1, "lpha beta gamma delta epsilon ze"), (2, "beta"), (3, "et"), (4, None), (5, "gamma delta")], "q int, quote string")
    found = evidence.located_quotes(texts, quotes, text_id="d", text="text", quote_id="q", quote="quote").select("d", "q", "start").collect()
    assert {tuple(r) for r in found} == {(1, 1, 1), (1, 2, 6), (2, 2, 0), (1, 5, 11)}


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('﻿{"a": 1}\n\nnot json\n[1]\n{"a": NaN}\n{"a": null}\n')
    good, notes = readers.tolerant_record_lines(spark, str(tmp_path / "a.jsonl"))
    assert good.count() == 2 and {r["note"] for r in notes.collect()} == {"not JSON", "not an object"}
    states = [r[0] for r in good.orderBy("_ord").select(readers.presence(F.try_variant_get("record", "$.a", "VARIANT"))).collect()]
    assert states == ["present", "null"]
    for name, body, n in (("x.json", '[{"a": 1}, {"a": 2}]', 2), ("y.json", '{"a": 1}', 1), ("z.json", '{"a": 1}\n{"a": 2}\n{"a": 3}', 3)):
        (tmp_path / name).write_text(body)
        assert readers.documents(spark, str(tmp_path / name)).count() == n
    (tmp_path / "p.txt").write_text("one\ftwo\fthree")
    assert [r["page"] for r in readers.text_pages(spark, str(tmp_path / "p.txt")).orderBy("page").collect()] == [1, 2, 3]
    (tmp_path / "t.csv").write_text("k,v\na,1\nb,2\n")
    assert readers.csv_table(spark, str(tmp_path / "t.csv"), ["k", "v"], unique="k").count() == 2
    with pytest.raises(ValueError):
        readers.csv_table(spark, str(tmp_path / "t.csv"), ["k"])
    rows = spark.createDataFrame([(1, [1, 2], 0.5)], "a int, b array<int>, c double")
    writers.write_records(rows, str(tmp_path / "out"))
    assert json.loads(spark.read.text(str(tmp_path / "out")).first()[0]) == {"a": 1, "b": [1, 2], "c": 0.5}
    with pytest.raises(Exception, match="not finite"):
        writers.write_records(rows.withColumn("c", F.lit(float("nan"))), str(tmp_path / "bad"))
    assert writers.cells(rows).first()["b"] == "[1,2]"
    assert one(spark, writers.canonical_json("t"), '{"b": 1e-7, "a": [1, "ß"]}') == '{"a":[1,"ß"],"b":1e-07}'
    made = writers.write_views({"v": rows}, str(tmp_path / "views")).first()
    assert made["rows"] == 1
    assert readers.load_extractor("rules")(spark.createDataFrame([("d", 1, "We found x. No. See 10.1234/ab.")], "doc string, page int, text string")).count() == 2


def test_command_line(spark, tmp_path, capsys):
    releases = str(tmp_path / "releases")
    assert cli.main(["check", str(SAMPLE)]) == 0 and cli.main(["release", str(SAMPLE), releases]) == 0 and cli.main(["resolve", releases]) == 0
    assert cli.main(["release", str(SAMPLE), releases]) == 2
    assert cli.main(["diff", releases, "1.0.0", "1.0.0"]) == 0
    good, bad = tmp_path / "good.jsonl", tmp_path / "bad.jsonl"
    good.write_text(json.dumps(GOOD) + "\n")
    bad.write_text(json.dumps(GOOD) + "\nno\n")
    assert cli.main(["validate", str(good), "--releases", releases]) == 0
    assert cli.main(["validate", str(bad), "--contract", str(SAMPLE)]) == 1
    assert cli.main(["derive", str(good), "--contract", str(SAMPLE), "--out", str(tmp_path / "views")]) == 0
    assert '"nodes": 2' in capsys.readouterr().out


def test_layers_with_a_cycle(spark):
    nodes = spark.createDataFrame([(x,) for x in "abcdef"], "node string")
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("d", "e"), ("e", "d"), ("f", "e"), ("c", "zz")], "s string, o string")
    got = {r["node"]: (r["layer"], r["cyclic"]) for r in graphs.topological_layers(nodes, edges, lambda df: stored(df, "layers")).collect()}
    assert got == {"a": (0, False), "b": (1, False), "c": (2, False), "d": (None, True), "e": (None, True), "f": (None, True)}


def test_chains_do_not_repeat_a_record(spark):
    edges = spark.createDataFrame([("a", "b", "evidence"), ("b", "a", "method"), ("b", "c", "method")], "s string, o string, kind string")
    assert {tuple(r["path"]) for r in graphs.chains(edges).where("start = 'a'").collect()} == {("a", "b"), ("a", "b", "c")}


def test_relations_conflict_between_clusters_only(spark):
    rows = [("s", "p", "o", "increase", 1), ("s", "q", "o", "decrease", 2), ("s2", "p", "o", "increase", 1), ("s2", "p", "o", "decrease", 2), ("s3", "p", "o", None, 1)]
    frame = spark.createDataFrame([(*r, True, "complete", None) for r in rows], "subject string, predicate string, object string, direction string, paper int, complete boolean, package string, inverse string")
    got = {(r["subject"], r["predicate"]): (r["conflict"], r["confidence"]) for r in aggregate.relations(frame.repartition(7)).collect()}
    assert got == {("s", "p"): (True, "C"), ("s", "q"): (True, "C"), ("s2", "p"): (False, "A"), ("s3", "p"): (False, "B")}


def test_every_leaf_is_accounted_for(spark):
    docs = spark.createDataFrame([(1, '{"a": {"b": "x", "c": [1, 2]}, "d": null, "e": ""}')], "k int, doc string")
    found = leaves(docs, ["k"], "doc")
    mapping = spark.createDataFrame([("a", "t", "mapped")], "source string, target string, status string")
    fates = {r["path"]: r["fate"] for r in migrate.accounted(migrate.mapped_leaves(found, mapping, ["k"]), ["k"]).collect()}
    assert fates == {"a.b": "conflict", "a.c.0": "conflict", "a.c.1": "conflict", "d": "empty", "e": "empty"} and found.count() == len(fates)


def test_paths(spark):
    rows = spark.createDataFrame([(("x", None),)], "g struct<a:string,b:string>")
    assert without(rows, "g.a").first()["g"] is None
    assert with_value(rows, "g.b", F.lit("y")).first()["g"]["b"] == "y"


def test_differences(spark):
    old, new = (spark.createDataFrame(x, "k string, v string") for x in ([("a", "1"), ("b", "1")], [("b", "2"), ("c", "Y")]))
    diff = joins.field_diff(old, new, "k", "v")
    assert {(r["k"], r["change"]) for r in diff.collect()} == {("a", "removed"), ("b", "changed"), ("c", "added")}
    assert joins.release_change(diff).first()["step"] == "major"


def test_longest_prefix_keeps_repeated_rows_and_null_paths(spark):
    rows = spark.createDataFrame([("a/b/c", 1), ("a/b/c", 1), ("a/x", 2), ("ab", 3), (None, 4), ("", 5)], "path string, n int")
    entries = spark.createDataFrame([("a", "one"), ("a/b", "two")], "source string, target string")
    got = sorted((r["n"], r["source"], r["target"]) for r in joins.longest_prefix(rows, "path", entries, "source").collect())
    assert got == [(1, "a/b", "two"), (1, "a/b", "two"), (2, "a", "one"), (3, None, None), (4, None, None), (5, None, None)]


def test_located_quotes_equal_containment(spark):
    texts = [(1, "one two three four five six seven"), (2, "two three four five six sevens"), (None, "a cat sat"), (4, ""), (5, None), (6, "cat cat")]
    quotes = [(1, "two three four five six seven"), (2, "cat"), (3, "at"), (None, " sat"), (5, None), (6, "one two three four five six seven eight")]
    got = evidence.located_quotes(spark.createDataFrame(texts, "i long, t string"), spark.createDataFrame(quotes, "q long, s string"), text_id="i", text="t", quote_id="q", quote="s")
    want = {(i, q, t.index(s), t.index(s) + len(s)) for i, t in texts for q, s in quotes if t and s and len(s) >= 3 and s in t}
    assert {(r["i"], r["q"], r["start"], r["end"]) for r in got.collect()} == want and got.count() == len(want)


def test_numbers_are_present_as_tokens(spark):
    present = lambda t, v: one(spark, text.value_present(F.lit(t), F.lit(v)))
    assert [present(t, "1") for t in ("21 rows", "1 row", "row 1.", "1.5", None)] == [False, True, True, False, False]
    assert present("2.50", "2.5") and present("2.5", "2.50") and present("1,536", "536") and not present("2.51", "2.5") and present("4.0", "4.00")
    assert present("Plant  Height", "plant height") and not present("x", None)


def test_located_evidence(spark):
    pages = spark.createDataFrame([("a", 1, "Alpha  beta"), ("a", 2, "gamma ﬁne-\n tuned  text"), ("a", 3, "alpha beta"), ("a", 4, "delta"), ("b", 1, "alpha beta"), ("b", 2, None)], "doc string, page int, text string")
    asked = [
        (1, "a", "alpha beta", 2), (2, "a", "alpha beta", 3), (3, "a", "alpha beta", None), (4, "a", "delta", 1), (5, "a", "delta", None), (6, "a", "finetuned TEXT", 9), (7, "a", "al", 1), (8, "b", "gamma", None), (9, "a", None, 1), (10, "c", "alpha", 1),
        (11, "a", "delta", 0),
    ]
    got = evidence.located_evidence(spark.createDataFrame(asked, "candidate int, doc string, quote string, hint int"), pages, ["doc"]).orderBy("candidate").collect()
    assert [tuple(r) for r in got] == [(1, 1, 0, 11, True), (2, 3, 0, 10, False), (3, 1, 0, 11, False), (5, 4, 0, 5, False), (6, 2, 6, 23, True), (11, 4, 0, 5, True)]


def test_repeated_text_ids_give_the_least_start(spark):
    texts = spark.createDataFrame([(1, "xx the end"), (1, "the end"), (2, "none")], "i long, t string")
    quotes = spark.createDataFrame([(1, "the end")], "q long, s string")
    got = evidence.located_quotes(texts, quotes, text_id="i", text="t", quote_id="q", quote="s").collect()
    assert [(r["i"], r["start"], r["text"]) for r in got] == [(1, 0, "the end")]


def test_first_values_of_a_stream_with_late_rows(spark, tmp_path):
    from sparkledger.streaming import incremental as S

    schema = "g string, v string, at timestamp, k string"
    batches = [
        [("a", "x", 5, "1"), ("a", "y", 6, "2"), ("b", None, 1, "3")],
        [("a", "y", 2, "4"), ("c", "z", 1, "6"), ("c", "w", 1, "5")],  # an earlier row comes late; a tie in time
        [("a", "x", 9, "7"), ("b", "q", 3, "8"), (None, "n", 1, "9"), ("d", "v", None, "1")],
    ]
    rows = []
    for k, own in enumerate(batches):
        made = spark.createDataFrame([(g, v, at, t) for g, v, at, t in own], "g string, v string, at int, k string").selectExpr("g", "v", "timestamp_seconds(at) AS at", "k")
        made.coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        rows += own
    told = []
    with S.state_tables(spark):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        found = S.first_values(stream, "g", "v", "at", "k")
        S.fold(found, lambda batch, n: told.extend((n, *r) for r in batch.collect()), f"{tmp_path}/checkpoint", "update").awaitTermination()
    last = {r[1]: r[2:] for r in sorted(told, key=lambda r: r[0])}
    want = {}
    for g in {r[0] for r in rows}:
        own = sorted(((10**9 if at is None else at, t, v) for x, v, at, t in rows if x == g and v is not None))
        want[g] = (own[0][2], len(own), sum(v != own[0][2] for _, _, v in own))
    assert last == want and len(told) > len(last)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")
