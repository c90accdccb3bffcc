"""Evidence, text and scan queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import identity, text, units
from ..operators import evidence as E
from ..operators import paths as P
from .registry import Tables, query


@query("evidence_locate", "SELECT doc_id, item_id, CAST(instr(d.text, b.text) - 1 AS INTEGER) AS start, CAST(instr(d.text, b.text) - 1 + length(b.text) AS INTEGER) AS \"end\", CAST(len(string_split(left(d.text, instr(d.text, b.text) - 1), chr(10))) AS INTEGER) AS line FROM documents d JOIN benchmark b ON contains(d.text, b.text) WHERE length(b.text) >= 3")
def evidence_locate(t: Tables) -> DataFrame:
    """Where every benchmark text stands verbatim in every document, with its line."""
    found = E.located_quotes(t.documents, t.benchmark, text_id="doc_id", text="text", quote_id="item_id", quote="text")
    return found.select("doc_id", "item_id", "start", "end", E.line_of(F.col("text"), F.col("start")).alias("line"))


_PAGES = "SELECT doc_id, CAST(p AS INTEGER) AS page, string_split(text, chr(10))[p] AS text FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u(p)"


@query("scan_pages", f"SELECT doc_id, page, CAST(length(text) AS INTEGER) AS chars FROM ({_PAGES})")
def scan_pages(t: Tables) -> DataFrame:
    return E.pages(t.documents, ["doc_id"], "text", "\n").select("doc_id", "page", F.length("text").alias("chars"))


@query("scan_page_gaps", f"SELECT doc_id, max(page) AS last, count(*) AS pages FROM ({_PAGES}) WHERE page <> 2 GROUP BY 1 HAVING max(page) <> count(*)")
def scan_page_gaps(t: Tables) -> DataFrame:
    return E.page_gaps(E.pages(t.documents, ["doc_id"], "text", "\n").where("page <> 2"), ["doc_id"]).select("doc_id", "last", "pages")


@query("page_annotation", """
WITH l AS (SELECT doc_id, i - 1 AS line, string_split(text, chr(10))[i] AS text FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u(i)),
s AS (SELECT *, coalesce(sum(length(text) + 1) OVER (PARTITION BY doc_id ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM l)
SELECT doc_id, CAST(line AS INTEGER) AS line, CAST(start AS BIGINT) AS start, CASE WHEN regexp_matches(trim(text, ' '), '^[|#*-]') THEN 'caption' ELSE 'heading' END AS kind FROM s
WHERE regexp_matches(trim(text, ' '), '^[|#*-]') OR (length(trim(text, ' ')) <= 60 AND regexp_matches(trim(text, ' '), '^[A-Z][a-z]+'))""")
def page_annotation(t: Tables) -> DataFrame:
    found = E.annotated_lines(E.pages(t.documents, ["doc_id"], "text"), ["doc_id"], "^[A-Z][a-z]+", "^[|#*-]")
    return found.select("doc_id", "line", "start", "kind")


@query("section_lookup", """
WITH l AS (SELECT doc_id, i AS line, string_split(text, chr(10))[i] AS text FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u(i)),
h AS (SELECT doc_id, line, text FROM l WHERE length(text) <= 60), e AS (SELECT doc_id, line FROM l WHERE length(text) > 300)
SELECT e.doc_id, CAST(e.line AS INTEGER) AS line, h.text AS section FROM e ASOF LEFT JOIN h ON e.doc_id = h.doc_id AND e.line >= h.line""")
def section_lookup(t: Tables) -> DataFrame:
    """The last short line before each long line of a document."""
    lines = E.pages(t.documents, ["doc_id"], "text", "\n").withColumnRenamed("page", "line")
    return E.with_last_before(lines.where(F.length("text") > 300).select("doc_id", "line"), lines.where(F.length("text") <= 60), ["doc_id"], "line", "text", "section")


def _candidates(t: Tables) -> DataFrame:
    found = E.located_quotes(t.documents, t.benchmark, text_id="doc_id", text="text", quote_id="item_id", quote="text")
    line = E.line_of(F.col("text"), F.col("start"))
    quote = F.get(F.split(F.get(F.split("text", "\n"), line - 1), r"\. "), F.lit(0))
    return found.select(F.concat_ws("/", "doc_id", "item_id").alias("candidate"), "doc_id", quote.alias("quote"), (line + F.col("item_id") % 4 - 1).cast("int").alias("hint"))


_HITS = """WITH f AS (SELECT doc_id, item_id, d.text, len(string_split(left(d.text, instr(d.text, b.text) - 1), chr(10))) AS line FROM documents d JOIN benchmark b ON contains(d.text, b.text)),
c AS (SELECT doc_id || '/' || item_id AS candidate, doc_id, string_split(string_split(text, chr(10))[line], '. ')[1] AS quote, CAST(line + item_id % 4 - 1 AS INTEGER) AS hint FROM f),
"""


@query("evidence_page_correction", _HITS + f"p AS ({_PAGES}), n AS (SELECT c.candidate, c.hint, p.page, row_number() OVER (PARTITION BY c.candidate ORDER BY abs(p.page - c.hint), p.page) AS k FROM c JOIN p ON p.doc_id = c.doc_id AND p.page BETWEEN c.hint - 1 AND c.hint + 1 AND contains(replace(lower(regexp_replace(p.text, '\\s+', ' ', 'g')), 'ß', 'ss'), replace(lower(trim(regexp_replace(c.quote, '\\s+', ' ', 'g'))), 'ß', 'ss'))) SELECT c.candidate, c.hint, n.page AS page_found, CASE WHEN trim(c.quote) = '' THEN 'EVIDENCE_MISSING' WHEN c.hint < 1 THEN 'EVIDENCE_PAGE_INVALID' WHEN length(c.quote) > 2000 THEN 'EVIDENCE_QUOTE_TOO_LONG' WHEN n.page IS NULL THEN 'EVIDENCE_QUOTE_NOT_FOUND' WHEN n.page <> c.hint THEN 'EVIDENCE_PAGE_CORRECTED' END AS code FROM c LEFT JOIN n ON n.candidate = c.candidate AND k = 1")
def evidence_page_correction(t: Tables) -> DataFrame:
    found = E.page_of_evidence(_candidates(t), E.pages(t.documents, ["doc_id"], "text", "\n"), ["doc_id"])
    return found.select("candidate", "hint", "page_found", "code")


_SPOT = "regexp_extract(p.text, '(?is)^(.*?)(' || replace(regexp_escape(trim(regexp_replace(c.quote, '\\s+', ' ', 'g'))), '\\ ', '\\s+') || ')', {0})"


@query("evidence_offsets", _HITS + f"p AS ({_PAGES}), h AS (SELECT candidate, doc_id, quote, CASE WHEN hint % 3 = 0 THEN NULL ELSE hint END AS hint FROM c), l AS (SELECT doc_id, max(page) AS last FROM p GROUP BY 1), n AS (SELECT c.candidate, c.hint, p.page, CAST(length({_SPOT.format(1)}) AS INTEGER) AS start, CAST(length({_SPOT.format(1)}) + length({_SPOT.format(2)}) AS INTEGER) AS \"end\", row_number() OVER (PARTITION BY c.candidate ORDER BY CASE WHEN c.hint BETWEEN 1 AND last THEN abs(p.page - c.hint) ELSE 0 END, p.page) AS k FROM h c JOIN l ON l.doc_id = c.doc_id JOIN p ON p.doc_id = c.doc_id AND (c.hint IS NULL OR c.hint NOT BETWEEN 1 AND last OR p.page BETWEEN c.hint - 1 AND c.hint + 1) WHERE length(trim(c.quote)) >= 3 AND {_SPOT.format(2)} <> '') SELECT candidate, page, start, \"end\", coalesce(hint <> page, false) AS corrected FROM n WHERE k = 1")
def evidence_offsets(t: Tables) -> DataFrame:
    """Page and place of each quote; every third hint is taken away, so that all pages of the document are searched."""
    asked = _candidates(t).withColumn("hint", F.when(F.col("hint") % 3 != 0, F.col("hint")))
    return E.located_evidence(asked, E.pages(t.documents, ["doc_id"], "text", "\n"), ["doc_id"])


@query("evidence_value_presence", _HITS + f"p AS ({_PAGES}), v AS (SELECT candidate, doc_id, hint, string_split(quote, ' ')[1] AS value FROM c) SELECT v.candidate, v.value, coalesce(bool_or(contains(replace(lower(p.text), 'ß', 'ss'), replace(lower(v.value), 'ß', 'ss'))), false) AS present FROM v LEFT JOIN p ON p.doc_id = v.doc_id AND p.page BETWEEN v.hint - 1 AND v.hint + 1 GROUP BY 1, 2")
def evidence_value_presence(t: Tables) -> DataFrame:
    values = _candidates(t).select(F.col("candidate").alias("value_id"), "doc_id", F.col("hint").alias("page"), F.get(F.split("quote", " "), F.lit(0)).alias("value"))
    found = E.values_near(values, E.pages(t.documents, ["doc_id"], "text", "\n"), ["doc_id"])
    return found.select(F.col("value_id").alias("candidate"), "value", "present")


@query("text_normalized", "SELECT doc_id, sha256(replace(lower(trim(regexp_replace(nfc_normalize(text), '\\s+', ' ', 'g'))), 'ß', 'ss')) AS digest FROM documents")
def text_normalized(t: Tables) -> DataFrame:
    """The exact Unicode kernel."""
    return t.documents.select("doc_id", F.sha2(text.normalized_exact("text"), 256).alias("digest"))


@query("text_normalized_columns", "SELECT item_id, sha256(replace(lower(trim(regexp_replace(nfc_normalize(text), '\\s+', ' ', 'g'))), 'ß', 'ss')) AS digest FROM benchmark")
def text_normalized_columns(t: Tables) -> DataFrame:
    return t.benchmark.select("item_id", F.sha2(text.normalized(F.col("text")), 256).alias("digest"))


@query("text_normalized_map", "SELECT item_id, replace(lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))), 'ß', 'ss') AS text, CAST(len(replace(lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))), 'ß', 'ss')) AS INTEGER) AS places FROM benchmark")
def text_normalized_map(t: Tables) -> DataFrame:
    return t.benchmark.select("item_id", text.normalized_with_map("text").alias("m")).select("item_id", "m.text", F.size("m.places").alias("places"))


_THE = "'(?is)^(|.*?[^A-Za-z0-9])the([^A-Za-z0-9]|$)'"


@query("text_spans", f"SELECT doc_id, CAST(length(regexp_extract(text, {_THE}, 1)) AS INTEGER) AS start, CAST(length(regexp_extract(text, {_THE}, 1)) + 3 AS INTEGER) AS \"end\" FROM documents WHERE regexp_matches(text, {_THE})")
def text_spans(t: Tables) -> DataFrame:
    """The first "the" that is a word of its own."""
    return t.documents.select("doc_id", text.first_span(F.col("text"), F.lit("THE")).alias("s")).where("s IS NOT NULL").select("doc_id", "s.start", "s.end")


@query("text_negation", "SELECT doc_id FROM documents WHERE regexp_matches(lower(text), '(^|\\W)(not|no|kein|pas)($|\\W)')")
def text_negation(t: Tables) -> DataFrame:
    return t.documents.where(text.negated(F.col("text"), ["not", "no", "kein", "pas"])).select("doc_id")


@query("text_numbers", "SELECT doc_id, regexp_matches(text, '(^|[^0-9.,]|(^|[^0-9]),)4(\\.0+)?($|[^0-9.,]|[.,]($|[^0-9]))') AS printed FROM documents")
def text_numbers(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.number_printed(F.col("text"), F.lit(4.0)).alias("printed"))


@query("text_ranges", "SELECT p_partkey, CAST(list_sum(range(p_size, p_size + p_size % 5 + 1)) AS BIGINT) AS total, CAST(p_size % 5 + 1 AS INTEGER) AS n FROM part")
def text_ranges(t: Tables) -> DataFrame:
    """Cited items such as "3-6" as numbers."""
    listed = text.number_range(F.concat(F.col("p_size").cast("string"), F.when(F.col("p_size") % 5 > 0, F.concat(F.lit("-"), (F.col("p_size") + F.col("p_size") % 5).cast("string"))).otherwise("")))
    return t.part.select("p_partkey", F.aggregate(listed, F.lit(0), lambda a, x: a + x).cast("long").alias("total"), F.size(listed).alias("n"))


@query("locators", "SELECT page_id, 'page=' || page_id || ';section=' || replace(replace(replace(url, '%', '%25'), ';', '%3B'), '=', '%3D') AS locator, url AS section FROM pages")
def locators(t: Tables) -> DataFrame:
    made = t.pages.select("page_id", text.locator(page=F.col("page_id"), section=F.col("url"), row=F.lit(None).cast("string")).alias("locator"))
    return made.withColumn("section", F.try_element_at(text.locator_parts(F.col("locator")), F.lit("section")))


@query("record_ids", "SELECT doc_id, 'rec_' || left(sha256(coalesce(source, 'None') || chr(31) || CAST(doc_id AS VARCHAR) || chr(31) || 'None'), 32) AS record_id FROM documents")
def record_ids(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", identity.record_id(F.col("source"), F.col("doc_id"), F.lit(None)).alias("record_id"))


@query("units", """SELECT p_partkey, CASE WHEN u.f IS NULL THEN NULL ELSE round(p_size * u.f + u.s, 10) END AS lo, CASE WHEN u.f IS NULL THEN NULL ELSE round((p_size + p_partkey % 2) * u.f + u.s, 10) END AS hi, u.c AS canonical, CASE WHEN u.f IS NULL THEN 'unknown_unit' END AS reason
FROM part LEFT JOIN (VALUES ('kb', 'bp', 1000.0::DOUBLE, 0.0::DOUBLE), ('degf', 'degC', 0.5::DOUBLE, -16.0::DOUBLE)) AS u(a, c, f, s) ON u.a = CASE p_partkey % 3 WHEN 0 THEN 'kb' WHEN 1 THEN 'degf' ELSE 'ell' END""")
def units_query(t: Tables) -> DataFrame:
    known = t.spark.createDataFrame([("KB", "bp", 1000.0, 0.0), ("degF", "degC", 0.5, -16.0)], "alias string, canonical string, factor double, shift double")
    size = F.col("p_size")
    value = F.when(F.col("p_partkey") % 2 == 0, size.cast("string")).otherwise(F.concat_ws(" - ", size, size + 1))
    rows = t.part.select("p_partkey", value.alias("raw"), F.when(F.col("p_partkey") % 3 == 0, "kb ").when(F.col("p_partkey") % 3 == 1, "DegF").otherwise("ell").alias("unit"))
    return units.normalized_values(rows, known, F.col("raw"), F.col("unit")).select("p_partkey", "lo", "hi", "canonical", "reason")


@query("instants", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%SZ') END AS instant FROM orders")
def instants(t: Tables) -> DataFrame:
    """ISO instants in UTC; those without an offset are refused."""
    iso = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("o_orderkey") % 2 == 0, "+02:00").otherwise(""))
    return t.orders.select("o_orderkey", units.instant_utc(iso).alias("instant"))


@query("unpivot_fields", "SELECT o_orderkey, CAST(ordinal AS INTEGER) AS ordinal, path, value FROM (SELECT o_orderkey, unnest([{'ordinal': 0, 'path': 'o_orderstatus', 'value': o_orderstatus}, {'ordinal': 1, 'path': 'o_orderpriority', 'value': CASE WHEN o_custkey % 2 = 0 THEN o_orderpriority END}, {'ordinal': 2, 'path': 'o_custkey', 'value': CAST(o_custkey AS VARCHAR)}], recursive := true) FROM orders) WHERE value IS NOT NULL")
def unpivot_fields(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("o_orderpriority", F.when(F.col("o_custkey") % 2 == 0, F.col("o_orderpriority")))
    return P.unpivot(rows, ["o_orderkey"], ["o_orderstatus", "o_orderpriority", "o_custkey"])


@query("walk_leaves", "SELECT event_id, 'k' AS path, json_extract_string(props, '$.k') AS value FROM events")
def walk_leaves(t: Tables) -> DataFrame:
    return P.leaves(t.events, ["event_id"], "props")


@query("strings_of_records", "SELECT p_partkey, CAST(3 + CASE WHEN p_size > 20 THEN 1 ELSE 0 END AS INTEGER) AS n FROM part")
def strings_of_records(t: Tables) -> DataFrame:
    """Every string inside nested values."""
    nested = F.struct(F.col("p_name").alias("name"), F.array(F.col("p_brand"), F.when(F.col("p_size") > 20, F.col("p_type"))).alias("tags"), F.create_map(F.lit("k"), F.col("p_type")).alias("m"))
    rows = t.part.select("p_partkey", nested.alias("g"))
    return rows.select("p_partkey", F.size(P.strings(F.col("g"), rows.schema["g"].dataType)).alias("n"))


@query("part_labels", "SELECT page_id, host, CASE WHEN n = 1 THEN 'supplement' ELSE 'supplement_' || n END AS label FROM (SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, row_number() OVER (PARTITION BY regexp_extract(url, '^https?://([^/]+)', 1) ORDER BY page_id) AS n FROM pages)")
def part_labels(t: Tables) -> DataFrame:
    """Labels of the parts of one document (pages of one host)."""
    rows = t.pages.select("page_id", F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("host"))
    n = F.row_number().over(Window.partitionBy("host").orderBy("page_id"))
    return rows.select("page_id", "host", F.when(n == 1, "supplement").otherwise(F.concat(F.lit("supplement_"), n.cast("string"))).alias("label"))


@query("source_completeness", """
SELECT source, count(*) AS documents, count(*) FILTER (regexp_matches(text, '(?i)licen[sc]ed under')) AS licensed, count(*) FILTER (regexp_matches(text, '[0-9]')) AS numbered,
CASE WHEN count(*) FILTER (regexp_matches(text, '(?i)licen[sc]ed under')) = 0 THEN 'not_submitted' WHEN count(*) FILTER (regexp_matches(text, '[0-9]')) = count(*) THEN 'complete' ELSE 'partial' END AS status FROM documents GROUP BY 1""")
def source_completeness(t: Tables) -> DataFrame:
    licensed, numbered, n = F.count_if(F.col("text").rlike("(?i)licen[sc]ed under")), F.count_if(F.col("text").rlike("[0-9]")), F.count(F.lit(1))
    status = F.when(licensed == 0, "not_submitted").when(numbered == n, "complete").otherwise("partial")
    return t.documents.groupBy("source").agg(n.alias("documents"), licensed.alias("licensed"), numbered.alias("numbered"), status.alias("status"))


@query("span_segments", """
WITH s AS (SELECT doc_id, greatest(instr(lower(text), 'the') - 1, 0) AS a, least(instr(lower(text), 'the') + 7, length(text)) AS b, 5 AS c, least(12, length(text)) AS d, length(text) AS n FROM documents WHERE length(text) >= 20),
cuts AS (SELECT doc_id, list_sort(list_distinct([0, n, a, b, c, d])) AS l, a, b, c, d FROM s)
SELECT doc_id, CAST(l[i] AS INTEGER) AS start, CAST(l[i + 1] AS INTEGER) AS "end", CASE WHEN a <= l[i] AND l[i + 1] <= b THEN 'first' WHEN c <= l[i] AND l[i + 1] <= d THEN 'second' END AS span FROM cuts, unnest(range(1, len(l))) AS u(i)""")
def span_segments(t: Tables) -> DataFrame:
    """A text cut at all ends of its spans; the first covering span names a piece."""
    at = F.instr(F.lower("text"), F.lit("the"))
    n = F.length("text")
    spans = F.array(F.struct(F.greatest(at - 1, F.lit(0)).alias("a"), F.least(at + 7, n).alias("b"), F.lit("first").alias("name")), F.struct(F.lit(5).alias("a"), F.least(F.lit(12), n).alias("b"), F.lit("second").alias("name")))
    rows = t.documents.where(n >= 20).select("doc_id", spans.alias("spans"), n.alias("n"))
    cuts = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0), F.col("n")), F.transform("spans", lambda s: s["a"]), F.transform("spans", lambda s: s["b"]))))
    pieces = F.transform(F.sequence(F.lit(0), F.size("cuts") - 2), lambda i: F.struct(F.get("cuts", i).alias("start"), F.get("cuts", i + 1).alias("end")))
    named = rows.withColumn("cuts", cuts).select("doc_id", "spans", F.inline(pieces))
    cover = F.get(F.filter("spans", lambda s: (s["a"] <= F.col("start")) & (F.col("end") <= s["b"])), F.lit(0))["name"]
    return named.select("doc_id", "start", "end", cover.alias("span"))
