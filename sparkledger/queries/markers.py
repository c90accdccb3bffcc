"""Phrases, predicate codes and entity markers over whole documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import markers as M
from .registry import Tables, query

_SPACED = "trim(regexp_replace({0}, '\\s+', ' ', 'g'))"
_PHRASES = f"p AS (SELECT item_id, lower(array_to_string(list_slice(string_split({_SPACED.format('text')}, ' '), 1, 2), ' ')) AS phrase FROM benchmark WHERE text IS NOT NULL), d AS (SELECT doc_id, text FROM documents WHERE text IS NOT NULL)"
_FOUND = r"'(?is)^(|.*?' || CASE WHEN regexp_matches(phrase, '^[a-z0-9]') THEN '[^A-Za-z0-9]' ELSE '' END || ')(' || replace(regexp_escape(phrase), '\ ', '\s+') || ')' || CASE WHEN regexp_matches(phrase, '[a-z0-9]$') THEN '([^A-Za-z0-9]|$)' ELSE '' END"


@query("phrase_hits", f"WITH {_PHRASES} SELECT doc_id, item_id, CAST(length(regexp_extract(text, {_FOUND}, 1)) AS INTEGER) AS first_start, CAST(length(regexp_extract(text, {_FOUND}, 1)) + length(regexp_extract(text, {_FOUND}, 2)) AS INTEGER) AS first_end FROM d, p WHERE phrase <> '' AND regexp_matches(text, {_FOUND})")
def phrase_hits(t: Tables) -> DataFrame:
    """Where the first two words of each benchmark item stand first in each document."""
    words = F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " ")
    phrases = t.benchmark.where("text IS NOT NULL").select("item_id", F.array_join(F.slice(words, 1, 2), " ").alias("phrase"))
    found = M.phrase_hits(t.documents, phrases, text_id="doc_id", text="text", phrase_id="item_id", phrase="phrase")
    return found.groupBy("doc_id", "item_id").agg(F.min("start").alias("first_start"), F.min_by("end", "start").alias("first_end"))


#: Codes whose cues are words of the documents: an active verb with its participle, a passive, and a location.
VOCABULARY = [
    {"code": "stands", "cues": ["is", "was"]},
    {"code": "placed", "cues": ["on the", "in the"]},
    {"code": "joined", "cues": ["with the"]},
]
_PLAIN = "lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))"
_WORD = r"'(^|[^a-z0-9]){0}($|[^a-z0-9])'"
_OWN = lambda cue: f"regexp_matches(regexp_replace(m, '(^|[^a-z0-9]){cue}\\s+([a-z]+ly\\s+)?by($|[^a-z0-9])', '\\1# ', 'g'), {_WORD.format(cue)})"
_CODED = f"""WITH s AS (
  SELECT doc_id, unnest(string_split(text, '.')) AS text, generate_subscripts(string_split(text, '.'), 1) AS sentence FROM documents
), n AS (SELECT doc_id, sentence, {_PLAIN} AS m FROM s), h AS (
  SELECT *, regexp_matches(m, '(^|[^a-z0-9])(not|no|non|none|never|neither|nor|cannot|without|fails to|failed to|fail to)($|[^a-z0-9])|n''t') AS negated,
    CASE WHEN {_OWN("was")} THEN 3 WHEN {_OWN("is")} THEN 2 ELSE 0 END AS stands, CASE WHEN {_OWN("on the")} OR {_OWN("in the")} THEN 6 ELSE 0 END AS placed, CASE WHEN {_OWN("with the")} THEN 8 ELSE 0 END AS joined
  FROM n WHERE m <> ''
)
SELECT code, reason, count(*) AS n, count(DISTINCT doc_id) AS documents FROM (
  SELECT doc_id, CASE WHEN negated OR greatest(stands, placed, joined) = 0 THEN NULL WHEN joined > 0 THEN 'joined' WHEN placed > 0 THEN 'placed' ELSE 'stands' END AS code,
    CASE WHEN negated THEN 'negated' WHEN greatest(stands, placed, joined) = 0 THEN 'no_cue' END AS reason FROM h
) GROUP BY ALL"""


@query("predicate_codes", _CODED)
def predicate_codes(t: Tables) -> DataFrame:
    """Codes and reasons of every sentence of every document."""
    sentences = t.documents.select("doc_id", F.explode(F.split("text", r"\.")).alias("sentence")).where(F.trim(F.regexp_replace("sentence", r"\s+", " ")) != "")
    found = M.predicate_codes(sentences, VOCABULARY, mention="sentence")
    return found.groupBy("code", "reason").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("documents"))


_MARK = lambda w: f"CASE WHEN regexp_matches(text, '(?is)^(|.*?[^A-Za-z0-9]){w}([^A-Za-z0-9]|$)') THEN CAST(length(regexp_extract(text, '(?is)^(|.*?[^A-Za-z0-9]){w}([^A-Za-z0-9]|$)', 1)) AS INTEGER) END"
_END = lambda w: f"{_MARK(w)} + {len(w)}"
_MARKERS = " UNION ALL ".join(
    f"SELECT doc_id, '{field}' AS field, '{w}' AS mention, {kind} AS entity_type, {_MARK(w)} AS start, {_END(w)} AS \"end\", {role} AS role FROM documents WHERE {on}"
    for field, w, kind, role, on in (
        ("genes", "that", "'gene'", "'subject'", "true"),
        ("traits", "with", "'trait'", "CASE WHEN doc_id % 2 = 0 THEN 'object' END", "true"),
        ("relation", "was", "NULL", "'object'", "doc_id % 2 = 1"),
    )
)


@query("entity_markers", _MARKERS)
def entity_markers(t: Tables) -> DataFrame:
    """Markers of two mentions in each whole document; the object is the mention wrapped, or another word."""
    rows = t.documents.select(F.col("doc_id").alias("record"), "text")
    cell = lambda **values: F.struct(*[(v if hasattr(v, "alias") else F.lit(v)).alias(k) for k, v in values.items()])
    own = F.array(cell(field="genes", mention="that", entity_type="gene"), cell(field="genes", mention="That", entity_type="gene"), cell(field="traits", mention="with", entity_type="trait"))
    mentions = rows.select("record", F.posexplode(own).alias("place", "m")).select("record", "m.field", "place", "m.mention", "m.entity_type")
    two = F.array(cell(role="subject", text=F.lit("the gene that")), cell(role="object", text=F.when(F.col("record") % 2 == 0, "the trait with").otherwise("was")))
    ends = rows.select("record", F.explode(two).alias("e")).select("record", "e.role", F.lit("relation").alias("field"), "e.text")
    return M.entity_markers(mentions, rows.select("record", F.col("text").alias("quote")), ends).withColumnRenamed("record", "doc_id")
