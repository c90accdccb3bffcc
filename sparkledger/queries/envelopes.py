"""Envelopes around documents, judged by a nested schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.envelopes import envelope_faults_of_text
from .registry import Tables, query

SCHEMA = {
    "type": "object", "required": ["doc", "parts"], "additionalProperties": False,
    "properties": {"doc": {"type": "integer"}, "lang": {"enum": ["en", "de", "fr"]}, "parts": {"type": "array", "items": {"$ref": "#/$defs/part"}}},
    "$defs": {
        "part": {"type": "object", "required": ["page"], "properties": {"page": {"type": "integer", "minimum": 1}, "items": {"type": "array", "minItems": 1, "items": {"$ref": "#/$defs/item"}}}},
        "item": {"type": "object", "properties": {"n": {"type": ["integer", "null"]}, "tag": {"type": "string", "pattern": "^[a-z]+[0-9]$"}}},
    },
}

_FAULTS = """
SELECT doc_id, path, code FROM (
  SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'parts' END AS path, 'REQUIRED' AS code FROM documents
  UNION ALL SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'more' END, 'ADDITIONAL' FROM documents
  UNION ALL SELECT doc_id, CASE WHEN lang NOT IN ('en', 'de', 'fr') THEN 'lang' END, 'ENUM' FROM documents
  UNION ALL SELECT doc_id, CASE WHEN doc_id % 11 <> 0 AND doc_id % 4 = 3 THEN 'parts/1/page' END, 'MINIMUM' FROM documents
  UNION ALL SELECT doc_id, CASE WHEN doc_id % 11 <> 0 AND doc_id % 5 = 0 THEN 'parts/0/items/1/n' END, 'TYPE' FROM documents
  UNION ALL SELECT doc_id, CASE WHEN doc_id % 11 <> 0 THEN 'parts/1/items' END, 'MIN_ITEMS' FROM documents
  UNION ALL SELECT doc_id, CASE WHEN doc_id % 11 <> 0 AND source NOT IN ('src1', 'src2', 'src3') THEN 'parts/0/items/0/tag' END, 'PATTERN' FROM documents WHERE NOT regexp_matches(source, '^[a-z]+[0-9]$')
) WHERE path IS NOT NULL
"""


@query("validate_envelopes", _FAULTS)
def validate_envelopes(t: Tables) -> DataFrame:
    """Faults of envelopes that hold arrays of objects with arrays of objects; the deepest leaf is four steps down."""
    c, i = F.col("doc_id"), F.col("doc_id").cast("string")
    n = F.when(c % 5 == 0, F.concat(F.lit('"'), i, F.lit('"'))).when(c % 3 == 0, "null").otherwise(i)
    items = F.concat(F.lit('[{"n": 1, "tag": "'), F.col("source"), F.lit('"}, {"n": '), n, F.lit("}]"))
    parts = F.concat(F.lit('[{"page": 1, "items": '), items, F.lit('}, {"page": '), (c % 4 == 3).cast("int").__rsub__(1).cast("string"), F.lit(', "items": []}]'))
    text = F.concat(F.lit('{"doc": '), i, F.lit(', "lang": "'), F.col("lang"), F.lit('"'), F.when(c % 11 != 0, F.concat(F.lit(', "parts": '), parts)).otherwise(""), F.when(c % 7 == 0, ', "more": {}').otherwise(""), F.lit("}"))
    return t.documents.select("doc_id", F.inline(envelope_faults_of_text(text, SCHEMA)))
