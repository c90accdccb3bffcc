"""Documents as files with text layers and supplements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import layers
from .registry import Tables, query


def _named(*parts) -> Column:
    return F.concat(*(p if not isinstance(p, str) else F.lit(p) for p in parts))


def _documents(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Each text is a file; those of even ids are scans whose pages (their lines) come from a layer. The benchmark passage of
    the same number is an appendix, and every seventh document gives its own file again."""
    i = F.col("doc_id").cast("string")
    docs = t.documents.where("text IS NOT NULL")
    even = F.col("doc_id") % 2 == 0
    own = F.when(even, _named("in/", i, ".pdf")).otherwise(_named("in/", i, ".txt"))
    file = lambda path, text: F.struct(path.alias("path"), F.encode(text, "UTF-8").alias("content"))
    made = docs.select(F.inline(F.array_compact(F.array(file(own, F.col("text")), F.when(even, file(_named("ocr/", i, ".txt"), F.replace("text", F.lit("\n"), F.lit("\f"))))))))
    b = F.col("item_id").cast("string")
    made = made.unionByName(t.benchmark.select(_named("more/", b, ".txt").alias("path"), F.encode("text", "UTF-8").alias("content")))
    files = made.select("path", F.length("content").cast("long").alias("length"), "content", F.sha2("content", 256).alias("sha256"))
    part = lambda path, layer, kind, given: F.struct(path.alias("path"), layer.alias("layer"), F.lit(kind).alias("kind"), F.lit(given).alias("given"))
    none = F.lit(None).cast("string")
    main = docs.select("doc_id", F.inline(F.array_compact(F.array(part(own, F.when(even, _named("ocr/", i, ".txt")), "main", 0), F.when(F.col("doc_id") % 7 == 0, part(own, none, "supplement", 1))))))
    more = t.benchmark.select(F.col("item_id").alias("doc_id"), F.inline(F.array(part(_named("more/", b, ".txt"), none, "appendix", 1), part(_named("lost/", b, ".txt"), none, "supplement", 2))))
    return main.unionByName(more).withColumnRenamed("doc_id", "doc"), files


@query("text_layer_pages", """
WITH d AS (SELECT doc_id AS doc, 'main' AS part, text AS original, CASE WHEN doc_id % 2 = 0 THEN replace(text, chr(10), chr(12)) ELSE text END AS layer, doc_id % 2 = 0 AS scan FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT item_id, 'appendix', text, text, false FROM benchmark),
s AS (SELECT *, string_split(layer, chr(12)) AS p FROM d),
k AS (SELECT *, CASE WHEN regexp_matches(p[len(p)], '^\\s*$') THEN p[1:len(p) - 1] ELSE p END AS q FROM s)
SELECT doc, part, CAST(i AS INTEGER) AS page, sha256(q[i]) AS text_sha256, sha256(original) AS sha256, CAST(strlen(original) AS BIGINT) AS size_bytes, CASE WHEN scan THEN 'application/pdf' ELSE 'text/plain' END AS media_type,
  CASE WHEN scan THEN doc || '.txt' END AS text_layer, CASE WHEN scan THEN sha256(layer) END AS text_layer_sha256 FROM k, unnest(range(1, len(q) + 1)) AS u(i)
""")  # fmt: skip
def text_layer_pages(t: Tables) -> DataFrame:
    """Pages of all documents: identity of the original, text of the layer."""
    pages, _ = layers.layered_pages(*_documents(t))
    return pages.withColumn("text_sha256", F.sha2("text", 256)).drop("text")


@query("text_layer_problems", "SELECT doc_id AS doc, 'given_twice' AS problem FROM documents WHERE text IS NOT NULL AND doc_id % 7 = 0 UNION ALL SELECT item_id, 'no_file' FROM benchmark")
def text_layer_problems(t: Tables) -> DataFrame:
    return layers.layered_pages(*_documents(t))[1].select("doc", "problem")
