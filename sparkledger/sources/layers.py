"""Documents of several files: identity from the original, pages from a text layer where one is given, parts by label.

Files are rows (path, length, content, sha256), as ``readers.files`` gives them; what belongs together is told by a table of
parts (doc, path, layer, kind, given), so that the bytes of an original move only where its own pages are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Kinds of further parts, media types by ending.
PART_KINDS = ("supplement", "appendix")
_MEDIA = {".pdf": "application/pdf", ".pages.jsonl": "application/jsonl", ".txt": "text/plain"}


def part_specs(specs: DataFrame, files: DataFrame) -> DataFrame:
    """specs (doc, spec, given) with path and kind: ``FILE`` or ``FILE:appendix``.

    The ending counts only if it names a kind and the rest is a file; else the whole is the path, of kind supplement."""
    cut = F.regexp_extract("spec", r"(?s)^(.+):([^:]*)$", 2)
    kind, rest = F.lower(F.trim(cut)), F.regexp_extract("spec", r"(?s)^(.+):([^:]*)$", 1)
    asked = specs.withColumn("_kind", F.when(kind.isin(*PART_KINDS), kind)).withColumn("_rest", F.when(F.col("_kind").isNotNull(), rest))
    known = files.select(F.col("path").alias("_rest"), F.lit(True).alias("_there")).distinct()
    met = asked.join(known, "_rest", "left")
    return met.withColumn("path", F.when(F.col("_there"), F.col("_rest")).otherwise(F.col("spec"))).withColumn("kind", F.when(F.col("_there"), F.col("_kind")).otherwise("supplement")).select(*specs.columns, "path", "kind")


def labelled(parts: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parts with part, sha256, size_bytes, media_type; problems (doc, path, problem)).

    The main file is ``main``; others are called by their kind and their place among it: ``supplement``, ``supplement_2``, ….
    A kind that is none counts as supplement.  A file that is not there, or whose bytes a document has already (in given
    order, main first), is a problem and no part."""
    known = F.when(F.col("kind").isin("main", *PART_KINDS), F.col("kind")).otherwise("supplement")
    identity = files.select("path", "sha256", F.col("length").alias("size_bytes")).dropDuplicates(["path"])
    met = parts.withColumn("kind", known).join(identity, "path", "left").withColumn("media_type", _media(F.col("path")))
    order = [F.col("kind") != "main", F.col("given"), F.col("path")]
    nth = F.row_number().over(Window.partitionBy("doc", "sha256").orderBy(*order))
    judged = met.withColumn("problem", F.when(F.col("sha256").isNull(), "no_file").when(nth > 1, "given_twice"))
    fine = judged.where("problem IS NULL").drop("problem")
    n = F.row_number().over(Window.partitionBy("doc", "kind").orderBy("given", "path"))
    part = F.when(n == 1, F.col("kind")).otherwise(F.concat_ws("_", "kind", n.cast("string")))
    return fine.withColumn("part", part), judged.where("problem IS NOT NULL").select("doc", "path", "problem")


def _media(path: Column) -> Column:
    kind = F.lit("application/octet-stream")
    for ending, media in reversed(_MEDIA.items()):
        kind = F.when(F.lower(path).endswith(ending), media).otherwise(kind)
    return kind


def _texts(path: Column, content: Column) -> Column:
    """Pages of a file: between form feeds (an empty last page is none), or a line of JSON each."""
    text = F.regexp_replace(F.decode(content, "UTF-8"), "^\\ufeff", "")
    feeds = F.split(text, "\f")
    last = F.element_at(feeds, -1).rlike(r"(?U)^\s*\z")
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    told = F.transform(lines, lambda x, i: F.from_json(x, "page int, text string"))
    told = F.transform(told, lambda p, i: F.struct(F.coalesce(p["page"], i + 1).alias("page"), F.coalesce(p["text"], F.lit("")).alias("text")))
    plain = F.transform(F.when(last, F.slice(feeds, 1, F.size(feeds) - 1)).otherwise(feeds), lambda x, i: F.struct((i + 1).alias("page"), x.alias("text")))
    return F.when(path.endswith(".pages.jsonl"), told).when(path.endswith(".txt"), plain)


def layered_pages(parts: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc, part, page, text, sha256, size_bytes, media_type, text_layer, text_layer_sha256) and problems (doc, path, problem).

    parts: (doc, path, layer, kind, given).  The pages come from the layer, or from the file itself where there is none;
    identity is the original's in both cases, and the layer's digest is its version.  A file whose pages cannot be read here
    (neither ``.txt`` nor ``.pages.jsonl``), and a layer that is not there, are problems: ``no_pages``, ``no_layer``.  An empty
    file has no pages; Spark's file reader leaves such files out, so that from there they come as ``no_file``."""
    rows, problems = labelled(parts, files)
    rows = rows.withColumn("_source", F.coalesce("layer", "path"))
    readable = F.col("path").endswith(".txt") | F.col("path").endswith(".pages.jsonl")
    texts = files.where(readable).dropDuplicates(["path"]).select(F.col("path").alias("_source"), F.col("sha256").alias("_version"), _texts(F.col("path"), F.col("content")).alias("_pages"))
    met = rows.join(texts, "_source", "left")
    lost = met.where("_version IS NULL").select("doc", "path", F.when(F.col("layer").isNull(), "no_pages").otherwise("no_layer").alias("problem"))
    layered = F.col("layer").isNotNull()
    pages = met.where("_version IS NOT NULL").select("doc", "part", "sha256", "size_bytes", "media_type", F.when(layered, F.element_at(F.split("layer", "/"), -1)).alias("text_layer"), F.when(layered, F.col("_version")).alias("text_layer_sha256"), F.inline("_pages"))
    return pages, problems.unionByName(lost)
