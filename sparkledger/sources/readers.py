"""Readers: records as JSON lines (strict and tolerant), JSON of any shape, pages, CSV, Parquet, files.

All read with Spark's own sources, so any path that Spark can open will do, and a place is kept (``_file``, ``_ord``)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, _file, _ord): lines with a number that grows in reading order within a file."""
    return spark.read.text(path).select(F.regexp_replace("value", "^\\ufeff", "").alias("value"), F.col("_metadata.file_path").alias("_file"), (F.col("_metadata.file_block_start").cast("long") * (1 << 20) + F.monotonically_increasing_id() % (1 << 33)).alias("_ord"))


def record_lines(spark: SparkSession, path: str) -> DataFrame:
    """(record VARIANT, raw, _file, _ord) of JSON lines; blank lines are skipped, a bad line stops the job."""
    return _lines(spark, path).where(F.trim("value") != "").select(F.parse_json("value").alias("record"), F.col("value").alias("raw"), "_file", "_ord")


def tolerant_record_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, notes): objects, and what was not an object or not JSON (non-finite constants are not JSON)."""
    rows = _lines(spark, path).where(F.trim("value") != "").withColumn("record", F.try_parse_json("value"))
    kind = F.schema_of_variant("record")
    note = F.when(F.col("record").isNull(), "not JSON").when(~kind.startswith("OBJECT"), "not an object")
    rows = rows.withColumn("note", note)
    return rows.where("note IS NULL").select("record", F.col("value").alias("raw"), "_file", "_ord"), rows.where("note IS NOT NULL").select("value", "note", "_file", "_ord")


def documents(spark: SparkSession, path: str) -> DataFrame:
    """(record VARIANT, _file, _ord): a file may be one object, an array of objects, or JSON lines."""
    whole = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^\\ufeff", "").alias("value"), F.col("_metadata.file_path").alias("_file"))
    parsed = whole.withColumn("v", F.try_parse_json("value"))
    lines = F.filter(F.split("value", "\n"), lambda x: F.trim(x) != "")
    # JSON lines: every line is a value of its own (the parser stops after the first)
    each = (F.size(lines) > 1) & F.forall(lines, lambda x: F.try_parse_json(x).isNotNull() & F.trim(x).startswith("{"))
    parts = F.when(each, F.transform(lines, lambda x: F.try_parse_json(x))).when(F.schema_of_variant("v").startswith("ARRAY"), F.expr("cast(v AS array<variant>)")).otherwise(F.array("v"))
    return parsed.select("_file", F.posexplode(parts).alias("_ord", "record"))


def typed(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Raw records as typed columns (validate the VARIANT first: a cast cannot tell null from missing)."""
    return records.select(F.from_json("raw", schema).alias("r"), *[c for c in records.columns if c.startswith("_")]).select("r.*", *[c for c in records.columns if c.startswith("_")])


def text_pages(spark: SparkSession, path: str) -> DataFrame:
    """(doc, page, text) of text files with form feeds between pages."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1).alias("doc"), F.posexplode(F.split("value", "\f")).alias("page", "text")).withColumn("page", F.col("page") + 1)


def page_lines(spark: SparkSession, path: str) -> DataFrame:
    """(doc, page, text) of ``*.pages.jsonl`` files."""
    return spark.read.schema("page long, text string").json(path).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)\.pages\.jsonl$", 1).alias("doc"), F.col("page").cast("int").alias("page"), "text")


def pdf_pages(spark: SparkSession, path: str) -> DataFrame:
    """(doc, page, text) of PDF files, if a PDF library is installed."""
    try:
        import pypdf  # noqa: F401
    except ImportError as missing:
        raise RuntimeError("reading PDF files needs pypdf; give pages as text instead") from missing

    def pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        from pypdf import PdfReader

        for batch in batches:
            for doc, content in zip(batch["doc"], batch["content"], strict=True):
                found = [p.extract_text() for p in PdfReader(io.BytesIO(content)).pages]
                yield pd.DataFrame({"doc": doc, "page": range(1, len(found) + 1), "text": found})

    return files(spark, path).select(F.col("path").alias("doc"), "content").mapInPandas(pages, "doc string, page int, text string")


def files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(path, length, content, sha256) of files below a folder."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", "content", F.sha2("content", 256).alias("sha256"))


def parts(main: DataFrame, others: DataFrame) -> DataFrame:
    """One document of several files (sha256, kind, given): main is 1, the others are labelled by kind and place; a file
    that is given twice is marked."""
    from pyspark.sql import Window

    rows = main.withColumn("kind", F.lit("main")).withColumn("given", F.lit(0)).unionByName(others)
    n = F.row_number().over(Window.partitionBy("doc", "kind").orderBy("given"))
    label = F.when(n == 1, F.col("kind")).otherwise(F.concat_ws("_", "kind", n.cast("string")))
    return rows.withColumn("label", label).withColumn("repeated", F.count(F.lit(1)).over(Window.partitionBy("doc", "sha256")) > 1)


def csv_table(spark: SparkSession, path: str, columns: list[str], *, unique: str | None = None) -> DataFrame:
    """A CSV table whose header must be the given columns; a repeated or empty key is an error."""
    rows = spark.read.option("header", "true").csv(path)
    if rows.columns != columns:
        raise ValueError(f"header is {rows.columns}, not {columns}")
    if unique and not rows.groupBy(unique).count().where(F.col("count").__gt__(1) | F.col(unique).isNull()).isEmpty():
        raise ValueError(f"{unique} is empty or repeated")
    return rows


EXTRACTORS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def extractor(name: str) -> Callable:
    """Registers a function from pages to candidates."""

    def register(fn: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        EXTRACTORS[name] = fn
        return fn

    return register


def load_extractor(name: str) -> Callable[[DataFrame], DataFrame]:
    """A registered extractor, or ``module:callable``."""
    if name in EXTRACTORS:
        return EXTRACTORS[name]
    module, _, attribute = name.partition(":")
    if not attribute:
        raise KeyError(f"no extractor {name}")
    import importlib

    return getattr(importlib.import_module(module), attribute)


@extractor("rules")
def rule_extractor(pages: DataFrame) -> DataFrame:
    """Sentences with a DOI, a year or a claim cue as candidates (doc, page, kind, quote)."""
    sentences = pages.select("doc", "page", F.explode(F.split("text", r"(?<=[.!?])\s+")).alias("quote")).where(F.length(F.trim("quote")) >= 3)
    kind = F.when(F.col("quote").rlike(r"\b10\.\d{4,9}/\S+"), "reference").when(F.lower("quote").rlike(r"\b(shows?|suggests?|indicates?|found)\b"), "claim").when(F.col("quote").rlike(r"\b(19|20)\d\d\b"), "context")
    return sentences.withColumn("kind", kind).where("kind IS NOT NULL").select("doc", "page", "kind", "quote")


def presence(column: Column) -> Column:
    """missing, null or present for a value of a VARIANT."""
    return F.when(column.isNull(), "missing").when(F.is_variant_null(column), "null").otherwise("present")
