"""Spreadsheet files as rows of cells, and tables found in them by their header.

Files come as bytes through Spark's own reader, so they may lie in any store that Spark reads; sheet XML is parsed as a stream
with the standard library, cell by cell.  A file is one row of one task (files over 2 GB are refused by the reader).
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BATCH = 5_000
_CELLS = "path string, sheet string, sheet_no int, row int, col int, value string"


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def column_number(letters: str) -> int:
    n = 0
    for c in letters:
        n = n * 26 + ord(c) - 64
    return n


def _texts(node: ElementTree.Element) -> str:
    """The text of a string item: all its runs, without phonetic ones."""
    out = []
    for child in node:
        if _local(child.tag) == "t":
            out.append(child.text or "")
        elif _local(child.tag) == "r":
            out += [t.text or "" for t in child if _local(t.tag) == "t"]
    return "".join(out)


def _shared(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out = []
    with book.open("xl/sharedStrings.xml") as stream:
        for _, node in ElementTree.iterparse(stream):
            if _local(node.tag) == "si":
                out.append(_texts(node))
                node.clear()
    return out


def _sheets(book: zipfile.ZipFile) -> Iterator[tuple[str, str]]:
    """(name, member) of each sheet, in the order of the workbook."""
    targets = {}
    for node in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        target = node.get("Target", "")
        targets[node.get("Id")] = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    for node in ElementTree.fromstring(book.read("xl/workbook.xml")).iter():
        if _local(node.tag) == "sheet":
            link = next((v for k, v in node.attrib.items() if _local(k) == "id"), None)
            if targets.get(link) in book.namelist():
                yield node.get("name", ""), targets[link]


def _value(cell: ElementTree.Element, shared: list[str]) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        own = next((n for n in cell if _local(n.tag) == "is"), None)
        return None if own is None else _texts(own)
    raw = next((n.text for n in cell if _local(n.tag) == "v"), None)
    if raw is None:
        return None
    if kind == "s":
        return shared[int(raw)]
    return {"1": "TRUE", "0": "FALSE"}.get(raw, raw) if kind == "b" else raw


def sheet_cells(content: bytes) -> Iterator[tuple[str, int, int, int, str]]:
    """(sheet, sheet's number, row, column, value) of every cell with a value; rows and columns from 1.

    A cell or row without a place of its own follows the one before it."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = _shared(book)
        for number, (name, member) in enumerate(_sheets(book)):
            row = col = 0
            with book.open(member) as stream:
                for event, node in ElementTree.iterparse(stream, ("start", "end")):
                    tag = _local(node.tag)
                    if event == "start" and tag == "row":
                        row, col = int(node.get("r", row + 1)), 0
                    elif event == "end" and tag == "c":
                        place = re.match(r"[A-Z]+", node.get("r", ""))
                        col = column_number(place[0]) if place else col + 1
                        value = _value(node, shared)
                        if value is not None:
                            yield name, number, row, col, value
                    elif event == "end" and tag == "row":
                        node.clear()


def read_cells(spark: SparkSession, path: str, pattern: str = "*.xlsx") -> DataFrame:
    """(path, sheet, sheet_no, row, col, value) of all sheets of all files; a file that is no workbook has no cells."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                out: list[tuple] = []
                try:
                    for cell in sheet_cells(content):
                        out.append((name, *cell))
                        if len(out) == _BATCH:
                            yield pd.DataFrame(out, columns=["path", "sheet", "sheet_no", "row", "col", "value"])
                            out = []
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
                    continue
                yield pd.DataFrame(out, columns=["path", "sheet", "sheet_no", "row", "col", "value"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(run, _CELLS)


def _letters(col):
    """A column's letters (up to ZZ)."""
    letter = lambda n: F.chr(F.lit(65) + n)
    return F.when(col <= 26, letter(col - 1)).otherwise(F.concat(letter(F.floor((col - 1) / 26) - 1), letter((col - 1) % 26)))


def tables_in(cells: DataFrame, columns: dict[str, str], *, keys: list[str] | None = None) -> DataFrame:
    """(path, sheet, row, locator, problem, and the named columns) of the rows below each sheet's header.

    columns: name -> pattern (case does not matter) of its header cell.  A sheet's header is its first row in which every
    pattern has a cell; sheets without one have no rows.  The first cell that fits is the column.  Rows in which all named
    columns are blank are left out; ``EMPTY_CELL`` marks rows with a blank one, ``REPEATED_KEY`` rows whose keys an earlier
    row of the sheet has.  locator is the range of the row's named cells, such as ``Sheet1!A4:B4``."""
    sheet = ["path", "sheet", "sheet_no"]
    fits = {name: F.min(F.when(F.lower("value").rlike(f"(?i){pattern}"), F.col("col"))) for name, pattern in columns.items()}
    by_row = cells.groupBy(*sheet, "row").agg(F.struct(*[c.alias(n) for n, c in fits.items()]).alias("at"))
    full = by_row.where(" AND ".join(f"at.`{n}` IS NOT NULL" for n in columns))
    header = full.groupBy(*sheet).agg(F.min_by("at", "row").alias("at"), F.min("row").alias("header"))
    below = cells.join(header, sheet).where("row > header")
    rows = below.groupBy(*sheet, "row").agg(*[F.max(F.when(F.col("col") == F.col(f"at.{n}"), F.nullif(F.trim("value"), F.lit("")))).alias(n) for n in columns], F.first("at").alias("at"))
    rows = rows.where(F.coalesce(*[F.col(n) for n in columns]).isNotNull())
    first, last = (pick(*[F.col(f"at.{n}") for n in columns]) if len(columns) > 1 else F.col(f"at.{next(iter(columns))}") for pick in (F.least, F.greatest))
    place = F.concat(F.col("sheet"), F.lit("!"), _letters(first), F.col("row"), F.lit(":"), _letters(last), F.col("row"))
    blank = F.lit(False)
    for n in columns:
        blank = blank | F.col(n).isNull()
    problem = F.when(blank, F.lit("EMPTY_CELL"))
    if keys:
        seen = rows.groupBy(*sheet, *keys).agg(F.min("row").alias("_first"))
        rows = rows.join(seen, [*sheet, *keys], "left")
        problem = problem.when(F.col("row") > F.col("_first"), "REPEATED_KEY")
    return rows.select("path", "sheet", "row", place.alias("locator"), problem.alias("problem"), *columns)
