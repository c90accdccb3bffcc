"""The migrator hook: a plug-in that adds records of its own to every migrated document.

A plug-in is a class with ``SCHEMA`` (DDL of the records it adds), ``row(row)`` for each row of a document in order, and
``end()`` after the last one; both give tuples or nothing.  It keeps what it needs between rows, so it sees a document of
any length one row at a time.  The table function asks for the partitioning itself, by the keys it is called with.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

MIGRATORS: dict[str, type] = {}


def migrator(name: str) -> Callable[[type], type]:
    """Registers a plug-in by name."""

    def register(plugin: type) -> type:
        MIGRATORS[name] = plugin
        return plugin

    return register


def load_migrator(name: str) -> type:
    """A registered plug-in, or ``module:class``."""
    if name in MIGRATORS:
        return MIGRATORS[name]
    module, _, attribute = name.partition(":")
    if not attribute:
        raise KeyError(f"no migrator {name}")
    import importlib

    return getattr(importlib.import_module(module), attribute)


def _names(text: str) -> list[str]:
    return [n.strip() for n in text.split(",") if n.strip()]


def table_function(plugin: type):
    """The plug-in as a polymorphic table function (table, keys, order); keys and order are comma-separated column names.

    Its rows are the keys, with the types they have in the table, and then the columns of the plug-in.  Rows without a key
    are a document of their own."""
    added = T.StructType.fromDDL(plugin.SCHEMA)

    class AddedRecords:
        def __init__(self):
            self.plugin, self.keys, self.at = plugin(), None, None

        @staticmethod
        def analyze(rows: AnalyzeArgument, keys: AnalyzeArgument, order: AnalyzeArgument) -> AnalyzeResult:
            if not rows.isTable:
                raise ValueError("the first argument must be a table")
            known = {f.name: f for f in rows.dataType.fields}
            parts, places = _names(keys.value or ""), _names(order.value or "")
            absent = [n for n in parts + places if n not in known]
            clash = [n for n in parts if n in added.names]
            if not parts or absent or clash:
                raise ValueError(f"keys and order must be columns of the table that the plug-in does not add: {parts}, {absent}, {clash}")
            schema = T.StructType([known[n] for n in parts] + list(added.fields))
            return AnalyzeResult(schema, partitionBy=[PartitioningColumn(n) for n in parts], orderBy=[OrderingColumn(n) for n in places])

        def eval(self, row, keys: str, order: str):
            if self.keys is None:
                self.keys = _names(keys)
                self.at = tuple(row[n] for n in self.keys)
            for record in self.plugin.row(row) or ():
                yield self.at + tuple(record)

        def terminate(self):
            if self.at is not None:
                for record in self.plugin.end() or ():
                    yield self.at + tuple(record)

    return F.udtf(AddedRecords)


def additional_records(rows: DataFrame, name: str, keys: list[str], order: list[str]) -> DataFrame:
    """(keys, columns of the plug-in): what the named plug-in adds to each document of rows.

    Documents are told apart by keys and their rows come in the given order; rows that tie there come in any order.  Keys
    must not clash with the columns of the plug-in; other columns of rows may be called anything."""
    return table_function(load_migrator(name))(rows.asTable(), F.lit(",".join(keys)), F.lit(",".join(order)))


@migrator("runs")
class RunRecords:
    """Neighbouring rows with one ``state`` as one record (first and last place, rows, sum of amounts), and one record of the
    whole document at the end, with state null.  Amounts are whole numbers; a null state is a state of its own."""

    SCHEMA = "state string, first int, last int, members long, amount long"

    def __init__(self):
        self.run, self.whole = None, None

    def row(self, row) -> Iterator[tuple]:
        done = None
        if self.run is None or self.run[0] != row["state"]:
            done, self.run = self.run, [row["state"], row["place"], row["place"], 0, 0]
        if self.whole is None:
            self.whole = [None, row["place"], row["place"], 0, 0]
        for told in (self.run, self.whole):
            told[2] = row["place"]
            told[3] += 1
            told[4] += row["amount"] or 0
        if done:
            yield tuple(done)

    def end(self) -> Iterator[tuple]:
        yield tuple(self.run)
        yield tuple(self.whole)
