"""Derived views of records: statements, triples, property graph, corpus questions.

Records are described by roles, not by names: which columns are mentions, ids, links, values, bibliography.  Every view is a
lazy union of selects over one DataFrame of records."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import digest
from ..functions.text import normalized


@dataclass(frozen=True)
class Roles:
    """Columns by role: mentions maps a column to (entity type, id column or None)."""

    key: str
    source: str
    mentions: dict[str, tuple[str, str | None]] = field(default_factory=dict)
    links: list[str] = field(default_factory=list)
    values: list[str] = field(default_factory=list)
    bibliography: list[str] = field(default_factory=list)
    subject: str | None = None
    predicate: str | None = None
    object: str | None = None
    qualifiers: list[str] = field(default_factory=list)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _list(rows: DataFrame, column: str) -> Column:
    return F.col(column) if dict(rows.dtypes)[column].startswith("array") else F.array(F.col(column))


def entities(rows: DataFrame, roles: Roles) -> DataFrame:
    """(record_id, field, position, entity_type, mention, entity_id) of all mentions."""
    parts = []
    for name, (kind, ident) in roles.mentions.items():
        part = rows.select(F.col(roles.key).cast("string").alias("record_id"), (F.col(ident).cast("string") if ident else F.lit(None).cast("string")).alias("entity_id"), F.posexplode(_list(rows, name)).alias("position", "mention"))
        parts.append(part.where("mention IS NOT NULL").select("record_id", F.lit(name).alias("field"), "position", F.lit(kind).alias("entity_type"), F.col("mention").cast("string").alias("mention"), "entity_id"))
    return _union(parts)


def links(rows: DataFrame, roles: Roles) -> DataFrame:
    parts = [rows.select(F.col(roles.key).cast("string").alias("record_id"), F.lit(c).alias("field"), F.explode(_list(rows, c).cast("array<string>")).alias("target")).where("target IS NOT NULL") for c in roles.links]
    return _union(parts)


def values(rows: DataFrame, roles: Roles) -> DataFrame:
    """(record_id, field, position, value) of multi-valued and single values."""
    parts = [rows.select(F.col(roles.key).cast("string").alias("record_id"), F.lit(c).alias("field"), F.posexplode(_list(rows, c)).alias("position", "value")).where("value IS NOT NULL").withColumn("value", F.col("value").cast("string")) for c in roles.values]
    return _union(parts)


def statements(rows: DataFrame, roles: Roles, predicates: dict[str, str] | None = None) -> DataFrame:
    """Subject, predicate and object of records that have both ends; the predicate is coded, verbatim or unlabelled; the
    identifier is a digest of the ends, the predicate, the qualifiers and the record."""
    coded = F.try_element_at(F.create_map(*(F.lit(x) for p in (predicates or {"": ""}).items() for x in p)), F.lower(F.col(roles.predicate)))
    status = F.when(coded.isNotNull(), "ontology").when(F.col(roles.predicate).isNotNull(), "verbatim").otherwise("unlabelled")
    subject = F.coalesce(*(F.col(c).cast("string") for c in (roles.mentions.get(roles.subject, ("", None))[1], roles.subject) if c))
    target = F.coalesce(*(F.col(c).cast("string") for c in (roles.mentions.get(roles.object, ("", None))[1], roles.object) if c))
    quals = F.array_join(F.array_compact(F.array(*(F.when(F.col(q).isNotNull(), F.concat(F.lit(q + "="), F.col(q).cast("string"))) for q in roles.qualifiers))), ";") if roles.qualifiers else F.lit("")
    key = F.col(roles.key).cast("string")
    predicate = F.coalesce(coded, F.col(roles.predicate))
    held = rows.where(F.col(roles.subject).isNotNull() & F.col(roles.object).isNotNull())
    return held.select(digest("stmt_", 24, key, subject, predicate, target, quals).alias("statement_id"), key.alias("record_id"), subject.alias("subject"), predicate.alias("predicate"), target.alias("object"), status.alias("predicate_status"), quals.alias("qualifiers"), F.col(roles.source).cast("string").alias("source_id"))


def triples(rows: DataFrame, roles: Roles, predicates: dict[str, str] | None = None) -> DataFrame:
    """(s, p, o, o_kind, record_id): literals, ids, record links, entity labels and types, and statements."""
    parts = [values(rows, roles).select(F.col("record_id").alias("s"), F.col("field").alias("p"), F.col("value").alias("o"), F.lit("literal").alias("o_kind"), "record_id")] if roles.values else []
    if roles.links:
        parts.append(links(rows, roles).select(F.col("record_id").alias("s"), F.col("field").alias("p"), F.col("target").alias("o"), F.lit("iri").alias("o_kind"), "record_id"))
    if roles.mentions:
        found = entities(rows, roles).withColumn("node", node_of("entity_type", "mention", "entity_id"))
        parts.append(found.select(F.col("record_id").alias("s"), F.col("field").alias("p"), F.col("node").alias("o"), F.lit("id").alias("o_kind"), "record_id"))
        for p, o in (("label", "mention"), ("type", "entity_type")):
            parts.append(found.select(F.col("node").alias("s"), F.lit(p).alias("p"), F.col(o).alias("o"), F.lit("literal").alias("o_kind"), "record_id"))
    if roles.subject:
        parts.append(statements(rows, roles, predicates).select(F.col("subject").alias("s"), F.col("predicate").alias("p"), F.col("object").alias("o"), F.lit("id").alias("o_kind"), "record_id"))
    return _union(parts)


def node_of(kind: str, mention: str, ident: str) -> Column:
    """The identifier of an entity: its own id, else its type and normalised mention."""
    return F.coalesce(F.col(ident), digest("ent_", 16, F.col(kind), normalized(F.col(mention))))


def graph(rows: DataFrame, roles: Roles) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges): sources, records, entities and external link targets; provenance, mention, link edges."""
    records = rows.select(F.col(roles.key).cast("string").alias("id"), F.lit("record").alias("kind")).distinct()
    sources = rows.select(F.col(roles.source).cast("string").alias("id"), F.lit("source").alias("kind")).where("id IS NOT NULL").distinct()
    found = entities(rows, roles).withColumn("id", node_of("entity_type", "mention", "entity_id"))
    things = found.select("id", F.lit("entity").alias("kind")).distinct()
    outgoing = links(rows, roles)
    external = outgoing.select(F.col("target").alias("id")).distinct().join(records, "id", "left_anti").withColumn("kind", F.lit("external"))
    edges = [
        rows.where(F.col(roles.source).isNotNull()).select(F.col(roles.key).cast("string").alias("s"), F.lit("from").alias("p"), F.col(roles.source).cast("string").alias("o"), F.lit("provenance").alias("kind")),
        found.select(F.col("record_id").alias("s"), F.col("field").alias("p"), F.col("id").alias("o"), F.lit("mention").alias("kind")),
        outgoing.select(F.col("record_id").alias("s"), F.col("field").alias("p"), F.col("target").alias("o"), F.lit("link").alias("kind")),
    ]
    return _union([records, sources, things, external]), _union(edges)


def cloze(rows: DataFrame, key: str, text: str, answer: Column, *, mask: str = "____", least: int = 20) -> DataFrame:
    """(qa_id, key, question, answer, start, end): the answer masked in its text, if enough context is left."""
    at = F.instr(F.col(text), answer)
    held = rows.withColumn("_a", answer).withColumn("_at", at).where((F.col("_at") > 0) & (F.length("_a") > 0) & (F.length(F.trim(text)) - F.length("_a") >= least))
    start, end = F.col("_at") - 1, F.col("_at") - 1 + F.length("_a")
    question = F.concat(F.substring(F.col(text), F.lit(1), start), F.lit(mask), F.substring(F.col(text), end + 1, F.length(text)))
    return held.select(digest("qa_", 16, F.col(key), start, end).alias("qa_id"), key, question.alias("question"), F.col("_a").alias("answer"), start.alias("start"), end.alias("end"))
