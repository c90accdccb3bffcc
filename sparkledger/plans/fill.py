"""Fill rules: a registry from names to functions that add a column to assembled records.

Phase 1 fills before validation, phase 2 after it; a rule sees the record's columns and the context of the run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.identity import record_id
from ..functions.text import first_span, locator, normalized
from ..operators.joins import code_of


@dataclass(frozen=True)
class Context:
    """What a run knows besides its records."""

    version: str = "1.0.0"
    profile: str = "extraction"
    run: str = "run"
    method: str = "rules"
    options: dict = field(default_factory=dict)
    grains: dict = field(default_factory=dict)
    natures: dict = field(default_factory=dict)
    required: tuple = ()


RULES: dict[str, tuple[int, int, Callable[[Context], Column]]] = {}


def rule(name: str, phase: int = 1, order: int = 50) -> Callable:
    def register(fn: Callable[[Context], Column]) -> Callable[[Context], Column]:
        RULES[name] = (phase, order, fn)
        return fn

    return register


def lookup(values: dict, key: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for p in values.items() for x in p)), key) if values else F.lit(None).cast("string")


rule("schema_version", order=1)(lambda c: F.lit(c.version))
rule("profile", order=1)(lambda c: F.lit(c.profile))
rule("run_id", order=1)(lambda c: F.lit(c.run))
rule("extraction_method", order=1)(lambda c: F.lit(c.method))
rule("source_id", order=2)(lambda c: F.coalesce(F.when(F.col("doi").isNotNull(), F.concat(F.lit("doi:"), F.lower("doi"))), F.concat(F.lit("file:sha256:"), F.col("sha256"))))
rule("grain", order=3)(lambda c: lookup(c.grains, F.col("kind")))
rule("source_part", order=4)(lambda c: F.coalesce("part", F.lit("main")))
rule("source_locator", order=5)(lambda c: locator(page=F.col("page"), part=F.when(F.col("part") != "main", F.col("part")), section=F.col("section")))
rule("source_span", order=6)(lambda c: F.when(F.col("start").isNotNull(), F.concat_ws("", F.lit("page="), F.col("page"), F.lit(";char="), F.col("start"), F.lit("-"), F.col("end"))))
rule("record_id", order=10)(lambda c: record_id(F.col("source_id"), F.col("kind"), F.col("page"), F.when(F.col("part") != "main", F.col("part")), normalized(F.col("quote")), F.col("ordinal")))
rule("confidence", order=20)(lambda c: F.when(F.col("score").between(0, 1), F.col("score")))
rule("subject_span", order=30)(lambda c: first_span(F.col("quote"), F.col("subject")))
rule("object_span", order=30)(lambda c: first_span(F.col("quote"), F.col("object")))
rule("relation_nature", order=31)(lambda c: lookup(c.natures, F.col("predicate")))
rule("claim_strength", order=32)(lambda c: F.when(F.col("evidence_type") == "experiment", "causal").when(F.col("evidence_type").isNotNull(), "associational"))
rule("evidence_origin", order=33)(lambda c: F.when(F.col("document_type") == "review", "review_report").otherwise("own_result"))
rule("predicate_code", order=30)(lambda c: code_of(F.col("predicate"), c.options.get("predicates", {"": []})))
rule("warning_codes", phase=2, order=1)(lambda c: F.array_sort(F.array_distinct(F.transform(F.filter("issues", lambda i: i["severity"] == "warning"), lambda i: i["code"]))))
rule("missing_fields", phase=2, order=2)(lambda c: F.map_from_arrays(F.array_compact(F.array(*(F.when(F.col(p).isNull(), F.lit(p)) for p in c.required))), F.transform(F.array_compact(F.array(*(F.when(F.col(p).isNull(), F.lit(p)) for p in c.required))), lambda x: F.lit("not_reported"))))
rule("validation_outcome", phase=2, order=3)(lambda c: F.when(F.exists("issues", lambda i: i["severity"] == "error"), "invalid").when(F.exists("issues", lambda i: i["blocking"]), "pending_review").otherwise("machine_extracted"))


def filled(rows, context: Context, names: list[str], phase: int):
    """rows with the columns of the named rules of a phase, in their order; a rule never replaces a value that is there."""
    for name in sorted((n for n in names if RULES[n][0] == phase), key=lambda n: (RULES[n][1], n)):
        value = RULES[name][2](context)
        rows = rows.withColumn(name, F.coalesce(F.col(name), value) if name in rows.columns else value)
    return rows
