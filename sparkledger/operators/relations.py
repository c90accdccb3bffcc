"""Relation coding by cues: the longest cue between two ends names the predicate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import first_span, negated


def between(text: Column, first: Column, second: Column) -> Column:
    """The text between two mentions, in either order; null if one of them is not there."""
    a, b = first_span(text, first), first_span(text, second)
    start, end = F.least(a["end"], b["end"]), F.greatest(a["start"], b["start"])
    return F.when(a.isNotNull() & b.isNotNull() & (end >= start), F.substring(text, start + 1, end - start))


def predicate_match(context: Column, cues: dict[str, list[str]], *, negations: list[str] = (), types: dict[str, tuple[list[str], list[str]]] | None = None, subject_type: Column | None = None, object_type: Column | None = None) -> Column:
    """struct<code, cue, status>: coded, ambiguous (two codes share the longest cue), negated, or no_cue.

    types gives the end types of a code; an end without a type passes, a typed mismatch does not."""
    table = [(code, cue) for code, own in cues.items() for cue in own]
    lower = F.concat(F.lit(" "), F.lower(F.regexp_replace(context, r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    cells = []
    for code, cue in table:
        fits = F.contains(lower, F.lit(f" {cue.lower()} "))
        for kinds, given in zip((types or {}).get(code, ([], [])), (subject_type, object_type), strict=True):
            if kinds and given is not None:
                fits = fits & (given.isNull() | given.isin(*kinds))
        cells.append(F.when(fits, F.struct(F.lit(len(cue)).alias("size"), F.lit(code).alias("code"), F.lit(cue).alias("cue"))))
    found = F.array_compact(F.array(*cells))
    longest = F.array_max(F.transform(found, lambda x: x["size"]))
    best = F.filter(found, lambda x: x["size"] == longest)
    codes = F.array_distinct(F.transform(best, lambda x: x["code"]))
    is_negated = negated(context, list(negations)) if negations else F.lit(False)
    status = F.when(context.isNull() | (F.size(found) == 0), "no_cue").when(is_negated, "negated").when(F.size(codes) > 1, "ambiguous").otherwise("coded")
    coded = status == "coded"
    return F.struct(F.when(coded, F.get(codes, F.lit(0))).alias("code"), F.when(coded, F.get(best, F.lit(0))["cue"]).alias("cue"), status.alias("status"))


def cited_items(text: Column) -> Column:
    """Labels of cited figures and tables (``figure 2``, ``table S1``), ranges expanded to 50 at most, sorted, distinct."""
    pattern = r"(?i)\b(fig(?:ure)?s?|tables?)\.?\s*(S?)(\d+)(?:\s*[-–]\s*S?(\d+))?"
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def expand(item: Column) -> Column:
        part = lambda k: F.regexp_extract(item, pattern, k)
        kind = F.when(F.lower(part(1)).startswith("fig"), "figure").otherwise("table")
        lo = part(3).cast("int")
        hi = F.coalesce(F.nullif(part(4), F.lit("")).cast("int"), lo)
        numbers = F.when((hi >= lo) & (hi - lo < 50), F.sequence(lo, hi)).otherwise(F.array(lo))
        return F.transform(numbers, lambda n: F.concat(kind, F.lit(" "), F.upper(part(2)), n.cast("string")))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(whole, expand))))


def package_status(cited: Column, held: Column, *, submitted: Column, verified: Column) -> Column:
    """complete, partial, unverified or not_submitted, of the items that a text cites and those that are held."""
    missing = F.size(F.array_except(cited, held)) > 0
    return F.when(~submitted, "not_submitted").when(~verified, "unverified").when(missing, "partial").otherwise("complete")
