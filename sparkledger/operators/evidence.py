"""Evidence: quotes in texts, pages near a hint, headings, values, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalized, normalized_with_map, value_present

_GRAM = 4
#: Runs of quotes that are sent to all tasks, at most; more of them are shuffled with the runs of the texts.
SENT_RUNS = 200_000


def _grams(words: Column, first: Column, last: Column) -> Column:
    at = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(at, lambda i: F.xxhash64(F.array_join(F.slice(words, i + 1, _GRAM), " "))))


def located_quotes(texts: DataFrame, quotes: DataFrame, *, text_id: str, text: str, quote_id: str, quote: str) -> DataFrame:
    """(text_id, quote_id, start, end): first verbatim occurrence of every quote in every text that holds it.

    Never a nested loop: a quote of at least six words has an inner run of four whole words, which is joined to the runs of
    four words of the texts; a shorter quote is joined by its first three characters.  Both joins are on a hash and carry ids
    only; each text then meets its distinct candidates, which are verified by containment.  A kind of runs that no quote has is
    not made, and few quotes (their number is counted first) are sent to the texts, so that only hits are shuffled.  Quotes
    under three characters are not looked for.  Rows of one text id, null included, count as one text: the least start counts."""
    split = lambda c: F.split(c, r"\s")
    asked = quotes.select(F.col(quote_id).alias("_q"), F.col(quote).alias("_quote")).where(F.length("_quote") >= 3).withColumn("_w", split(F.col("_quote")))
    long = F.size("_w") >= _GRAM + 2
    by_words = asked.where(long).select("_q", F.xxhash64(F.array_join(F.slice("_w", 2, _GRAM), " ")).alias("_g"))
    by_chars = asked.where(~long).select("_q", F.xxhash64(F.left("_quote", F.lit(3))).alias("_g"))
    held = texts.select(F.col(text_id).alias("_t"), F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    words = held.select("_t", split(F.col("_text")).alias("_w"))
    word_runs = words.select("_t", F.explode(_grams(F.col("_w"), F.lit(0), F.size("_w") - _GRAM)).alias("_g"))
    char_runs = held.select("_t", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length("_text") - 2, F.lit(1))), lambda i: F.xxhash64(F.substring(F.col("_text"), i, F.lit(3)))))).alias("_g"))
    n_words, n_chars = asked.agg(F.coalesce(F.sum(long.cast("long")), F.lit(0)), F.coalesce(F.sum((~long).cast("long")), F.lit(0))).first()
    sides = [(word_runs, by_words, n_words), (char_runs, by_chars, n_chars)]
    found = [runs.join(F.broadcast(own) if n <= SENT_RUNS else own, "_g") for runs, own, n in sides if n] or [word_runs.join(by_words, "_g")]
    met = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    named = met.select(F.col("_t").alias("_mt"), F.col("_q").alias("_mq")).distinct().join(asked.select("_q", "_quote"), F.col("_mq").eqNullSafe(F.col("_q")))
    pairs = held.join(named, F.col("_t").eqNullSafe(F.col("_mt")))
    at = F.instr(F.col("_text"), F.col("_quote"))
    spans = pairs.where(at > 0).select("_t", "_q", F.struct((at - 1).alias("start"), (at - 1 + F.length("_quote")).alias("end"), F.col("_text").alias("text")).alias("_s"))
    least = spans.groupBy("_t", "_q").agg(F.min("_s").alias("_s"))
    return least.select(F.col("_t").alias(text_id), F.col("_q").alias(quote_id), "_s.start", "_s.end", "_s.text")


def line_of(text: Column, start: Column) -> Column:
    """1-based line of a 0-based place."""
    return F.size(F.split(F.substring(text, F.lit(1), start), "\n"))


def pages(texts: DataFrame, keys: list[str], text: str, separator: str = "\f") -> DataFrame:
    """(keys, page, text): pages from 1, separated by form feeds (or another separator)."""
    return texts.select(*keys, F.posexplode(F.split(F.col(text), separator)).alias("page", "text")).withColumn("page", F.col("page") + 1)


def page_gaps(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Documents whose pages are not 1..n without gaps or repeats."""
    return rows.groupBy(*keys).agg(F.max("page").alias("last"), F.count(F.lit(1)).alias("pages"), F.count_distinct("page").alias("distinct_pages")).where("last <> pages OR pages <> distinct_pages")


def annotated_lines(page_rows: DataFrame, keys: list[str], heading: str, caption: str) -> DataFrame:
    """(keys, page, line, start, text, kind): lines that are headings or captions, with their place in the page."""
    lines = page_rows.select(*keys, "page", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    place = Window.partitionBy(*keys, "page").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("start", F.coalesce(F.sum(F.length("text") + 1).over(place), F.lit(0)))
    kind = F.when(F.trim("text").rlike(caption), "caption").when((F.length(F.trim("text")) <= 60) & F.trim("text").rlike(heading), "heading")
    return lines.withColumn("kind", kind).where("kind IS NOT NULL")


def with_last_before(events: DataFrame, marks: DataFrame, keys: list[str], at: str, value: str, out: str) -> DataFrame:
    """As-of join: each event gets the value of the last mark at or before its place, within its keys.

    Both sides are one sorted union, so a key is sorted once; nothing is compared pairwise."""
    blank = [F.lit(None).cast(t).alias(c) for c, t in events.dtypes if c not in (*keys, at)]
    both = events.withColumn("_v", F.lit(None).cast(dict(marks.dtypes)[value])).withColumn("_e", F.lit(1)).unionByName(marks.select(*keys, at, *blank, F.col(value).alias("_v"), F.lit(0).alias("_e")))
    w = Window.partitionBy(*keys).orderBy(at, "_e").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(out, F.last("_v", ignorenulls=True).over(w)).where("_e = 1").drop("_v", "_e")


def page_of_evidence(candidates: DataFrame, page_rows: DataFrame, keys: list[str], *, radius: int = 1, longest: int | None = 2000) -> DataFrame:
    """Adds page_found and code to candidates (candidate, keys, quote, hint): the hinted page, else the nearest within the
    radius (the lower one first), else none.  The join is on the keys and one of the 2 * radius + 1 pages.  Without ``longest``
    a quote may be of any length."""
    steps = [s for d in range(radius + 1) for s in ((-d, d) if d else (0,))]
    near = candidates.select("candidate", *keys, "quote", "hint", F.posexplode(F.array(*(F.col("hint") + s for s in steps))).alias("_rank", "page"))
    near = near.withColumn("_quote", normalized(F.col("quote")))
    met = near.join(page_rows.select(*keys, "page", normalized(F.col("text")).alias("_page")), [*keys, "page"]).where(F.contains("_page", F.col("_quote")))
    best = met.groupBy("candidate").agg(F.min_by("page", "_rank").alias("page_found"))
    judged = candidates.join(best, "candidate", "left")
    code = (
        F.when(F.col("quote").isNull() | (F.trim("quote") == ""), "EVIDENCE_MISSING")
        .when(F.col("hint").isNull() | (F.col("hint") < 1), "EVIDENCE_PAGE_INVALID")
        .when(F.length("quote") > F.lit(longest).cast("int"), "EVIDENCE_QUOTE_TOO_LONG")
        .when(F.col("page_found").isNull(), "EVIDENCE_QUOTE_NOT_FOUND")
        .when(F.col("page_found") != F.col("hint"), "EVIDENCE_PAGE_CORRECTED")
    )
    return judged.withColumn("code", code)


def located_evidence(candidates: DataFrame, page_rows: DataFrame, keys: list[str], *, radius: int = 1, shortest: int = 3) -> DataFrame:
    """(candidate, page, start, end, corrected): where the quote of (candidate, keys, quote, hint) stands, in code points of the
    page's own text; candidates that are not found are left out.

    With a hint on an existing page, that page counts first, then the nearest within the radius, the lower one before the
    higher; without one all pages of the document do, from the first.  Quotes whose normal form has fewer than ``shortest``
    characters are not looked for.  Each page and each quote is normalised once; of rows of one page the least text counts."""
    made = page_rows.groupBy(*keys, "page").agg(F.min("text").alias("_text")).withColumn("_m", normalized_with_map("_text"))
    own = made.select(*keys, "page", F.col("_m.text").alias("_page"), F.col("_m.places").alias("_places"))
    last = page_rows.groupBy(*keys).agg(F.max("page").alias("_last"))
    asked = candidates.select("candidate", *keys, "hint", normalized_with_map("quote").alias("_m")).select("candidate", *keys, "hint", F.col("_m.text").alias("_q")).where(F.length("_q") >= shortest)
    asked = asked.join(last, keys)
    hinted = F.coalesce((F.col("hint") >= 1) & (F.col("hint") <= F.col("_last")), F.lit(False))
    steps = [s for d in range(radius + 1) for s in ((-d, d) if d else (0,))]
    near = asked.where(hinted).select("candidate", *keys, "hint", "_q", F.posexplode(F.array(*(F.col("hint") + s for s in steps))).alias("_rank", "page")).join(own, [*keys, "page"])
    far = asked.where(~hinted).join(own, keys).withColumn("_rank", F.col("page"))
    both = near.unionByName(far, allowMissingColumns=True)
    at = F.instr(F.col("_page"), F.col("_q"))
    met = both.where(at > 0).select("candidate", "hint", "page", F.col("_rank").cast("int").alias("_rank"), F.get("_places", at - 1).alias("start"), (F.get("_places", at + F.length("_q") - 2) + 1).alias("end"))
    best = met.groupBy("candidate").agg(F.min_by(F.struct("page", "start", "end", "hint"), "_rank").alias("b"))
    return best.select("candidate", "b.page", "b.start", "b.end", F.coalesce(F.col("b.hint") != F.col("b.page"), F.lit(False)).alias("corrected"))


def values_near(values: DataFrame, page_rows: DataFrame, keys: list[str], *, radius: int = 1) -> DataFrame:
    """Adds present to (value_id, keys, page, value): whether a page within the radius holds the value (see value_present)."""
    near = values.select("value_id", *keys, F.explode(F.sequence(F.col("page") - radius, F.col("page") + radius)).alias("page"), "value")
    met = near.join(page_rows.select(*keys, "page", F.col("text").alias("_page")), [*keys, "page"])
    found = met.groupBy("value_id").agg(F.bool_or(value_present(F.col("_page"), F.col("value"))).alias("present"))
    return values.join(found, "value_id", "left").withColumn("present", F.coalesce("present", F.lit(False)))


def section_title(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"^[0-9.]+\s*", ""))
