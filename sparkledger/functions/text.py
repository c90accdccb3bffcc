"""Text functions as Columns; the two exact Unicode kernels are Arrow UDFs."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters that normalisation maps to plain ones: dashes, quotes (fixed values).
_DASHES = "‐‑‒–—−"
_QUOTES = {"‘": "'", "’": "'", "“": '"', "”": '"'}
_TABLE = str.maketrans({**dict.fromkeys(_DASHES, "-"), **_QUOTES, "\u00ad": ""})


_BROKEN = re.compile(r"(?<=\w)-\s*\n\s*(?=\w)")
#: Characters on which the JVM's form is the exact one (tests compare the two over all of Unicode): ASCII, Latin letters without
#: compatibility forms, plain signs, CJK ideographs and kana.
_PROVEN = r"\t-\r -~¡-§©«¬\u00AD®°±¶·»¿-įĴ-ľŁ-ňŊ-žƀ-ƃ‐-—‘’“”−一-鿿ぁ-ゖァ-ヺ、。《》"


def exact_form(text: str | None) -> str | None:
    """Compatibility form, joined line breaks at hyphens, plain dashes and quotes, single spaces, case folded."""
    if text is None:
        return None
    return " ".join(_BROKEN.sub("", unicodedata.normalize("NFKC", text)).translate(_TABLE).split()).casefold()


@F.pandas_udf(T.StringType())
def normalized_exact(text: pd.Series) -> pd.Series:
    """``exact_form`` of each text."""
    return text.map(exact_form)


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("places", T.ArrayType(T.IntegerType()))]))
def normalized_with_map(text: pd.Series) -> pd.DataFrame:
    """Normalised text by single characters, with the source place of each of its characters."""

    def one(t: str | None) -> tuple[str, list[int]]:
        out: list[str] = []
        places: list[int] = []
        space = True
        for i, ch in enumerate(t or ""):
            for c in unicodedata.normalize("NFKC", ch).translate(_TABLE).casefold():
                if c.isspace():
                    if out and out[-1] == "-" and len(out) > 1 and out[-2].isalnum() and ch == "\n":
                        out.pop()
                        places.pop()
                        space = True
                    elif not space:
                        out.append(" ")
                        places.append(i)
                        space = True
                else:
                    out.append(c)
                    places.append(i)
                    space = False
        while out and out[-1] == " ":
            out.pop()
            places.pop()
        return "".join(out), places

    rows = [one(t) for t in text]
    return pd.DataFrame({"text": [r[0] for r in rows], "places": [r[1] for r in rows]})


def normalized_plain(text: Column) -> Column:
    """The JVM's form, equal to ``exact_form`` on proven characters."""
    joined = F.regexp_replace(text, r"(?U)(?<=\w)-\s*\n\s*(?=\w)", "")
    plain = F.translate(joined, _DASHES + "".join(_QUOTES) + "\u00ad", "-" * len(_DASHES) + "".join(_QUOTES.values()))
    return F.replace(F.lower(F.trim(F.regexp_replace(plain, r"(?U)\s+", " "))), F.lit("ß"), F.lit("ss"))


def normalized(text: Column) -> Column:
    """``exact_form`` as a Column: on the JVM where all characters are proven, else by the exact kernel, to which the other
    rows go as nulls."""
    other = F.regexp_like(text, F.lit(f"[^{_PROVEN}]"))
    return F.when(other, normalized_exact(F.when(other, text))).otherwise(normalized_plain(text))


def label(text: Column) -> Column:
    """White space collapsed, lower case: the form in which labels of the network are compared."""
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def first_span(text: Column, needle: Column) -> Column:
    """0-based start and exclusive end, in code points, of the first occurrence; null if there is none.

    Case and the length of runs of white space do not matter; an ASCII letter or digit at an edge of the needle must not
    stand beside another one in the text."""
    words = F.split(F.trim(F.regexp_replace(needle, r"(?U)\s+", " ")), " ")
    literal = F.array_join(F.transform(words, lambda w: F.regexp_replace(w, r"([^\p{L}\p{N}_])", r"\\$1")), r"\s+")
    before = F.when(needle.rlike(r"(?U)^\s*[A-Za-z0-9]"), r"(?<![A-Za-z0-9])").otherwise("")
    after = F.when(needle.rlike(r"(?U)[A-Za-z0-9]\s*$"), r"(?![A-Za-z0-9])").otherwise("")
    pattern = F.concat(before, literal, after)
    cut = lambda group: F.length(F.call_function("regexp_extract", text, F.concat(F.lit("(?isuU)^(.*?)("), pattern, F.lit(")")), F.lit(group))).cast("int")
    found = (F.trim(needle) != "") & F.regexp_like(text, F.concat(F.lit("(?iuU)"), pattern))
    return F.when(found, F.struct(cut(1).alias("start"), (cut(1) + cut(2)).alias("end")))


def span_matches(text: Column, start: Column, end: Column, mention: Column, form: Callable[[Column], Column] = normalized) -> Column:
    """Whether a span lies inside the text, is trimmed, and normalises to the mention (inside a lambda, where no Python kernel
    can run, form must be ``normalized_plain``)."""
    inside = (start >= 0) & (start < end) & (end <= F.length(text))
    cut = F.substring(text, start + 1, end - start)
    return F.coalesce(inside & (cut == F.trim(cut)) & (form(cut) == form(mention)), F.lit(False))


def _forms(number: Column) -> list[Column]:
    """How a number is printed: with its decimals, or a whole one first with one zero and then without; as patterns."""
    digits = number.try_cast("decimal(38,15)").cast("string")
    plain = F.coalesce(F.regexp_replace(F.regexp_replace(digits, r"0+$", ""), r"\.$", ""), number.cast("string"))
    whole = ~F.contains(plain, F.lit("."))
    escaped = F.replace(F.replace(plain, F.lit("."), F.lit(r"\.")), F.lit("+"), F.lit(r"\+"))
    return [F.concat(escaped, F.when(whole, r"\.0").otherwise(""), F.lit("0*")), F.when(whole, escaped)]


def number_span(text: Column, number: Column) -> Column:
    """struct<start, end> of a number where it is printed as one of its own; null if it isn't.

    Zeros after decimals don't matter (23.5 is found in 23.50); a part of a longer number is none (8 in 8.6, 536 in 1,536)."""
    spans = []
    for form in _forms(number.cast("double")):
        pattern = F.concat(F.lit(r"(?s)^(.*?)(?<![\p{Nd}.])(?<!\p{Nd},)("), form, F.lit(r")(?!\p{Nd}|[.,]\p{Nd})"))
        cut = lambda group, p=pattern: F.length(F.call_function("regexp_extract", text, p, F.lit(group)))
        spans.append(F.when(cut(2) > 0, F.struct(cut(1).alias("start"), (cut(1) + cut(2)).alias("end"))))
    return F.coalesce(*spans)


def number_printed(text: Column, number: Column) -> Column:
    """Whether a number is in the text as one of its own (see ``number_span``)."""
    return number_span(text, number).isNotNull()


def value_present(text: Column, value: Column) -> Column:
    """Whether a value is in the text, both normalised: a plain number as one of its own (zeros after decimals don't matter, a
    comma before it does not make it longer), any other string as a part."""
    plain, hay = F.trim(value), normalized(text)
    number = plain.rlike(r"^[0-9]+(\.[0-9]+)?$")
    short = F.regexp_replace(F.regexp_replace(plain, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    form = F.concat(F.replace(short, F.lit("."), F.lit(r"\.")), F.when(F.contains(short, F.lit(".")), "0*").when(F.contains(plain, F.lit(".")), r"(?:\.0+)?").otherwise(""))
    printed = F.regexp_like(hay, F.concat(F.lit(r"(?<![0-9.])"), form, F.lit(r"(?!\.?[0-9])")))
    return F.coalesce(F.when(number, printed).otherwise(F.contains(hay, normalized(value))), F.lit(False))


def number_range(text: Column) -> Column:
    """Items such as "2-4" as an array of all numbers of the range (50 at most)."""
    lo, hi = F.regexp_extract(text, r"^(\d+)", 1).cast("int"), F.regexp_extract(text, r"-(\d+)$", 1)
    last = F.when(hi == "", lo).otherwise(hi.cast("int"))
    return F.when((last >= lo) & (last - lo < 50), F.sequence(lo, last)).otherwise(F.array(lo))


def locator(**parts: Column) -> Column:
    """``key=value`` parts joined by semicolons; %, ; and = are percent-escaped; parts that are null are left out."""
    escape = lambda c: F.replace(F.replace(F.replace(c.cast("string"), F.lit("%"), F.lit("%25")), F.lit(";"), F.lit("%3B")), F.lit("="), F.lit("%3D"))
    return F.array_join(F.array_compact(F.array(*(F.when(c.isNotNull(), F.concat(F.lit(k + "="), escape(c))) for k, c in parts.items()))), ";")


def locator_parts(text: Column) -> Column:
    """The map of a locator's parts."""
    plain = lambda c: F.replace(F.replace(F.replace(c, F.lit("%3D"), F.lit("=")), F.lit("%3B"), F.lit(";")), F.lit("%25"), F.lit("%"))
    return F.transform_values(F.str_to_map(text, F.lit(";"), F.lit("=")), lambda k, v: plain(v))


def negated(text: Column, words: list[str]) -> Column:
    """Whether one of the negation words stands in the text."""
    return F.coalesce(F.lower(text).rlike(r"(^|\W)(" + "|".join(words) + r")($|\W)"), F.lit(False))
