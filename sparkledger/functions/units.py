"""Raw values and unit conversion as Columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NUMBER = r"[-+]?\d+(?:\.\d+)?"
_THOUSANDS = r"[-+]?\d{1,3}(?:,\d{3})+(?:\.\d+)?"
_EXPONENT = r"(?:[eE][-+]?\d{1,3})?"
#: Full-width forms of the characters that a number is written with, and the minus sign (fixed values).
_WIDE = ("０１２３４５６７８９．，＋－～　−", "0123456789.,+-~ -")


def raw_value(text: Column, *, exponents: bool = False) -> Column:
    """struct<lo, hi>: a single number (thousands separators allowed) or a closed range, whose ends must not be reversed;
    null if it is neither.  With ``exponents`` numbers such as 1e5 count too; one that no double holds does not."""
    number = _NUMBER + (_EXPONENT if exponents else "")
    plain = F.regexp_replace(F.translate(text, *_WIDE), r"(?U)^\s+|\s+$", "")
    plain = F.when(plain.rlike(f"^{_THOUSANDS}$"), F.replace(plain, F.lit(","), F.lit(""))).otherwise(plain)
    part = lambda group: F.regexp_extract(plain, rf"^({number})(?:\s*(?:-|–|—|~|to)\s*({number}))?$", group).try_cast("double")
    lo, hi = part(1), F.coalesce(part(2), part(1))
    return F.when((lo <= hi) & (F.abs(lo) != float("inf")) & (F.abs(hi) != float("inf")), F.struct(lo.alias("lo"), hi.alias("hi")))


def normalized_values(rows: DataFrame, units: DataFrame, value: Column, unit: Column) -> DataFrame:
    """Adds lo, hi, canonical and reason: value and unit strings against units(alias, canonical, factor, shift).

    units is a dimension table of a contract; Spark broadcasts it by its size.  Ends of a range are put in order after the
    conversion (a factor may be negative).  A value without a unit stays as it is; an unknown unit is a reason."""
    raw = rows.withColumn("_raw", raw_value(value)).withColumn("_unit", F.lower(F.trim(unit)))
    joined = raw.join(units.select(F.lower("alias").alias("_unit"), "canonical", "factor", "shift"), "_unit", "left")
    bare = F.coalesce(F.col("_unit"), F.lit("")) == ""
    convert = lambda x: F.when(bare, F.round(x, 10)).otherwise(F.round(x * F.col("factor") + F.col("shift"), 10))
    a, b = convert(F.col("_raw.lo")), convert(F.col("_raw.hi"))
    reason = F.when(value.isNull(), "no_raw_value").when(F.col("_raw").isNull(), "unparsed_value").when(~bare & F.col("canonical").isNull(), "unknown_unit")
    return joined.select(*rows.columns, F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"), F.when(~bare, F.col("canonical")).alias("canonical"), reason.alias("reason"))


def instant_utc(text: Column) -> Column:
    """An ISO-8601 instant with an offset as UTC text ending in Z; null without an offset."""
    ok = text.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d(:\d\d(\.\d+)?)?(Z|[+-]\d\d:\d\d)$")
    return F.when(ok, F.date_format(F.try_to_timestamp(text), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
