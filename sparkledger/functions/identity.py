"""Content-derived identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "\x1f"


def digest(prefix: str, length: int, *parts: Column) -> Column:
    """prefix plus the first hex digits of the SHA-256 of the parts; a null part counts as the word None."""
    joined = F.concat_ws(SEPARATOR, *(F.coalesce(p.cast("string"), F.lit("None")) for p in parts))
    return F.concat(F.lit(prefix), F.left(F.sha2(joined, 256), F.lit(length)))


def record_id(*parts: Column) -> Column:
    return digest("rec_", 32, *parts)
