"""Small documents with the cases that every operator must take: nulls, empty and long texts, ties, repeated rows."""

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n)]


def documents() -> list[tuple]:
    rng = random.Random(3)
    base = words(rng, 120)
    rows = [
        (1, " ".join(base), "aa"),
        (2, " ".join(base), "aa"),
        (3, " ".join([*base[:60], "changed", *base[61:]]), "aa"),
        (4, " ".join([*base[:30], *words(rng, 90)]), "bb"),
        (5, None, "aa"),
        (6, "", None),
        (7, "two words", "bb"),
        (8, "Two\tWORDS", "bb"),
        (9, "  \n ", None),
        (10, "é ñ 中文 😀 " * 80, "bb"),
        (11, " ".join(words(rng, 9000)), "aa"),
        (12, "abab" * 400, None),
        (None, " ".join(base), "aa"),
        (13, "x" * 199, "aa"),
        (14, "x" * 200, "aa"),
        (14, "x" * 200, "aa"),
    ]
    rows += [(100 + i, " ".join([*base[: 100 - i], *words(rng, i)]), "aa") for i in range(0, 60, 4)]
    rows += [(200 + i, " ".join([*base[:i], "y" * (i + 2), *base[i + 1 :]]), "aa") for i in range(50)]
    return [(a, b, c, "src0", None if b is None else len(b)) for a, b, c in rows]


def frame(spark, rows=None, schema=DOC_SCHEMA):
    return spark.createDataFrame(documents() if rows is None else rows, schema)


def with_extra(df):
    """df with columns whose names operators use inside."""
    from pyspark.sql import functions as F

    for name in ("class", "n", "token", "component", "owner", "length", "crc", "ids", "start", "query_id", "window", "pos", "u", "id"):
        df = df.withColumn(name, F.lit("clash"))
    return df
