"""Small documents with every odd row, and plain forms of what operators share."""

from __future__ import annotations

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    # names that operators use inside
    T.StructField("id", T.StringType()), T.StructField("key", T.StringType()), T.StructField("label", T.StringType())])


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang)."""
    return spark.createDataFrame([(*r, None)[:3] + ("x", "y", "z") for r in rows], SCHEMA)


def long_text(n: int, seed: int = 0) -> str:
    import random

    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abcdefghijklmnop") for _ in range(pick.randint(2, 9))) for _ in range(n))


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "é"), (5, "a"), (6, "same words here and there, twice over"),
       (7, "same words here and there, twice over"), (None, "no id at all, but words"), (None, None),
       (8, long_text(30_000, 8)), (9, "\x00\x1f odd   marks 😀 İ ΑΣ"), (6, "same words here and there, twice over")]
