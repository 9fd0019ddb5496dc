"""Bounded samples of labelled documents, for fitting classifiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestream.llm._tables import written


def _known(labels: DataFrame, label_col: str, id_col: str) -> DataFrame:
    """``id``, ``label``: rows without an id or label don't count; an id labelled twice has its larger label."""
    return (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
            .dropna().groupBy("id").agg(F.max("label").alias("label")))


def class_shares(labels: DataFrame, label_col: str, per_class: int, id_col: str = "doc_id") -> dict[int, float]:
    """How many labelled ids one picked id of each class stands for in ``labelled_sample``."""
    total = _known(labels, label_col, id_col).where("label in (0, 1)").groupBy("label").agg(F.count("*").alias("n"))
    return {r["label"]: r["n"] / min(r["n"], per_class) for r in total.collect()}


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, per_class: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``text``, ``label``: at most ``per_class`` labelled ids of each class 0 and 1, by a hash of the id.

    One row of each id, the one whose text has the least hash. The picked ids
    are bounded, so they may be broadcast; of the documents only the sample is
    shuffled. It is written, as fitting reads it several times.
    """
    known = _known(labels, label_col, id_col)
    picked = reduce(DataFrame.unionAll, [
        known.where(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(per_class) for c in (0, 1)])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("hash"))
    least = rows.drop("text").join(F.broadcast(picked), "id").groupBy("id", "label").agg(F.min("hash").alias("hash"))
    least = written(least, "picked")
    # rows of an id with that hash are copies
    return written(rows.join(F.broadcast(least), ["id", "hash"]).groupBy("id", "label").agg(F.min("text").alias("text"))
                   .select("id", "text", "label"), "sample")
