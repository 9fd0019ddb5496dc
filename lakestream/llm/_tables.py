"""Intermediate tables in the cluster's shared folder, and connected components over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestream.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared checkpoint folder and read back: lost executors can't lose them."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or one like it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def plain_ids(docs: DataFrame, id_col: str) -> bool:
    """Whether ids are integers, none null or repeated."""
    if dict(docs.dtypes)[id_col] not in ("bigint", "int", "smallint", "tinyint"):
        return False
    ids = docs.select(F.col(id_col).alias("id"))
    return ids.groupBy("id").agg(F.count("*").alias("n")).where("id is null or n > 1").isEmpty()


def key_of(docs: DataFrame, id_col: str, text_col: str) -> F.Column:
    """A key of each row: its id where ids are plain (``plain_ids``), else a hash of id and text."""
    return F.col(id_col).cast("long") if plain_ids(docs, id_col) else F.xxhash64(id_col, text_col)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``text`` and ``key``."""
    key = key_of(docs, id_col, text_col)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), key.alias("key"))


def near(df: DataFrame, rows: int) -> DataFrame:
    """``df``, to be broadcast if it has at most ``rows`` rows (counted first); else joins shuffle it."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def components(links: DataFrame) -> DataFrame:
    """``id``, ``label``: the least id that links (``a``, ``b``) lead to, for each id with a link.

    Each round gives every id the least label among its neighbours and then its
    label's label, so chains shrink by more than half; ends when nothing changes.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = (both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near")))
        moved = labels.join(near, labels["id"] == near["a"], "left").select(
            "id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        above = labels.select(F.col("id").alias("of"), F.col("label").alias("next"))
        new = written(moved.join(above, moved["label"] == above["of"], "left").select(
            "id", "old", F.least("label", F.coalesce("next", "label")).alias("label")), "labels")
        if new.where("label <> old").isEmpty():
            return new.select("id", "label")
        labels = new.select("id", "label")
