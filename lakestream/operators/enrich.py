"""Fact ⋈ dimension enrichment with a size-checked broadcast and skew handling.

Join strategy, in order:

1. ``broadcast=True``: the caller vouches for the dimension's size; hint it.
2. ``broadcast="checked"`` (default): measure the dimension with one
   distributed aggregate (row count and row bytes) and broadcast it only when
   it is below ``max_broadcast_bytes``. A broadcast join never shuffles the
   facts, so a key holding a third of all facts costs nothing extra.
3. Otherwise a shuffle join on the key. With adaptive execution on, Spark
   still converts it to a broadcast join when the *measured* shuffle size of
   the dimension is small, and splits oversized (skewed) partitions of the
   facts. ``skew="split"`` instead finds the hot keys up front, in one pass,
   and spreads their facts over several tasks by a salt. Streams, where
   adaptive execution doesn't run, are always salted, on hot keys if they are
   known.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024
BROADCASTABLE_HOW = {"inner", "left", "left_outer", "leftouter", "left_semi", "leftsemi",
                     "semi", "left_anti", "leftanti", "anti"}

def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def drop_shared_columns(df: DataFrame, other: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Drop from ``df`` every column ``other`` also has, except the join keys.

    Used before a USING join so the other side's copy of a shared column wins
    and the result has no ambiguous names.
    """
    keep = set(_keys(key))
    shared = [c for c in df.columns if c in set(other.columns) and c not in keep]
    return df.drop(*shared)


@dataclass(frozen=True)
class SizeEstimate:
    rows: int
    bytes: int


def _variable_bytes(df: DataFrame) -> Column:
    parts = []
    for field in df.schema.fields:
        c = df[field.name]
        if isinstance(field.dataType, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(field.dataType, (StructType, ArrayType, MapType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)))
    if not parts:
        return F.lit(0).cast("long")
    return reduce(lambda a, b: a + b, [p.cast("long") for p in parts])


def estimate_size(df: DataFrame) -> SizeEstimate:
    """Rows and approximate in-memory bytes of ``df``, from one distributed pass.

    Bytes are 16 for each field and the length of strings, binaries and (as
    JSON) nested values. The pass is a plain aggregate (map-side partial sums).
    """
    fixed = 16 * len(df.columns)
    row = df.agg(F.count(F.lit(1)).alias("rows"),
                 F.sum(_variable_bytes(df)).alias("var")).first()
    rows = int(row["rows"] or 0)
    return SizeEstimate(rows=rows, bytes=rows * fixed + int(row["var"] or 0))


def fits_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """True when the measured size of ``df`` is within ``max_bytes``."""
    return estimate_size(df).bytes <= max_bytes


def hot_keys(facts: DataFrame, key: str | Sequence[str], share: float = 0.01) -> DataFrame:
    """Keys holding at least ``share`` of all facts: at most ``1 / share`` rows, from one pass over the facts."""
    keys = _keys(key)
    count, whole = (_free_name(n, facts) for n in ("_n", "_all"))
    counts = facts.select(*keys).groupingSets([[F.col(k) for k in keys], []], *keys).agg(
        F.count(F.lit(1)).alias(count), F.grouping_id().alias(whole))
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    # the row of all facts comes first; a key of so large a share is among the next 1 / share
    top = counts.where((F.col(whole) > 0) | known).orderBy(F.desc(count), F.desc(whole)).limit(
        math.floor(1 / share) + 1).collect()
    least = math.ceil(top[0][count] * share) if top else 0
    rows = [tuple(r[k] for k in keys) for r in top[1:] if r[count] >= least]
    return facts.sparkSession.createDataFrame(rows, facts.select(*keys).schema)


def _free_name(name: str, *dfs: DataFrame) -> str:
    """``name``, or one like it that no column of the frames has."""
    taken = {c.lower() for df in dfs for c in df.columns}
    while name in taken:
        name += "_"
    return name


def salted_join(facts: DataFrame, dim: DataFrame, key: str | Sequence[str], how: str = "inner",
                salts: int = 16, hot: DataFrame | None = None) -> DataFrame:
    """A shuffle join in which a key's facts meet in ``salts`` tasks instead of one.

    Each fact gets a salt by a hash of its other columns, and the dimension one
    row for each salt. ``hot`` (from :func:`hot_keys`) restricts that to those
    keys, so the rest of the dimension isn't multiplied; without it every key is
    salted, as in streams whose keys weren't counted. Facts with a NULL key
    match nothing and are spread likewise. The facts are read once.
    """
    keys = _keys(key)
    rest = [c for c in facts.columns if c not in keys]
    # not nullable, or a filter would compute it from all columns once more
    salt = F.coalesce(F.pmod(F.xxhash64(*rest), F.lit(salts)).cast("int"), F.lit(0)) if rest else F.lit(0)
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    salted, is_hot = (_free_name(n, facts, dim) for n in ("_salt", "_hot"))
    if hot is None:
        left, right = facts.withColumn(salted, salt), dim.withColumn(salted, F.explode(every))
    else:
        marked = F.broadcast(hot.select(*keys, F.lit(True).alias(is_hot)))
        null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        left = facts.join(marked, keys, "left").withColumn(
            salted, F.when(F.col(is_hot) | null, salt).otherwise(0)).drop(is_hot)
        right = dim.join(marked, keys, "left").withColumn(
            salted, F.explode(F.when(F.col(is_hot), every).otherwise(F.array(F.lit(0))))).drop(is_hot)
    return left.join(right, [*keys, salted], how).drop(salted)


def split_hot_join(facts: DataFrame, dim: DataFrame, key: str | Sequence[str], how: str = "inner",
                   hot_key_share: float = 0.01, salts: int = 16) -> DataFrame:
    """Join with the facts of hot keys spread over ``salts`` tasks each (see :func:`salted_join`).

    Keys are hot from ``hot_key_share`` of all facts up; one counting pass finds
    them. No row is dropped or sampled, and nothing but the hot keys is broadcast.
    """
    return salted_join(facts, dim, key, how, salts, hot_keys(facts, key, hot_key_share))


def enrich(facts: DataFrame, dim: DataFrame, key: str | Sequence[str], how: str = "inner",
           broadcast: bool | str = "checked",
           max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
           skew: str = "adaptive", hot_key_share: float = 0.01,
           drop_shared: bool = True, keep: str = "dimension", salts: int = 16,
           hot: DataFrame | None = None) -> DataFrame:
    """Join facts to a dimension on ``key`` (USING semantics, one key column).

    ``drop_shared`` removes a non-key column that both sides have from one of
    them: the facts, so the dimension's values win, or with ``keep="facts"``
    the dimension. ``broadcast``: ``True`` (the caller vouches for the size),
    ``"checked"`` (broadcast after measuring), ``False`` (never).
    ``skew``: ``"adaptive"`` (leave splitting to adaptive execution) or
    ``"split"`` (explicit hot-key split, see :func:`split_hot_join`).

    Either side may be a stream. A streaming dimension can't be measured or
    broadcast: the static facts are, in an inner join, if they are small
    enough. Adaptive execution doesn't run in streams, so a stream that is
    joined without a broadcast is salted: on the keys ``hot`` (see
    :func:`hot_keys`) if the caller knows them, else on every key, with
    ``salts`` copies of the dimension in each batch.
    """
    keys = _keys(key)
    if broadcast not in (True, False, "checked"):
        raise ValueError(f"broadcast must be True, False or 'checked', not {broadcast!r}")
    if keep not in ("dimension", "facts"):
        raise ValueError(f"keep must be 'dimension' or 'facts', not {keep!r}")
    if drop_shared and keep == "facts":
        dim = drop_shared_columns(dim, facts, keys)
    elif drop_shared:
        facts = drop_shared_columns(facts, dim, keys)
    if dim.isStreaming and not facts.isStreaming and how.lower() == "inner":
        names = [*keys, *[c for d in (facts, dim) for c in d.columns if c not in keys]]
        small = broadcast is True or broadcast == "checked" and fits_broadcast(facts, max_broadcast_bytes)
        joined = dim.join(F.broadcast(facts), keys) if small else salted_join(dim, facts, keys, "inner", salts)
        return joined.select(*names)
    can_broadcast = how.lower() in BROADCASTABLE_HOW and not dim.isStreaming
    if can_broadcast and broadcast is True:
        return facts.join(F.broadcast(dim), keys, how)
    if can_broadcast and broadcast == "checked" and fits_broadcast(dim, max_broadcast_bytes):
        return facts.join(F.broadcast(dim), keys, how)
    if skew == "split" and how.lower() in {"inner", "left", "left_outer", "leftouter"}:
        return split_hot_join(facts, dim, keys, how, hot_key_share, salts)
    if facts.isStreaming and not dim.isStreaming and how.lower() in {"inner", "left", "left_outer", "leftouter"}:
        return salted_join(facts, dim, keys, how, salts, hot)
    return facts.join(dim, keys, how)
