"""Merkle manifest of a dataset: a leaf for each row, a tree for each group of rows, one root over their tops.

A leaf is the SHA-256 of a row's fields, each as ``-`` if null, else its length
in UTF-8 bytes, ``:`` and its value. A group's leaves ascend by id; every
``fanout`` neighbours (the last run may be shorter, even one) become the hash of
their digests in hexadecimal, until one is left. Those of all groups, in the
order of the groups, form the last tree. A proof lists the other members of the
run at each level from a leaf to the root.

Cogrouped subtree exchange: a superblock is ``fanout ** HEIGHT`` neighbours.
*Up*, each superblock is reduced to its top node, and tops are superblocked again
until every group has one node; a level is a ``HEIGHT``-th power smaller than the
one below. *Down*, each superblock is cogrouped with the one row of its top
node that holds the way from there to the root, so its nodes get theirs; the
last of these passes meets the leaves, rebuilds their subtree, joins inner and
outer proof and folds the checked leaves. A task holds one superblock at a time,
so a group with most of all rows only has more superblocks, and nothing but the
number of levels reaches the driver.

Results on odd rows: a null field is ``-`` in the leaf; a null group is a group
of its own, the first; null ids come first in their group; rows with the same id
are ordered by their leaves, and equal rows are equal leaves, each with a proof
of its own place; a lone row is the top of its group, and has an empty proof if
there is no other group. An empty table has no rows and no root. Other columns
don't count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestream.llm._order import running
from lakestream.llm._tables import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 2
#: Levels of a superblock: 1024 leaves for a fanout of 2.
HEIGHT = 10

_NODES = "tree string, pos long, n long, digest binary"
_WAYS = "tree string, pos long, way array<binary>, subroot binary, root binary"


def leaf_digest(values: Sequence[Column]) -> Column:
    """The leaf of a row with these fields, as 32 bytes."""
    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def parent(digests: Sequence[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def climb(nodes: list[str], n: int, fanout: int, height: int) -> list[list[str]]:
    """The levels of a superblock up to its top node; its tree has ``n`` nodes at the first of them."""
    levels = [nodes]
    while n > 1 and len(levels) <= height:
        below = levels[-1]
        levels.append([parent(below[i:i + fanout]) for i in range(0, len(below), fanout)])
        n = -(-n // fanout)
    return levels


def inner_way(levels: list[list[str]], at: int, fanout: int) -> list[bytes]:
    """For each level below the top: the node's place in its run (one byte) and the run's other digests."""
    way = []
    for nodes in levels[:-1]:
        first = at - at % fanout
        run = nodes[first:first + fanout]
        way.append(bytes([at - first]) + bytes.fromhex("".join(run[:at - first] + run[at - first + 1:])))
        at //= fanout
    return way


def siblings(step: bytes) -> list[str]:
    return [step[i:i + 32].hex() for i in range(1, len(step), 32)]


def fold(digest: str, way: Sequence[bytes]) -> str:
    """The root that a digest and its way lead to."""
    for step in way:
        run = siblings(step)
        run.insert(step[0], digest)
        digest = parent(run)
    return digest


def _hexes(column: pd.Series) -> list[str]:
    return [bytes(d).hex() for d in column]


def _tops(nodes: DataFrame, fanout: int, height: int) -> DataFrame:
    """The top node of each superblock."""
    size = fanout ** height

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        n = int(block["n"].iloc[0])
        top = climb(_hexes(block["digest"]), n, fanout, height)[-1][0]
        return pd.DataFrame({"tree": block["tree"].iloc[:1].tolist(), "pos": [int(block["pos"].iloc[0]) // size],
                             "n": [-(-n // size)], "digest": [bytes.fromhex(top)]})

    return nodes.groupBy("tree", F.expr(f"pos div {size}").alias("block")).applyInPandas(run, _NODES)


def _levels(nodes: DataFrame, fanout: int, height: int) -> list[DataFrame]:
    """``nodes`` and the tops above them, up to the level where every tree has one node."""
    levels = [nodes]
    while (nodes.agg(F.max("n")).first()[0] or 0) > 1:
        nodes = written(_tops(nodes, fanout, height), "merkle-tops")
        levels.append(nodes)
    return levels


def _by_block(nodes: DataFrame, ways: DataFrame, size: int):
    return (nodes.withColumn("block", F.expr(f"pos div {size}")).groupBy("tree", "block")
            .cogroup(ways.withColumnRenamed("pos", "block").groupBy("tree", "block")))


def _down(levels: list[DataFrame], ways: DataFrame, fanout: int, height: int) -> DataFrame:
    """From the ways of the last level's nodes to those of the first level's; no levels: the ways are those asked for."""
    def run(block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        own = climb(_hexes(block["digest"]), int(block["n"].iloc[0]), fanout, height)
        rest = list(outer["way"].iloc[0])
        n = len(block)
        return pd.DataFrame({"tree": block["tree"].tolist(), "pos": block["pos"].tolist(),
                             "way": [inner_way(own, i, fanout) + rest for i in range(n)],
                             "subroot": outer["subroot"].tolist() * n, "root": outer["root"].tolist() * n})

    for nodes in levels[-2::-1]:
        ways = written(_by_block(nodes, ways, fanout ** height).applyInPandas(run, _WAYS), "merkle-ways")
    return ways


def _subroot_ways(tops: DataFrame, fanout: int, height: int) -> DataFrame:
    """The root over the trees' top nodes, and the way of each to it."""
    order = running(tops.select(F.lit("").alias("whole"), "tree", "digest", F.lit(1).cast("long").alias("one")),
                    "whole", ["tree"], "one", "merkle-trees")
    order = written(order.select("tree", "digest", F.col("before").alias("pos"), F.col("total").alias("n")), "merkle-roots")
    levels = _levels(order.select(F.lit("").alias("tree"), "pos", "n", "digest"), fanout, height)
    ways = levels[-1].select("tree", "pos", F.array().cast("array<binary>").alias("way"), F.col("digest").alias("subroot"),
                             F.col("digest").alias("root"))
    ways = _down(levels, ways, fanout, height).withColumnRenamed("tree", "whole")
    return ways.join(order.select("pos", F.col("tree"), F.col("digest").alias("own")), "pos").select(
        "tree", F.lit(0).cast("long").alias("pos"), "way", F.col("own").alias("subroot"), "root")


def merkle_manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: Sequence[str] = FIELDS,
                    checked: Mapping[str, Column] | None = None, fanout: int = FANOUT, height: int = HEIGHT) -> DataFrame:
    """Per row: its id, ``leaf``, ``subroot`` and ``root``, ``proof`` and ``proof_sha256``, ``folded_root``, ``verified``.

    The tree is that of ``docs``. ``checked`` gives other values of some fields,
    such as those of a copy to be tested: the leaf of those is folded with the
    proof of the original one, and ``verified`` tells whether it leads to the root.
    ``proof`` has for each level the row's place in its run, as a byte, and the
    run's other digests, 32 bytes each; ``proof_sha256`` is the hash of all of
    them in hexadecimal, from the leaf to the root.
    """
    checked = checked or {}
    kind = docs.schema[id_col].dataType.simpleString()
    size = fanout ** height
    own = leaf_digest([F.col(f) for f in fields])
    other = leaf_digest([checked.get(f, F.col(f)) for f in fields]) if checked else own
    tree = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    leaves = written(docs.select(F.col(id_col).alias("id"), tree.alias("tree"), own.alias("digest"), other.alias("checked"),
                                 F.monotonically_increasing_id().alias("row"), F.lit(1).cast("long").alias("one")), "merkle-leaves")
    placed = running(leaves, "tree", ["id", "digest", "checked", "row"], "one", "merkle-order")
    # ids as text: a null among them would turn the others into floating point numbers in pandas
    nodes = placed.select(F.col("id").cast("string").alias("id"), "tree", F.col("before").alias("pos"),
                          F.col("total").alias("n"), "digest", "checked")

    levels = _levels(nodes.select("tree", "pos", "n", "digest"), fanout, height)
    ways = _down(levels[1:], _subroot_ways(levels[-1], fanout, height), fanout, height)

    def run(block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        digests, claims = _hexes(block["digest"]), _hexes(block["checked"])
        inner = climb(digests, int(block["n"].iloc[0]), fanout, height)
        rest = [bytes(s) for s in outer["way"].iloc[0]]
        subroot, root = bytes(outer["subroot"].iloc[0]).hex(), bytes(outer["root"].iloc[0]).hex()
        ways = [inner_way(inner, i, fanout) + rest for i in range(len(block))]
        folded = [fold(c, w) for c, w in zip(claims, ways)]
        return pd.DataFrame({"id": block["id"].tolist(), "leaf": digests, "subroot": subroot, "root": root, "proof": ways,
                             "proof_sha256": [parent([s for step in w for s in siblings(step)]) for w in ways],
                             "folded_root": folded, "verified": np.array(folded, object) == root})

    found = _by_block(nodes, ways, size).applyInPandas(
        run, "id string, leaf string, subroot string, root string, proof array<binary>, proof_sha256 string,"
             " folded_root string, verified boolean")
    return found.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)
