"""Token-ID output: best-fit-decreasing packing of documents into rows of a fixed length.

Documents become token ids with a separator after each; what is longer than a
row is split losslessly into full rows and a rest. Pieces are packed longest
first, each into the row with the least room that still takes it; a segment tree
over the possible amounts of room finds that in logarithmic time. Every task
packs the documents of its partition in groups of bounded token counts, so
memory is bounded by the group and nothing is shuffled.

A packed row has ``length`` ids (little-endian, two bytes if the vocabulary
allows, else four; unused places hold ``PAD``), the cumulative lengths of its
segments from 0 (``cu_seqlens``, as attention kernels take them), and the
position ids, which start at 0 again with every segment.

Results on odd rows: a null or empty text gives its separator alone; repeated
rows and ids are packed each; an empty table gives no row; other columns aren't
carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestream.llm import _batches as B
from lakestream.llm._ranks import encoding

LENGTH = 2048
#: Tokens that are packed together.
GROUP_TOKENS = 2 << 20
PAD = 0


class Room:
    """A segment tree over amounts of room 0 to ``size``: which amounts have an open row."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.any = [0] * (2 * self.leaves)  # open rows with an amount below each node
        self.rows: list[list[int]] = [[] for _ in range(self.leaves)]

    def add(self, amount: int, row: int) -> None:
        self.rows[amount].append(row)
        self._count(amount, 1)

    def _count(self, amount: int, by: int) -> None:
        node = amount + self.leaves
        while node:
            self.any[node] += by
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """A row of the smallest amount of room from ``least`` up, and that amount."""
        node = least + self.leaves
        if not self.any[node]:
            # up until a right neighbour has something, then down to its first
            while node & 1 or not self.any[node + 1]:
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        amount = node - self.leaves
        row = self.rows[amount].pop()
        self._count(amount, -1)
        return row, amount


def best_fit_decreasing(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Rows, each a list of places of ``sizes`` (1 to ``length``) in the order they were put in."""
    room, rows = Room(length), []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        found = room.take(size)
        if found is None:
            found = len(rows), length
            rows.append([])
        row, amount = found
        rows[row].append(i)
        if amount > size:
            room.add(amount - size, row)
    return rows


def pack_tokens(docs: DataFrame, ranks_path: str, pattern: str, separator: int, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Packed rows of the rank file's token ids, ``separator`` after each document: ``group`` and ``row`` (its place), ``ids``, ``cu_seqlens``, ``positions``, ``n_tokens`` used,
    and for each segment the document's id (``segment_ids``) and where it starts in the document (``segment_starts``)."""
    kind = docs.schema[id_col].dataType

    def run(batches):
        encode = encoding(ranks_path, pattern).encode_ordinary
        wide = "<u2" if max(separator, encoding(ranks_path, pattern).max_token_value) < 1 << 16 else "<u4"
        ids, tokens, group, total = [], [], 0, 0

        def packed():
            size = np.array([len(t) for t in tokens], np.int64)
            parts = -(-size // length)
            of = np.repeat(np.arange(len(size)), parts)
            at = (np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)) * length
            sizes = np.minimum(size[of] - at, length)
            rows = best_fit_decreasing(sizes, length)
            for low in range(0, len(rows), 256):
                some = rows[low:low + 256]
                matrix = np.full((len(some), length), PAD, wide)
                places = np.zeros((len(some), length), wide)
                ends = []
                for r, pieces in enumerate(some):
                    to = 0
                    edge = [0]
                    for p in pieces:
                        n = int(sizes[p])
                        matrix[r, to:to + n] = tokens[of[p]][at[p]:at[p] + n]
                        places[r, to:to + n] = np.arange(n)
                        to += n
                        edge.append(to)
                    ends.append(edge)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([group] * len(some), pa.int64()), pa.array(range(low, low + len(some)), pa.int64()),
                     pa.array([m.tobytes() for m in matrix], pa.binary()), pa.array(ends, pa.list_(pa.int32())),
                     pa.array([m.tobytes() for m in places], pa.binary()), pa.array([e[-1] for e in ends], pa.int32()),
                     pa.array([[ids[of[p]] for p in pieces] for pieces in some], pa.list_(id_type)),
                     pa.array([[int(at[p]) for p in pieces] for pieces in some], pa.list_(pa.int64()))],
                    names=["group", "row", "ids", "cu_seqlens", "positions", "n_tokens", "segment_ids", "segment_starts"])

        id_type = pa.int64()
        for part in B.slices(batches, "text"):
            id_type = B.column(part, "id").type
            for key, text in zip(B.column(part, "id").to_pylist(), B.column(part, "text").to_pylist()):
                ids.append(key)
                tokens.append(np.array([*encode(text or ""), separator], wide))
                total += len(tokens[-1])
                if total >= group_tokens:
                    yield from packed()
                    ids, tokens, group, total = [], [], group + 1, 0
        if tokens:
            yield from packed()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        B.task(run), "group long, row long, ids binary, cu_seqlens array<int>, positions binary, n_tokens int, "
             f"segment_ids array<{kind.simpleString()}>, segment_starts array<long>")
    # groups are numbered in each partition; the partition makes them unique
    return rows.withColumn("group", F.col("group") + F.spark_partition_id().cast("long") * F.lit(1 << 32))


def write_packed(packed: DataFrame, folder: str) -> None:
    """The rows of ``pack_tokens`` as Parquet files in a shared folder, written by Spark's tasks."""
    packed.write.mode("errorifexists").parquet(folder)
