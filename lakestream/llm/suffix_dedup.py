"""Suffix-array dedup: byte strings of a given length that start in two places are removed everywhere.

Distributed prefix doubling on a sparse suffix array. Every window of ``WINDOW``
byte positions has a sampled one (an anchor: the position whose 16-byte
fingerprint is least), so two equal strings of ``length`` bytes share the anchor
of their first window. Spark sorts (rank, rank further on, position) rows by
range and reranks over growing lengths; the rank of a length is the
fingerprint of so many bytes, and sorted neighbours tell whether it is unique
(128 bits decide that something repeats: two ranks of an anchor, two independent
fingerprints of a string):

1. The rank of the ``length - WINDOW + 1`` bytes from an anchor, which all its
   strings hold: a unique anchor has no repeated string and drops out. Second in
   the same order is the rank of everything that its strings cover together:
   where that repeats, all of them do, and the threshold is passed.
2. Anchors between the two are the ends of repeats. Their strings are ranked one
   by one at the full length, together with those of one anchor of each equal run
   that shares their core.

Sorting by range also splits a rank that very many positions share, as the
position is part of the order; only neighbours in the order are compared, so no
task holds the positions of a rank. What partition borders cut is joined up
from one row at each border. Matches never cross documents.

Results on odd rows: a null or empty text has no bytes; texts below ``length``
bytes have nothing removed; a repeated row repeats all of its strings; ids may
be null, repeated or of any type; an empty table gives an empty result; other
columns aren't carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestream.llm import _batches as B
from lakestream.llm._hashing import Prefix
from lakestream.llm._tables import free_name, key_of, keyed, written

LENGTH = 400
#: Positions among which one is sampled, and bytes of the fingerprint that picks it.
WINDOW, GRAM = 128, 16
#: Undecided anchors up to this number (16 bytes each) are broadcast to the texts; more are joined by a shuffle.
BROADCAST_ANCHORS = 2_000_000
ROWS = 1 << 16


def _sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over each run of ``size`` values."""
    have = 1
    while have < size and len(values):
        step = min(have, size - have)
        values = pick(values[:-step], values[step:]) if len(values) > step else values[:0]
        have += step
    return values


class Sampled:
    """Fingerprints and anchors of one text of at least ``length`` bytes."""

    def __init__(self, data: np.ndarray, window: int):
        self.prefix = Prefix(data)
        at = np.arange(len(data) - GRAM + 1)
        self.gram = self.prefix.hash(at, at + GRAM)
        self.least = _sliding(self.gram, window, np.minimum)
        wide = np.concatenate([np.zeros(window - 1, np.uint64), self.least, np.zeros(window - 1, np.uint64)])
        self.anchors = np.flatnonzero(self.gram == _sliding(wide, window, np.maximum))

    def owners(self, starts: np.ndarray) -> np.ndarray:
        """The anchor of each start: the first position of its window that has the least fingerprint."""
        at = np.searchsorted(self.anchors, starts)
        off = np.flatnonzero(self.gram[self.anchors[at]] != self.least[starts])
        while len(off):
            at[off] += 1
            off = off[self.gram[self.anchors[at[off]]] != self.least[starts[off]]]
        return self.anchors[at]


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64))


def _chunks(parts, names: list[str]):
    """Record batches of about ``ROWS`` rows from many small column tuples."""
    held, rows = [], 0
    for part in parts:
        held.append(part)
        rows += len(part[0])
        if rows >= ROWS:
            yield pa.RecordBatch.from_arrays([_longs(np.concatenate(c)) for c in zip(*held)], names=names)
            held, rows = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([_longs(np.concatenate(c)) for c in zip(*held)], names=names)


def _anchors(docs: DataFrame, length: int, window: int) -> DataFrame:
    def run(batches):
        def parts():
            for part in B.slices(batches, "text"):
                data, offsets = B.utf8(B.column(part, "text"))
                for key, a, b in zip(B.ints(part, "key").tolist(), offsets[:-1], offsets[1:]):
                    n = int(b - a)
                    if n >= length:
                        text = Sampled(data[a:b], window)
                        at = text.anchors
                        at = at[at + length - window + 1 <= n]
                        low = np.maximum(at - window + 1, 0)
                        # with the anchor's place in it, or two anchors near a text's ends had the same bytes around them
                        around = text.prefix.hash(low, np.minimum(at + length, n)) + (at - low).astype(np.uint64)
                        yield text.prefix.hash(at, at + length - window + 1), around, np.full(len(at), key), at

        yield from _chunks(parts(), ["core", "around", "key", "at"])

    return docs.mapInArrow(B.task(run), "core long, around long, key long, at long")


def _same_as_next(batches, ranks: list[str]):
    """Batches of a sorted partition with, for each of ``ranks``, masks: equal to the row before, to the row after.

    The last row is held back until the next batch; yields (batch, [(before, after)], first, last).
    """
    held, before, first = None, None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.concat_batches([held, batch.select(held.schema.names)])
        n = batch.num_rows
        masks = []
        for i, name in enumerate(ranks):
            value = B.ints(batch, name)
            equal = value[1:] == value[:-1]
            masks.append((np.append(False if before is None else before[i], equal), np.append(equal, False)))
        if n > 1:
            yield batch.slice(0, n - 1), [(b[:-1], a[:-1]) for b, a in masks], first, False
            first = False
        held, before = batch.slice(n - 1), [b[-1] for b, _ in masks]
    if held is not None:
        yield held, [(np.array([b]), np.array([False])) for b in before], first, True


def _judged_anchors(ranked: DataFrame) -> DataFrame:
    """Anchors whose core isn't unique. ``whole``: all their strings repeat; ``ranked``: their strings are to be ranked.

    Ranked are those that aren't whole, and of a run of equal whole ones that has
    a neighbour with its core one row, which stands for the run's strings. Rows
    at partition borders, whose neighbours aren't seen, are taken for both.
    """

    def run(batches):
        for batch, (core, around), first, last in _same_as_next(batches, ["core", "around"]):
            keep = core[0] | core[1]
            if first:
                keep[0] = True
            if last:
                keep[-1] = True
            same = around[0] & core[0], around[1] & core[1]
            whole = same[0] | same[1]
            ranked = ~whole | (core[0] & ~same[0]) | (core[1] & ~same[1])
            if first:
                ranked[0] = True
            if last:
                ranked[-1] = True
            at = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([B.column(batch, "key").take(at), B.column(batch, "at").take(at),
                                              pa.array(whole[keep]), pa.array(ranked[keep])],
                                             names=["key", "at", "whole", "ranked"])

    return ranked.repartitionByRange("core", "around", "key", "at").sortWithinPartitions(
        "core", "around", "key", "at").mapInArrow(B.task(run), "key long, at long, whole boolean, ranked boolean")


def _strings(docs: DataFrame, length: int, window: int) -> DataFrame:
    """The rank of every string whose anchor is undecided (``undecided``: a list of each text's), and its second fingerprint."""

    def run(batches):
        def parts():
            for part in B.slices(batches, "text"):
                data, offsets = B.utf8(B.column(part, "text"))
                lists = B.column(part, "undecided")
                for i, key in enumerate(B.ints(part, "key").tolist()):
                    own = data[offsets[i]:offsets[i + 1]]
                    if len(own) < length:
                        continue
                    text = Sampled(own, window)
                    open_ = np.zeros(len(own), bool)
                    open_[lists[i].values.to_numpy()] = True
                    starts = np.arange(len(own) - length + 1)
                    starts = starts[open_[text.owners(starts)]]
                    rank = text.prefix.hash(starts, starts + length)
                    del text
                    yield rank, Prefix(own, 1).hash(starts, starts + length), np.full(len(starts), key), starts

        yield from _chunks(parts(), ["rank", "proof", "key", "at"])

    return docs.mapInArrow(B.task(run), "rank long, proof long, key long, at long")


#: Kinds of rows of judged strings: repeated; alone at a partition border; a border's sign of more such rows.
_REPEATED, _ALONE, _SIGN = 0, 1, 2


def _judged_strings(ranked: DataFrame) -> DataFrame:
    def run(batches):
        sign, run_first = None, True
        for batch, (one, two), first, last in _same_as_next(batches, ["rank", "proof"]):
            rank, proof = B.ints(batch, "rank"), B.ints(batch, "proof")
            same = one[0] & two[0] | one[1] & two[1]
            kind = np.where(same, _REPEATED, -1)
            extra = []
            if first:
                if same[0]:
                    extra.append(0)
                else:
                    kind[0] = _ALONE
                sign = rank[0], proof[0]
            if last and not (first and len(rank) == 1):
                if not same[-1]:
                    kind[-1] = _ALONE
                elif (rank[-1], proof[-1]) != sign:
                    extra.append(len(rank) - 1)
            at = np.append(np.flatnonzero(kind >= 0), extra).astype(np.int64)
            kinds = np.append(kind[kind >= 0], np.full(len(extra), _SIGN)).astype(np.int32)
            rows = batch.take(pa.array(at))
            rank, proof = (pa.array(np.where(kinds == _REPEATED, 0, B.ints(rows, c))) for c in ("rank", "proof"))
            yield pa.RecordBatch.from_arrays([B.column(rows, "key"), B.column(rows, "at"), rank, proof, pa.array(kinds)],
                                             names=["key", "at", "rank", "proof", "kind"])

    order = "rank", "proof", "key", "at"
    judged = written(ranked.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        B.task(run), "key long, at long, rank long, proof long, kind int"), "strings")
    border = judged.where(F.col("kind") > 0)
    twice = border.groupBy("rank", "proof").agg(F.count("*").alias("n")).where("n > 1").select("rank", "proof")
    return judged.where(F.col("kind") == _REPEATED).select("key", "at").union(
        border.where(F.col("kind") == _ALONE).join(twice, ["rank", "proof"], "left_semi").select("key", "at"))


def covered(n: int, wholes: pa.Scalar, starts: pa.Scalar, length: int, window: int) -> np.ndarray:
    """Which of a text's ``n`` bytes its repeats cover."""
    step = np.zeros(n + 1, np.int32)
    for places, before in ((wholes, window - 1), (starts, 0)):
        if places.is_valid and len(places):
            at = places.values.to_numpy()
            np.add.at(step, np.maximum(at - before, 0), 1)
            np.add.at(step, np.minimum(at + length, n), -1)
    return np.cumsum(step[:-1]) > 0


def _packed(docs: DataFrame) -> DataFrame:
    """Texts as compressed bytes, which take less of a shuffle than what Spark's own compression makes of rows."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for part in B.slices(batches, "text"):
            data, offsets = B.utf8(B.column(part, "text"))
            own = memoryview(np.ascontiguousarray(data))
            yield pa.RecordBatch.from_arrays(
                [B.column(part, "id"), B.column(part, "key"),
                 pa.array([pack(own[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], pa.binary())],
                names=["id", "key", "packed"])

    return docs.mapInArrow(B.task(run), f"id {docs.schema['id'].dataType.simpleString()}, key long, packed binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   window: int = WINDOW) -> DataFrame:
    """Per row: the id, ``n_bytes``, ``n_removed``, ``spans`` (starts and ends of what is removed), ``kept`` (bytes)
    and ``text`` (these without the bytes of characters that a removal cut apart)."""
    docs = keyed(docs, id_col, text_col)
    return _removed(docs, _spans(docs, length, window), length, window, id_col)


def _spans(docs: DataFrame, length: int, window: int) -> DataFrame:
    """For each ``key`` that has repeats: anchors all of whose strings repeat (``wholes``), and single ``starts``."""
    # written first: a sort by range reads its input twice
    ranks = written(_anchors(docs.select("key", "text"), length, window), "ranks")
    anchors = written(_judged_anchors(ranks), "anchors")
    undecided = anchors.where("ranked")
    lists = undecided.groupBy("key").agg(F.collect_set("at").alias("undecided"))
    # a list is no longer than its text has anchors, so their number bounds what is broadcast
    few = undecided.limit(BROADCAST_ANCHORS + 1).count() <= BROADCAST_ANCHORS
    strings = _judged_strings(_strings(docs.join(F.broadcast(lists) if few else lists, "key").select("key", "text", "undecided"), length, window))
    places = anchors.where("whole").select("key", "at", F.lit(True).alias("whole")).union(
        strings.select("key", "at", F.lit(False)))
    return places.groupBy("key").agg(F.collect_list(F.expr("if(whole, at, null)")).alias("wholes"),
                                      F.collect_list(F.expr("if(whole, null, at)")).alias("starts"))


def _removed(docs: DataFrame, spans: DataFrame, length: int, window: int, id_col: str) -> DataFrame:
    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for part in B.slices([batch], "packed"):
                size, removed, edges, kept, texts = [], [], [], [], []
                columns = (B.column(part, c) for c in ("packed", "wholes", "starts"))
                for packed, wholes, starts in zip(*columns):
                    data = np.frombuffer(unpack.decompress(packed.as_py()), np.uint8)
                    n = len(data)
                    out = covered(n, wholes, starts, length, window)
                    turn = np.flatnonzero(np.diff(np.concatenate([[False], out, [False]]).astype(np.int8)))
                    size.append(n)
                    removed.append(int(out.sum()))
                    edges.append([{"start": int(a), "end": int(b)} for a, b in zip(turn[::2], turn[1::2])])
                    kept.append(data[~out].tobytes())
                    texts.append(kept[-1].decode("utf-8", "ignore"))
                yield pa.RecordBatch.from_arrays(
                    [B.column(part, "id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(edges, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     pa.array(kept, pa.binary()), pa.array(texts, pa.string())],
                    names=[id_col, "n_bytes", "n_removed", "spans", "kept", "text"])

    kind = docs.schema["id"].dataType.simpleString()
    return _packed(docs).join(spans, "key", "left").select("id", "packed", "wholes", "starts").mapInArrow(
        B.task(run), f"`{id_col}` {kind}, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary, text string")


def long_runs(data: np.ndarray, out: np.ndarray, min_words: int) -> np.ndarray:
    """``out`` without its runs that hold fewer words (parts of words count); words as in ``[^\\x20\\x09-\\x0D]+``."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    begins = ~space & np.append(True, space[:-1] | (out[1:] & ~out[:-1]))
    turn = np.flatnonzero(np.diff(np.concatenate([[False], out, [False]]).astype(np.int8)))
    words = np.append(0, np.cumsum(begins))
    step = np.zeros(len(out) + 1, np.int32)
    for a, b in zip(turn[::2], turn[1::2]):
        if words[b] - words[a] >= min_words:
            step[a] += 1
            step[b] -= 1
    return np.cumsum(step[:-1]) > 0


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                    window: int = WINDOW, min_words: int = 0) -> DataFrame:
    """The rows of ``docs`` with what is left of their texts; rows of whose text nothing is left go.

    Only runs of ``min_words`` words or more are removed: with a small ``length``
    this takes passages by their words, however many bytes those have. Bytes of
    characters that a removal cut apart go too. Other columns stay as they are.
    """
    key = key_of(docs, id_col, text_col)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), key.alias("key"))
    span_key, span_wholes, span_starts = (free_name(docs, f"span {c}") for c in ("key", "wholes", "starts"))
    spans = written(_spans(own, length, window), "spans").toDF(span_key, span_wholes, span_starts)
    cut = docs.join(spans, key == spans[span_key], "left").drop(span_key)
    names = docs.columns
    at = names.index(text_col)

    def run(batches):
        for part in B.slices(batches, text_col):
            texts, keep = B.column(part, text_col).to_pylist(), []
            wholes, starts = B.column(part, span_wholes), B.column(part, span_starts)
            for i, text in enumerate(texts):
                if wholes[i].is_valid:
                    data = np.frombuffer(text.encode(), np.uint8)
                    out = covered(len(data), wholes[i], starts[i], length, window)
                    if min_words:
                        out = long_runs(data, out, min_words)
                    texts[i] = data[~out].tobytes().decode("utf-8", "ignore")
                keep.append(not (wholes[i].is_valid and not texts[i]))
            columns = [B.column(part, c) for c in names]
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep))

    return cut.mapInArrow(B.task(run), docs.schema)
