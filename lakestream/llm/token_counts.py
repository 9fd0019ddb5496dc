"""Token counts under edits: a segment tree of pre-token blocks for each document.

A text is cut into leaves of some hundred characters, only where the splitting
pattern must begin a new pre-token whatever stands around: at a blank between
two characters that aren't white space. Tokens never cross pre-tokens, so a
document's count is the sum of its leaves' counts. The tree over the leaves
holds sums of characters and tokens of every subtree.

An edit finds its leaves by descending the character sums. Only the text of
these leaves is encoded again, with as many neighbours as it takes until both
borders are cuts again; then the sums above them are updated. If the number of
leaves changes, sums are added up anew, without encoding anything.

Results on odd rows: a null text counts as empty (0 tokens); an empty or null
list of edits changes nothing; edits apply in order, each to the text that the
one before left; positions and lengths beyond the text are cut to it; null
inserts are empty; repeated rows each get their row; an empty table gives an
empty result; other columns aren't carried.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestream.llm import _batches as B
from lakestream.llm._ranks import encoding

#: Characters of a leaf, about; one leaf that an edit leaves larger than LARGE times that is split.
LEAF, LARGE = 512, 4
EDITS = "array<struct<at: long, cut: long, put: string>>"


def is_cut(text: str, at: int) -> bool:
    """Whether a pre-token begins at this place whatever else the text holds."""
    return (0 < at < len(text) - 1 and text[at] == " "
            and not text[at - 1].isspace() and not text[at + 1].isspace())


def split(text: str, size: int = LEAF) -> list[str]:
    """Leaves of at least ``size`` characters (but for the last), which end at cuts."""
    out, begin = [], 0
    while begin < len(text):
        at = text.find(" ", begin + size)
        while at >= 0 and not is_cut(text, at):
            at = text.find(" ", at + 1)
        end = at if at >= 0 else len(text)
        out.append(text[begin:end])
        begin = end
    return out or [""]


class Tree:
    """Sums over leaves: ``sums[1]`` is the total, ``sums[k]`` that of nodes 2k and 2k + 1, leaves stand last."""

    def __init__(self, values: list[int]):
        self.first = 1 << max(0, (len(values) - 1).bit_length())
        self.sums = [0] * (2 * self.first)
        self.sums[self.first:self.first + len(values)] = values
        for k in range(self.first - 1, 0, -1):
            self.sums[k] = self.sums[2 * k] + self.sums[2 * k + 1]

    def set(self, leaf: int, value: int) -> None:
        k = leaf + self.first
        by = value - self.sums[k]
        while k:
            self.sums[k] += by
            k >>= 1

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds a place, and the place in it (the last leaf's end for the end of all)."""
        k = 1
        while k < self.first:
            k *= 2
            if place >= self.sums[k] and self.sums[k + 1]:
                place -= self.sums[k]
                k += 1
        return k - self.first, place

    def before(self, leaf: int) -> int:
        """The sum of all leaves before one."""
        k, out = leaf + self.first, 0
        while k > 1:
            if k & 1:
                out += self.sums[k - 1]
            k >>= 1
        return out


class CountedText:
    """A text with trees of characters and tokens over its leaves; ``encoded``: characters encoded so far."""

    def __init__(self, text: str, count: Callable[[str], int], tokens: list[int] | None = None,
                 chars: list[int] | None = None):
        self.text, self.count, self.encoded = text, count, 0
        if tokens is None:
            leaves = split(text)
            chars, tokens = [len(x) for x in leaves], [self._count(x) for x in leaves]
        self._build(list(chars), list(tokens))

    def _build(self, chars: list[int], tokens: list[int]) -> None:
        self.n, self.chars, self.tokens = len(chars), Tree(chars), Tree(tokens)

    def _count(self, text: str) -> int:
        self.encoded += len(text)
        return self.count(text)

    def leaves(self, tree: Tree) -> list[int]:
        return tree.sums[tree.first:tree.first + self.n]

    def edit(self, at: int, cut: int, put: str) -> None:
        """Takes out ``cut`` characters at a place and puts others there."""
        at = min(max(at, 0), len(self.text))
        cut = min(max(cut, 0), len(self.text) - at)
        low, inside = self.chars.find(at)
        high, _ = self.chars.find(at + cut)
        begin = at - inside
        end = self.chars.before(high) + self.chars.sums[high + self.chars.first]
        self.text = text = self.text[:at] + put + self.text[at + cut:]
        end += len(put) - cut
        while low and not is_cut(text, begin):
            low -= 1
            begin -= self.chars.sums[low + self.chars.first]
        while high < self.n - 1 and not is_cut(text, end):
            high += 1
            end += self.chars.sums[high + self.chars.first]
        if low == high and end - begin <= LARGE * LEAF:
            self.chars.set(low, end - begin)
            self.tokens.set(low, self._count(text[begin:end]))
            return
        # cuts inside are judged with the neighbouring characters, as at the borders
        new, chars, tokens = split(text[begin:end]), self.leaves(self.chars), self.leaves(self.tokens)
        chars[low:high + 1] = map(len, new)
        tokens[low:high + 1] = map(self._count, new)
        self._build(chars, tokens)


def token_trees(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                edits_col: str | None = None) -> DataFrame:
    """Per row: the id, ``text``, ``n_tokens``, ``leaf_chars`` and ``leaf_tokens``; ``edits`` if a column is named."""
    edits = F.col(edits_col).cast(EDITS) if edits_col else F.lit(None).cast(EDITS)

    def run(batches):
        encode = encoding(ranks_path, pattern).encode_ordinary
        for part in B.slices(batches, "text"):
            texts = [x or "" for x in B.column(part, "text").to_pylist()]
            found = [CountedText(x, lambda piece: len(encode(piece))) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [B.column(part, "id"), pa.array(texts, pa.string()), pa.array([x.tokens.sums[1] for x in found], pa.int64()),
                 pa.array([x.leaves(x.chars) for x in found], pa.list_(pa.int32())),
                 pa.array([x.leaves(x.tokens) for x in found], pa.list_(pa.int32())), B.column(part, "edits")],
                names=[id_col, "text", "n_tokens", "leaf_chars", "leaf_tokens", "edits"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), edits.alias("edits")).mapInArrow(
        B.task(run), f"`{id_col}` {kind}, text string, n_tokens long, leaf_chars array<int>, leaf_tokens array<int>, edits {EDITS}")


def apply_edits(trees: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """``trees`` after the edits of their ``edits`` column, with ``n_tokens_before`` and ``encoded_chars``, which
    says how much text had to be encoded for that; ``edits`` is empty then."""

    def run(batches):
        encode = encoding(ranks_path, pattern).encode_ordinary
        for part in B.slices(batches, "text"):
            found = []
            columns = (B.column(part, c).to_pylist() for c in ("text", "leaf_tokens", "leaf_chars", "edits"))
            for text, tokens, chars, edits in zip(*columns):
                own = CountedText(text, lambda piece: len(encode(piece)), tokens, chars)
                for e in edits or ():
                    if e is not None:
                        own.edit(e["at"] or 0, e["cut"] or 0, e["put"] or "")
                found.append(own)
            yield pa.RecordBatch.from_arrays(
                [B.column(part, "id"), pa.array([x.text for x in found], pa.string()),
                 pa.array([x.tokens.sums[1] for x in found], pa.int64()),
                 pa.array([x.leaves(x.chars) for x in found], pa.list_(pa.int32())),
                 pa.array([x.leaves(x.tokens) for x in found], pa.list_(pa.int32())),
                 pa.array([None] * len(found), B.column(part, "edits").type),
                 B.column(part, "n_tokens"), pa.array([x.encoded for x in found], pa.int64())],
                names=[id_col, "text", "n_tokens", "leaf_chars", "leaf_tokens", "edits", "n_tokens_before", "encoded_chars"])

    kind = trees.schema[id_col].dataType.simpleString()
    return trees.withColumnRenamed(id_col, "id").mapInArrow(B.task(run), f"`{id_col}` {kind}, text string, n_tokens long, leaf_chars array<int>, "
                                 f"leaf_tokens array<int>, edits {EDITS}, n_tokens_before long, encoded_chars long")
