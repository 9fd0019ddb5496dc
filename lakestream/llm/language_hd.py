"""Language ID by hyperdimensional profiles.

Each letter has a random vector of +1 and -1 (made from its code point alone).
A trigram binds its letters: the product of the first one's vector rotated
twice, the second's rotated once and the third's. A document is the sum of its
trigram vectors, a language the sum of those of its training documents; the
language whose prototype has the largest cosine with the document is predicted.

Letters are lower-cased; anything between letters counts as one blank, with a
vector of its own. Whole texts count, for training and prediction.

Results on odd rows: a null text or one without a letter gives ``und`` and
score 0; so does every text when nothing was learned; equal cosines go to the
first language by name; repeated rows each get their row (and count for
training each time); an empty table gives an empty result; other input columns
aren't carried, so their names can't clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestream.llm import _batches as B

DIM = 1024
UNKNOWN = "und"
#: Rows of a slice: a trigram's key has 10 bits for the document and 18 for each letter.
ROWS, _LETTER = 512, 18
#: Trigram vectors a task keeps (DIM bytes each); others are bound anew when they come up.
KEEP = 1 << 16


class Space:
    """Letter vectors, and the trigram vectors met so far."""

    def __init__(self, dim: int = DIM):
        self.dim = dim
        self.symbol = np.full(0x110000, -1, np.int32)  # dense number of a code point; 0: no letter
        self.points: list[int] = [0]
        self.letters = np.zeros((0, dim), np.int8)
        self.kept: dict[int, int] = {}
        self.vectors = np.zeros((0, dim), np.int8)

    def symbols(self, text: str) -> np.ndarray:
        point = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        out = self.symbol[point]
        if out.size and out.min() < 0:
            for p in np.unique(point[out < 0]):
                low = chr(p).lower()[0] if chr(p).isalpha() else ""
                if low and self.symbol[ord(low)] < 0:
                    self.points.append(ord(low))
                    self.symbol[ord(low)] = len(self.points) - 1
                self.symbol[p] = self.symbol[ord(low)] if low else 0
            out = self.symbol[point]
        return out

    def _bind(self, keys: np.ndarray) -> np.ndarray:
        if len(self.letters) < len(self.points):
            new = [np.random.default_rng([11, p]).integers(0, 2, self.dim, np.int8) * 2 - 1
                   for p in self.points[len(self.letters):]]
            self.letters = np.concatenate([self.letters, np.array(new, np.int8)])
        mask = (1 << _LETTER) - 1
        a, b, c = keys >> (2 * _LETTER), (keys >> _LETTER) & mask, keys & mask
        return np.roll(self.letters[a], 2, 1) * np.roll(self.letters[b], 1, 1) * self.letters[c]

    def bound(self, keys: np.ndarray) -> np.ndarray:
        """Vectors of distinct trigrams."""
        at = np.fromiter((self.kept.get(k, -1) for k in keys.tolist()), np.int64, len(keys))
        new = np.flatnonzero(at < 0)
        if len(new) and len(self.kept) + len(new) <= KEEP:
            have = len(self.kept)
            if len(self.vectors) < have + len(new):
                grown = np.zeros((min(KEEP, max(1024, 2 * (have + len(new)))), self.dim), np.int8)
                grown[:have] = self.vectors[:have]
                self.vectors = grown
            at[new] = np.arange(have, have + len(new))
            self.vectors[at[new]] = self._bind(keys[new])
            self.kept.update(zip(keys[new].tolist(), at[new].tolist()))
            new = new[:0]
        out = self.vectors[at]
        if len(new):
            out[new] = self._bind(keys[new])
        return out

    def trigrams(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, key and count of each distinct trigram that has a letter."""
        whole = "".join([f"\0{t or ''}\0" for t in texts])
        symbol = self.symbols(whole)
        size = np.array([len(t or "") + 2 for t in texts], np.int64)
        doc = np.repeat(np.arange(len(texts)), size)
        # a run of blanks is one blank; a document begins and ends with one
        keep = (symbol != 0) | np.append(True, (symbol[:-1] != 0) | (doc[1:] != doc[:-1]))
        symbol, doc = symbol[keep].astype(np.int64), doc[keep]
        if len(symbol) < 3:
            return doc[:0], symbol[:0], symbol[:0]
        key = (symbol[:-2] << (2 * _LETTER)) | (symbol[1:-1] << _LETTER) | symbol[2:]
        fine = (doc[2:] == doc[:-2]) & (key != 0)
        full, count = np.unique((doc[:-2][fine] << (3 * _LETTER)) | key[fine], return_counts=True)
        return full >> (3 * _LETTER), full & ((1 << (3 * _LETTER)) - 1), count


_spaces: dict[int, Space] = {}


def space(dim: int) -> Space:
    return _spaces.setdefault(dim, Space(dim))


def _rows(batches, text: str):
    for part in B.slices(batches, text):
        for at in range(0, part.num_rows, ROWS):
            yield part.slice(at, ROWS)


@dataclass
class Profiles:
    languages: list[str]
    vectors: np.ndarray  # a prototype of unit length for each


def fit_profiles(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", dim: int = DIM) -> Profiles:
    """Bundles all given documents by language (a null language teaches nothing).

    Each task adds up its own documents, so what is shuffled and collected has
    ``dim`` numbers a language, however many documents there are.
    """

    def run(batches):
        own, sums = space(dim), {}
        for part in _rows(batches, "text"):
            doc, key, count = own.trigrams(B.column(part, "text").to_pylist())
            lang = B.column(part, "lang").to_pylist()
            names = sorted(set(lang))
            of = np.array([names.index(x) for x in lang], np.int64)[doc]
            keys, at = np.unique(key, return_inverse=True)
            for i, name in enumerate(names):
                mine = of == i
                weight = np.bincount(at[mine], count[mine], len(keys))
                used = np.flatnonzero(weight)
                sums[name] = sums.get(name, 0) + _product(weight[used][None, :], own, keys[used])[0]
        for name, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * dim), pa.array(np.arange(dim, dtype=np.int32)), pa.array(np.rint(total).astype(np.int64))],
                names=["lang", "at", "value"])

    parts = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna().mapInArrow(
        B.task(run), "lang string, at int, value long")
    got = parts.groupBy("lang", "at").agg(F.sum("value").alias("value")).toArrow()
    rows: dict[str, np.ndarray] = {}
    for name, at, value in zip(*(got.column(c).to_pylist() for c in ("lang", "at", "value"))):
        rows.setdefault(name, np.zeros(dim))[at] = value
    names = sorted(n for n, v in rows.items() if v.any())
    vectors = np.array([rows[n] / np.linalg.norm(rows[n]) for n in names]).reshape(-1, dim)
    return Profiles(names, vectors)


def _product(counts: np.ndarray, own: Space, keys: np.ndarray) -> np.ndarray:
    """Sums of trigram vectors, some thousand trigrams at a time."""
    out = np.zeros((len(counts), own.dim))
    for at in range(0, len(keys), 4096):
        out += counts[:, at:at + 4096].astype(np.float32) @ own.bound(keys[at:at + 4096]).astype(np.float32)
    return out


def predict_language(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``lang_pred`` and ``score``, the cosine with that language (0 to 1)."""
    dim = profiles.vectors.shape[1] if len(profiles.languages) else DIM

    def run(batches):
        own = space(dim)
        for part in _rows(batches, "text"):
            n = part.num_rows
            doc, key, count = own.trigrams(B.column(part, "text").to_pylist())
            keys, at = np.unique(key, return_inverse=True)
            cosine = np.zeros((n, max(1, len(profiles.languages))))
            for low in range(0, n, 64):  # so many rows of counts at a time
                lo, hi = np.searchsorted(doc, [low, low + 64])
                counts = np.zeros((min(64, n - low), len(keys)), np.float32)
                counts[doc[lo:hi] - low, at[lo:hi]] = count[lo:hi]
                used = np.flatnonzero(counts.any(0))
                vector = _product(counts[:, used], own, keys[used])
                length = np.maximum(np.linalg.norm(vector, axis=1, keepdims=True), 1e-9)
                if len(profiles.languages):
                    cosine[low:low + 64] = vector / length @ profiles.vectors.T
            best = cosine.argmax(1)
            known = (np.bincount(doc, minlength=n) > 0) & bool(profiles.languages)
            yield pa.RecordBatch.from_arrays(
                [B.column(part, "id"),
                 pa.array([profiles.languages[b] if k else UNKNOWN for b, k in zip(best, known)], pa.string()),
                 pa.array(np.where(known, np.clip(cosine.max(1), 0, 1), 0.0))],
                names=[id_col, "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        B.task(run), f"`{id_col}` {kind}, lang_pred string, score double")
