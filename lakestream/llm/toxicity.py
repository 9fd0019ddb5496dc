"""Toxicity: cumulative-link ordinal regression on sparse text features.

P(grade >= k) = sigmoid(w . x - threshold_k) for every grade k, with one
weight vector shared by all (ordered) thresholds. Features are words and word
beginnings of 4 to 6 letters, valued log(1 + count). The expected severity is
the sum of these probabilities; a text with P(grade >= 1) >= 1/2 and at least
one marked feature is rejected (the labels' shares alone reject nothing).

Labels say toxic or not. The grades of the sample's toxic texts come from how
many of their words are marked ones (telling features of toxic texts): fewer
than a third, two thirds or all of the toxic texts of the sample have so many.

Fitted on a bounded sample of labelled documents (``PER_CLASS``) and
``FEATURES`` features; a sampled document weighs as many as it stands for, so
the classes have their shares of all labels. Scoring covers whole texts. Results on odd rows: a null,
empty or wordless text scores as one without any feature; repeated rows each
get their row; an empty table gives an empty result; without labels of both
classes nothing is rejected and every severity is 0; other input columns
aren't carried.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestream.llm import _batches as B
from lakestream.llm._samples import class_shares, labelled_sample

#: Bounds of the sample: documents of each class, features kept, fewest texts with a feature.
PER_CLASS, FEATURES, MIN_TEXTS = 5000, 4096, 4
GRADES = 3
#: Least log-likelihood ratio (G squared) of a kept feature: by chance, fewer than one of ten million has it.
#: Where none has so much: what by chance one of the features at hand has (``chance_g``).
MIN_G = 30.0
#: Words whose features a task remembers.
KEEP = 200_000

_WORDS = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    """The word itself, and its beginnings (with a star) where it goes on."""
    return [word, *(word[:k] + "*" for k in (4, 5, 6) if len(word) > k)]


def chance_g(n: int) -> float:
    """The G squared that by chance one of ``n`` features reaches (chi-squared, one degree of freedom)."""
    return NormalDist().inv_cdf(1 - 1 / (2 * max(2, n))) ** 2


def words(text: str | None) -> Counter:
    return Counter(_WORDS.findall((text or "").lower()))


@dataclass
class Ordinal:
    """index: place of each feature in weights; thresholds: one for each grade from 1 up, ascending.

    marked: places of the telling features of toxic texts (None: all are).
    """

    index: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    thresholds: np.ndarray = field(default_factory=lambda: np.full(GRADES, np.inf))
    marked: set[int] | None = None

    def counts(self, text: str | None, seen: dict[str, tuple[int, ...]]) -> Counter:
        """How often each feature occurs, by its place; ``seen`` remembers words."""
        out: Counter = Counter()
        if len(seen) > KEEP:
            seen.clear()
        for word, n in words(text).items():
            places = seen.get(word)
            if places is None:
                places = seen[word] = tuple(self.index[x] for x in word_features(word) if x in self.index)
            for i in places:
                out[i] += n
        return out

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for each score (rows) and grade (columns)."""
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(self.thresholds - score[:, None]))


    def judge(self, texts: list[str | None], seen: dict[str, tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
        """``above`` of each text, and which ones are rejected."""
        found = [self.counts(t, seen) for t in texts]
        above = self.above(np.array([sum(self.weights[i] * np.log1p(n) for i, n in x.items()) for x in found], float))
        telling = np.array([bool(x) if self.marked is None else not self.marked.isdisjoint(x) for x in found], bool)
        return above, telling & (above[:, 0] >= 0.5)


def fit_weights(rows: list[dict[int, float]], grade: np.ndarray, n: int, rounds: int = 600, rate: float = 0.1,
                l2: float = 1e-4, stands_for: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood by gradient ascent (Adam), each row as often as it ``stands_for``; weights, thresholds."""
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.array([i for r in rows for i in r], np.int64)
    val = np.log1p(np.array([v for r in rows for v in r.values()], float))
    weight = np.ones(len(rows)) if stands_for is None else np.asarray(stands_for, float)
    weight = weight / max(weight.sum(), 1e-12)
    # the first threshold, then logarithms of the steps to the next
    params, m, v = np.concatenate([np.zeros(n), [1.0], np.zeros(GRADES - 1)]), 0.0, 0.0
    for step in range(1, rounds + 1):
        w, gap = params[:n], np.exp(params[n + 1:])
        theta = np.concatenate([[-np.inf], params[n] + np.append(0, np.cumsum(gap)), [np.inf]])
        score = np.bincount(row, w[col] * val, len(rows))
        with np.errstate(over="ignore"):
            up, down = 1 / (1 + np.exp(theta[grade] - score)), 1 / (1 + np.exp(theta[grade + 1] - score))
        likely = np.maximum(up - down, 1e-12)
        d_up, d_down = weight * up * (1 - up) / likely, weight * down * (1 - down) / likely
        slope = np.bincount(col, (d_up - d_down)[row] * val, n)
        edge = np.array([(d_down[grade == k]).sum() - (d_up[grade == k + 1]).sum() for k in range(GRADES)])
        tail = np.cumsum(edge[::-1])[::-1]
        grad = np.concatenate([slope - l2 * w, [tail[0]], tail[1:] * gap - l2 * params[n + 1:]])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        params = params + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return params[:n], params[n] + np.append(0, np.cumsum(np.exp(params[n + 1:])))


def fit_ordinal(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
                text_col: str = "text", per_class: int = PER_CLASS, features: int = FEATURES) -> Ordinal:
    """Fits the model: telling features of the sample by G squared, grades, weights."""

    def listed(batches):
        for part in B.slices(batches, "text"):
            for y, text in zip(B.column(part, "label").to_pylist(), B.column(part, "text").to_pylist()):
                own = list({x for w in words(text) for x in word_features(w)})
                yield pa.RecordBatch.from_arrays([pa.array([y] * len(own), pa.int32()), pa.array(own, pa.string())],
                                                 names=["label", "feature"])

    # each class at once is bounded by per_class, so both numbers of texts are
    sample = labelled_sample(docs, labels, label_col, per_class, id_col, text_col)
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Ordinal()
    n1, n0 = float(sizes[1]), float(sizes[0])
    a, b = F.col("a"), F.col("b")
    expect = (a + b) / (n1 + n0)
    part = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    g = 2 * (part(a, n1 * expect) + part(b, n0 * expect) + part(n1 - a, n1 * (1 - expect)) + part(n0 - b, n0 * (1 - expect)))
    tested = (sample.select("label", "text").mapInArrow(B.task(listed), "label int, feature string")
              .groupBy("feature").agg(F.sum(F.expr("label")).cast("double").alias("a"), F.sum(F.expr("1 - label")).cast("double").alias("b"))
              .where(a + b >= MIN_TEXTS).withColumn("g", g))

    def best(floor: float) -> list:
        return tested.where(F.col("g") >= floor).orderBy(F.desc("g"), "feature").limit(features).collect()

    top = best(MIN_G) or best(min(MIN_G, chance_g(tested.count())))
    marked = {i for i, r in enumerate(top) if r["a"] / n1 > r["b"] / n0}
    model = Ordinal({r["feature"]: i for i, r in enumerate(top)}, marked=marked)

    def vectors(batches):
        seen: dict[str, tuple[int, ...]] = {}
        for part in B.slices(batches, "text"):
            own = [model.counts(t, seen) for t in B.column(part, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [B.column(part, "label"), pa.array([list(x) for x in own], pa.list_(pa.int32())),
                 pa.array([list(x.values()) for x in own], pa.list_(pa.int64()))], names=["label", "places", "counts"])

    got = sample.select("label", "text").mapInArrow(B.task(vectors), "label int, places array<int>, counts array<long>").toArrow()
    rows = sorted((y, tuple(sorted(zip(p, c)))) for y, p, c in zip(
        *(got.column(k).to_pylist() for k in ("label", "places", "counts"))))
    label = np.array([y for y, _ in rows])
    share = class_shares(labels, label_col, per_class, id_col)
    evidence = np.array([sum(c for i, c in r if i in marked) for _, r in rows], float)
    cuts = np.quantile(evidence[label == 1], [k / GRADES for k in range(1, GRADES)])
    grade = np.where(label == 1, 1 + (evidence[:, None] > cuts).sum(1), 0)
    model.weights, model.thresholds = fit_weights(
        [dict(r) for _, r in rows], grade, len(top), stands_for=np.array([share[y] for y in label.tolist()]))
    return model


def toxicity(docs: DataFrame, model: Ordinal, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``severity`` (expected grade), ``grade`` (the most whose P(grade >= k) is 1/2), ``rejected``."""

    def run(batches):
        seen: dict[str, tuple[int, ...]] = {}
        for part in B.slices(batches, "text"):
            above, rejected = model.judge(B.column(part, "text").to_pylist(), seen)
            grade = (above >= 0.5).sum(1)
            yield pa.RecordBatch.from_arrays(
                [B.column(part, "id"), pa.array(above.sum(1)), pa.array(grade.astype(np.int32)), pa.array(rejected)],
                names=[id_col, "severity", "grade", "rejected"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        B.task(run), f"`{id_col}` {kind}, severity double, grade int, rejected boolean")


def without_toxic(docs: DataFrame, model: Ordinal, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that aren't rejected, with all their columns."""

    def run(batches):
        seen: dict[str, tuple[int, ...]] = {}
        for part in B.slices(batches, text_col):
            _, rejected = model.judge(B.column(part, text_col).to_pylist(), seen)
            yield part.filter(pa.array(~rejected))

    return docs.mapInArrow(B.task(run), docs.schema)
