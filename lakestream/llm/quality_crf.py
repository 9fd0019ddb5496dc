"""Quality rules and line labels: Viterbi decoding of a linear-chain conditional random field.

Every line with a word is content or boilerplate. Features of a line are cheap
counts (length, symbols, capitals, repetition); a linear-chain CRF with two
states weighs them and the step from one line to the next. It is fitted by
maximum likelihood on a bounded sample of labelled documents with the states of
the lines hidden: the quality label of its text is evidence about a line, and so
is that a line of a rejected text stands in a good one too. A text is kept if it passes the base rules
and at least ``MIN_CONTENT`` of its words are in content lines.

Words are ``[^\\x20\\x09-\\x0D]+``. Results on odd rows: a null, empty or blank
text has zero counts, fails the base rules and isn't kept; repeated rows each
get their row; an empty table gives an empty result; without labels of both
classes every line counts as content; other input columns aren't carried.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestream.llm import _batches as B
from lakestream.llm._hashing import Prefix, mix
from lakestream.llm._samples import labelled_sample
from lakestream.llm._tables import written

#: Bounds of the fitted sample, of each class: documents, and runs of so many of their lines (96 bytes a line).
PER_CLASS, SEQUENCES, SEQUENCE = 1500, 6000, 64
#: How likely a line is content by its text's label alone, 0 or 1.
TRUST = np.array([0.1, 0.98])
MIN_CONTENT = 0.5
#: Base rules: fewest words, and the most per cent of words in repeated windows.
MIN_WORDS, MAX_REPEATED, WINDOW = 10, 20, 5
FEATURES = ("bias", "words", "word length", "symbols", "capitals", "digits", "shouts", "earlier line",
            "repeated words", "same as last word", "sentence end")


def _lut(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


_SPACE = _lut(b" \t\n\x0b\x0c\r")
_SYMBOL = _lut(b"#*$%&|<>")
_UPPER, _DIGIT, _SHOUT, _STOP = (_lut(x) for x in (bytes(range(65, 91)), b"0123456789", b"!?", b".!?:"))
_FIRST = ~_lut(bytes(range(0x80, 0xC0)))  # bytes that begin a character


@dataclass
class Lines:
    """Counts of the documents of a slice, and features of their lines with words, in order."""

    counts: dict[str, np.ndarray]
    doc: np.ndarray
    words: np.ndarray
    features: np.ndarray
    hashes: np.ndarray


def measure(data: np.ndarray, offsets: np.ndarray) -> Lines:
    n = len(offsets) - 1
    zeros = np.zeros(n, np.int64)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    if not (~_SPACE[data]).any():
        return Lines(dict.fromkeys(names, zeros), zeros[:0], zeros[:0], np.zeros((0, len(FEATURES))), np.zeros(0, np.uint64))
    full = np.flatnonzero(np.diff(offsets))
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets[full]] = True
    begins[-1] = True
    solid = ~_SPACE[data]
    start = np.flatnonzero(solid & (np.concatenate([[True], ~solid[:-1]]) | begins[:-1]))
    end = np.flatnonzero(solid & (np.concatenate([~solid[1:], [True]]) | begins[1:])) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    per_doc = lambda mask, weights=None: np.bincount(doc[mask], weights, n).astype(np.int64)
    prefix = Prefix(data)
    word = prefix.hash(start, end)

    # lines: the part of a document before, between and after its line feeds
    feed = np.flatnonzero(data == 10)
    at = np.concatenate([offsets[full], feed + 1])
    of = np.concatenate([full, np.searchsorted(offsets, feed, "right") - 1])
    order = np.lexsort((at, of))
    at, of = at[order], of[order]
    last = np.append(of[1:] != of[:-1], True)
    to = np.where(last, offsets[of + 1], np.append(at[1:], 0) - 1)
    line = np.searchsorted(at, start, "right") - 1
    words = np.bincount(line, minlength=len(at))
    own = np.flatnonzero(words)
    text = mix(prefix.hash(at[own], to[own]) + mix((to - at)[own].astype(np.uint64)))
    key = mix(text + mix(of[own].astype(np.uint64)))
    again = np.ones(len(own), bool)
    again[np.unique(key, return_index=True)[1]] = False

    # words in windows that their text has twice
    w = WINDOW
    marked = np.zeros(len(word) + 1, np.int64)
    if len(word) >= w:
        gram = np.zeros(len(word) - w + 1, np.uint64)
        for k in range(w):
            gram = mix(gram + word[k:len(word) - w + 1 + k])
        same = np.flatnonzero(doc[:len(gram)] == doc[w - 1:])
        gram = mix(gram[same] + doc[same].astype(np.uint64))
        order = np.argsort(gram, kind="stable")
        equal = gram[order[1:]] == gram[order[:-1]]
        twice = same[order[np.append(equal, False) | np.concatenate([[False], equal])]]
        marked[:-1] += np.bincount(twice, minlength=len(word))
        marked[:] -= np.bincount(twice + w, minlength=len(word) + 1)[:len(word) + 1]
    marked = np.cumsum(marked)[:-1] > 0

    # totals between any two places, from running sums
    def total(mask: np.ndarray):
        sums = np.concatenate([[0], np.cumsum(mask)])
        return lambda a, b: sums[b] - sums[a]

    chars, symbols = total(solid & _FIRST[data]), total(_SYMBOL[data])
    counts = {"n_words": per_doc(slice(None)), "word_chars": chars(offsets[:-1], offsets[1:]),
              "n_symbols": symbols(offsets[:-1], offsets[1:]),
              "n_dup_lines": np.bincount(of[own][again], minlength=n), "n_repeat_words": per_doc(marked)}

    a, b, nw = at[own], to[own], words[own]
    size = np.maximum(chars(a, b), 1)
    place = np.searchsorted(own, line)
    sticky = np.concatenate([[False], (word[1:] == word[:-1]) & (line[1:] == line[:-1])])
    by_line = lambda mask: np.bincount(place[mask], minlength=len(own)) / nw
    share = lambda lut: total(lut[data])(a, b) / size
    final = np.zeros(len(own), bool)
    final[place] = _STOP[data[end - 1]]  # of the words of a line the last one is written last
    features = np.stack([np.ones(len(own)), np.log1p(nw) / 3, np.minimum(size / nw, 40) / 10, symbols(a, b) / size,
                         share(_UPPER), share(_DIGIT), share(_SHOUT), again, by_line(marked), by_line(sticky), final], 1)
    return Lines(counts, of[own], nw, features, text)


@dataclass
class Crf:
    """weights: of the features, for content against boilerplate; steps[i, j]: from state i to j (1: content)."""

    weights: np.ndarray
    steps: np.ndarray

    def decode(self, features: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The best states of each document's lines; all documents take a step together. Ties: content."""
        score = features @ self.weights
        out = np.ones(len(score), np.int8)
        if not len(score):
            return out
        first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        size = np.diff(np.append(first, len(doc)))
        order = np.argsort(-size, kind="stable")
        first, size = first[order], size[order]
        best = np.stack([np.zeros(len(first)), score[first]], 1)
        back = np.zeros((len(score), 2), np.int8)
        alive = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")  # documents with so many lines
        for t in range(1, size[0]):
            k = alive[t]
            way = best[:k, :, None] + self.steps
            pick = way[:, 1] >= way[:, 0]
            back[first[:k] + t] = pick
            best[:k] = np.where(pick, way[:, 1], way[:, 0])
            best[:k, 1] += score[first[:k] + t]
        state = (best[:, 1] >= best[:, 0]).astype(np.int8)
        for t in range(size[0] - 1, -1, -1):
            k = alive[t]
            at = first[:k] + t
            out[at] = state[:k]
            state[:k] = back[at, state[:k]]
        return out


#: The model that takes every line for content.
ALL_CONTENT = Crf(np.eye(len(FEATURES))[0], np.zeros((2, 2)))


def _beliefs(score: np.ndarray, steps: np.ndarray, first: np.ndarray, size: np.ndarray, alive: list[int],
             weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward: each line's probability of content, and the weighted expected count of each step."""
    fore, after = score.copy(), np.zeros_like(score)
    for t in range(1, size[0]):
        at = first[:alive[t]] + t
        fore[at] += np.logaddexp.reduce(fore[at - 1][:, :, None] + steps, 1)
    for t in range(size[0] - 1, 0, -1):
        at = first[:alive[t]] + t
        after[at - 1] = np.logaddexp.reduce(steps + (score[at] + after[at])[:, None, :], 2)
    total = np.logaddexp.reduce(fore[first + size - 1], 1)
    content = np.exp(fore[:, 1] + after[:, 1] - np.repeat(total, size))
    turn = np.zeros((2, 2))
    for t in range(1, size[0]):
        k = alive[t]
        at = first[:k] + t
        joint = np.exp(fore[at - 1][:, :, None] + steps + (score[at] + after[at])[:, None, :] - total[:k, None, None])
        turn += (joint * weight[:k, None, None]).sum(0)
    return content, turn


def fit(features: list[np.ndarray], labels: list[int], hashes: list[np.ndarray] | None = None, rounds: int = 300,
        rate: float = 0.2, l2: float = 1e-4) -> Crf:
    """Maximum likelihood of the evidence by gradient ascent (Adam), the states of the lines being hidden.

    A sequence's label is evidence about its lines (``TRUST``), but a line that
    some good text has too (by ``hashes``) counts as one of a good text. The
    gradient is the difference of two expectations, one given the evidence and
    one without it, so steps between the states are learned as well.
    """
    if hashes is None:
        hashes = [np.zeros(len(x)) for x in features]
        good = np.zeros(0)
    else:
        good = np.concatenate([np.zeros(0, np.uint64), *(h for h, y in zip(hashes, labels) if y)])
    pieces = [(x[i:i + SEQUENCE], y, h[i:i + SEQUENCE])
              for x, y, h in zip(features, labels, hashes) for i in range(0, len(x), SEQUENCE)]
    if len({y for _, y, _ in pieces}) < 2:
        return ALL_CONTENT
    pieces.sort(key=lambda p: -len(p[0]))
    size = np.array([len(x) for x, _, _ in pieces])
    flat, y = np.concatenate([x for x, _, _ in pieces]), np.array([y for _, y, _ in pieces])
    first = np.append(0, np.cumsum(size)[:-1])
    alive = [int((size > t).sum()) for t in range(size[0])]
    # log odds of content before a line is looked at
    known = np.isin(np.concatenate([h for _, _, h in pieces]), good)
    evidence = np.log(TRUST / (1 - TRUST))[np.where(known, 1, np.repeat(y, size))]
    # both classes weigh the same, whatever their share of the sample
    weight = np.where(y == 1, 0.5 / size[y == 1].sum(), 0.5 / size[y == 0].sum())
    per_line = np.repeat(weight, size)
    params, m, v = np.zeros(flat.shape[1] + 4), 0.0, 0.0
    for step in range(1, rounds + 1):
        w, steps = params[:-4], params[-4:].reshape(2, 2)
        free = flat @ w
        told, told_turn, said, said_turn = (x for odds in (free + evidence, free) for x in _beliefs(
            np.stack([np.zeros(len(flat)), odds], 1), steps, first, size, alive, weight))
        grad = np.append(flat.T @ ((told - said) * per_line), (told_turn - said_turn).ravel()) - l2 * params
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        params = params + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return Crf(params[:-4], params[-4:].reshape(2, 2))


def fit_crf(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
            text_col: str = "text", per_class: int = PER_CLASS, sequences: int = SEQUENCES) -> Crf:
    """Fits the model on at most ``sequences`` runs of 64 lines from at most ``per_class`` documents of each label.

    Tasks measure all lines of the sampled documents; which runs of a long text
    are taken is told by a hash of the text's and the run's place.
    """

    def run(batches):
        for part in B.slices(batches, "text"):
            lines = measure(*B.utf8(B.column(part, "text")))
            found = [(i, j, *(x[at[j:j + SEQUENCE]].tobytes() for x in (lines.features.astype("<f8"), lines.hashes.astype("<u8"))))
                     for i in range(part.num_rows) for at in [np.flatnonzero(lines.doc == i)] for j in range(0, len(at), SEQUENCE)]
            of, place, rows, hashes = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [*(B.column(part, c).take(pa.array(of, pa.int64())) for c in ("label", "hash")), pa.array(place, pa.int64()),
                 pa.array(rows, pa.binary()), pa.array(hashes, pa.binary())], names=["label", "hash", "place", "lines", "hashes"])

    sample = labelled_sample(docs, labels, label_col, per_class, id_col, text_col)
    cut = written(sample.select("label", F.xxhash64("id").alias("hash"), "text").mapInArrow(
        B.task(run), "label int, hash long, place long, lines binary, hashes binary"), "lines")
    order = [F.xxhash64("hash", "place"), F.col("hash"), F.col("place")]
    got = reduce(DataFrame.unionAll, [cut.where(F.col("label") == c).orderBy(*order).limit(sequences) for c in (0, 1)]).toArrow()
    rows = sorted(zip(*(got.column(c).to_pylist() for c in ("label", "lines", "hashes"))))
    return fit([np.frombuffer(x, "<f8").reshape(-1, len(FEATURES)) for _, x, _ in rows], [y for y, _, _ in rows],
               [np.frombuffer(h, "<u8") for _, _, h in rows])


def quality_rules(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, the base counts, ``base_failed``, ``content_share`` of the words, ``kept``."""

    def run(batches):
        for part in B.slices(batches, "text"):
            lines = measure(*B.utf8(B.column(part, "text")))
            state = model.decode(lines.features, lines.doc)
            n = lines.counts["n_words"]
            content = np.bincount(lines.doc, lines.words * state, part.num_rows)
            share = content / np.maximum(n, 1)
            failed = (n < MIN_WORDS) | (100 * lines.counts["n_repeat_words"] > MAX_REPEATED * n)
            yield pa.RecordBatch.from_arrays(
                [B.column(part, "id"), *map(pa.array, lines.counts.values()), pa.array(failed), pa.array(share),
                 pa.array(~failed & (share >= MIN_CONTENT))],
                names=[id_col, *lines.counts, "base_failed", "content_share", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        B.task(run), f"`{id_col}` {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "base_failed boolean, content_share double, kept boolean")
