"""Word shingles of texts as 64-bit fingerprints."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lakestream.llm import _batches as B
from lakestream.llm._hashing import Prefix, mix

WORDS = 5
#: Bytes of words: ASCII letters and digits, and all of a character beyond ASCII.
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Document and fingerprint of each word of the lower-cased texts, in order."""
    data, offsets = B.utf8(pc.utf8_lower(texts.cast(pa.large_string())))
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    word = _WORD[data]
    start = np.flatnonzero(word & (np.append(True, ~word[:-1]) | edge[:-1]))
    end = np.flatnonzero(word & (np.append(~word[1:], True) | edge[1:])) + 1
    return np.searchsorted(offsets, start, "right") - 1, Prefix(data).hash(start, end)


def shingles(doc: np.ndarray, word: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Document and fingerprint of each run of ``size`` words; a shorter text is one shingle of all its words."""
    if not len(doc):
        return doc, word
    first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    count = np.diff(np.append(first, len(doc)))
    runs = max(0, len(word) - size + 1)
    out = np.zeros(runs, np.uint64)
    for k in range(size if runs else 0):
        out = mix(out + word[k:runs + k])
    whole = np.flatnonzero(doc[:runs] == doc[size - 1:]) if runs else np.zeros(0, np.int64)
    short = np.flatnonzero(count < size)
    if not len(short):
        return doc[whole], out[whole]
    single = np.zeros(len(short), np.uint64)
    for k in range(size):
        has = count[short] > k
        single[has] = mix(single[has] + word[first[short[has]] + k])
    owner, value = np.append(doc[whole], doc[first[short]]), np.append(out[whole], single)
    order = np.argsort(owner, kind="stable")
    return owner[order], value[order]


def bags(doc: np.ndarray, shingle: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, fingerprint and count of each distinct shingle, by document and fingerprint."""
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    if not len(doc):
        return doc, shingle, doc
    first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])))
    return doc[first], shingle[first], np.diff(np.append(first, len(doc)))
