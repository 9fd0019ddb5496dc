"""BPE encoding and decoding: speculate with greedy longest matches, verify pairs, merge only what fails.

A greedy longest match proposes the tokens of each distinct word. Tokens are
right exactly if no merge would ever cross the border of two neighbours; that
is checked for all neighbours of a batch at once, by undoing the merges on both
sides of each border in the reverse of their order. Only words with a failing
border are merged step by step. All three steps take the new words of a batch
together, as arrays; long words go one by one.

Words never cross white space, so each task keeps, until it ends, the ids of the chunks
between white space that it has met (two bounded generations of them), and a
text costs one look-up a chunk. What ids decode to is joined by Arrow.

Results on odd rows: a null or empty text has no tokens and decodes to ``""``;
repeated rows and equal ids each get their row; an empty table gives an empty
result; other columns of the input aren't carried, so their names can't clash.
"""

from __future__ import annotations

import gc
import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestream.llm import _batches as B

# White space and word pattern of the tokenizer file's normaliser and splitter.
_SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^" + _SPACES + r"\p{L}\p{N}]+"

_SPLIT = re.compile(f"[{_SPACES}]+")
#: str.split() also splits at these, which the normaliser takes for ordinary characters.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_NONE = np.int64(1 << 40)
#: stands for the word end in proposals, as one letter that no byte has and a byte that no word has
_STOP = "\n"
_STOP_BYTE = ord(_STOP)
_SPACE = pa.scalar(" ", pa.large_string())
#: Words up to so many letters are encoded together, longer ones singly, merged with a heap.
_SHORT = 64
#: Chunks kept by a task in each of its two generations (some 200 bytes each), and the longest one kept.
CACHE_CHUNKS, CACHE_CHARS = 200_000, 100


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the rest from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(rest)) for b in range(256)]


def pack(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class _Found:
    """Values of integer keys (distinct, none negative), looked up for whole arrays in a hash table with open addressing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: int):
        bits = len(keys).bit_length() + 2
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, missing, np.int64)
        at = self._slot(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]
            mine = self.keys[at] == keys
            self.values[at[mine]] = values[mine]
            at, keys, values = (at[~mine] + 1) & self.mask, keys[~mine], values[~mine]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        out, there = self.values[at], self.keys[at]
        off = np.flatnonzero((there != keys) & (there >= 0))
        while off.size:
            at[off] = next_ = (at[off] + 1) & self.mask
            out[off], there = self.values[next_], self.keys[next_]
            off = off[(there != keys[off]) & (there >= 0)]
        return out


class WordBpe:
    """A tokenizer file whose BPE model marks word ends; ``encode`` gives token ids of lower-cased words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.texts = {i: t for t, i in (self.vocab | self.special).items()}
        self.words = regex.compile(_WORD)
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.letters = str.maketrans({chr(b): x for b, x in enumerate(byte_letters())})
        n = max(self.texts) + 1
        self.n = n
        #: rank of the merge that makes a token (-1: none does), and the two tokens it joins
        self.made, self.left, self.right = np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        pairs = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y, z = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.merge.setdefault((x, y), (rank, z))
            self.made[z], self.left[z], self.right[z] = rank, x, y
            pairs.append((x * n + y, rank))
        pairs.sort()
        keys, ranks = (np.array(v, np.int64) for v in zip(*pairs))
        keys, first = np.unique(keys, return_index=True)  # of equal pairs the one of the lowest rank
        self.ranks = _Found(keys, ranks[first], int(_NONE))
        #: the token that the merge of each rank makes
        self.joined = np.zeros(len(pairs), np.int64)
        for rank, z in self.merge.values():
            self.joined[rank] = z
        #: the tokens of single bytes inside a word, and of those at its end
        self.inner, self.last = (np.array([self.vocab[x + e] for x in byte_letters()], np.int64) for e in ("", self.end))
        self.proposed = self._proposed()
        self._grow()
        #: how far the tokens go that begin with the same four letters; others end before the fourth
        self.reach: dict[str, int] = {}
        for t in self.proposed:
            if len(t) > 3:
                self.reach[t[:4]] = max(len(t), self.reach.get(t[:4], 0))

    def _proposed(self) -> dict[str, int]:
        """The tokens that merging their own letters gives; no other token can be in a result."""
        z = np.flatnonzero(self.made >= 0)
        whole = self._apart(self.left[z], self.right[z], self.made[z])
        good = np.ones(self.n, bool)
        for i in np.argsort(self.made[z], kind="stable"):
            t = z[i]
            good[t] = whole[i] and good[self.left[t]] and good[self.right[t]]
        return {t.removesuffix(self.end) + _STOP * t.endswith(self.end): i
                for t, i in self.vocab.items() if good[i]}

    def _grow(self) -> None:
        """The proposed tokens as a tree: ``step`` goes from node * 256 + byte to the next node (-1: none), ``token``
        is each node's token (-1: none)."""
        byte = {x: b for b, x in enumerate(byte_letters()) if b != _STOP_BYTE} | {_STOP: _STOP_BYTE}
        steps: dict[int, int] = {}
        token = [-1]
        for t, i in self.proposed.items():
            if all(c in byte for c in t):
                node = 0
                for c in t:
                    node = steps.setdefault(node << 8 | byte[c], len(token))
                    if node == len(token):
                        token.append(-1)
                token[node] = i
        self.step = _Found(*(np.fromiter(v, np.int64, len(steps)) for v in (steps, steps.values())), -1)
        self.token = np.array(token, np.int64)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.ranks(a * self.n + b)

    def _apart(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge (before rank ``until``) crosses the border of neighbours a and b.

        Walks back in time: of the two tokens at the border the later made one is
        taken apart. A merge across the border happens if its rank comes before the
        merges that took both tokens in; of equal ranks the left one comes first.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        whole = np.ones(len(a), bool)
        live = np.arange(len(a))
        end = np.full(len(a), _NONE) if until is None else until.astype(np.int64)
        end_a, end_b = end.copy(), np.where(end == _NONE, _NONE - 1, end - 1)
        while live.size:
            x, y = a[live], b[live]
            rank = self._rank(x, y)
            bad = (rank < end_a[live]) & (rank <= end_b[live])
            whole[live[bad]] = False
            made_x, made_y = self.made[x], self.made[y]
            right = made_y >= made_x
            on = ~bad & (np.maximum(made_x, made_y) >= 0)
            r, s = live[on & right], live[on & ~right]
            end_b[r], end_a[s] = self.made[b[r]], self.made[a[s]]
            b[r], a[s] = self.left[b[r]], self.right[a[s]]
            live = live[on]
        return whole

    def _propose(self, letters: str) -> list[int]:
        out, at, n, known, reach = [], 0, len(letters), self.proposed.get, self.reach.get
        whole = letters + _STOP
        while at < n:
            to = min(n + 1, at + reach(whole[at:at + 4], 3))
            while (token := known(whole[at:to])) is None or to == n:
                to -= 1
            out.append(token)
            at = to
        return out

    def merged(self, letters: str) -> list[int]:
        """Exact merging: the pair of the lowest rank first, of equals the leftmost."""
        ids = [self.vocab[c] for c in letters[:-1]] + [self.vocab[letters[-1] + self.end]]
        after, before = [*range(1, len(ids)), -1], list(range(-1, len(ids) - 1))
        heap = [(*self.merge[p], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in self.merge]
        heap = [(rank, i, z, p) for rank, z, i, p in heap]
        heapq.heapify(heap)
        while heap:
            _, i, z, pair = heapq.heappop(heap)
            j = after[i]
            if ids[i] is None or j < 0 or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j], after[i] = z, None, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0 and (p := (ids[k], ids[after[k]])) in self.merge:
                    rank, new = self.merge[p]
                    heapq.heappush(heap, (rank, k, new, p))
        return [x for x in ids if x is not None]

    def _proposals(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Greedy longest matches in words of bytes, a stop after each: the token at each place where one begins, else -1."""
        ids = np.full(len(data), -1)
        at = starts
        while at.size:
            best, end = np.zeros(len(at), np.int64), at.copy()
            live, node, to = np.arange(len(at)), np.zeros(len(at), np.int64), at
            while live.size:
                node = self.step(node << 8 | data[to])
                on = np.flatnonzero(node >= 0)
                live, node, to = live[on], node[on], to[on] + 1
                # a word's last token takes the stop in
                hit = np.flatnonzero((self.token[node] >= 0) & (data[to] != _STOP_BYTE))
                best[live[hit]], end[live[hit]] = self.token[node[hit]], to[hit]
            ids[at] = best
            at = end[data[end - 1] != _STOP_BYTE]
        return ids

    def _merge_all(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, ids: np.ndarray) -> None:
        """Exact merging of words of bytes, in each the pair of the lowest rank first, of equals the leftmost.

        A round makes one merge in every word that has one left. Writes each word's tokens into ``ids`` from its start on.
        """
        size = ends - starts
        word = np.repeat(np.arange(len(size)), size)
        place = starts[word] + np.arange(len(word)) - (np.cumsum(size) - size)[word]
        token = np.where(place + 1 < ends[word], self.inner[data[place]], self.last[data[place]])
        rank = np.full(len(token), _NONE)
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside] = self._rank(token[inside], token[inside + 1])
        while len(token):
            edge = np.cumsum(size) - size
            low = np.minimum.reduceat(rank, edge)
            if (low == _NONE).any():
                done = np.repeat(low == _NONE, size)
                own = np.flatnonzero(done)
                ids[starts[word[own]] + own - np.repeat(edge, size)[own]] = token[own]
                token, rank, word = token[~done], rank[~done], word[~done]
                size, low = size[low != _NONE], low[low != _NONE]
                edge = np.cumsum(size) - size
                if not len(token):
                    break
            least = np.flatnonzero(rank == np.repeat(low, size))
            at = least[np.append(True, word[least[1:]] != word[least[:-1]])]
            token[at] = self.joined[low]
            keep = np.ones(len(token), bool)
            keep[at + 1] = False
            after = at + 2 < edge + size
            rank[at] = _NONE
            rank[at[after]] = self._rank(token[at[after]], token[at[after] + 2])
            before = at[at > edge]
            rank[before - 1] = self._rank(token[before - 1], token[before])
            token, rank, word, size = token[keep], rank[keep], word[keep], size - 1

    def _packed_short(self, words: list[str]) -> list[bytes]:
        data = np.frombuffer((_STOP.join(words) + _STOP + " ").encode("utf-8", "surrogatepass"), np.uint8).astype(np.int64)
        ends = np.flatnonzero(data == _STOP_BYTE)
        starts = np.append(0, ends[:-1] + 1)
        ids = self._proposals(data, starts)
        begins = np.flatnonzero(ids >= 0)
        flat = ids[begins]
        word = np.searchsorted(starts, begins, "right") - 1
        border = np.flatnonzero(word[1:] == word[:-1])
        apart = self._apart(flat[border], flat[border + 1])
        wrong = np.zeros(len(starts), bool)
        wrong[word[border[~apart]]] = True
        if wrong.any():
            ids[begins[wrong[word]]] = -1
            self._merge_all(data, starts[wrong], ends[wrong], ids)
        known = ids >= 0
        packed = ids[known].astype("<u4").tobytes()
        edges = [0, *(np.cumsum(known)[ends] * 4).tolist()]
        return [packed[a:b] for a, b in zip(edges, edges[1:])]

    def _encoded_long(self, word: str) -> list[int]:
        letters = word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)
        ids = np.array(self._propose(letters), np.int64)
        return ids.tolist() if self._apart(ids[:-1], ids[1:]).all() else self.merged(letters)

    def packed_words(self, words: list[str]) -> list[bytes]:
        """Packed token ids of each word (a match of the word pattern)."""
        # no character has more than four bytes
        short = [w for w in words if len(w) <= _SHORT // 4 or len(w.encode("utf-8", "surrogatepass")) <= _SHORT]
        out = self._packed_short(short) if short else []
        if len(short) == len(words):
            return out
        known = dict(zip(short, out))
        return [known[w] if w in known else pack(self._encoded_long(w)) for w in words]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Token ids of each word (a match of the word pattern)."""
        return [np.frombuffer(x, "<u4").tolist() for x in self.packed_words(words)]

    def parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """Pieces of a text, and whether each is a special token."""
        if "<|" in text:
            for i, piece in enumerate(self.specials.split(text)):
                if piece:
                    yield piece, i % 2 == 1
        elif text:
            yield text, False

    @staticmethod
    def chunks(text: str) -> list[str]:
        """The normalised text between white space."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:
                text = text.replace("Σ", "σ")  # letter by letter, so no final sigma
        text = text.lower()
        if any(c in text for c in _SEPARATORS):
            return [x for x in _SPLIT.split(text) if x]
        return text.split()

    def decode(self, ids) -> str:
        return " ".join(self.texts[int(i)] for i in ids)


class Encoder:
    """Encodes texts, keeping what each chunk gave: its ids as little-endian 32-bit integers."""

    def __init__(self, path: str):
        self.bpe = WordBpe(path)
        #: special tokens have a line feed before them, which no chunk can hold
        self.fixed = {"\n" + t: pack([i]) for t, i in self.bpe.special.items()}
        self.texts = pa.array([self.bpe.texts.get(i, "") for i in range(self.bpe.n)], pa.large_string())
        self.keep = CACHE_CHUNKS
        self.forget()

    def forget(self) -> None:
        self.new, self.old = dict(self.fixed), {}

    def learn(self, chunks: set[str]) -> list[str]:
        """Sees to it that ``new`` has all chunks; returns what of ``new`` is too long to be kept."""
        if len(self.new) + len(chunks) > self.keep:
            self.old, self.new = self.new, dict(self.fixed)
        new, old = self.new, self.old
        todo = chunks.difference(new)
        if old:
            kept = {c: old[c] for c in todo if c in old}
            new.update(kept)
            todo.difference_update(kept)
        words = set(filter(str.isalpha, todo))
        find = self.bpe.words.findall
        mixed = [(c, find(c)) for c in todo.difference(words)]
        words.update(*(ws for _, ws in mixed))
        words = list(words.difference(new))
        new.update(zip(words, self.bpe.packed_words(words)))
        for c, ws in mixed:
            if c not in new:
                new[c] = b"".join([new[w] for w in ws])
        return [c for c in (*words, *(c for c, _ in mixed)) if len(c) > CACHE_CHARS]

    def ids(self, batch: list[str | None]) -> list[bytes]:
        """The packed ids of each text."""
        bpe, rows = self.bpe, []
        for text in batch:
            row: list[str] = []
            for piece, special in bpe.parts(text or ""):
                row += ["\n" + piece] if special else bpe.chunks(piece)
            rows.append(row)
        long = self.learn(set().union(*rows))
        new = self.new
        out = [b"".join([new[c] for c in row]) for row in rows]
        for c in long:
            new.pop(c, None)  # a chunk may be a word, too
        return out

    def decoded(self, ids: list[bytes]) -> pa.Array:
        """The text of each row's packed ids."""
        edges = np.cumsum([0, *map(len, ids)]) // 4
        tokens = self.texts.take(pa.array(np.frombuffer(b"".join(ids), "<u4")))
        return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(edges, pa.int64()), tokens), _SPACE).cast(pa.string())

    def encode(self, batch: list[str | None]) -> Iterator[tuple[bytes, str]]:
        ids = self.ids(batch)
        return zip(ids, self.decoded(ids).to_pylist())


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
        # the tables stay, and what is kept of texts has no cycles: collections needn't walk them often
        gc.freeze()
        gc.set_threshold(200_000, 50, 1000)
    return _encoders[path]


def bpe_encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
               keep_chunks: int = CACHE_CHUNKS, slice_bytes: int = B.SLICE_BYTES) -> DataFrame:
    """Per row: the id, ``n_tokens``, ``ids`` (little-endian 32-bit, end to end) and ``decoded`` (text of the ids).

    ``vocab_path`` is the tokenizer file, which every executor must have there.
    ``keep_chunks`` and ``slice_bytes`` (texts encoded together) trade a task's
    memory for time; results don't depend on them.
    """

    def run(batches):
        own = encoder(vocab_path)
        try:
            own.keep = keep_chunks
            for part in B.slices(batches, "text", slice_bytes):
                ids = own.ids(B.column(part, "text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [B.column(part, "id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array(ids, pa.binary()), own.decoded(ids)],
                    names=[id_col, "n_tokens", "ids", "decoded"])
        finally:
            own.forget()  # the worker lives on, and other stages need its memory

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        B.task(run), f"`{id_col}` {kind}, n_tokens long, ids binary, decoded string")


def bpe_decode(tokens: DataFrame, vocab_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: the id and ``decoded``, the text of the packed ids (null: empty)."""

    def run(batches):
        bpe = encoder(vocab_path).bpe
        for part in batches:
            ids = [bpe.decode(np.frombuffer(x or b"", "<u4")) for x in B.column(part, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([B.column(part, "id"), pa.array(ids, pa.string())],
                                             names=[id_col, "decoded"])

    kind = tokens.schema[id_col].dataType.simpleString()
    return tokens.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(
        B.task(run), f"`{id_col}` {kind}, decoded string")
