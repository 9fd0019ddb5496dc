"""BPE, packing and edited counts against the libraries and brute force."""

from __future__ import annotations

import hashlib
import sys
from pathlib import Path

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
from helpers import ODD, documents, long_text  # noqa: E402

from lakestream.llm import queries as Q  # noqa: E402
from lakestream.llm._ranks import encoding  # noqa: E402
from lakestream.llm._ship import ship  # noqa: E402
from lakestream.llm.bpe import CACHE_CHARS, bpe_decode, bpe_encode, encoder  # noqa: E402
from lakestream.llm.packing import best_fit_decreasing, pack_tokens  # noqa: E402
from lakestream.llm.token_counts import CountedText, apply_edits, is_cut, split, token_trees  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(Q.WORD_BPE)
    t.no_truncation()
    t.no_padding()
    return t


def _expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abehinorst'. \t\x1d\x85 <|>_09²éßΣİ日́😀"), max_size=40), max_size=4))
def test_bpe_equals_library(texts):
    library = Tokenizer.from_file(Q.WORD_BPE)
    for text, (ids, decoded) in zip(texts, encoder(Q.WORD_BPE).encode(texts)):
        assert (np.frombuffer(ids, "<u4").tolist(), decoded) == _expected(library, text)


def test_bpe_words_that_fail_the_check_are_merged(library):
    bpe = encoder(Q.WORD_BPE).bpe
    words = ["thoughtfulness", "a" * 300, "ononenen", "zzxqj"]
    assert bpe.encode_words(words) == [library.encode(w, add_special_tokens=False).ids for w in words]


def test_bpe_words_of_a_batch_are_encoded_together(library):
    """Python's calls depend on the longest word's merges, not on how many words there are."""
    bpe = encoder(Q.WORD_BPE).bpe
    parts = ["on", "en", "ti", "th", "nd", "re", "sh", "ou", "ea", "wh", "ble", "ing"]
    words = [a + b + c + d for a in parts for b in parts for c in parts for d in parts]
    greedy = [bpe._propose(w) for w in words[:2000]]
    assert sum(g != bpe.merged(w) for g, w in zip(greedy, words)) > 200  # many have to be merged

    def calls(some):
        n = 0

        def count(frame, event, arg):
            nonlocal n
            n += event == "call"

        sys.setprofile(count)
        try:
            bpe.encode_words(some)
        finally:
            sys.setprofile(None)
        return n

    assert calls(words) < len(words) / 10
    assert bpe.encode_words(words[::50]) == [library.encode(w, add_special_tokens=False).ids for w in words[::50]]


def test_bpe_short_and_long_words_agree(library):
    bpe, rng = encoder(Q.WORD_BPE).bpe, np.random.default_rng(3)
    words = ["".join(rng.choice(list("abehinorst"), n)) for n in (*range(1, 140), 400)]
    words += ["".join(rng.choice(list("éßñжя日"), n)) for n in range(1, 40)] + ["a" * n for n in range(1, 80)]
    want = [library.encode(w, add_special_tokens=False).ids for w in words]
    assert bpe.encode_words(words) == want
    assert [bpe._encoded_long(w) for w in words] == want
    assert bpe.encode_words([]) == []


def test_bpe_long_words_are_not_kept(library):
    own = encoder(Q.WORD_BPE)
    texts = ["q" * 300 + ". short", None, "x" * 200, "<|endoftext|>" + "ab" * 100 + "!?"]
    assert [d for _, d in own.encode(texts)] == [_expected(library, t)[1] for t in texts]
    assert "short" in own.new and max(map(len, own.new)) <= CACHE_CHARS
    own.forget()


def test_op3_equals_library(spark, library):
    ship(spark)
    got = {r["doc_id"]: r for r in Q.op3_bpe(spark, SMALL).collect()}
    rows = Q.table(spark, SMALL, "documents").collect()
    assert len(got) == len(rows)
    for row in rows:
        ids, decoded = _expected(library, row["text"])
        r = got[row["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_odd_rows(spark, library):
    ship(spark)
    docs = documents(spark, [*ODD, (10, "<|endoftext|> and <|STARTOFTEXT|> <|startoftext|>")])
    coded = bpe_encode(docs, Q.WORD_BPE)
    rows = coded.collect()
    assert len(rows) == docs.count()
    texts = [(r["doc_id"], *_expected(library, r["text"])) for r in docs.collect()]
    assert sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"]) for r in rows) == sorted(
        (str(i), ids, d) for i, ids, d in texts)
    assert bpe_decode(coded, Q.WORD_BPE).subtract(coded.select("doc_id", "decoded")).isEmpty()
    assert bpe_encode(docs.limit(0), Q.WORD_BPE).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=60))
def test_best_fit_decreasing_is_the_plain_one(sizes):
    rows, room = [], []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [r for r in range(len(rows)) if room[r] >= sizes[i]]
        if fits:
            least = min(room[r] for r in fits)
            r = next(r for r in fits if room[r] == least)
        else:
            r = len(rows)
            rows.append([])
            room.append(16)
        rows[r].append(sizes[i])
        room[r] -= sizes[i]
    got = best_fit_decreasing(np.array(sizes, np.int64), 16)
    assert sorted(i for r in got for i in r) == list(range(len(sizes)))
    # rows of equal room are interchangeable
    assert sorted(sum(sizes[i] for i in r) for r in got) == sorted(map(sum, rows))


def _unpacked(rows, wide="<u2"):
    pieces = {}
    for r in rows:
        ids, places = np.frombuffer(r["ids"], wide), np.frombuffer(r["positions"], wide)
        edge = r["cu_seqlens"]
        assert edge[0] == 0 and edge[-1] == r["n_tokens"] and len(edge) == len(r["segment_ids"]) + 1
        for a, b, key, start in zip(edge, edge[1:], r["segment_ids"], r["segment_starts"]):
            assert places[a:b].tolist() == list(range(b - a))
            pieces.setdefault(key, []).append((start, ids[a:b].tolist()))
        assert not ids[edge[-1]:].any()
    return pieces


def test_op1_is_lossless(spark):
    ship(spark)
    rows = Q.op1_packing(spark, SMALL).collect()
    assert len({(r["group"], r["row"]) for r in rows}) == len(rows)
    pieces = _unpacked(rows)
    encode = encoding(Q.BYTE_RANKS, P.PATTERN).encode_ordinary
    docs = Q.table(spark, SMALL, "documents").collect()
    assert len(pieces) == len(docs)
    total = 0
    for d in docs:
        own = [t for _, x in sorted(pieces[d["doc_id"]]) for t in x]
        assert own == [*encode(d["text"] or ""), Q.SEPARATOR]
        total += len(own)
    assert total / (len(rows) * 2048) > 0.9


def test_packing_odd_rows(spark):
    ship(spark)
    docs = documents(spark, ODD)
    pieces = _unpacked(pack_tokens(docs, Q.BYTE_RANKS, P.PATTERN, Q.SEPARATOR, length=64, group_tokens=500).collect())
    encode = encoding(Q.BYTE_RANKS, P.PATTERN).encode_ordinary
    expected = sum(len(encode(r["text"] or "")) + 1 for r in docs.collect())
    assert sum(len(x) for p in pieces.values() for _, x in p) == expected
    assert pack_tokens(docs.limit(0), Q.BYTE_RANKS, P.PATTERN, Q.SEPARATOR).count() == 0


_TEXT = st.text(st.sampled_from("ab 's\n\t.,1\x1cé　"), max_size=80)


@settings(max_examples=200, deadline=None)
@given(_TEXT, st.lists(st.tuples(st.integers(-3, 90), st.integers(0, 30), _TEXT), max_size=5))
def test_edited_counts_equal_full_counts(text, edits):
    import lakestream.llm.token_counts as M

    encode = encoding(Q.BYTE_RANKS, P.PATTERN).encode_ordinary
    full, M.LEAF = M.LEAF, 8
    try:
        own = CountedText(text, lambda x: len(encode(x)))
        for at, cut, put in edits:
            own.edit(at, cut, put)
            at = min(max(at, 0), len(text))
            text = text[:at] + put + text[at + cut:]
            assert own.text == text
            assert own.tokens.sums[1] == len(encode(text))
            assert own.chars.sums[1] == len(text)
    finally:
        M.LEAF = full


def test_leaves_end_at_cuts():
    text = long_text(2000)
    leaves = split(text)
    at = 0
    for x in leaves[:-1]:
        at += len(x)
        assert is_cut(text, at)
    assert "".join(leaves) == text


def test_op5_equals_full_counts(spark):
    ship(spark)
    encode = encoding(Q.BYTE_RANKS, P.PATTERN).encode_ordinary
    docs = {r["doc_id"]: r["text"] for r in Q.table(spark, SMALL, "documents").collect()}
    rows = Q.op5_token_counts(spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r["n_tokens"] == len(encode(docs[r["doc_id"]] or ""))
    edits = [(1, 0, "new text "), (40, 30, ""), (3, 5, "x"), (10**9, 5, " end"), (0, 0, None)]
    source = documents(spark, ODD)
    from pyspark.sql import functions as F

    made = source.withColumn("edits", F.array(*[F.struct(F.lit(a).cast("long").alias("at"), F.lit(c).cast("long").alias("cut"),
                                                         F.lit(p).cast("string").alias("put")) for a, c, p in edits]))
    trees = token_trees(made, Q.BYTE_RANKS, P.PATTERN, edits_col="edits")
    out = apply_edits(trees, Q.BYTE_RANKS, P.PATTERN).collect()
    expected = []
    for r in source.collect():
        text = before = r["text"] or ""
        for a, c, p in edits:
            a = min(a, len(text))
            text = text[:a] + (p or "") + text[a + c:]
        expected.append((str(r["doc_id"]), text, len(encode(text)), len(encode(before))))
    assert sorted((str(r["doc_id"]), r["text"], r["n_tokens"], r["n_tokens_before"]) for r in out) == sorted(expected)
    long = max(out, key=lambda r: len(r["text"]))
    assert long["encoded_chars"] < 20_000 < len(long["text"])
    plain = apply_edits(token_trees(source, Q.BYTE_RANKS, P.PATTERN), Q.BYTE_RANKS, P.PATTERN)
    assert all(r["n_tokens"] == r["n_tokens_before"] and r["encoded_chars"] == 0 for r in plain.collect())
    assert apply_edits(trees.limit(0), Q.BYTE_RANKS, P.PATTERN).count() == 0


def test_packed_rows_are_written(spark, scratch):
    from lakestream.llm.packing import write_packed

    ship(spark)
    packed, folder = Q.op1_packing(spark, SMALL), scratch("packed")
    write_packed(packed, folder)
    back = spark.read.parquet(folder)
    assert back.columns == packed.columns
    assert sorted(map(repr, back.collect())) == sorted(map(repr, packed.collect()))
