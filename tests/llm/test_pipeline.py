"""The pipeline: each stage on its own input against brute force; planted documents go, clean ones stay."""

from __future__ import annotations

import sys
from pathlib import Path

import numpy as np
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
from helpers import ODD, documents, long_text  # noqa: E402
from test_pairs import classes, leaks, passages  # noqa: E402

import corpus_pipeline  # noqa: E402
from lakestream.llm import queries as Q  # noqa: E402
from lakestream.llm.toxicity import fit_ordinal, toxicity  # noqa: E402
from lakestream.llm._ship import ship  # noqa: E402

SMALL = "/root/testdata/sf0.01"


def test_each_stage_does_its_work_on_what_the_one_before_kept(spark):
    ship(spark)
    stages = dict(corpus_pipeline.STAGES)
    docs = Q.table(spark, SMALL, "documents")
    names = docs.columns

    rows = docs.collect()
    model = fit_ordinal(docs, Q.table(spark, SMALL, "labels"))
    rejected = {r["doc_id"] for r in toxicity(docs, model).where("rejected").collect()}
    one = stages["toxicity"](spark, docs, SMALL)
    kept = [r for r in rows if r["doc_id"] not in rejected]
    assert one.columns == names and sorted(one.collect()) == sorted(kept) and rejected

    two = stages["near_duplicates"](spark, one, SMALL)
    top = classes({r["doc_id"]: r["text"] for r in kept})
    kept = [r for r in kept if top[r["doc_id"]] == r["doc_id"]]
    assert two.columns == names and sorted(two.collect()) == sorted(kept) and len(kept) < len(top)

    three = stages["suffix_dedup"](spark, two, SMALL).cache()
    left = dict(zip([r["doc_id"] for r in kept], passages(
        [r["text"] for r in kept], corpus_pipeline.PASSAGE_BYTES, corpus_pipeline.PASSAGE_WORDS)))
    texts = {r["doc_id"]: r["text"] for r in three.collect()}
    assert three.columns == names and texts == {i: t for i, t in left.items() if t}

    four = stages["decontamination"](spark, three, SMALL)
    items = [(r["item_id"], r["text"]) for r in Q.table(spark, SMALL, "benchmark").collect()]
    dirty = {d for d, _ in leaks(texts.items(), items)}
    assert four.columns == names and {r["doc_id"] for r in four.collect()} == texts.keys() - dirty

    library = Tokenizer.from_file(Q.WORD_BPE)
    five = stages["bpe_encoding"](spark, four, SMALL).collect()
    assert {r["doc_id"] for r in five} == texts.keys() - dirty
    for r in five:
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode(texts[r["doc_id"]], add_special_tokens=False).ids

    whole = Q.queries()["pipeline"](spark, SMALL).collect()
    assert {(r["doc_id"], r["n_tokens"]) for r in whole} == {(r["doc_id"], r["n_tokens"]) for r in five}


def test_stages_take_odd_rows(spark):
    ship(spark)
    docs = documents(spark, [*ODD, (40, long_text(200, 4))])
    for start in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, start, SMALL)
            assert out.columns == docs.columns, name
            assert out.count() <= start.count()
        assert corpus_pipeline.STAGES[-1][1](spark, start, SMALL).count() == start.count()
