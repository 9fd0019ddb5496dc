"""The corpus pipeline: toxicity, near-duplicates, repeated passages, benchmark leaks, token ids.

Each stage takes the documents that its predecessor kept and is judged on those.
All but the last return the columns of the documents; the last returns their ids
and tokens. Documents without an id can be no near-duplicate of another; they
stay. Of rows with the same id and text one stays; different texts of an id are judged one by one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestream.llm._batches import table
from lakestream.llm._ship import ship
from lakestream.llm._tables import written
from lakestream.llm.bpe import bpe_encode
from lakestream.llm.decontaminate import without_leaks
from lakestream.llm.probminhash import kept_documents
from lakestream.llm.suffix_dedup import without_repeats
from lakestream.llm.toxicity import fit_ordinal, without_toxic


#: Passages that the suffix stage removes: of so many words, found by repeated strings of so many bytes
#: (in prose 51 words have some 300 bytes, and fewer than 160 in one of a thousand cases).
PASSAGE_WORDS, PASSAGE_BYTES, PASSAGE_WINDOW = 50, 160, 64


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose severity is below grade 1."""
    ship(spark)
    return without_toxic(docs, fit_ordinal(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the least id."""
    ship(spark)
    return kept_documents(docs)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that start in two places; those of which nothing is left go."""
    ship(spark)
    return without_repeats(docs, length=PASSAGE_BYTES, window=PASSAGE_WINDOW, min_words=PASSAGE_WORDS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (little-endian 32-bit) and ``decoded``."""
    ship(spark)
    return bpe_encode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("suffix_dedup", suffix_stage),
    ("decontamination", decontamination_stage),
    ("bpe_encoding", encoding_stage),
]

#: SQL can't express the fitted model and the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result but the last written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    encoded = STAGES[-1][1](spark, docs, sf_dir)
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
