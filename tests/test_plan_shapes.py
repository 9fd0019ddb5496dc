"""Plan shapes that matter at scale, read from ``explain`` output.

Pruned scans with pushed filters, one shuffle for the flagship, no broadcast
of facts, no Python in the cleaner, map-side partial aggregation.
"""

from __future__ import annotations

import re

import __spark_entry__ as entry
from conftest import SF_SMALL
from conftest import plan_text as plan


def test_flagship_prunes_pushes_broadcasts_and_shuffles_once(spark):
    text = plan(entry.q_gold_stats(spark, SF_SMALL))
    orders = re.search(r"orders\.parquet.*?ReadSchema: (struct<[^>]*>)", text).group(1)
    assert orders == "struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderpriority:string>"
    assert "IsNotNull(o_orderpriority)" in text
    assert text.count("Exchange hashpartitioning") == 1  # the partial aggregates only
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    assert text.index("partial_avg") > text.index("Exchange hashpartitioning")  # partial below


def test_skewed_split_never_broadcasts_facts(spark):
    text = plan(entry.q_gold_stats_skewed(spark, SF_SMALL), "formatted")
    tree = text.split("\n\n")[0]
    assert "SortMergeJoin" in tree and "Union" not in tree and "_salt" in text
    assert len(re.findall(r"\) Scan parquet[^\n]*\nOutput[^\n]*o_orderkey", text)) == 1  # one scan of the facts
    # the only broadcasts are the hot keys (for each side) and the 25 nations
    found = re.findall(r"\(\d+\) BroadcastExchange\nInput \[\d+\]: \[([^\]]*)\]", text)
    assert len(found) >= 3, found
    for cols in found:
        assert "o_orderkey" not in cols and "result_id" not in cols, cols


def test_cleaner_is_native_and_codegen(spark):
    text = plan(entry.q_clean_text(spark, SF_SMALL))
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert "*(1) Project" in text and "regexp_replace" in text


def test_dedup_and_latest_aggregate_before_the_shuffle(spark):
    from lakestream.operators import latest_per_key

    text = plan(entry.q_dedup(spark, SF_SMALL))
    lines = text.splitlines()
    ex = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert any("HashAggregate" in line for line in lines[ex + 1:])  # map-side step under the shuffle

    hist = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "k int, v string, batch_id int")
    text = plan(latest_per_key(hist, ["k"], "batch_id"))
    assert "partial_max_by" in text


def test_pre_aggregated_gold_joins_counts_not_facts(spark):
    text = plan(entry.q_gold_stats_preagg(spark, SF_SMALL), "formatted")
    tree = text.split("\n\n")[0].splitlines()
    smj = next(i for i, line in enumerate(tree) if "SortMergeJoin" in line)
    scan = next(i for i, line in enumerate(tree) if "Scan parquet" in line and i > smj)  # orders, first child
    assert any("HashAggregate" in line for line in tree[smj:scan])
    assert "BroadcastNestedLoopJoin" not in text
