"""Merkle manifest, filter audit and source mixing against brute force and SQL, on odd rows too."""

from __future__ import annotations

import sys
import zlib
from hashlib import sha256
from itertools import permutations
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).parent))
from helpers import ODD, long_text  # noqa: E402

from lakestream.llm._order import running  # noqa: E402
from lakestream.llm._ship import ship  # noqa: E402
from lakestream.llm.filter_audit import filter_audit  # noqa: E402
from lakestream.llm.merkle import fold, merkle_manifest  # noqa: E402
from lakestream.llm.mixing import mix, targets  # noqa: E402

#: The columns of documents and names that operators use inside.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("row", T.StringType()),
    T.StructField("tree", T.StringType()), T.StructField("pos", T.IntegerType()), T.StructField("part", T.StringType()),
    T.StructField("before", T.IntegerType()), T.StructField("size", T.StringType()), T.StructField("id", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(*r, "r", "t", 1, "p", 2, "s", "i") for r in rows], SCHEMA)


def odd_rows():
    rows = [(i, t, ("en", None, "", "fr")[k % 4], ("b", None, "a", "")[k % 3], None if k % 5 == 0 else len(t or ""))
            for k, (i, t) in enumerate(ODD)]
    return rows + rows[-1:] * 3 + [(i, f"text {i} & More", "en", "a", 9) for i in range(100, 137)]


def digest(parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(r):
    values = [r[0], r[3], r[2], r[4], r[1]]
    return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def grow(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(levels[-1][i:i + fanout]) for i in range(0, len(levels[-1]), fanout)])
    return levels


def manifest(rows, fanout):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    names = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    built = {name: grow([leaf(r) for r in trees[name]], fanout) for name in names}
    top = grow([built[name][-1][0] for name in names], fanout)
    out = []
    for at_tree, name in enumerate(names):
        for at, r in enumerate(trees[name]):
            touched = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded, others = leaf((*r[:4], r[4] + 1)) if touched else leaf(r), []
            for levels, i in ((built[name], at), (top, at_tree)):
                for nodes in levels[:-1]:
                    run = nodes[i - i % fanout:i - i % fanout + fanout]
                    others += run[:i % fanout] + run[i % fanout + 1:]
                    folded = digest([*run[:i % fanout], folded, *run[i % fanout + 1:]])
                    i //= fanout
            out.append((r[0], leaf(r), built[name][-1][0], top[-1][0], digest(others), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def touched_lengths():
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return F.when(touched, F.col("n_chars") + 1).otherwise(F.col("n_chars"))


@pytest.mark.parametrize("fanout, height, keep", [(2, 2, None), (3, 1, None), (2, 10, 1), (2, 1, 2)])
def test_manifest_equals_brute_force(spark, fanout, height, keep):
    ship(spark)
    rows = odd_rows()[:keep]
    found = merkle_manifest(frame(spark, rows).repartition(3), checked={"n_chars": touched_lengths()}, fanout=fanout, height=height).collect()
    plain = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]) for r in found]
    assert sorted(plain, key=str) == manifest(rows, fanout)
    for r in found:  # the proof itself leads from the leaf to the root
        assert fold(r["leaf"], [bytes(s) for s in r["proof"]]) == r["root"]


def test_large_ids_and_no_rows(spark):
    ship(spark)
    rows = [(2**62 + i, "x", None, None, 1) for i in range(3)] + [(None, "x", None, None, 1)]
    found = merkle_manifest(frame(spark, rows))
    assert {r["doc_id"] for r in found.collect()} == {2**62, 2**62 + 1, 2**62 + 2, None} and found.where("verified").count() == 4
    assert merkle_manifest(frame(spark, rows).limit(0)).count() == 0


def test_running_totals_of_a_group_over_many_partitions(spark):
    ship(spark)
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
                                    F.xxhash64("id").alias("o"), (F.col("id") % 7).alias("v")).repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = running(rows, "g", ["o"], "v", "test").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    groups = {}
    for r in sorted(rows.collect(), key=lambda r: r["o"]):
        groups.setdefault(r["g"], []).append(r)
    want = {}
    for g, own in groups.items():
        before, total = 0, sum(r["v"] for r in own)
        for r in own:
            want[r["o"]] = (before, total)
            before += r["v"]
    assert {r["o"]: (r["before"], r["total"]) for r in found} == want


def fails(rows):
    first = {}
    for r in rows:
        if r[0] is not None:
            first[r[1] or ""] = min(first.get(r[1] or "", r[0]), r[0])
    out = []
    for r in rows:
        text = r[1] or ""
        words, at = [], ""
        for c in text + " ":
            if c in " \t\n\x0b\x0c\r":
                words += [at] if at else []
                at = ""
            else:
                at += c
        out.append({x for x, bad in (("A", len(words) < 50), ("B", 100 * len(set(words)) < 65 * len(words)),
                                     ("C", 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text)),
                                     ("D", any(c in "#$%&*|" for c in text)),
                                     ("E", r[0] is not None and r[0] > first[text])) if bad})
    return out


def test_audit_equals_brute_force(spark):
    rows = odd_rows() + [(300 + i, long_text(60 + i, i % 4) + (" #" if i % 3 == 0 else ""), "en", f"s{i % 2}", 1) for i in range(9)]
    labels = [(1, 1, 0), (6, 1, 1), (6, 0, 0), (101, 0, 1), (302, 1, 1), (303, None, 1), (None, 1, 1), (999, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in filter_audit(frame(spark, rows), table).collect()}
    failing = fails(rows)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    want, values = {}, {}
    for part in {r[3] or "" for r in rows}:
        own = [(r, f) for r, f in zip(rows, failing) if (r[3] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for at, x in enumerate(order):
                gone = [(r, f) for r, f in left if x in f]
                left = [(r, f) for r, f in left if x not in f]
                values[part, x] = values.get((part, x), 0) + len(gone)
                want[part, order, at + 1] = [
                    len(left), len(gone), sum(x in f for _, f in own) - len(gone), sum(f == {x} for _, f in own),
                    sum(r[0] in good for r, _ in gone), sum(r[0] in toxic for r, _ in gone)]
    assert found == {(p, o, k): (*v, values[p, o[k - 1]]) for (p, o, k), v in want.items()}
    assert filter_audit(frame(spark, rows).limit(0), table).count() == 0
    lost = filter_audit(frame(spark, rows), table.limit(0)).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()
    assert tuple(lost) == (0, 0)


def test_targets_fill_up_by_weight(spark):
    rows = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), ("d", 20), (None, 400), ("", 0)], "source string, size long")
    got = {r["source"]: r["target"] for r in targets(rows).collect()}
    size, weight = {"": 0, "a": 10, "b": 1000, "c": 500, "d": 20, None: 400}, {"": 3, "a": 1, "b": 2, "c": 3, "d": 1, None: 2}
    want, free, words = {}, set(size), 1.5 * sum(size.values())
    while free:
        level = words / sum(weight[s] for s in free)
        full = {s for s in free if 2 * size[s] < level * weight[s]}
        if not full:
            want |= {s: level * weight[s] for s in free}
            break
        want |= {s: 2.0 * size[s] for s in full}
        words -= sum(2 * size[s] for s in full)
        free -= full
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)
    assert abs(sum(got.values()) - 1.5 * sum(size.values())) < 1e-6


def test_mix_meets_its_targets_and_reruns_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    hot = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(F.col("source")))
    for table in (docs, hot):
        found = mix(table).cache()
        own = found.groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.max("size").alias("long")).collect()
        for r in own:
            assert abs(r["taken"] - r["target"]) <= 0.02 * r["target"], r
        assert found.where("taken > 2 * size or taken < 0 or taken <> copies * size").isEmpty()
        again = mix(table.repartition(7, "n_chars").select(*reversed(table.columns)))
        key = lambda d: sorted(map(tuple, d.select("doc_id", "taken").collect()))
        assert key(found) == key(again)


def test_mix_takes_odd_rows(spark):
    rows = odd_rows()
    found = mix(frame(spark, rows)).collect()
    assert len(found) == len(rows) and all(0 <= r["taken"] <= 2 * r["size"] for r in found)
    assert mix(frame(spark, rows).limit(0)).count() == 0
    lone = mix(frame(spark, [(1, None, None, None, None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in lone] == [(0, 0.0, 0)]
    copies = [(5, "one two three", None, "a", 1)] * 400 + [(k, "four five six", None, "b", 1) for k in range(400)]
    got = mix(frame(spark, copies)).groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 3 for r in got)
