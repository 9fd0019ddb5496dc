"""Mixing sources to target weights: whole copies for certain, the rest by Pareto order sampling.

Each source gets a target of words: shares of a total by weight, none above a
given multiple of the source's own size; what a source can't take is shared
again among the others. A source takes as many whole copies of all its documents
as its target holds. The rest is a sample without replacement: a document's
random odds u / (1 - u), divided by its inclusion odds p / (1 - p), rank it, and
the first documents up to the words wanted are taken, the last one if that comes
nearer. ``u`` comes from a hash of id and text, so reruns agree.

Long documents would miss the target by much, so they are drawn first:
``STRATA`` splits a source by document size relative to the words wanted, and
each stratum's inclusion probability is that of the words that those before it
have left over. The last stratum's documents are short, and what is missing or
too much is at most half of one of them.

All strata are sorted at once, by range, with running totals (a source may hold
any share of all rows); the words taken then are one aggregate a stratum.
Sources are shared out from sums, whose rows are one a source.

Results on odd rows: a null or empty text has no words and takes none; a null
source is one of its own, the last; a source without words has target 0; rows
with the same id and text are ranked one after the other, and which of them is
taken doesn't show; ids may be null or of any type. An empty table gives none.
Other columns don't count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestream.llm._order import running
from lakestream.llm._tables import written
from lakestream.operators.enrich import enrich

SPACE = "[\\x20\\x09-\\x0D]+"
#: Weights of the sources in their order, again and again; words of the mix for each one of the corpus; copies at most.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Documents above these shares of a source's sampled words are drawn before shorter ones.
STRATA = (1, 1 / 4, 1 / 16, 1 / 64, 1 / 256)
SEED = 20260101
_BITS = 52


def _sources(rows: DataFrame, weights: Sequence[int]) -> DataFrame:
    """``source``, ``source_size``, ``weight``; one row a source."""
    sums = written(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sums")
    order = running(sums.select(F.lit("").alias("whole"), F.col("source").isNull().alias("last"), "source", "source_size",
                                F.lit(1).cast("long").alias("one")), "whole", ["last", "source"], "one", "source-order")
    weight = F.lit([float(w) for w in weights])[F.pmod("before", F.lit(len(weights))).cast("int")]
    return written(order.select("source", "source_size", weight.alias("weight")), "sources")


def targets(rows: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from rows with a ``source`` and a ``size``.

    Each round shares what capped sources leave among the others by weight; the
    driver sees two sums a round.
    """
    sources = _sources(rows, weights)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = None
    while True:  # the words for a weight of 1 only grow, and stop when no further source is capped
        full = F.lit(False) if level is None else F.col("source_size") * most <= F.lit(level) * F.col("weight")
        capped, weight = sources.agg(F.sum(F.when(full, F.col("source_size") * most).otherwise(0)),
                                     F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        new = (share * total - capped) / weight if weight else None
        if new is None or new == level:
            break
        level = new
    cap = (F.col("source_size") * most).cast("double")
    target = cap if level is None or new is None else F.least(cap, F.lit(level) * F.col("weight"))
    return sources.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, strata: Sequence[float] = STRATA,
        seed: int = SEED) -> DataFrame:
    """Per row: its id, ``size``, ``source_size``, ``target`` (of its source), ``copies`` (whole ones) and ``taken`` words."""
    text = F.coalesce(text_col, F.lit(""))
    size = F.size(F.filter(F.split(text, SPACE), lambda w: w != "")).cast("long")
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.md5(text))
    draw = F.conv(F.substring(F.md5(name), 1, _BITS // 4), 16, 10).cast("long")
    rows = written(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), size.alias("size"),
                               draw.alias("draw"), F.monotonically_increasing_id().alias("row")), "sizes")
    goals = targets(rows, weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    name_of = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    goals = written(goals.select(name_of.alias("name"), "source_size", "target", whole.alias("whole"),
                                 (F.col("target") - whole * F.col("source_size")).alias("rest")), "targets")
    rows = enrich(rows.withColumn("name", name_of).drop("source"), goals, "name", skew="split")

    # the ranking: within a stratum the inclusion probability is one number, which the words left over only shift
    stratum = sum(((F.col("size") <= F.col("rest") * s).cast("int") for s in strata), F.lit(0))
    u = (F.col("draw") + 0.5) / F.lit(float(1 << _BITS))
    p = F.when(F.col("rest") > 0, F.col("rest") / F.col("source_size")).otherwise(F.lit(0.5))
    ranked = rows.select("id", "size", "row", "source_size", "target", "whole", "rest", "name", stratum.alias("stratum"),
                         F.concat(stratum.cast("string"), F.lit("|"), F.col("name")).alias("group"),
                         ((u / (1 - u)) / (p / (1 - p))).alias("rank"))
    placed = written(running(ranked, "group", ["rank", "row"], "size", "ranking"), "ranked")

    # words wanted of each stratum, from the first (long documents) to the last
    sums = written(placed.groupBy("name", "stratum").agg(F.first("total").alias("words"), F.first("rest").alias("rest")), "strata")
    wanted = None
    left = goals.select("name", F.col("rest").alias("need"), F.col("source_size").alias("words_left"))
    for k in range(len(strata) + 1):
        own = sums.where(F.col("stratum") == k).select("name", "words")
        here = left.join(own, "name", "left").select(
            "name", "need", "words_left", F.coalesce("words", F.lit(0)).alias("words"))
        share_of = F.when(F.col("words_left") > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("need") / F.col("words_left"))))
        here = written(here.select("name", "need", "words_left", "words", (F.col("words") * share_of).alias("goal"),
                                   F.concat(F.lit(f"{k}|"), F.col("name")).alias("group")), "goals")
        goal = here.select("group", F.coalesce("goal", F.lit(0.0)).alias("goal"))
        wanted = goal if wanted is None else wanted.unionAll(goal)
        if k < len(strata):
            took = (enrich(placed.where(F.col("stratum") == k).select("group", "name", "size", "before"), goal, "group", skew="split")
                    .where(_taken()).groupBy("name").agg(F.sum("size").alias("took")))
            left = here.join(took, "name", "left").select(
                "name", (F.col("need") - F.coalesce("took", F.lit(0))).alias("need"),
                (F.col("words_left") - F.col("words")).alias("words_left"))
    chosen = enrich(placed, wanted, "group", skew="split")
    n = F.col("whole") + _taken().cast("long")
    return chosen.select(F.col("id").alias(id_col), "size", "source_size", "target", n.alias("copies"),
                         (n * F.col("size")).alias("taken"))


def _taken():
    """Up to the words wanted, and the document across that line if it comes nearer with it."""
    return (F.col("goal") > 0) & (2 * F.col("before") + F.col("size") <= 2 * F.col("goal"))
