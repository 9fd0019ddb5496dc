"""Interaction audit of filters: what each removes at each step of each order, and what others would have removed.

Failing-id relations: every filter has a table of the rows that fail it, by row
number. What a set of filters leaves is the rows left-anti joined with each of
their tables, whatever their order, so the prefixes of all orders come down to
one relation for each set. Rows with a good or toxic label are left-semi joined
out once and go through the same joins. From the survivors' counts of each part:

* removed by a filter after a set: survivors of the set less those of the set with it;
* redundant: all that fail it less those;
* failing it alone: what it removes after all others;
* its Shapley value, over all orders: the removals after each set, times the
  orders that have this set before it.

All relations are joined on the row number, so a plan shuffles each once and
that exchange is read by all its joins; row numbers are unique, so no key is hot. Counts
are added up by part before they are shuffled. Row numbers are given when the
rows are written, so they hold for all reads.

Results on odd rows: a null text is empty, a null part the empty string; rows
without an id are judged by the filters of their own text, but equal no smaller
id and have no label; a repeated row counts as often as it stands there, and the
copies of the smallest id don't fail as copies; an id labelled twice has both
labels. Empty labels lose nothing; an empty table has no parts and no rows.
Other columns don't count.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestream.llm._tables import written

#: Words: runs of anything but these characters.
SPACE = "[\\x20\\x09-\\x0D]+"
#: Filters whose sets are joined in one plan.
TOGETHER = 3
#: What the rows of a relation stand for.
ALL, GOOD, TOXIC = 0, 1, 2


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def text_filters(text: str = "text") -> dict[str, Column]:
    """Failure conditions of a text: too short, too repetitive, too many capitals, marks of markup or code."""
    own = words(F.col(text))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {"A": F.size(own) < 50,
            "B": 100 * F.size(F.array_distinct(own)) < 65 * F.size(own),
            "C": 100 * capitals > 5 * F.length(text),
            "D": F.col(text).rlike("[#$%&*|]")}


def copies(rows: DataFrame) -> DataFrame:
    """Rows (``row``, ``id``, ``hash``) whose text a smaller id has: all but those of each text's least id.

    They are found by id and text, so that the rows of a very common text don't meet in one task.
    """
    known = rows.where("id is not null")
    least = known.groupBy("hash").agg(F.min("id").alias("id"))
    return known.join(least, ["hash", "id"], "left_anti").select("row")


def numbered(docs: DataFrame, filters: Mapping[str, Column], id_col: str, part_col: str, text_col: str) -> DataFrame:
    """``row``, ``id``, ``part``, ``hash`` (of the text) and a flag for each filter; written."""
    text = F.coalesce(text_col, F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       text.alias(text_col))
    flags = [F.coalesce(c, F.lit(False)).alias(f"fails {name}") for name, c in filters.items()]
    return written(rows.select(F.monotonically_increasing_id().alias("row"), "id", "part",
                               F.unhex(F.sha2(text_col, 256)).alias("hash"), *flags), "rows")


def survivors(rows: DataFrame, failing: list[DataFrame]) -> DataFrame:
    """``part``, ``kind``, ``after`` (a set of filters as bits) and ``n``: the rows that no filter of the set removes.

    What the filters beyond the first ``TOGETHER`` leave is written for each set
    of those; the sets of the first ones start from there, in one plan each.
    """
    def left(start: DataFrame, after: int) -> DataFrame:
        some = [f for i, f in enumerate(failing) if after >> i & 1]
        return reduce(lambda r, f: r.join(f, "row", "left_anti"), some, start)

    def counts(late: int) -> DataFrame:
        start = rows if late == 0 else written(left(rows, late), "survivors")
        sets = [left(start, early).groupBy("part", "kind").agg(F.count("*").alias("n")).withColumn("after", F.lit(late | early))
                for early in range(first)]
        return written(reduce(DataFrame.unionAll, sets), "counts")

    first = 1 << min(TOGETHER, len(failing))
    return reduce(DataFrame.unionAll, map(counts, range(0, 1 << len(failing), first)))


def audit(rows: DataFrame, failing: Mapping[str, DataFrame], good: DataFrame, toxic: DataFrame) -> DataFrame:
    """The counts of each part, order and step.

    ``rows`` has ``row``, ``id`` and ``part``; ``failing`` the ``row`` numbers
    that fail each filter; ``good`` and ``toxic`` ids.
    """
    names = list(failing)
    k, every = len(names), (1 << len(names)) - 1
    tables = [written(f.select("row"), f"failing-{name}") for name, f in failing.items()]
    kinds = [rows.select("row", "part", F.lit(ALL).alias("kind"))] + [
        rows.join(ids.toDF("id").distinct(), "id", "left_semi").select("row", "part", F.lit(kind).alias("kind"))
        for kind, ids in ((GOOD, good), (TOXIC, toxic))]
    counts = survivors(written(reduce(DataFrame.unionAll, kinds), "kinds"), tables)

    # 3 * 2^k numbers for each part
    known = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(
        F.struct((F.col("after") * 3 + F.col("kind")).alias("key"), "n"))).alias("n"))
    left = lambda after, kind=ALL: F.coalesce(F.col("n")[after * 3 + kind], F.lit(0).cast("long"))
    bit = lambda i: F.lit(1 << i)

    def shapley(i: int) -> Column:
        before = [s for s in range(every + 1) if not s >> i & 1]
        weight = lambda s: factorial(s.bit_count()) * factorial(k - 1 - s.bit_count())
        return sum((weight(s) * (left(F.lit(s)) - left(F.lit(s | 1 << i))) for s in before), F.lit(0).cast("long"))

    # for each filter: what fails it, what fails it alone, and its Shapley value
    per_filter = (F.array(*(left(F.lit(0)) - left(bit(i)) for i in range(k))).alias("all_failing"),
                  F.array(*(left(F.lit(every ^ 1 << i)) - left(F.lit(every)) for i in range(k))).alias("alone"),
                  F.array(*(shapley(i) for i in range(k))).alias("values"))
    steps = [(order, at, sum(1 << f for f in order[:at]), order[at]) for order in permutations(range(k)) for at in range(k)]
    spelled = F.lit(["".join(names[i] for i in o) for o, _, _, _ in steps])
    place = F.arrays_zip(spelled.alias("filter_order"), F.lit([at + 1 for _, at, _, _ in steps]).alias("step"),
                         F.lit([b for _, _, b, _ in steps]).alias("before"), F.lit([f for _, _, _, f in steps]).alias("own"))
    rows = known.select("part", "n", *per_filter, F.explode(place).alias("at")).select(
        "part", "n", "all_failing", "alone", "values", "at.*")
    after = F.expr("before + shiftleft(1, own)")
    lost = lambda kind: left(F.col("before"), kind) - left(after, kind)
    return rows.select("part", "filter_order", "step", left(after).alias("kept"), lost(ALL).alias("removed"),
                       (F.col("all_failing")[F.col("own")] - lost(ALL)).alias("redundant"),
                       F.col("alone")[F.col("own")].alias("unique_fails"), lost(GOOD).alias("good_lost"),
                       lost(TOXIC).alias("toxic_lost"), F.col("values")[F.col("own")].alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column] | None = None, copies_as: str | None = "E",
                 id_col: str = "doc_id", part_col: str = "source", text_col: str = "text") -> DataFrame:
    """Per part, order of the filters and step: ``kept``, ``removed``, ``redundant``, ``unique_fails``, ``good_lost``,
    ``toxic_lost`` and ``shapley``.

    ``filters`` are failure conditions on the (never null) text; ``copies_as``
    adds one under that letter that texts of a smaller id fail. ``labels`` has
    the id, ``quality`` and ``toxic``.
    """
    filters = text_filters(text_col) if filters is None else filters
    rows = numbered(docs, filters, id_col, part_col, text_col)
    failing = {name: rows.where(f"`fails {name}`") for name in filters}
    if copies_as:
        failing[copies_as] = copies(rows)
    return audit(rows, failing, labels.where("quality = 1").select(id_col), labels.where("toxic = 1").select(id_col))
