"""Aggregations: grouped means, distinct values, indicators, profiles, latest state."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lakestream.functions import as_double, run_timestamp
from lakestream.operators.enrich import enrich
from lakestream.schemas import MEASURES, STAT_KEYS, TIMESTAMP_COL
from lakestream.session import scratch_path


def group_means(df: DataFrame, keys: Sequence[str] = STAT_KEYS,
                measures: Sequence[str] = MEASURES, run_ts=None, digits: int | None = None,
                ts_col: str | None = TIMESTAMP_COL) -> DataFrame:
    """``avg_<measure>`` per group, plus the computation time.

    Measures are converted with ``try_cast`` to double first, so text that is
    not a number is ignored like NULL instead of failing the job. A NULL key
    value forms its own group. Planned as partial + final hash aggregation,
    so one huge group is pre-reduced in every map task before the shuffle;
    the same expression is a running aggregate on a stream.
    ``digits`` rounds the averages (for reproducible comparisons).
    """
    aggs = []
    for m in measures:
        a = F.avg(as_double(df[m]))
        aggs.append((F.round(a, digits) if digits is not None else a).alias(f"avg_{m}"))
    out = df.groupBy(*keys).agg(*aggs)
    if ts_col:
        out = out.withColumn(ts_col, run_timestamp(run_ts))
    return out


def weighted_means(df: DataFrame, weight: str, keys: Sequence[str] = STAT_KEYS,
                   measures: Sequence[str] = MEASURES, run_ts=None, digits: int | None = None,
                   ts_col: str | None = TIMESTAMP_COL) -> DataFrame:
    """:func:`group_means` over rows that each stand for ``weight`` equal rows.

    ``avg_<m> = Σ(weight·m) / Σ(weight where m is not NULL)``: the same value
    as averaging the expanded rows (NULL when no row has a number, NaN when
    one is NaN). Lets a join run on pre-aggregated counts instead of on every
    row.
    """
    w = df[weight]
    aggs = []
    for m in measures:
        v = as_double(df[m])
        a = F.sum(v * w) / F.sum(F.when(v.isNotNull(), w))
        aggs.append((F.round(a, digits) if digits is not None else a).alias(f"avg_{m}"))
    out = df.groupBy(*keys).agg(*aggs)
    if ts_col:
        out = out.withColumn(ts_col, run_timestamp(run_ts))
    return out


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """One row with the table's row count."""
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Every distinct (column, value) pair over the listed columns, in one pass.

    Values are rendered as text; NULL is a value of its own.
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), df[c].cast("string").alias("value")) for c in cols
    ])).alias("cv")
    return df.select(pairs).select("cv.*").distinct()


def indicator_name(column: str, value) -> str:
    """``<column>__<value>``; anything but ASCII letters, digits, ``.`` and ``-`` as ``_<hex>_``, NULL as ``_null_``.

    Different values have different names: the text ``None`` and NULL, ``a b`` and ``a_b``.
    """
    if value is None:
        return f"{column}___null_"
    return f"{column}__" + "".join(
        c if c.isascii() and (c.isalnum() or c in ".-") else f"_{ord(c):x}_" for c in str(value))


def indicator_columns(df: DataFrame, cols: Sequence[str], vocabulary: Iterable[tuple[str, str | None]],
                      keep: Sequence[str] | None = None) -> DataFrame:
    """One-hot columns named by :func:`indicator_name` (1 when the row has that value, else 0).

    ``vocabulary`` lists the (column, value) pairs that get a column, such as
    the rows of :func:`distinct_values` of columns known to have few values;
    :func:`indicator_map` is the form for any number of values. ``keep`` lists
    input columns to carry along (default: all).
    """
    order = {c: i for i, c in enumerate(cols)}
    vocab = sorted({(c, v) for c, v in vocabulary if c in order},
                   key=lambda cv: (order[cv[0]], cv[1] is None, cv[1] or ""))
    carried = list(df.columns if keep is None else keep)
    names = carried + [indicator_name(c, v) for c, v in vocab]
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"indicator names clash with each other or with columns: {sorted(names)}")
    flags = []
    for c, v in vocab:
        hit = df[c].isNull() if v is None else df[c].cast("string").eqNullSafe(F.lit(v))
        flags.append(F.when(hit, 1).otherwise(0).alias(indicator_name(c, v)))
    return df.select(*[df[c] for c in carried], *flags)


def indicator_map(df: DataFrame, cols: Sequence[str], map_col: str = "indicators",
                  keep: Sequence[str] | None = None) -> DataFrame:
    """Indicators as a map ``{(column, value): 1}`` per row, for any number of values; NULL is a value."""
    entries = []
    for c in dict.fromkeys(cols):
        entries += [F.struct(F.lit(c).alias("column"), df[c].cast("string").alias("value")), F.lit(1)]
    carried = [df[c] for c in (df.columns if keep is None else keep)]
    return df.select(*carried, F.create_map(*entries).alias(map_col))


def value_dictionary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``column``, ``value``, ``id``: every distinct pair, numbered 0, 1, 2 ... in the order of column and value (NULL first).

    The pairs are sorted by range and written to the shared scratch folder; each
    range numbers its own, and one row a range says how many came before. The
    driver sees none of them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "dictionary")
    distinct_values(df, cols).repartitionByRange("column", "value").sortWithinPartitions("column", "value").withColumn(
        "row", F.monotonically_increasing_id()).write.parquet(path)
    pairs = spark.read.schema("`column` string, value string, row long").parquet(path).select(
        "column", "value", F.shiftright("row", 33).alias("range"), F.expr("row & 8589934591").alias("within"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = pairs.groupBy("range").agg(F.count("*").alias("n")).select(
        "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return pairs.join(F.broadcast(offsets), "range").select("column", "value", (F.col("within") + F.col("before")).alias("id"))


def indicator_vectors(df: DataFrame, cols: Sequence[str], dictionary: DataFrame, vector_col: str = "indicators",
                      keep: Sequence[str] | None = None) -> DataFrame:
    """One-hot vectors in sparse form: the ascending dictionary ids of a row's values, for any number of values.

    A value that the dictionary doesn't have has no id. The dictionary is
    broadcast if it measures small enough; else common values are joined salted.
    """
    text = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))  # noqa: E731  a NULL is a value
    carried = list(df.columns if keep is None else keep)
    out = df.select(F.struct(*carried).alias("row"), *(text(df[c]).alias(f"key {i}") for i, c in enumerate(cols)))
    for i, c in enumerate(cols):
        own = dictionary.where(F.col("column") == c).select(text(F.col("value")).alias(f"key {i}"), F.col("id").alias(f"id {i}"))
        out = enrich(out, own, f"key {i}", "left", skew="split", drop_shared=False)
    ids = F.array_sort(F.array_compact(F.array(*(F.col(f"id {i}") for i in range(len(cols))))))
    return out.select("row.*", ids.alias(vector_col))


def profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type, non-NULL count and table row count.

    A single aggregate pass over the table, unpivoted afterwards.
    """
    fields = df.schema.fields
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count(df[f.name]).alias(f"_c{i}") for i, f in enumerate(fields)])
    cells = F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                 F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.col(f"_c{i}").alias("non_null"))
        for i, f in enumerate(fields)
    ])).alias("p")
    return agg.select(F.col("_rows").alias("rows"), cells).select("p.*", "rows")


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows (a look at the data, like ``show``)."""
    return df.limit(n)


def latest_per_key(history: DataFrame, keys: Sequence[str], order_col: str = "batch_id") -> DataFrame:
    """For an append-only history of updates, the newest row per key.

    Text in ``order_col`` (the sinks tag batches with text) is ordered as the
    number it holds: batch 10 is newer than batch 9.

    Uses ``max_by`` in a grouped aggregate (map-side partial), so a key with
    a very long history is reduced in every map task before the shuffle.
    Ties on ``order_col`` (a replayed batch) resolve to one of the equal rows.
    """
    values = [c for c in history.columns if c not in set(keys)]
    order = history[order_col]
    if isinstance(history.schema[order_col].dataType, StringType):
        order = F.struct(order.try_cast("decimal(38,0)"), order)
    latest = F.max_by(F.struct(*[history[c] for c in values]), order).alias("_latest")
    return history.groupBy(*[history[k] for k in keys]).agg(latest).select(*keys, "_latest.*")
