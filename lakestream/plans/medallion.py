"""Layered lake jobs: landing CSV → bronze → silver → gold.

Each job reads whole tables, lets Catalyst prune and push filters into the
Parquet scans, and overwrites its output so a re-run replaces rather than
duplicates. Layers are the boundary between jobs (a written table), so a
failed stage restarts from the previous layer, not from the landing files.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestream.operators import (clean_string_columns, coerce_numeric, dedup_rows,
                                  drop_shared_columns, enrich, fits_broadcast, group_means,
                                  numeric_rows, require_not_null, weighted_means)
from lakestream.schemas import ATHLETE_KEY, MEASURES, STAT_KEYS
from lakestream.sources.files import BRONZE, GOLD, SILVER, read_csv, read_layer, write_layer

# The two tables of the lake and the gold table name.
BIO_TABLE = "athlete_bio"
RESULTS_TABLE = "athlete_event_results"
GOLD_TABLE = "avg_stats"
LAKE_TABLES = (BIO_TABLE, RESULTS_TABLE)

NOT_NULL_KEYS = ("sex", "country_noc", "sport")


def gold_stats(results: DataFrame, bio: DataFrame, key: str = ATHLETE_KEY, run_ts=None,
               digits: int | None = None, broadcast: bool | str = "checked",
               skew: str = "adaptive", pre_aggregate: bool = False) -> DataFrame:
    """Average height and weight per (sport, medal, sex, country_noc).

    Inner join on ``key`` (the dimension's copy of shared columns wins),
    measures coerced to double (bad text → NULL, ignored by the average),
    rows with a NULL sex, country or sport dropped, then grouped.

    Join plans: a dimension that measures below the broadcast bound is
    broadcast, so the facts are never shuffled for the join and the one
    shuffle carries partial aggregates. With ``pre_aggregate=True``
    the facts are first counted per (key, fact-side group columns), inside
    every map task before the shuffle, and only those counts are joined and
    averaged with the counts as weights: the join shuffle carries one row per
    athlete and group instead of every fact, and a key holding a third of all
    facts arrives as a handful of rows. By default every fact is joined (then
    ``skew`` applies to the fact rows); the choice is the caller's, so it never
    changes with the size of the data.
    """
    hint = _hint(used_dimension_columns(bio, key), broadcast)
    if _eager(results, bio, pre_aggregate):
        return _pre_aggregated_means(results, bio, key, "inner", run_ts, digits, hint, skew)
    joined = enrich(results, bio, key, "inner", broadcast=hint, skew=skew)
    numeric = coerce_numeric(joined, MEASURES)
    kept = require_not_null(numeric.select(*STAT_KEYS, *MEASURES), NOT_NULL_KEYS)
    return group_means(kept, STAT_KEYS, MEASURES, run_ts=run_ts, digits=digits)


def _hint(dim: DataFrame, broadcast: bool | str) -> bool:
    if broadcast not in (True, False, "checked"):
        raise ValueError(f"broadcast must be True, False or 'checked', not {broadcast!r}")
    return fits_broadcast(dim) if broadcast == "checked" else broadcast


_WEIGHT = "_facts"


def used_dimension_columns(dim: DataFrame, key: str = ATHLETE_KEY) -> DataFrame:
    """The dimension's columns the statistics read: the broadcast holds only these
    (Catalyst prunes the rest), so the size check measures only these."""
    return dim.select(key, *[c for c in (*STAT_KEYS, *MEASURES) if c in dim.columns and c != key])



def _eager(facts: DataFrame, dim: DataFrame, pre_aggregate: bool) -> bool:
    """Aggregate before the join? Only for batch facts, with measures from the dimension."""
    return pre_aggregate and not facts.isStreaming and all(m in dim.columns for m in MEASURES)


def _pre_aggregated_means(facts: DataFrame, dim: DataFrame, key: str, how: str, run_ts,
                          digits: int | None, broadcast: bool, skew: str) -> DataFrame:
    """Count facts per (key, fact-side group columns), join the counts, weighted means."""
    facts = drop_shared_columns(facts, dim, key)  # measures and shared keys come from dim
    fact_keys = [k for k in STAT_KEYS if k in facts.columns]
    counts = facts.groupBy(key, *fact_keys).agg(F.count(F.lit(1)).alias(_WEIGHT))
    joined = enrich(counts, dim, key, how, broadcast=broadcast, skew=skew, drop_shared=False)
    kept = require_not_null(joined.select(*STAT_KEYS, *MEASURES, _WEIGHT), NOT_NULL_KEYS)
    return weighted_means(kept, _WEIGHT, STAT_KEYS, MEASURES, run_ts=run_ts, digits=digits)


def enriched_stats(events: DataFrame, bio: DataFrame, key: str = ATHLETE_KEY, run_ts=None,
                   digits: int | None = None, broadcast: bool | str = "checked",
                   finite_only: bool = False, pre_aggregate: bool = False, hot: DataFrame | None = None) -> DataFrame:
    """The stream's statistic, usable on a batch or a streaming ``events`` frame.

    Dimension rows need *both* measures numeric; events are left-joined to
    them and rows without sex, country or sport are dropped (which makes the
    join an inner one), then averaged per group. ``pre_aggregate`` counts batch
    events per key and group before the join, as in :func:`gold_stats`; a stream
    always joins events (one stateful aggregation per query in update mode); ``hot``
    are its keys to be salted, as in :func:`lakestream.operators.enrich`.
    """
    dim = numeric_rows(bio, MEASURES, finite_only=finite_only)
    hint = _hint(used_dimension_columns(dim, key), broadcast)
    if _eager(events, dim, pre_aggregate):
        return _pre_aggregated_means(events, dim, key, "left", run_ts, digits, hint, "adaptive")
    joined = enrich(events, dim, key, "left", broadcast=hint, hot=hot)
    kept = require_not_null(joined.select(*STAT_KEYS, *MEASURES), NOT_NULL_KEYS)
    return group_means(kept, STAT_KEYS, MEASURES, run_ts=run_ts, digits=digits)


def landing_to_bronze(spark: SparkSession, landing_dir: str, root: str,
                      tables: Iterable[str] = LAKE_TABLES,
                      schemas: Mapping[str, object] | None = None,
                      csv: Mapping[str, object] | None = None, versions: bool = False,
                      observed_types: bool = False) -> list[str]:
    """Each ``{landing_dir}/{table}.csv`` (header, inferred or given types) → bronze.

    ``csv``: keyword arguments of :func:`lakestream.sources.read_csv`; ``versions``
    as in :func:`lakestream.sources.write_layer`. With ``observed_types`` landing is read
    once: bronze holds the text of tables without a schema, and the types found while it is written.
    """
    paths = []
    options = {**({"infer": False} if observed_types else {}), **(csv or {})}
    for t in tables:
        schema = (schemas or {}).get(t)
        df = read_csv(spark, f"{landing_dir.rstrip('/')}/{t}.csv", schema=schema, **options)
        paths.append(write_layer(df, root, BRONZE, t, versions=versions, observed_types=observed_types and schema is None))
    return paths


def bronze_to_silver(spark: SparkSession, root: str, tables: Iterable[str] = LAKE_TABLES,
                     exclude: Mapping[str, Sequence[str]] | None = None,
                     null_text: str | None = "None", versions: bool = False) -> list[str]:
    """Clean every text column, drop duplicate rows, write silver."""
    paths = []
    for t in tables:
        df = read_layer(spark, root, BRONZE, t)
        silver = dedup_rows(clean_string_columns(df, (exclude or {}).get(t, ()), null_text))
        paths.append(write_layer(silver, root, SILVER, t, versions=versions))
    return paths


def silver_to_gold(spark: SparkSession, root: str, bio_table: str = BIO_TABLE,
                   results_table: str = RESULTS_TABLE, gold_table: str = GOLD_TABLE,
                   run_ts=None, digits: int | None = None,
                   broadcast: bool | str = "checked", skew: str = "adaptive",
                   pre_aggregate: bool = False, versions: bool = False) -> str:
    """Join the silver tables, average per group, write ``gold/{gold_table}``.

    ``broadcast``, ``skew`` and ``pre_aggregate`` choose the plan as in :func:`gold_stats`.
    """
    bio = read_layer(spark, root, SILVER, bio_table)
    results = read_layer(spark, root, SILVER, results_table)
    stats = gold_stats(results, bio, run_ts=run_ts, digits=digits, broadcast=broadcast, skew=skew,
                       pre_aggregate=pre_aggregate)
    return write_layer(stats, root, GOLD, gold_table, versions=versions)


def run_medallion(spark: SparkSession, landing_dir: str, root: str,
                  tables: Sequence[str] = LAKE_TABLES, run_ts=None, digits: int | None = None,
                  schemas: Mapping[str, object] | None = None,
                  broadcast: bool | str = "checked", skew: str = "adaptive", pre_aggregate: bool = False,
                  exclude: Mapping[str, Sequence[str]] | None = None, null_text: str | None = "None",
                  bio_table: str = BIO_TABLE, results_table: str = RESULTS_TABLE,
                  csv: Mapping[str, object] | None = None, versions: bool = False, observed_types: bool = False) -> str:
    """The three jobs strictly in order; safe to re-run (every layer is replaced once its successor is complete).

    With ``versions`` each run makes a version of every layer, and the ones before stay readable.

    ``exclude`` names columns of a table that the cleaner leaves as they are (it
    takes signs and dots out of numbers in text), ``null_text`` is what it makes
    of NULL (None: NULL stays), and ``csv`` has keyword arguments of
    :func:`lakestream.sources.read_csv`; ``observed_types`` as in :func:`landing_to_bronze`. ``tables`` may list more than the two
    that gold is made of.
    """
    landing_to_bronze(spark, landing_dir, root, tables, schemas, csv, versions, observed_types)
    bronze_to_silver(spark, root, tables, exclude, null_text, versions)
    return silver_to_gold(spark, root, bio_table, results_table, run_ts=run_ts, digits=digits,
                          broadcast=broadcast, skew=skew, pre_aggregate=pre_aggregate, versions=versions)
