"""

Every query reads whole test tables (or data Spark derives from them) at the
given scale-factor folder. Averages are rounded to 6 digits and the run time
is pinned to a literal, so the Spark result and the DuckDB oracle can be
compared value for value.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import (IntegerType, StringType, StructField,  # noqa: E402
                               StructType)

from lakestream.functions import KEEP_PATTERN, clean_text, parse_json_column, run_timestamp  # noqa: E402
from lakestream.operators import (clean_string_columns, coerce_numeric, decode_messages,  # noqa: E402
                                  dedup_rows, distinct_values, enrich, field_types, fits_broadcast, group_means, hot_keys,
                                  indicator_columns, indicator_map, indicator_name, indicator_vectors, latest_per_key, numeric_rows, parse_evolving, parse_json,
                                  preview, profile, quarantine_unparsed, row_count, to_envelope, value_dictionary)
from lakestream.plans import (BIO_TABLE, RESULTS_TABLE, enriched_stats, gold_stats,  # noqa: E402
                              landing_to_bronze, publish_to_files, run_medallion)
from lakestream.schemas import (ATHLETE_KEY, BATCH_COL, GOLD_SCHEMA, MEASURES,  # noqa: E402
                                RESULT_EVENT_SCHEMA, STAT_KEYS)
from lakestream.session import scratch_path  # noqa: E402
from lakestream.sources import (files_per_batch, read_csv, read_layer, read_messages, read_messages_stream,  # noqa: E402
                                write_csv, write_layer)
from lakestream.sources.athletes import (athlete_inputs, bio_view,  # noqa: E402
                                         skewed_results_view, table)
from lakestream.sources.files import BRONZE, GOLD  # noqa: E402
from lakestream.sources.topics import write_messages  # noqa: E402
from lakestream.sources.versions import write_version  # noqa: E402
from lakestream.streaming import (adopt_state, await_done, batch_means, combine_batch_means, committed_files_sink, fan_out,  # noqa: E402
                                  joined_batch_means, message_files_sink, parquet_history_sink, parse_results, per_batch,
                                  pinned_versions, read_committed, run_enrichment, run_rejected, start, stop_when_idle)

try:  # the training-data operators are an optional part
    from lakestream.llm import queries as llm_queries  # noqa: E402
except ImportError:  # they, or a package that only they need, aren't there
    llm_queries = None


SMOKE_DIR = "/root/testdata/sf0.001"
RUN_TS = "2024-01-01 00:00:00"
DIGITS = 6
# Indicator columns of a result at most.
MOST_COLUMNS = 1000
# Micro-batches that a stream makes of its whole topic, at any size: batches
# grow with the data, and every stream carries state over several of them.
BATCHES = 8
# Messages in a file of a topic at most: a large micro-batch is of many files, so that many tasks read it.
FILE_ROWS = 50_000


# --------------------------------------------------------------------------
# Flagship
# --------------------------------------------------------------------------
def q_gold_stats(spark: SparkSession, sf: str) -> DataFrame:
    results, bio = athlete_inputs(spark, sf)
    return gold_stats(results, bio, run_ts=RUN_TS, digits=DIGITS)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query (gold statistics) on the sf0.001 tables."""
    return q_gold_stats(spark, SMOKE_DIR)


# --------------------------------------------------------------------------
# Batch operators
# --------------------------------------------------------------------------
def q_gold_stats_skewed(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the facts on one key, every fact joined: the hot-key split join."""
    orders, customer, nation = (table(spark, sf, n) for n in ("orders", "customer", "nation"))
    return gold_stats(skewed_results_view(orders), bio_view(customer, nation), run_ts=RUN_TS,
                      digits=DIGITS, broadcast=False, skew="split")


def q_gold_stats_preagg(spark: SparkSession, sf: str) -> DataFrame:
    """Same facts without a broadcast: counts per key and group are joined instead of facts."""
    orders, customer, nation = (table(spark, sf, n) for n in ("orders", "customer", "nation"))
    return gold_stats(skewed_results_view(orders), bio_view(customer, nation), run_ts=RUN_TS,
                      digits=DIGITS, broadcast=False, pre_aggregate=True)


def q_enrich_left_stats(spark: SparkSession, sf: str) -> DataFrame:
    results, bio = athlete_inputs(spark, sf)
    return enriched_stats(results, bio, run_ts=RUN_TS, digits=DIGITS)


def q_join_drop_collisions(spark: SparkSession, sf: str) -> DataFrame:
    results, bio = athlete_inputs(spark, sf)
    return enrich(results, bio, ATHLETE_KEY, "inner")


def q_numeric_filter(spark: SparkSession, sf: str) -> DataFrame:
    _, bio = athlete_inputs(spark, sf)
    return numeric_rows(bio, MEASURES)


def q_numeric_coerce(spark: SparkSession, sf: str) -> DataFrame:
    _, bio = athlete_inputs(spark, sf)
    return coerce_numeric(bio, MEASURES)


def q_json_parse(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return parse_json(events.select("event_id", "props"), StructType([StructField("k", IntegerType())]),
                      value_col="props", keep=("event_id",))


def q_quarantine_json(spark: SparkSession, sf: str) -> DataFrame:
    """Event properties (JSON) and raw pages (not JSON) parsed with one schema;
    rows whose parsed struct is entirely NULL are split off as quarantined."""
    events = table(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.lit("events").alias("source"), F.col("props").alias("value"))
    pages = table(spark, sf, "pages").select(
        F.col("page_id").alias("id"), F.lit("pages").alias("source"), F.col("html").alias("value"))
    schema = StructType([StructField("k", IntegerType())])
    messages = events.unionByName(pages)
    parsed = messages.select("id", "source", parse_json_column("value", schema).alias("data"))
    good, bad = quarantine_unparsed(parsed, "data")
    return (good.select("id", "source", F.lit("parsed").alias("status"), "data.k")
            .unionByName(bad.select("id", "source", F.lit("quarantined").alias("status"), "data.k")))


def _changing_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Events as messages of three payload versions (by id), and raw pages, which are no JSON."""
    k = F.get_json_object("props", "$.k").cast("int")
    third = F.struct(F.concat(F.lit("v"), k.cast("string")).alias("k"), F.struct(F.col("user_id").alias("id")).alias("user"))
    payload = (F.when(F.col("event_id") % 3 == 0, F.col("props"))
               .when(F.col("event_id") % 3 == 1, F.to_json(F.struct("event_type", k.alias("k"), "user_id")))
               .otherwise(F.to_json(third)))
    events = table(spark, sf, "events").select(F.col("event_id").alias("id"), F.lit("events").alias("source"), payload.alias("value"))
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("id"), F.lit("pages").alias("source"), F.col("html").alias("value"))
    return events.unionByName(pages)


def q_evolving_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Typed fields of a payload that gained, renamed and retyped some; what doesn't fit is kept beside them."""
    return parse_evolving(_changing_messages(spark, sf), {"k": "int", "user_id": "bigint"}, keep=("id", "source"))


def q_payload_types(spark: SparkSession, sf: str) -> DataFrame:
    """Which fields the messages hold, in which types and how often."""
    return field_types(_changing_messages(spark, sf), by=("source",))


def q_json_envelope(spark: SparkSession, sf: str) -> DataFrame:
    return to_envelope(table(spark, sf, "events"), key="event_id")


def q_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return parse_json(to_envelope(events), events.schema)


def q_clean_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", clean_text("text").alias("text"))


def q_clean_columns_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_rows(clean_string_columns(table(spark, sf, "conversations")))


def q_dedup(spark: SparkSession, sf: str) -> DataFrame:
    results, _ = athlete_inputs(spark, sf)
    return dedup_rows(results.select("athlete_id", "sport", "medal", "country_noc"))


def q_distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    results, bio = athlete_inputs(spark, sf)
    return distinct_values(enrich(results, bio, ATHLETE_KEY), ["medal", "sex", "country_noc", "sport"])


def q_indicator_columns(spark: SparkSession, sf: str) -> DataFrame:
    """One-hot columns; the few values of each come from the table that has the column, before the join."""
    results, bio = athlete_inputs(spark, sf)
    known = distinct_values(results, ["medal", "sport"]).union(distinct_values(bio, ["sex"]))
    # each value becomes a column of the result, so their number is bounded by its schema
    vocabulary = [(r["column"], r["value"]) for r in known.limit(MOST_COLUMNS + 1).collect()]
    if len(vocabulary) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} values: use indicator_map or indicator_vectors")
    joined = enrich(results, bio, ATHLETE_KEY)
    return indicator_columns(joined, ["medal", "sex", "sport"], vocabulary, keep=["result_id", "athlete_id"])


def q_indicator_map(spark: SparkSession, sf: str) -> DataFrame:
    """Indicators as a map, here a row for each entry; no vocabulary is needed."""
    results, _ = athlete_inputs(spark, sf)
    mapped = indicator_map(results, ["medal", "event"], keep=["result_id"])
    return mapped.select("result_id", F.explode("indicators").alias("entry", "flag")).select(
        "result_id", "entry.column", "entry.value", "flag")


def q_indicator_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Indicators as the ids of a distributed dictionary; no vocabulary reaches the driver."""
    results, _ = athlete_inputs(spark, sf)
    known = value_dictionary(results, ["medal", "sport", "athlete"])
    found = indicator_vectors(results, ["medal", "sport", "athlete"], known, keep=["result_id"])
    return found.select("result_id", F.array_join("indicators", " ").alias("indicators"))


def q_run_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").withColumn("timestamp", run_timestamp(RUN_TS))


def q_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile(table(spark, sf, "lineitem"))


def q_preview(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows of a table (the look ``show`` gives), in key order so any
    engine shows the same rows; a top-k, so no full sort is shuffled."""
    return preview(table(spark, sf, "orders").orderBy("o_orderkey"), 5)


def q_row_count(spark: SparkSession, sf: str) -> DataFrame:
    return row_count(table(spark, sf, "orders"))


# --------------------------------------------------------------------------
# Files and layers
# --------------------------------------------------------------------------
def q_csv_to_bronze(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "csv-bronze")
    write_csv(table(spark, sf, "supplier"), f"{root}/landing/supplier.csv")
    landing_to_bronze(spark, f"{root}/landing", root, ["supplier"])
    return read_layer(spark, root, BRONZE, "supplier")


def _csv_roundtrip(spark: SparkSession, sf: str, name: str, **csv) -> DataFrame:
    root, source = scratch_path(spark, f"csv-{name}"), table(spark, sf, name)
    write_csv(source, f"{root}/landing/{name}.csv", exact=True)
    landing_to_bronze(spark, f"{root}/landing", root, [name], {name: source.schema}, {"exact": True, **csv})
    return read_layer(spark, root, BRONZE, name)


def q_csv_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with line breaks and quotes through CSV, value for value."""
    return _csv_roundtrip(spark, sf, "documents", multi_line=True)


def q_csv_events(spark: SparkSession, sf: str) -> DataFrame:
    """Timestamps with microseconds and JSON text through CSV, in files that Spark can split."""
    return _csv_roundtrip(spark, sf, "events")


def q_csv_observed_types(spark: SparkSession, sf: str) -> DataFrame:
    """Types found while bronze text is written, one version of a layer made of two writes: landing is read once."""
    root, source = scratch_path(spark, "csv-observed"), table(spark, sf, "lineitem")
    for line, mode in ((F.col("l_linenumber") <= 3, "overwrite"), (F.col("l_linenumber") > 3, "append")):
        landing = f"{root}/landing-{mode}/lineitem.csv"
        write_csv(source.where(line), landing, exact=True)
        write_layer(read_csv(spark, landing, infer=False, exact=True), root, BRONZE, "lineitem", mode, versions=True,
                    observed_types=True)
    return read_layer(spark, root, BRONZE, "lineitem")


def q_medallion_observed(spark: SparkSession, sf: str) -> DataFrame:
    """The medallion run without an inference pass: bronze text, types observed while it is written."""
    root = scratch_path(spark, "medallion")
    results, bio = athlete_inputs(spark, sf)
    write_csv(bio, f"{root}/landing/{BIO_TABLE}.csv")
    write_csv(results, f"{root}/landing/{RESULTS_TABLE}.csv")
    run_medallion(spark, f"{root}/landing", root, run_ts=RUN_TS, digits=DIGITS, observed_types=True)
    return read_layer(spark, root, GOLD, "avg_stats")


def q_parquet_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "overwrite")
    part = table(spark, sf, "part")
    write_layer(part, root, BRONZE, "part")
    write_layer(part, root, BRONZE, "part")
    return read_layer(spark, root, BRONZE, "part")


def q_layer_versions(spark: SparkSession, sf: str) -> DataFrame:
    """A layer replaced and then appended to, with a failed write and an unfinished one in between: all its versions."""
    root, part = scratch_path(spark, "versions"), table(spark, sf, "part")
    write_layer(part, root, BRONZE, "part", versions=True)
    write_layer(part.where("p_size > 10"), root, BRONZE, "part")
    broken = part.withColumn("p_size", F.when(F.col("p_partkey") > 0, F.raise_error(F.lit("broken on purpose")).cast("int")))
    try:
        write_layer(broken, root, BRONZE, "part")
    except Exception as error:  # this write is meant to fail
        if "broken on purpose" not in str(error):
            raise
    write_layer(part.where("p_size <= 5"), root, BRONZE, "part", mode="append")
    versions = [read_layer(spark, root, BRONZE, "part", v).withColumn("version", F.lit(v)) for v in (1, 2, 3)]
    return reduce(DataFrame.unionByName, versions)


def q_medallion_run(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "medallion")
    results, bio = athlete_inputs(spark, sf)
    write_csv(bio, f"{root}/landing/{BIO_TABLE}.csv")
    write_csv(results, f"{root}/landing/{RESULTS_TABLE}.csv")
    run_medallion(spark, f"{root}/landing", root, run_ts=RUN_TS, digits=DIGITS)
    return read_layer(spark, root, GOLD, "avg_stats")


def q_medallion_run_excluded(spark: SparkSession, sf: str) -> DataFrame:
    """Measures left as they are by the cleaner, NULLs kept, given schemas, no inference pass."""
    root = scratch_path(spark, "medallion")
    results, bio = athlete_inputs(spark, sf)
    write_csv(bio, f"{root}/landing/{BIO_TABLE}.csv", exact=True)
    write_csv(results, f"{root}/landing/{RESULTS_TABLE}.csv", exact=True)
    run_medallion(spark, f"{root}/landing", root, run_ts=RUN_TS, digits=DIGITS, exclude={BIO_TABLE: MEASURES},
                  null_text=None, schemas={BIO_TABLE: bio.schema, RESULTS_TABLE: results.schema}, csv={"exact": True})
    return read_layer(spark, root, GOLD, "avg_stats")


# --------------------------------------------------------------------------
# Topics (file-backed stand-in with the Kafka key/value envelope)
# --------------------------------------------------------------------------
def q_decode_messages(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "topic-events")
    events = table(spark, sf, "events")
    write_messages(to_envelope(events, key="event_id"), path)
    return decode_messages(read_messages(spark, path), events.schema)


def q_publish_messages(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "topic-results")
    results, _ = athlete_inputs(spark, sf)
    publish_to_files(results, path)
    return decode_messages(read_messages(spark, path), RESULT_EVENT_SCHEMA).drop("key")


# --------------------------------------------------------------------------
# Streams: each runs with availableNow over the whole published topic
# --------------------------------------------------------------------------
def _topic(spark: SparkSession, df: DataFrame, name: str, batches: int = BATCHES) -> DataFrame:
    """The rows published to a file-backed topic, as a stream of about ``batches`` micro-batches."""
    path = scratch_path(spark, name)
    publish_to_files(df, path, rows_per_file=max(1, min(FILE_ROWS, -(-df.count() // batches))))
    return read_messages_stream(spark, path, files_per_batch(spark, path, batches))


def _run_enrichment(spark: SparkSession, results: DataFrame, bio: DataFrame,
                    broadcast: bool | str = "checked", hot: DataFrame | None = None) -> tuple[str, str]:
    history, out_topic = scratch_path(spark, "history"), scratch_path(spark, "topic-out")
    query = run_enrichment(_topic(spark, results, "topic-results"), bio,
                           [parquet_history_sink(history), message_files_sink(out_topic)],
                           scratch_path(spark, "ckpt"), run_ts=RUN_TS, digits=DIGITS, broadcast=broadcast, hot=hot)
    await_done(query)
    return history, out_topic


def q_stream_enrich(spark: SparkSession, sf: str) -> DataFrame:
    history, _ = _run_enrichment(spark, *athlete_inputs(spark, sf))
    return latest_per_key(spark.read.parquet(history), STAT_KEYS, BATCH_COL).drop(BATCH_COL)


def q_stream_enrich_skewed(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the events on one key and no broadcast: the salted stream join."""
    orders, customer, nation = (table(spark, sf, n) for n in ("orders", "customer", "nation"))
    results = skewed_results_view(orders)
    history, _ = _run_enrichment(spark, results, bio_view(customer, nation), broadcast=False, hot=hot_keys(results, ATHLETE_KEY))
    return latest_per_key(spark.read.parquet(history), STAT_KEYS, BATCH_COL).drop(BATCH_COL)


def q_fan_out_messages(spark: SparkSession, sf: str) -> DataFrame:
    _, out_topic = _run_enrichment(spark, *athlete_inputs(spark, sf))
    schema = StructType([*GOLD_SCHEMA.fields, StructField(BATCH_COL, StringType())])
    msgs = decode_messages(read_messages(spark, out_topic), schema).drop("key")
    return latest_per_key(msgs, STAT_KEYS, BATCH_COL).drop(BATCH_COL)


def q_stream_events_stats(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    parsed = parse_json(_topic(spark, events, "topic-events"), events.schema)
    stats = group_means(parsed, ["event_type"], ["value"], digits=DIGITS, ts_col=None)
    history = scratch_path(spark, "history")
    await_done(start(stats, fan_out(parquet_history_sink(history)), scratch_path(spark, "ckpt")))
    return latest_per_key(spark.read.parquet(history), ["event_type"], BATCH_COL).drop(BATCH_COL)


def q_microbatch_stats(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    parsed = parse_json(_topic(spark, events, "topic-events"), events.schema)
    history = scratch_path(spark, "history")
    fn = per_batch(batch_means(["event_type"], ["value"], run_ts=RUN_TS), parquet_history_sink(history))
    await_done(start(parsed, fn, scratch_path(spark, "ckpt"), "append"))
    return combine_batch_means(spark.read.parquet(history), ["event_type"], ["value"], DIGITS)


def q_microbatch_join_stats(spark: SparkSession, sf: str) -> DataFrame:
    results, bio = athlete_inputs(spark, sf)
    dim = numeric_rows(bio, MEASURES)
    hint = fits_broadcast(dim)  # decided once, not per micro-batch
    events = parse_results(_topic(spark, results, "topic-results"))
    history = scratch_path(spark, "history")
    fn = per_batch(joined_batch_means(dim, hint, run_ts=RUN_TS), parquet_history_sink(history))
    await_done(start(events, fn, scratch_path(spark, "ckpt"), "append"))
    return combine_batch_means(spark.read.parquet(history), STAT_KEYS, MEASURES, DIGITS)


def q_stream_static_inner(spark: SparkSession, sf: str) -> DataFrame:
    results, bio = athlete_inputs(spark, sf)
    events = parse_results(_topic(spark, results, "topic-results"))
    dim = numeric_rows(bio, MEASURES)
    joined = enrich(dim, events.select("athlete_id", "result_id", "sport", "medal"), ATHLETE_KEY,
                    "inner", drop_shared=False)
    history = scratch_path(spark, "history")
    await_done(start(joined, fan_out(parquet_history_sink(history)), scratch_path(spark, "ckpt"),
                     "append"))
    return spark.read.parquet(history).drop(BATCH_COL)


def q_history_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Running averages over more than ten micro-batches, read from messages that tag their batch with text."""
    events = table(spark, sf, "events")
    parsed = parse_json(_topic(spark, events, "topic-events", 12), events.schema)
    stats = group_means(parsed, ["event_type"], ["value"], digits=DIGITS, ts_col=None)
    out_topic = scratch_path(spark, "topic-out")
    await_done(start(stats, fan_out(message_files_sink(out_topic)), scratch_path(spark, "ckpt")))
    schema = "event_type string, avg_value double, batch_id string"
    msgs = decode_messages(read_messages(spark, out_topic), _schema(schema)).drop("key")
    return latest_per_key(msgs, ["event_type"], BATCH_COL).drop(BATCH_COL)


def q_replayed_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Per-batch averages in an append-only history that has every second batch twice, as after replays."""
    events = table(spark, sf, "events")
    parsed = parse_json(_topic(spark, events, "topic-events"), events.schema)
    out_topic = scratch_path(spark, "topic-out")
    fn = per_batch(batch_means(["event_type"], ["value"], run_ts=RUN_TS), message_files_sink(out_topic))
    await_done(start(parsed, fn, scratch_path(spark, "ckpt"), "append"))
    once = read_messages(spark, out_topic)
    schema = "event_type string, avg_value double, n_value long, batch_id string"
    history = decode_messages(once, _schema(schema)).drop("key")
    history = history.unionByName(history.where(F.col(BATCH_COL).cast("int") % 2 == 0))
    return combine_batch_means(history, ["event_type"], ["value"], DIGITS)


def q_stream_restart(spark: SparkSession, sf: str) -> DataFrame:
    """Half of the events, a stop, the other half, a restart on the same checkpoint, and a run without new messages."""
    events = table(spark, sf, "events")
    path, history, ckpt = (scratch_path(spark, n) for n in ("topic-events", "history", "ckpt"))
    for part in (F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1, F.lit(False)):
        publish_to_files(events.where(part), path)
        parsed = parse_json(read_messages_stream(spark, path), events.schema)
        stats = group_means(parsed, ["event_type"], ["value"], digits=DIGITS, ts_col=None)
        await_done(start(stats, fan_out(parquet_history_sink(history)), ckpt))
    return latest_per_key(spark.read.parquet(history), ["event_type"], BATCH_COL).drop(BATCH_COL)


def q_late_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """A dimension that gains rows between two runs of a stream: later events join to them, earlier ones don't."""
    results, bio = athlete_inputs(spark, sf)
    path, dims, history, ckpt = (scratch_path(spark, n) for n in ("topic-results", "dimension", "history", "ckpt"))
    schema = bio.schema
    for rest in (0, 1):
        bio.where(F.col(ATHLETE_KEY) % 2 == rest).write.mode("append").parquet(dims)
        publish_to_files(results.where(F.col("result_id") % 2 == rest), path)
        read = lambda: numeric_rows(spark.read.schema(schema).parquet(dims), MEASURES)
        fn = per_batch(joined_batch_means(read, False, run_ts=RUN_TS), parquet_history_sink(history))
        await_done(start(parse_results(read_messages_stream(spark, path)), fn, ckpt, "append"))
    return combine_batch_means(spark.read.parquet(history), STAT_KEYS, MEASURES, DIGITS)


def q_stream_dimension_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Running averages of one continuous stream whose dimension gains rows while it runs, until it has nothing to do."""
    results, bio = athlete_inputs(spark, sf)
    path, dims, history, ckpt, state = (scratch_path(spark, n) for n in ("topic-results", "dimension", "history", "ckpt", "state"))
    write_version(bio.where(F.col(ATHLETE_KEY) % 2 == 0), dims)
    publish_to_files(results.where(F.col("result_id") % 2 == 0), path)
    query = run_enrichment(read_messages_stream(spark, path), pinned_versions(spark, dims, state), [parquet_history_sink(history)],
                           ckpt, run_ts=RUN_TS, digits=DIGITS, trigger=None, state=state, compact_every=1)
    try:
        query.processAllAvailable()
        write_version(bio.where(F.col(ATHLETE_KEY) % 2 == 1), dims, "append")
        publish_to_files(results.where(F.col("result_id") % 2 == 1), path)
        query.processAllAvailable()
        stop_when_idle(query, idle_s=1)
    finally:
        query.stop()
    return latest_per_key(spark.read.parquet(history), STAT_KEYS, BATCH_COL).drop(BATCH_COL)


def q_stream_rescaled(spark: SparkSession, sf: str) -> DataFrame:
    """Running averages in Spark's state, moved after half of the events to sums that have no fixed number of partitions."""
    results, bio = athlete_inputs(spark, sf)
    path, history, old, new = (scratch_path(spark, n) for n in ("topic-results", "history", "ckpt", "ckpt"))
    for rest, ckpt, form in ((0, old, False), (1, new, "checked")):
        publish_to_files(results.where(F.col("result_id") % 2 == rest), path)
        if rest:
            adopt_state(spark, old, new)
        await_done(run_enrichment(read_messages_stream(spark, path), bio, [parquet_history_sink(history)], ckpt, run_ts=RUN_TS,
                                  digits=DIGITS, broadcast=form))
    return latest_per_key(spark.read.parquet(history), STAT_KEYS, BATCH_COL).drop(BATCH_COL)


def q_committed_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Per-batch averages in a file sink with commit records, every batch delivered twice: the sink holds each once."""
    events = table(spark, sf, "events")
    parsed = parse_json(_topic(spark, events, "topic-events"), events.schema)
    out = scratch_path(spark, "committed")
    sink = committed_files_sink(out)
    fn = per_batch(batch_means(["event_type"], ["value"], run_ts=RUN_TS), sink, sink)
    await_done(start(parsed, fn, scratch_path(spark, "ckpt"), "append"))
    schema = _schema("event_type string, avg_value double, n_value long, batch_id string")
    history = decode_messages(read_committed(spark, out), schema)
    mean = F.sum(F.col("avg_value") * F.col("n_value")) / F.sum("n_value")
    return history.groupBy("event_type").agg(F.round(mean, DIGITS).alias("avg_value"), F.sum("n_value").alias("n_value"))


def q_stream_rejected(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of events (JSON), raw pages (not JSON) and nations (broken UTF-8): those that a sink of their own gets."""
    props = table(spark, sf, "events").select(F.encode("props", "UTF-8").alias("value"))
    pages = table(spark, sf, "pages").select(F.encode("html", "UTF-8").alias("value"))
    broken = table(spark, sf, "nation").select(
        F.concat(F.unhex(F.lit("FF")), F.encode("n_name", "UTF-8")).alias("value"))
    path, out = scratch_path(spark, "topic-mixed"), scratch_path(spark, "rejected")
    write_messages(props.union(pages).union(broken), path)
    schema = StructType([StructField("k", IntegerType())])
    await_done(run_rejected(read_messages_stream(spark, path), [parquet_history_sink(out)], scratch_path(spark, "ckpt"),
                            schema=schema))
    return spark.read.parquet(out).select("value", "is_utf8")


def _schema(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _lake_queries() | (llm_queries.queries() if llm_queries else {})


def _lake_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "gold_stats": q_gold_stats,
        "gold_stats_skewed": q_gold_stats_skewed,
        "gold_stats_preagg": q_gold_stats_preagg,
        "enrich_left_stats": q_enrich_left_stats,
        "join_drop_collisions": q_join_drop_collisions,
        "numeric_filter": q_numeric_filter,
        "numeric_coerce": q_numeric_coerce,
        "json_parse": q_json_parse,
        "quarantine_json": q_quarantine_json,
        "evolving_payloads": q_evolving_payloads,
        "payload_types": q_payload_types,
        "json_envelope": q_json_envelope,
        "json_roundtrip": q_json_roundtrip,
        "clean_text": q_clean_text,
        "clean_columns_dedup": q_clean_columns_dedup,
        "dedup": q_dedup,
        "distinct_values": q_distinct_values,
        "indicator_columns": q_indicator_columns,
        "run_timestamp": q_run_timestamp,
        "profile": q_profile,
        "preview": q_preview,
        "row_count": q_row_count,
        "csv_to_bronze": q_csv_to_bronze,
        "parquet_overwrite": q_parquet_overwrite,
        "medallion_run": q_medallion_run,
        "decode_messages": q_decode_messages,
        "publish_messages": q_publish_messages,
        "stream_enrich": q_stream_enrich,
        "fan_out_messages": q_fan_out_messages,
        "stream_events_stats": q_stream_events_stats,
        "microbatch_stats": q_microbatch_stats,
        "microbatch_join_stats": q_microbatch_join_stats,
        "stream_static_inner": q_stream_static_inner,
        "csv_documents": q_csv_documents,
        "csv_events": q_csv_events,
        "medallion_run_excluded": q_medallion_run_excluded,
        "indicator_map": q_indicator_map,
        "stream_enrich_skewed": q_stream_enrich_skewed,
        "history_latest": q_history_latest,
        "replayed_batches": q_replayed_batches,
        "stream_restart": q_stream_restart,
        "late_dimension": q_late_dimension,
        "stream_rejected": q_stream_rejected,
        "layer_versions": q_layer_versions,
        "csv_observed_types": q_csv_observed_types,
        "medallion_observed": q_medallion_observed,
        "stream_rescaled": q_stream_rescaled,
        "stream_dimension_snapshots": q_stream_dimension_snapshots,
        "committed_batches": q_committed_batches,
        "indicator_vectors": q_indicator_vectors,
    }


# --------------------------------------------------------------------------
# Oracles (DuckDB SQL over the pre-registered tables)
# --------------------------------------------------------------------------
_DIM = """
select cast(c_custkey as integer) as athlete_id, c_mktsegment as sex,
  case when c_custkey % 17 = 0 then null else n_name end as country_noc,
  case when c_custkey % 7 = 0 then 'na' when c_custkey % 11 = 0 then null
       when c_custkey % 13 = 0 then '63-65' else cast(140 + c_custkey % 70 as varchar) end as height,
  case when c_custkey % 19 = 0 then '' else cast(40 + c_custkey % 90 as varchar) end as weight
from customer join nation on c_nationkey = n_nationkey"""


def _fact(athlete_id: str = "cast(o_custkey as integer)") -> str:
    return f"""
select cast(year(o_orderdate) as integer) as edition_id, o_orderstatus as country_id,
  o_orderpriority as sport, o_orderpriority || ' ' || o_orderstatus as event,
  o_orderkey as result_id, 'athlete ' || cast(o_custkey as varchar) as athlete,
  {athlete_id} as athlete_id, cast(o_orderkey % 10 + 1 as varchar) as pos,
  case when o_orderkey % 3 = 0 then null else o_orderstatus end as medal,
  case when o_orderkey % 2 = 0 then 'True' else 'False' end as isTeamSport,
  o_orderstatus as country_noc
from orders"""


_FACT = _fact()
_FACT_SKEWED = _fact("case when o_orderkey % 3 = 0 then 1 else cast(o_custkey as integer) end")
_DIM_NUMERIC = f"""select * from ({_DIM}) where try_cast(height as double) is not null
  and try_cast(weight as double) is not null"""
_TS = f"timestamp '{RUN_TS}'"
_KEEP = "'" + KEEP_PATTERN.replace("'", "''") + "'"  # the cleaner's pattern as an SQL literal


def _c(x: str) -> str:
    return f"regexp_replace(coalesce({x}, 'None'), {_KEEP}, '', 'g')"


def _c0(x: str) -> str:
    return f"regexp_replace({x}, {_KEEP}, '', 'g')"


_EVENT_MEANS = "select event_type, round(avg(value), 6) as avg_value from events group by event_type"


def _gold_sql(fact: str) -> str:
    return f"""
select sport, medal, sex, country_noc,
  round(avg(try_cast(height as double)), 6) as avg_height,
  round(avg(try_cast(weight as double)), 6) as avg_weight,
  {_TS} as "timestamp"
from (select f.sport, f.medal, d.sex, d.country_noc, d.height, d.weight
      from ({fact}) f join ({_DIM}) d on f.athlete_id = d.athlete_id)
where sex is not null and country_noc is not null and sport is not null
group by sport, medal, sex, country_noc"""


_ENRICH_LEFT = f"""
select sport, medal, sex, country_noc,
  round(avg(try_cast(height as double)), 6) as avg_height,
  round(avg(try_cast(weight as double)), 6) as avg_weight,
  {_TS} as "timestamp"
from (select f.sport, f.medal, d.sex, d.country_noc, d.height, d.weight
      from ({_FACT}) f left join ({_DIM_NUMERIC}) d on f.athlete_id = d.athlete_id)
where sex is not null and country_noc is not null and sport is not null
group by sport, medal, sex, country_noc"""

_JOINED = f"""
select f.athlete_id, f.edition_id, f.country_id, f.sport, f.event, f.result_id, f.athlete, f.pos,
  f.medal, f.isTeamSport, d.sex, d.country_noc, d.height, d.weight
from ({_FACT}) f join ({_DIM}) d on f.athlete_id = d.athlete_id"""

# Vocabulary of the indicator query (values of the TPC-H columns behind it).
_STATUSES = ["F", "O", "P"]
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _indicator_sql() -> str:
    flags = []
    for col, values in (("medal", _STATUSES + [None]), ("sex", _SEGMENTS), ("sport", _PRIORITIES)):
        for v in values:
            name = indicator_name(col, v)
            test = f"{col} is null" if v is None else f"{col} = '{v}'"
            flags.append(f'case when {test} then 1 else 0 end as "{name}"')
    return f"select result_id, athlete_id, {', '.join(flags)} from ({_JOINED})"


def _medallion_sql() -> str:
    # CSV turns '' into NULL; types are inferred: athlete_id int, weight int,
    # height stays text (holds 'na', '63-65') and is cleaned like other text.
    dim = f"""select distinct athlete_id, {_c('sex')} as sex, {_c('country_noc')} as country_noc,
      {_c('height')} as height, try_cast(nullif(weight, '') as integer) as weight from ({_DIM})"""
    fact = f"""select distinct athlete_id, {_c('sport')} as sport, {_c('medal')} as medal,
      result_id from ({_FACT})"""
    return f"""
select sport, medal, sex, country_noc,
  round(avg(try_cast(height as double)), 6) as avg_height,
  round(avg(cast(weight as double)), 6) as avg_weight,
  {_TS} as "timestamp"
from (select f.sport, f.medal, d.sex, d.country_noc, d.height, d.weight
      from ({fact}) f join ({dim}) d on f.athlete_id = d.athlete_id)
where sex is not null and country_noc is not null and sport is not null
group by sport, medal, sex, country_noc"""


def _profile_sql() -> str:
    cols = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
            ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
            ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
            ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]
    parts = [f"""select {i} as position, '{c}' as "column", '{t}' as data_type,
      count({c}) as non_null, count(*) as "rows" from lineitem""" for i, (c, t) in enumerate(cols)]
    return " union all ".join(parts)


def oracle_sql() -> dict[str, str]:
    return _lake_sql() | (llm_queries.oracle_sql() if llm_queries else {})


def _lake_sql() -> dict[str, str]:
    return {
        "gold_stats": _gold_sql(_FACT),
        "gold_stats_skewed": _gold_sql(_FACT_SKEWED),
        "gold_stats_preagg": _gold_sql(_FACT_SKEWED),
        "enrich_left_stats": _ENRICH_LEFT,
        "join_drop_collisions": _JOINED,
        "numeric_filter": _DIM_NUMERIC,
        "numeric_coerce": f"""select athlete_id, sex, country_noc, try_cast(height as double) as height,
            try_cast(weight as double) as weight from ({_DIM})""",
        "json_parse": """select event_id, try_cast(json_extract_string(props, '$.k') as integer) as k
            from events""",
        "quarantine_json": """
select id, source, case when k is null then 'quarantined' else 'parsed' end as status, k from (
  select event_id as id, 'events' as source,
    try_cast(json_extract_string(props, '$.k') as integer) as k from events
  union all
  select page_id, 'pages', case when json_valid(html)
    then try_cast(json_extract_string(html, '$.k') as integer) end from pages)""",
        "evolving_payloads": """
with e as (select event_id as id, event_id % 3 as version, cast(json_extract_string(props, '$.k') as integer) as k, user_id, event_type from events)
select id, 'events' as source, case when version < 2 then k end as k, case when version = 1 then user_id end as user_id,
  case version when 1 then '{"event_type":"' || event_type || '"}' when 2 then '{"user":{"id":' || user_id || '}}' end as unknown,
  case when version = 2 then '{"k":"v' || k || '"}' end as misfits, cast(null as varchar) as broken from e
union all select page_id, 'pages', null, null, null, null, html from pages""",
        "payload_types": """
with e as (select event_id % 3 as version from events)
select 'events' as source, field, type, count(*) as messages from e join (values
  (0, 'k', 'BIGINT'), (1, 'event_type', 'STRING'), (1, 'k', 'BIGINT'), (1, 'user_id', 'BIGINT'),
  (2, 'k', 'STRING'), (2, 'user', 'OBJECT<id: BIGINT>')) as f(version, field, type) using (version) group by all""",
        "json_envelope": """select cast(event_id as varchar) as "key", to_json(struct_pack(
            event_id := event_id, ts := strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), user_id := user_id,
            event_type := event_type, value := value, props := props)) as value from events""",
        "json_roundtrip": "select * from events",
        "clean_text": f"select doc_id, {_c('text')} as text from documents",
        "clean_columns_dedup": f"""select distinct conv_id, turn, {_c('role')} as role,
            {_c('text')} as text from conversations""",
        "dedup": f"select distinct athlete_id, sport, medal, country_noc from ({_FACT})",
        "distinct_values": " union ".join(
            f"""select distinct '{c}' as "column", cast({c} as varchar) as value from ({_JOINED})"""
            for c in ("medal", "sex", "country_noc", "sport")),
        "indicator_columns": _indicator_sql(),
        "run_timestamp": f'select *, {_TS} as "timestamp" from orders',
        "profile": _profile_sql(),
        "preview": "select * from orders order by o_orderkey limit 5",
        "row_count": 'select count(*) as "rows" from orders',
        "csv_to_bronze": """select cast(s_suppkey as integer) as s_suppkey, s_name,
            s_nationkey, s_acctbal from supplier""",
        "parquet_overwrite": "select * from part",
        "medallion_run": _medallion_sql(),
        "medallion_observed": _medallion_sql(),
        "csv_observed_types": """select cast(l_orderkey as integer) as l_orderkey, cast(l_partkey as integer) as l_partkey,
            cast(l_suppkey as integer) as l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
            l_returnflag, l_linestatus, l_shipdate from lineitem""",
        "decode_messages": 'select cast(event_id as varchar) as "key", * from events',
        "publish_messages": f"""select edition_id, country_id, sport, event, result_id, athlete,
            athlete_id, pos, medal, isTeamSport from ({_FACT})""",
        "stream_enrich": _ENRICH_LEFT,
        "stream_rescaled": _ENRICH_LEFT,
        "fan_out_messages": _ENRICH_LEFT,
        "stream_events_stats": """select event_type, round(avg(value), 6) as avg_value
            from events group by event_type""",
        "microbatch_stats": """select event_type, round(avg(value), 6) as avg_value
            from events group by event_type""",
        "microbatch_join_stats": f"""
select sport, medal, sex, country_noc,
  round(avg(try_cast(height as double)), 6) as avg_height,
  round(avg(try_cast(weight as double)), 6) as avg_weight
from (select f.sport, f.medal, d.sex, d.country_noc, d.height, d.weight
      from ({_FACT}) f join ({_DIM_NUMERIC}) d on f.athlete_id = d.athlete_id)
group by sport, medal, sex, country_noc""",
        "stream_static_inner": f"""select d.athlete_id, d.sex, d.country_noc, d.height, d.weight,
            f.result_id, f.sport, f.medal
            from ({_DIM_NUMERIC}) d join ({_FACT}) f on f.athlete_id = d.athlete_id""",
        "csv_documents": "select * from documents",
        "csv_events": "select * from events",
        "medallion_run_excluded": f"""
select sport, medal, sex, country_noc,
  round(avg(try_cast(height as double)), 6) as avg_height,
  round(avg(try_cast(weight as double)), 6) as avg_weight,
  {_TS} as "timestamp"
from (select f.sport, f.medal, d.sex, d.country_noc, d.height, d.weight
      from (select athlete_id, {_c0('sport')} as sport, {_c0('medal')} as medal from ({_FACT})) f
      join (select distinct athlete_id, {_c0('sex')} as sex, {_c0('country_noc')} as country_noc, height, weight
            from ({_DIM})) d on f.athlete_id = d.athlete_id)
where sex is not null and country_noc is not null and sport is not null
group by sport, medal, sex, country_noc""",
        "indicator_map": f"""select result_id, 'medal' as "column", medal as value, 1 as flag from ({_FACT})
            union all select result_id, 'event', event, 1 from ({_FACT})""",
        "stream_enrich_skewed": _ENRICH_LEFT.replace(_FACT, _FACT_SKEWED),
        "history_latest": _EVENT_MEANS,
        "replayed_batches": _EVENT_MEANS,
        "stream_restart": _EVENT_MEANS,
        "late_dimension": f"""
select sport, medal, sex, country_noc,
  round(avg(try_cast(height as double)), 6) as avg_height,
  round(avg(try_cast(weight as double)), 6) as avg_weight
from (select f.sport, f.medal, d.sex, d.country_noc, d.height, d.weight
      from ({_FACT}) f join ({_DIM_NUMERIC}) d on f.athlete_id = d.athlete_id
      where f.result_id % 2 = 1 or d.athlete_id % 2 = 0)
group by sport, medal, sex, country_noc""",
        "layer_versions": """select *, 1 as version from part union all select *, 2 from part where p_size > 10
            union all select *, 3 from part where p_size > 10 or p_size <= 5""",
        "stream_dimension_snapshots": f"""
select sport, medal, sex, country_noc,
  round(avg(try_cast(height as double)), 6) as avg_height,
  round(avg(try_cast(weight as double)), 6) as avg_weight, {_TS} as "timestamp"
from (select f.sport, f.medal, d.sex, d.country_noc, d.height, d.weight
      from ({_FACT}) f join ({_DIM_NUMERIC}) d on f.athlete_id = d.athlete_id
      where f.result_id % 2 = 1 or d.athlete_id % 2 = 0)
where sex is not null and country_noc is not null and sport is not null
group by sport, medal, sex, country_noc""",
        "committed_batches": """select event_type, round(avg(value), 6) as avg_value, count(value) as n_value
            from events group by event_type""",
        "indicator_vectors": f"""
with f as (select * from ({_FACT})),
v as (select distinct 'athlete' as c, athlete as v from f union select distinct 'medal', medal from f union select distinct 'sport', sport from f),
d as (select c, v, row_number() over (order by c, v nulls first) - 1 as id from v)
select result_id, array_to_string(list_sort([a.id, m.id, s.id]), ' ') as indicators
from f join d a on a.c = 'athlete' and a.v = f.athlete
join d m on m.c = 'medal' and m.v is not distinct from f.medal join d s on s.c = 'sport' and s.v = f.sport""",
        "stream_rejected": """select html as value, true as is_utf8 from pages
            union all select chr(65533) || n_name, false from nation""",
    }
