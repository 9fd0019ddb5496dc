"""Schemas and fixed names of the athlete data model."""

from __future__ import annotations

from pyspark.sql.types import (BinaryType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType, TimestampNTZType)

# ---------------------------------------------------------------------------
# Fixed values (must equal the original jobs for identical results):
# - payload schema of a competition-result message, in field order:
#   edition_id int, country_id string, sport string, event string,
#   result_id bigint, athlete string, athlete_id int, pos string,
#   medal string, isTeamSport string (all nullable)
# - join key: athlete_id
# - grouping keys, in order: sport, medal, sex, country_noc
# - measures, in order: height, weight (output avg_height, avg_weight)
# - computation time column: timestamp; micro-batch tag column: batch_id
# ---------------------------------------------------------------------------
RESULT_EVENT_SCHEMA = StructType([
    StructField("edition_id", IntegerType(), True),
    StructField("country_id", StringType(), True),
    StructField("sport", StringType(), True),
    StructField("event", StringType(), True),
    StructField("result_id", LongType(), True),
    StructField("athlete", StringType(), True),
    StructField("athlete_id", IntegerType(), True),
    StructField("pos", StringType(), True),
    StructField("medal", StringType(), True),
    StructField("isTeamSport", StringType(), True),
])

ATHLETE_KEY = "athlete_id"
STAT_KEYS = ("sport", "medal", "sex", "country_noc")
MEASURES = ("height", "weight")
TIMESTAMP_COL = "timestamp"
BATCH_COL = "batch_id"

GOLD_SCHEMA = StructType([
    StructField("sport", StringType(), True),
    StructField("medal", StringType(), True),
    StructField("sex", StringType(), True),
    StructField("country_noc", StringType(), True),
    StructField("avg_height", DoubleType(), True),
    StructField("avg_weight", DoubleType(), True),
    StructField("timestamp", TimestampNTZType(), True),
])

# Envelope of a topic message (Kafka's key/value columns).
MESSAGE_SCHEMA = StructType([
    StructField("key", BinaryType(), True),
    StructField("value", BinaryType(), True),
])
