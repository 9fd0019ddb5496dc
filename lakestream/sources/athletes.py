"""Athlete-shaped views derived from the TPC-H-style test tables.

The test tables have no athletes, so these views re-label columns into the
two inputs the jobs expect, with dirty measures made from the key so every
cleaning rule has work to do. They are plain projections and one join over
whole tables; nothing is sampled or capped.

* bio (dimension): customer ⋈ nation —
  athlete_id = c_custkey, sex = c_mktsegment,
  country_noc = n_name (NULL when c_custkey % 17 = 0),
  height = 'na' (key % 7 = 0) / NULL (% 11) / '63-65' (% 13) / 140 + key % 70,
  weight = '' (key % 19 = 0) / 40 + key % 90, both as text.
* results (facts): orders —
  athlete_id = o_custkey, sport = o_orderpriority,
  medal = NULL when o_orderkey % 3 = 0 else o_orderstatus,
  country_noc = o_orderstatus (collides with the dimension on purpose), and
  the remaining result-message fields.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, names: Iterable[str] = TABLES) -> dict[str, DataFrame]:
    return {n: table(spark, sf_dir, n) for n in names}


def bio_view(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """The athlete dimension. ``nation`` has 25 rows by definition, so it is broadcast."""
    k = F.col("c_custkey")
    joined = customer.join(F.broadcast(nation), customer["c_nationkey"] == nation["n_nationkey"])
    return joined.select(
        k.cast("int").alias("athlete_id"),
        F.col("c_mktsegment").alias("sex"),
        F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("country_noc"),
        F.when(k % 7 == 0, F.lit("na"))
         .when(k % 11 == 0, F.lit(None).cast("string"))
         .when(k % 13 == 0, F.lit("63-65"))
         .otherwise((F.lit(140) + k % 70).cast("string")).alias("height"),
        F.when(k % 19 == 0, F.lit("")).otherwise((F.lit(40) + k % 90).cast("string")).alias("weight"),
    )


def results_view(orders: DataFrame) -> DataFrame:
    """Competition results with every field of the result message, plus ``country_noc``."""
    ok = F.col("o_orderkey")
    return orders.select(
        F.year("o_orderdate").alias("edition_id"),
        F.col("o_orderstatus").alias("country_id"),
        F.col("o_orderpriority").alias("sport"),
        F.concat_ws(" ", F.col("o_orderpriority"), F.col("o_orderstatus")).alias("event"),
        ok.alias("result_id"),
        F.concat(F.lit("athlete "), F.col("o_custkey").cast("string")).alias("athlete"),
        F.col("o_custkey").cast("int").alias("athlete_id"),
        (ok % 10 + 1).cast("string").alias("pos"),
        F.when(ok % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus")).alias("medal"),
        F.when(ok % 2 == 0, F.lit("True")).otherwise(F.lit("False")).alias("isTeamSport"),
        F.col("o_orderstatus").alias("country_noc"),
    )


def athlete_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(results, bio) views over one scale factor's tables."""
    t = tables(spark, sf_dir, ("customer", "nation", "orders"))
    return results_view(t["orders"]), bio_view(t["customer"], t["nation"])


def skewed_results_view(orders: DataFrame) -> DataFrame:
    """Results where one athlete (id 1) holds every third result: a hot key.

    Same rows as :func:`results_view`; only ``athlete_id`` changes, so a third
    of all facts share one join key. Athlete 1 has a complete dimension row
    (country and both measures valid), so the hot key's facts reach the result.
    """
    base = results_view(orders)
    hot = F.when(F.col("result_id") % 3 == 0, F.lit(1)).otherwise(F.col("athlete_id"))
    return base.withColumn("athlete_id", hot.cast("int"))
