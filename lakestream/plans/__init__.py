"""Composed jobs: the layered lake and table publishing."""

from lakestream.plans.medallion import (BIO_TABLE, GOLD_TABLE, LAKE_TABLES, RESULTS_TABLE,
                                        bronze_to_silver, enriched_stats, gold_stats,
                                        landing_to_bronze, run_medallion, silver_to_gold)
from lakestream.plans.publish import publish_table, publish_to_files, publish_to_kafka

__all__ = [
    "BIO_TABLE", "GOLD_TABLE", "LAKE_TABLES", "RESULTS_TABLE", "bronze_to_silver",
    "enriched_stats", "gold_stats", "landing_to_bronze", "publish_table", "publish_to_files", "publish_to_kafka",
    "run_medallion", "silver_to_gold",
]
