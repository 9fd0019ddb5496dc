"""Lakestream: a layered data lake and a live enrichment stream on Spark.

Sub-packages:

* ``functions`` — native column expressions (cleaner, numeric tests, JSON)
* ``operators`` — DataFrame → DataFrame steps (quality, joins, statistics)
* ``sources``   — CSV / Parquet layers, JDBC, Kafka and file-backed topics
* ``plans``     — composed batch jobs (bronze → silver → gold, publishing)
* ``streaming`` — fan-out sinks and the streaming enrichment job
"""

__version__ = "0.1.0"
