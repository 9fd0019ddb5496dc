"""JDBC tables: option builders, partitioned reads, appends.

Credentials come only from the caller. No database is started by this
library; these functions talk to whatever endpoint the options name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, fetch_size: int | None = None,
                 batch_size: int | None = None, **extra) -> dict[str, str]:
    """Options for ``format("jdbc")`` (``dbtable`` may also be a subquery)."""
    opts = {"url": url, "dbtable": table}
    for k, v in (("user", user), ("password", password), ("driver", driver),
                 ("fetchsize", fetch_size), ("batchsize", batch_size)):
        if v is not None:
            opts[k] = str(v)
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def partitioned(options: dict[str, str], column: str, lower: int, upper: int,
                num_partitions: int) -> dict[str, str]:
    """Add range partitioning so the table is read by ``num_partitions`` tasks.

    Without it a JDBC scan is a single task on one connection. Use a column
    with unique, evenly spread values (a row id, not a foreign key): all rows
    of one value fall into one range, so a hot value would make one task read
    its whole share.
    """
    return {**options, "partitionColumn": column, "lowerBound": str(lower),
            "upperBound": str(upper), "numPartitions": str(num_partitions)}


def key_bounds(spark: SparkSession, options: dict[str, str], column: str) -> tuple[int, int]:
    """Min and max of a numeric key, computed by the database (one small row)."""
    probe = {**options, "dbtable": f"(select min({column}) as lo, max({column}) as hi "
                                   f"from {options['dbtable']}) bounds"}
    row = spark.read.format("jdbc").options(**probe).load().first()
    return int(row["lo"] or 0), int(row["hi"] or 0)


def read_jdbc(spark: SparkSession, options: dict[str, str], partition_column: str | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """Read a table; with a partition column, split the key range over tasks."""
    if partition_column and num_partitions and "partitionColumn" not in options:
        lo, hi = key_bounds(spark, options, partition_column)
        options = partitioned(options, partition_column, lo, hi + 1, num_partitions)
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(df: DataFrame, options: dict[str, str], mode: str = "append",
               max_connections: int | None = 64) -> None:
    """Append (by default) rows to a table; each task writes its own partition.

    ``max_connections`` caps the concurrent connections, so a wide job does not
    open thousands against one database. The rows are dealt anew to so many
    tasks, so what computes them isn't narrowed to that number.
    """
    if max_connections and "numPartitions" not in options:
        df = df.repartition(max_connections)
    df.write.format("jdbc").options(**options).mode(mode).save()
