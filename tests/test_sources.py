"""Connector option builders (no database or broker is started in tests)."""

from __future__ import annotations

from lakestream.sources import jdbc_options, kafka_options, partitioned


def test_kafka_options_sasl_plain():
    opts = kafka_options(["b1:9092", "b2:9092"], "SASL_PLAINTEXT", "PLAIN", "u", "p")
    assert opts["kafka.bootstrap.servers"] == "b1:9092,b2:9092"
    assert opts["kafka.security.protocol"] == "SASL_PLAINTEXT"
    assert opts["kafka.sasl.mechanism"] == "PLAIN"
    assert opts["kafka.sasl.jaas.config"] == (
        'org.apache.kafka.common.security.plain.PlainLoginModule required username="u" password="p";')


def test_kafka_options_without_login():
    assert kafka_options("b:9092") == {"kafka.bootstrap.servers": "b:9092"}


def test_jdbc_options_and_partitioning():
    opts = jdbc_options("jdbc:mysql://h:3306/db", "athlete_bio", "u", "p", driver="com.mysql.cj.jdbc.Driver",
                        fetch_size=10000)
    assert opts == {"url": "jdbc:mysql://h:3306/db", "dbtable": "athlete_bio", "user": "u",
                    "password": "p", "driver": "com.mysql.cj.jdbc.Driver", "fetchsize": "10000"}
    p = partitioned(opts, "athlete_id", 1, 1000, 16)
    assert p["partitionColumn"] == "athlete_id" and p["numPartitions"] == "16"
    assert p["lowerBound"] == "1" and p["upperBound"] == "1000"


def test_tune_keeps_user_choices_and_measured_broadcasts(spark):
    from lakestream.session import tune

    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.skewJoin.enabled")
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")  # the user's choice
        tune(spark)
        assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
        assert spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold") == "32MB"
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_shared_dir_refuses_a_local_folder_on_a_cluster():
    import pytest

    from lakestream.session import shared_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())
