"""Kafka JSON source options and decoding.

The Kafka data source ships as a separate package (spark-sql-kafka); add it
at submit time (``spark.jars.packages``). Option builders and the
decode/encode functions are plain DataFrame code and are tested on JSON
lines without a broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.scalar import from_json_record
from tideline.functions.time import spark_interval

# The login module of the Kafka client itself (not a relocated copy of it).
PLAIN_LOGIN_MODULE = "org.apache.kafka.common.security.plain.PlainLoginModule"


def source_options(bootstrap_servers: str, topic: str, starting_offsets: str = "earliest",
                   extra: dict[str, str] | None = None) -> dict[str, str]:
    """``'scan.startup.mode'='earliest-offset'`` -> ``startingOffsets=earliest``."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
            "startingOffsets": starting_offsets}
    opts.update(extra or {})
    return opts


def sink_options(bootstrap_servers: str, extra: dict[str, str] | None = None) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": bootstrap_servers}
    opts.update(extra or {})
    return opts


def sasl_plain_options(username: str, password: str, protocol: str = "SASL_SSL",
                       mechanism: str = "PLAIN", group_id: str | None = None) -> dict[str, str]:
    """SASL/PLAIN client properties; pass secrets in from a secret store, not code."""
    jaas = f'{PLAIN_LOGIN_MODULE} required username="{username}" password="{password}";'
    opts = {"kafka.security.protocol": protocol, "kafka.sasl.mechanism": mechanism,
            "kafka.sasl.jaas.config": jaas}
    if group_id:
        opts["kafka.group.id"] = group_id
    return opts


def sasl_plain_options_from_conf(spark: SparkSession, prefix: str = "spark.tideline.kafka.") -> dict[str, str]:
    """SASL options from session conf keys ``<prefix>username`` / ``password`` / ``groupId``."""
    g = spark.conf.get
    return sasl_plain_options(g(prefix + "username"), g(prefix + "password"),
                              group_id=g(prefix + "groupId", None))


def decode_json_value(raw: DataFrame, schema: str, timestamp_format: str | None = None,
                      keep: list[str] | None = None) -> DataFrame:
    """Kafka ``value`` bytes -> the declared columns (malformed rows -> nulls).

    ``keep`` may name ``value``, the raw bytes, for a dead-letter output.
    """
    parsed = raw.select(*(keep or []), from_json_record(F.col("value").cast("string"), schema,
                                                        timestamp_format).alias("__r"))
    return parsed.select(*(keep or []), "__r.*")


def read_json_topic(spark: SparkSession, options: dict[str, str], schema: str,
                    event_time: str | None = None, delay=None,
                    timestamp_format: str | None = None) -> DataFrame:
    """Streaming source table with an optional declared watermark."""
    raw = spark.readStream.format("kafka").options(**options).load()
    df = decode_json_value(raw, schema, timestamp_format)
    if event_time and delay is not None:
        df = df.withWatermark(event_time, spark_interval(delay))
    return df
