"""Connectors that need no broker or database: JSON lines, Kafka encode/decode, options."""

from __future__ import annotations

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tideline.sinks.writers import labelled, to_kafka_records
from tideline.sources import avro, jdbc, kafka
from tideline.sources.files import read_json

TICKS = [
    {"stock_symbol": "TCS", "price": 100.0, "event_time": "2024-01-01T00:00:00.000"},
    {"stock_symbol": "TCS", "price": 94.0, "event_time": "2024-01-01T00:00:01.250"},
    {"stock_symbol": "INFY", "price": 10.0, "event_time": "2024-01-01T00:00:02.000"},
]
TICK_SCHEMA = "stock_symbol string, price double, event_time timestamp"


def _jsonl(rows):
    d = tempfile.mkdtemp(prefix="tideline-json-")
    with open(os.path.join(d, "part.json"), "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")
    return d


def test_read_json_iso8601(spark):
    df = read_json(spark, _jsonl(TICKS), TICK_SCHEMA)
    rows = df.orderBy("event_time").collect()
    assert rows[1].event_time.replace(tzinfo=None) == dt.datetime(2024, 1, 1, 0, 0, 1, 250000)
    assert [r.price for r in rows] == [100.0, 94.0, 10.0]


def test_kafka_value_roundtrip(spark):
    df = read_json(spark, _jsonl(TICKS), TICK_SCHEMA)
    recs = to_kafka_records(df, ["stock_symbol", "price", "event_time"], key_col="stock_symbol")
    values = [json.loads(r.value) for r in recs.collect()]
    assert {"stock_symbol": "TCS", "price": 94.0, "event_time": "2024-01-01T00:00:01.250"} in values
    raw = recs.select(F.col("value").cast("binary").alias("value"))
    back = kafka.decode_json_value(raw, TICK_SCHEMA)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())


def test_kafka_decode_malformed_gives_nulls(spark):
    raw = spark.createDataFrame([(b"not json",), (b'{"stock_symbol":"A","price":1.5}',)], "value binary")
    rows = kafka.decode_json_value(raw, TICK_SCHEMA).collect()
    assert (rows[0].stock_symbol, rows[1].price) == (None, 1.5)


def test_kafka_options():
    src = kafka.source_options("broker:9092", "stock_prices_topic")
    assert src == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "stock_prices_topic",
                   "startingOffsets": "earliest"}
    auth = kafka.sasl_plain_options("u", "p", group_id="g")
    assert auth["kafka.security.protocol"] == "SASL_SSL" and auth["kafka.sasl.mechanism"] == "PLAIN"
    assert auth["kafka.sasl.jaas.config"].startswith("org.apache.kafka.common.security.plain.PlainLoginModule required")
    assert auth["kafka.group.id"] == "g"


def test_kafka_options_from_conf(spark):
    spark.conf.set("spark.tideline.kafka.username", "alice")
    spark.conf.set("spark.tideline.kafka.password", "s3cret")
    opts = kafka.sasl_plain_options_from_conf(spark)
    assert 'username="alice"' in opts["kafka.sasl.jaas.config"] and "kafka.group.id" not in opts


def test_jdbc_partitioned_read_needs_bounds(spark):
    with pytest.raises(ValueError):
        jdbc.read_table(spark, "jdbc:none", "t", partition_column="id")


def test_avro_guard(spark):
    if avro.avro_available(spark):
        pytest.skip("spark-avro present")
    with pytest.raises(avro.AvroUnavailable):
        avro.decode(spark, F.col("value"), "{}")


def test_labelled(spark):
    df = labelled(spark.createDataFrame([(1,)], "orderId int"), "Unique Order")
    assert df.columns == ["label", "orderId"] and df.first().label == "Unique Order"


def test_times_with_any_fraction_and_zone(spark):
    texts = ["2024-01-01T00:00:01", "2024-01-01T00:00:01.250", "2024-01-01T00:00:01.250001", "2024-01-01T00:00:01Z",
             "2024-01-01T02:00:01.5+02:00"]
    want = [dt.datetime(2024, 1, 1, 0, 0, 1, us) for us in (0, 250000, 250001, 0, 500000)]
    rows = [{"stock_symbol": str(i), "price": 1.0, "event_time": t} for i, t in enumerate(texts)]
    read = read_json(spark, _jsonl(rows), TICK_SCHEMA).orderBy("stock_symbol").collect()
    raw = spark.createDataFrame([(json.dumps(r).encode(),) for r in rows], "value binary")
    decoded = kafka.decode_json_value(raw, TICK_SCHEMA).orderBy("stock_symbol").collect()
    for got in (read, decoded):
        assert [r.event_time.replace(tzinfo=None) for r in got] == want


def test_null_fields_stay_in_records(spark):
    df = spark.createDataFrame([(None, 1.0), ("x", None)], "a string, b double")
    values = sorted(r.value for r in to_kafka_records(df, ["a", "b"]).collect())
    assert values == ['{"a":"x","b":null}', '{"a":null,"b":1.0}']
