"""Avro payload decoding, available only when the spark-avro package is loaded."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession


class AvroUnavailable(RuntimeError):
    pass


def avro_available(spark: SparkSession) -> bool:
    """True when the ``avro`` data source can be resolved on this session."""
    try:
        conf = spark._jsparkSession.sessionState().conf()
        spark._jvm.org.apache.spark.sql.execution.datasources.DataSource.lookupDataSource("avro", conf)
        return True
    except Exception:
        return False


def decode(spark: SparkSession, payload: Column, json_schema: str) -> Column:
    """``from_avro(payload, schema)``; raises ``AvroUnavailable`` without the package."""
    if not avro_available(spark):
        raise AvroUnavailable("spark-avro is not on the classpath; add it with spark.jars.packages")
    from pyspark.sql.avro.functions import from_avro
    return from_avro(payload, json_schema)
