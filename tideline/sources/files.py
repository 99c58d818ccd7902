"""File sources: CSV lines and JSON lines, batch and streaming.

Streaming file sources need a directory (new files are picked up per
trigger) and an explicit schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_csv(spark: SparkSession, path: str, schema: str = "word string", header: bool = False,
             stream: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """``CREATE TABLE t (word STRING) WITH ('connector'='filesystem','format'='csv')``."""
    r = spark.readStream if stream else spark.read
    r = r.schema(schema).option("header", str(header).lower())
    if stream and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(path)


def read_json(spark: SparkSession, path: str, schema: str, timestamp_format: str | None = None,
              stream: bool = False, max_files_per_trigger: int | None = None, raw: str | None = None) -> DataFrame:
    """JSON lines with ISO-8601 timestamps (``'json.timestamp-format.standard'='ISO-8601'``).

    Times may have any fraction of seconds and a zone, unless a format is
    given. ``raw`` names a column for lines that cannot be parsed.
    """
    r = spark.readStream if stream else spark.read
    r = r.schema(schema if raw is None else f"{schema}, {raw} string").option("mode", "PERMISSIVE")
    if raw is not None:
        r = r.option("columnNameOfCorruptRecord", raw)
    if timestamp_format:
        r = r.option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
    if stream and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(path)


def read_parquet_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    """Replay a parquet folder as a stream (one or more files per trigger)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)
