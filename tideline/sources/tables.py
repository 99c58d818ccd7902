"""Readers for the driver's parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``<sf_dir>/<name>.parquet`` (a file or a folder of parts).

    Column pruning and filter pushdown reach the scan because everything
    downstream is declarative.
    """
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events(event_id, ts timestamp_ntz, user_id, event_type, value, props)``."""
    return table(spark, sf_dir, "events")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def save_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str,
                  sort_by: list[str] | None = None) -> None:
    """Store ``df`` hash-bucketed by ``keys`` (and sorted within buckets) as a table at ``path``.

    Several keyed jobs over the same events (signals, sessions, dedup,
    watermark traces) then read partitions already clustered by key: a
    window or aggregate on ``keys`` needs no shuffle. ``path`` should be in
    shared storage; choose ``buckets`` so one bucket file is a few hundred MB.
    """
    w = df.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *keys)
    if sort_by:
        w = w.sortBy(*sort_by)
    w.saveAsTable(table)
