"""Registered queries that run a real stream over the driver's tables and return what it has written.

The table is written to the shared folder as the files of a stream, the
streaming job runs over them in several micro-batches, and the query reads
what its sink holds afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.time import epoch_us
from tideline.session import ROCKSDB, shared_path
from tideline.sinks.writers import late_sinks, parquet_batch_writer, read_committed
from tideline.sources.files import read_parquet_stream
from tideline.sources.tables import documents, table
from tideline.streaming.changelog import replayed_counts, stream_word_changelog

# Micro-batches of the word count, and files of each, at least.
LINE_BATCHES, LINE_FILES = 4, 4
# Late rows: a line item's event time is its order's date, and it arrives in the batch of its ship year.
LATE_WINDOW, LATE_DELAY = "30 days", "90 days"


def _run(writer, spark: SparkSession, job: str) -> None:
    for k, v in ROCKSDB.items():
        spark.conf.set(k, v)
    writer.option("checkpointLocation", job).trigger(availableNow=True).start().awaitTermination()


def q_word_count_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The continuous word count as a changelog over several micro-batches, replayed to its current counts."""
    lines, out, job = (shared_path(spark, n) for n in ("lines", "changelog", "changelog-job"))
    docs = documents(spark, sf_dir).select("text")
    # As many files a batch as the table has splits, so that every batch keeps all cores busy.
    files = max(LINE_FILES, docs.rdd.getNumPartitions())
    docs.repartition(LINE_BATCHES * files).write.parquet(lines)
    log = stream_word_changelog(read_parquet_stream(spark, lines, docs.schema, files), "text")
    _run(log.writeStream.foreachBatch(parquet_batch_writer(out)), spark, job)
    return replayed_counts(spark.read.parquet(out), "word")


def _shipped_by_year(spark: SparkSession, sf_dir: str) -> str:
    """Line items as a stream, a micro-batch for each ship year, parted by ``late_sinks``; the folder of its outputs.

    The job is started anew for each year's files and goes on from its
    checkpoint, so every start is one batch, whatever the number of files.
    """
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                                    F.year("l_shipdate").alias("ship_year"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", F.col("o_orderdate").cast("timestamp_ntz").alias("ts"))
    rows = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    files, root, job = (shared_path(spark, n) for n in ("shipped", "shipped-out", "shipped-job"))
    years = [r[0] for r in items.select("ship_year").distinct().orderBy("ship_year").collect()]
    for year in years:
        rows.filter(F.col("ship_year") == year).write.mode("append").parquet(files)
        stream = spark.readStream.schema(rows.schema).parquet(files)
        _run(stream.writeStream.foreachBatch(late_sinks(root, "ts", LATE_WINDOW, LATE_DELAY)), spark, job)
    return root


def q_late_rows_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose window had closed when they arrived, with their micro-batch."""
    late = read_committed(spark, _shipped_by_year(spark, sf_dir), "late")
    return late.select("o_orderpriority", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "ts", "ship_year", "epoch")


def q_on_time_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and quantity of each window and priority, of the rows that arrived in time."""
    rows = read_committed(spark, _shipped_by_year(spark, sf_dir), "on_time")
    days = F.floor(epoch_us(rows, "ts") / (30 * 86_400_000_000)).cast("long") * 30
    return rows.groupBy("o_orderpriority", days.alias("window_start_day")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("l_quantity").cast("decimal(28,8)")), 6).cast("double").alias("total_quantity"))
