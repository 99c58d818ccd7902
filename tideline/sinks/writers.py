"""Sinks: print, memory, table append, Kafka JSON, JDBC, and two outputs from one operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tideline.functions.scalar import ISO_8601_MS, to_json_record
from tideline.functions.time import duration_us, epoch_us
from tideline.session import checkpoint_location


def labelled(df: DataFrame, label: str | None) -> DataFrame:
    """Prefix every row with a ``label`` column (the print sink's "Unique Order>")."""
    return df if label is None else df.select(F.lit(label).alias("label"), *df.columns)


def print_table(df: DataFrame, label: str | None = None, write: Callable[[str], None] = print) -> None:
    """Print every row of a batch result, one line per row, with the label in front.

    Rows come to the driver one partition at a time; meant for looking at results.
    """
    prefix = "" if label is None else f"{label}> "
    for row in df.toLocalIterator():
        write(prefix + ", ".join(map(str, row)))


def console(df: DataFrame, job: str, label: str | None = None, output_mode: str = "append",
            checkpoint: str | None = None, write: Callable[[str], None] = print, **trigger) -> StreamingQuery:
    """Streaming print sink; one line per row of each micro-batch, optionally labelled."""
    w = df.writeStream.outputMode(output_mode).foreachBatch(lambda batch, epoch_id: print_table(batch, label, write))
    return _start(w, df, job, checkpoint, trigger)


def memory(df: DataFrame, query_name: str, output_mode: str = "append",
           checkpoint: str | None = None, **trigger) -> StreamingQuery:
    """Streaming sink into an in-memory table ``query_name`` (tests).

    The table is lost with the session, so each start begins anew.
    """
    w = df.writeStream.format("memory").queryName(query_name).outputMode(output_mode)
    return _start(w, df, f"{query_name}-{uuid.uuid4().hex}", checkpoint, trigger)


def append_to_table(df: DataFrame, table: str, checkpoint: str | None = None, **trigger):
    """``INSERT INTO table SELECT ...``: batch ``insertInto`` or streaming ``toTable``."""
    if not df.isStreaming:
        df.write.insertInto(table)
        return None
    loc = checkpoint or checkpoint_location(df.sparkSession, f"append-{table}")
    w = df.writeStream.option("checkpointLocation", loc).outputMode("append")
    if trigger:
        w = w.trigger(**trigger)
    return w.toTable(table)


def to_kafka_records(df: DataFrame, value_cols: list[str], key_col: str | None = None,
                     timestamp_format: str = ISO_8601_MS) -> DataFrame:
    """``(key, value)`` string columns: the row as one ISO-8601 JSON object."""
    key = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    return df.select(key.alias("key"), to_json_record(*value_cols, timestamp_format=timestamp_format).alias("value"))


def kafka(df: DataFrame, options: dict[str, str], topic: str, value_cols: list[str],
          key_col: str | None = None, checkpoint: str | None = None, **trigger):
    """Write rows as JSON to a Kafka topic (batch or streaming).

    Needs the spark-sql-kafka package on the classpath at submit time.
    """
    recs = to_kafka_records(df, value_cols, key_col)
    opts = dict(options, topic=topic)
    if not df.isStreaming:
        recs.write.format("kafka").options(**opts).save()
        return None
    w = recs.writeStream.format("kafka").options(**opts)
    return _start(w, df, f"kafka-{topic}", checkpoint, trigger)


def jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
         mode: str = "append", batch_size: int = 10_000, num_partitions: int | None = None) -> None:
    """Batch JDBC write; ``num_partitions`` caps concurrent connections."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()


def jdbc_batch_writer(url: str, table: str, properties: dict[str, str] | None = None) -> Callable:
    """A ``foreachBatch`` function that appends each micro-batch over JDBC."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        jdbc(batch, url, table, properties)
    return write


def two_sinks(flag: str, write_main: Callable[[DataFrame, int], None],
              write_side: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body for an operator with a side output.

    The batch is persisted once and filtered twice: rows with ``flag`` false
    go to ``write_main``, the others to ``write_side``. Both sinks see every
    micro-batch exactly once per attempt; for exactly-once results the
    writers should be idempotent per ``epoch_id`` (e.g. overwrite a
    partition named by it).
    """
    def run(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            write_main(batch.filter(~F.col(flag)).drop(flag), epoch_id)
            write_side(batch.filter(F.col(flag)).drop(flag), epoch_id)
        finally:
            batch.unpersist()
    return run


_COMMIT = "main_rows long, side_rows long, latest_us long, epoch long"


def _write_jointly(batch: DataFrame, flag: str, epoch_id: int, root: str, main: str, side: str, latest: Column) -> None:
    batch.persist()
    try:
        for name, rows in ((main, batch.filter(~F.col(flag))), (side, batch.filter(F.col(flag)))):
            rows.drop(flag).write.mode("overwrite").parquet(f"{root}/{name}/epoch={epoch_id}")
        commit = batch.agg(F.count(F.when(~F.col(flag), 1)).alias("main_rows"), F.count(F.when(F.col(flag), 1)).alias("side_rows"),
                           F.max(latest).cast("long").alias("latest_us"))
        commit.coalesce(1).write.mode("overwrite").parquet(f"{root}/commits/epoch={epoch_id}")
    finally:
        batch.unpersist()


def joint_sinks(flag: str, root: str, main: str = "main", side: str = "side") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body that commits both outputs of an operator together.

    Each output of a micro-batch is written to a folder of its epoch, and a
    commit of the epoch last. ``read_committed`` shows epochs that have one. A
    batch that fails between the writes is shown by neither output; when it
    runs again, with the same epoch and rows, it replaces what it left.
    """
    root = root.rstrip("/")
    return lambda batch, epoch_id: _write_jointly(batch, flag, epoch_id, root, main, side, F.lit(None))


def late_sinks(root: str, time: str, size, delay="5 seconds", main: str = "on_time", side: str = "late") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body that parts the rows of a windowed job: those in time, and those whose window had closed.

    The watermark of a batch is the largest time of all batches before it, as
    their commits tell, less ``delay``; a row is late when its tumbling window
    of ``size`` ended at or before it. So a restart goes on with the same
    watermark, and a batch that runs again decides as before. Rows without a
    time are in no window and not late. Both outputs are committed together,
    with their numbers of rows (``committed_epochs``); no row is dropped.
    """
    root, size_us, delay_us = root.rstrip("/"), duration_us(size), duration_us(delay)

    def run(batch: DataFrame, epoch_id: int) -> None:
        epochs = committed_epochs(batch.sparkSession, root)
        latest = epochs.filter(F.col("epoch") < epoch_id).agg(F.max("latest_us")).first()[0] if epochs is not None else None
        at = epoch_us(batch, time)
        ended = at - F.pmod(at, F.lit(size_us)) + F.lit(size_us)
        late = F.lit(False) if latest is None else F.coalesce(ended <= F.lit(latest - delay_us), F.lit(False))
        _write_jointly(batch.withColumn("__late", late), "__late", epoch_id, root, main, side, at)
    return run


def committed_epochs(spark: SparkSession, root: str) -> DataFrame | None:
    """(epoch, main_rows, side_rows, latest_us) of each committed epoch; None before the first."""
    try:
        return spark.read.schema(_COMMIT).parquet(f"{root.rstrip('/')}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_committed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rows of one output of ``joint_sinks`` or ``late_sinks`` and their ``epoch``, of committed epochs only."""
    rows, epochs = spark.read.parquet(f"{root.rstrip('/')}/{name}"), committed_epochs(spark, root)
    rows = rows.withColumn("epoch", F.col("epoch").cast("long"))
    return rows.filter(F.lit(False)) if epochs is None else rows.join(epochs.select("epoch"), "epoch", "left_semi").select(*rows.columns)


def parquet_batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Append each micro-batch to a parquet folder (one sub-folder per epoch, so retries overwrite)."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/epoch={epoch_id}")
    return write


def _start(w: DataStreamWriter, df: DataFrame, name: str, checkpoint: str | None, trigger: dict) -> StreamingQuery:
    loc = checkpoint or checkpoint_location(df.sparkSession, name)
    w = w.option("checkpointLocation", loc)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
