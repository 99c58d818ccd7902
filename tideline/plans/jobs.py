"""The reference's jobs, wired end to end from tideline's sources, operators and sinks.

Each function starts a Structured Streaming query (or returns a batch
DataFrame) the way the corresponding reference job runs: source -> operator ->
sink. Kafka topics can be replaced by folders of JSON lines (``fmt='json'``),
which is how the tests run them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tideline.functions.scalar import ISO_8601_MS, to_json_record
from tideline.session import checkpoint_location
from tideline.sinks import writers
from tideline.sources import generators as gen
from tideline.sources import kafka as kafka_src
from tideline.sources import literals
from tideline.sources.files import read_csv, read_json
from tideline.streaming.dedup import stream_dedup_expiring, stream_keep_first, stream_tag_duplicates
from tideline.streaming.signals import split_valid, stream_price_signals
from tideline.streaming.windows import stream_word_counts

# The schemas of the reference's stock source and signal sink tables.
STOCK_TICK_SCHEMA = "stock_symbol string, price double, event_time timestamp"
STOCK_SIGNAL_COLUMNS = ["stock_symbol", "signal", "price", "event_time"]


def stocks_signals_job(spark: SparkSession, source: str | dict, sink: str | dict, fmt: str = "kafka",
                       topic: str = "stock_signals_topic", delay: str = "5 seconds", job: str = "stocks-signals",
                       rejects: str | None = None, **trigger) -> list[StreamingQuery]:
    """Stock ticks (JSON, ISO-8601) -> BUY/SELL on >5% moves vs the previous tick -> JSON sink.

    ``fmt='kafka'``: ``source``/``sink`` are option dicts (see ``sources.kafka``).
    ``fmt='json'``: ``source``/``sink`` are folders of JSON lines. A restart
    under the same ``job`` name resumes. Ticks without symbol or time (a record
    that cannot be decoded has neither) do not reach the operator: with
    ``rejects`` a second query writes them to that folder as text. The number
    of rejected and late rows of each batch is in the query's progress, under
    observedMetrics. Returns the queries, the signals first.
    """
    if fmt == "kafka":
        raw = spark.readStream.format("kafka").options(**source).load()
        ticks = kafka_src.decode_json_value(raw, STOCK_TICK_SCHEMA, keep=["value"]).withColumn("raw", F.col("value").cast("string"))
    else:
        ticks = read_json(spark, source, STOCK_TICK_SCHEMA, stream=True, raw="raw")
    valid, rejected = split_valid(ticks, "stock_symbol", "event_time")
    signals = stream_price_signals(valid, "stock_symbol", "price", "event_time", delay=delay)
    signals = signals.select(*STOCK_SIGNAL_COLUMNS)
    loc = checkpoint_location(spark, job)
    if fmt == "kafka":
        queries = [writers.kafka(signals, sink, topic, STOCK_SIGNAL_COLUMNS, key_col="stock_symbol",
                                 checkpoint=loc, **trigger)]
    else:
        out = signals.select(to_json_record(*STOCK_SIGNAL_COLUMNS, timestamp_format=ISO_8601_MS).alias("value"))
        queries = [_to_text(out, sink, loc, trigger)]
    if rejects:
        record = F.coalesce("raw", to_json_record("stock_symbol", "price", "event_time"))
        queries.append(_to_text(rejected.select(record.alias("value")), rejects, checkpoint_location(spark, f"{job}-rejects"), trigger))
    return queries


def _to_text(df: DataFrame, path: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    w = df.writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()


def dedup_job(orders: DataFrame, key: str = "orderId", order: str = "seq", mode: str = "first",
              ttl: str = "10 minutes", main=None, side=None, job: str | None = None,
              **trigger) -> StreamingQuery:
    """Keyed dedup of an order stream: ``mode`` = 'first', 'side_output' or 'expiring'.

    ``main``/``side`` are ``foreachBatch``-style writers ``(df, epoch_id)``;
    by default rows are printed with the reference's labels. A restart under
    the same ``job`` name (default: by the mode) goes on with its state.
    """
    spark = orders.sparkSession
    loc = checkpoint_location(spark, job or f"dedup-{mode}")
    if mode == "first":
        out = stream_keep_first(orders, [key], order)
    elif mode == "expiring":
        out = stream_dedup_expiring(orders, [key], order, ttl)
    elif mode == "side_output":
        tagged = stream_tag_duplicates(orders, [key], order)
        body = writers.two_sinks("is_duplicate", main or _printer("Unique Order"), side or _printer("Duplicate Order"))
        w = tagged.writeStream.foreachBatch(body).option("checkpointLocation", loc)
        return (w.trigger(**trigger) if trigger else w).start()
    else:
        raise ValueError(f"unknown mode {mode!r}")
    w = out.writeStream.foreachBatch(main or _printer("Unique Order")).option("checkpointLocation", loc)
    return (w.trigger(**trigger) if trigger else w).start()


def _printer(label: str):
    def write(batch: DataFrame, epoch_id: int) -> None:
        writers.print_table(batch, label)
    return write


def word_count_job(spark: SparkSession, path: str, query_name: str | None = None, job: str = "word-count",
                   **trigger) -> StreamingQuery:
    """CSV lines -> lateral split -> continuous COUNT per word; each batch gives the words that changed."""
    counts = stream_word_counts(read_csv(spark, path, "word string", stream=True), "word")
    if query_name:
        return writers.memory(counts, query_name, "update", **trigger)
    return writers.console(counts, job, output_mode="update", **trigger)


def datagen_job(spark: SparkSession, end: int = 10, query_name: str | None = None, job: str = "datagen",
                **trigger) -> StreamingQuery:
    """Sequence source 1..end with random data -> ``SELECT id + 1, data`` -> print sink."""
    src = gen.stream_sequence_table(spark, 1, end)
    out = src.select((F.col("id") + 1).alias("id"), "data")
    if query_name:
        return writers.memory(out, query_name, **trigger)
    return writers.console(out, job, **trigger)


def table_print_job(spark: SparkSession) -> DataFrame:
    """Strings -> table -> temp view -> ``SELECT UPPER(f0)`` -> rows."""
    return spark.sql("SELECT UPPER(f0) AS f0 FROM {names}", names=literals.names(spark))
