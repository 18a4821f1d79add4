"""Structured Streaming jobs.

S1-S3 are stateless and append-only, like the reference: a topic stream is
decoded, cut off at the job start, joined to a static per-symbol table
(snapshot or day sentiment) and written back to a topic or a sink, always
with a durable checkpoint (S4). S5 and S6 are where state lives: a windowed
OHLCV aggregation and a title de-duplication, both bounded by a watermark.

A side is a stored table whose bytes the planner knows: broadcast within Spark's limit, else joined
under salts (``functions/sides.py``; AQE does not re-plan inside micro-batches). By default it
is frozen at job start. With ``refresh`` it is a function that gives the newest version, called for each
micro-batch; batches are then written by ``foreachBatch``, each into its own folder of the output
topic, so that a replayed batch replaces itself.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.functions.sides import stored
from tickflow.operators import bars as B
from tickflow.operators import incremental as I
from tickflow.operators import signals as SG
from tickflow.sources import schemas as SC
from tickflow.sources import tables as TB
from tickflow.sources import topics as TP

Refresh = Callable[[], DataFrame]


def _run(query, wait: bool):
    if wait:
        query.awaitTermination()
    return query


def _decide(stream: DataFrame, side: DataFrame | None, refresh: Refresh | None, decide, out_topic: dict, fields: list[str],
            checkpoint: str, trigger: dict | None, wait: bool):
    """Write ``decide(rows, side)`` of a stream to a topic, with a frozen side or one re-read per batch."""
    def encoded(rows: DataFrame, with_side: DataFrame) -> DataFrame:
        # the output record keeps the input's arrival time (a broker would stamp its own)
        return TP.encode(decide(rows, with_side).select(*fields, "kafka_timestamp"), "symbol", timestamp="kafka_timestamp", value_cols=fields)

    if refresh is None:
        return _run(TP.stream_to_topic(encoded(stream, side), out_topic, checkpoint, trigger or {"availableNow": True}), wait)

    def write(batch: DataFrame, batch_id: int) -> None:
        TP.write_batch(encoded(batch, refresh()), out_topic, batch_id)

    if not checkpoint:
        raise ValueError("a checkpoint location is required")
    q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(**(trigger or {"availableNow": True})).start())
    return _run(q, wait)


def _messages(spark: SparkSession, topic: dict, schema, start, starting) -> DataFrame:
    raw = TP.decode(TP.stream_topic(spark, topic, starting), schema, keep_ts="kafka_timestamp")
    return raw if start is None else I.since(raw, "kafka_timestamp", start)


def stream_sma_signals(spark: SparkSession, quotes_topic: dict, out_topic: dict, snapshot: DataFrame | None,
                       checkpoint: str, snapshot_path: str | None = None, start=None, trigger: dict | None = None,
                       wait: bool = False, starting="latest", refresh: Refresh | None = None):
    """Quote topic -> cut-off (F1) -> typed quotes (P2) -> snapshot join (J1) -> C1 -> topic.

    The snapshot is frozen at job start (written once), as in the reference, or given by ``refresh``.
    ``starting``: ``"latest"``, ``"earliest"`` or an instant (IO5). Quotes of symbols without
    history give no row.
    """
    def decide(quotes: DataFrame, snap: DataFrame) -> DataFrame:
        return SG.attach_snapshot(quotes, snap).withColumn("signal", SG.sma_signal())

    snap = None if refresh else stored(snapshot, "snapshot", snapshot_path)
    quotes = B.typed_quotes(_messages(spark, quotes_topic, SC.QUOTE_MESSAGE, start, starting))
    return _decide(quotes, snap, refresh, decide, out_topic, SC.SMA_SIGNAL_FIELDS, checkpoint, trigger, wait)


def stream_combined_signals(spark: SparkSession, sma_topic: dict, out_topic: dict, day_sentiment: DataFrame | None,
                            checkpoint: str, sentiment_path: str | None = None, start=None, trigger: dict | None = None,
                            wait: bool = False, starting="latest", refresh: Refresh | None = None):
    """SMA signal topic -> cut-off -> P2 -> day sentiment (J2, left) -> C3 -> topic.

    ``starting`` and ``refresh`` as for ``stream_sma_signals``.
    """
    def decide(signals: DataFrame, sentiment: DataFrame) -> DataFrame:
        return SG.attach_sentiment(signals, sentiment.select("symbol", "day", "sentiment_signal")).withColumn("combined_signal", SG.combined_signal())

    sent = None if refresh else stored(day_sentiment.select("symbol", "day", "sentiment_signal"), "day-sentiment", sentiment_path)
    typed = _messages(spark, sma_topic, SC.SMA_SIGNAL_MESSAGE, start, starting)
    for c in ("open", "high", "low", "close", "volume"):
        typed = typed.withColumn(c, F.col(c).try_cast("double"))
    typed = (typed.withColumn("datetime", F.try_to_timestamp("datetime"))
             .withColumnRenamed("signal", "sma_signal")
             .withColumn("day", F.to_date("datetime")))
    return _decide(typed, sent, refresh, decide, out_topic, SC.COMBINED_SIGNAL_FIELDS, checkpoint, trigger, wait)


def stream_signal_sink(spark: SparkSession, combined_topic: dict, path: str, checkpoint: str,
                       trigger: dict | None = None, wait: bool = False, starting="earliest"):
    """S3 + S4: combined signal topic -> typed (P3) -> idempotent batch sink (IO11).

    Signals rest typed, in day partitions; ``serving`` reads them from there and renders
    documents (P14). Like the reference's sink, it sets no start of its own by default.
    """
    if not checkpoint:
        raise ValueError("a checkpoint location is required")
    raw = TP.decode(TP.stream_topic(spark, combined_topic, starting), SC.COMBINED_SIGNAL_MESSAGE,
                    keep_ts="kafka_timestamp")
    known, started = {}, threading.Event()

    def run_id() -> str:
        if not started.wait(600):
            raise TimeoutError("the query's id is not known yet; the batch is tried again")
        return known["id"]

    q = (SG.typed_signals(raw).writeStream.foreachBatch(TB.signal_sink(path, run_id=run_id))
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(**(trigger or {"availableNow": True})).start())
    known["id"] = str(q.id)
    started.set()
    return _run(q, wait)


def stream_resample(ticks: DataFrame, path: str, checkpoint: str, interval: str = "1 day",
                    watermark: str = "1 hour", ts: str = "datetime", price: str = "close",
                    volume: str | None = "volume", tie: str | None = None,
                    trigger: dict | None = None, wait: bool = False):
    """Streaming OHLCV bars; append mode emits a bar once the watermark passes its end."""
    bars = B.resample(ticks, interval, ts=ts, price=price, volume=volume, tie=tie, watermark=watermark)
    q = (bars.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(**(trigger or {"availableNow": True})).start())
    return _run(q, wait)


def dedupe_stream(news: DataFrame, watermark: str = "1 day", keys=("symbol",), title: str = "title",
                  ts: str = "publishedAt", arrival: str = "timestamp") -> DataFrame:
    """Drop repeated titles (case-insensitive) per key within the watermark.

    State per title key is kept until the watermark passes it, so memory is
    bounded by the titles of one watermark span, not by the whole stream. The watermark
    follows the ``arrival`` column where there is one (else ``ts``): articles that arrive
    in another order than they were published are late by neither.
    """
    keyed = (news.withColumn(ts, F.col(ts).cast("timestamp"))
             .withColumn("title_key", F.lower(F.coalesce(F.col(title), F.lit("")))))
    if arrival in keyed.columns:
        keyed = keyed.withColumn(arrival, F.col(arrival).cast("timestamp"))
        ts = arrival
    return keyed.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([*keys, "title_key"])
