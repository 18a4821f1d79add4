"""Topic envelopes: read, decode, encode and write (IO3-IO5, IO10, IO12, IO13).

A topic is configured by a dict:

* ``{"format": "kafka", "servers": "...", "topic": "..."}`` - a Kafka topic
  (needs the Kafka connector on the classpath);
* ``{"format": "file", "path": "..."}`` - a folder of parquet files with the
  columns ``key BINARY, value BINARY, timestamp TIMESTAMP``, the part of a
  Kafka record that the jobs use. Tests and fixtures use this form.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.functions.timeutil import ts_lit
from tickflow.sources.schemas import TOPIC

# JSON timestamp layout used on every topic we write: ISO-8601 with
# microseconds, so that a round trip keeps the full precision.
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _millis(ts) -> int:
    if isinstance(ts, _dt.datetime):
        if ts.tzinfo is None:
            ts = ts.replace(tzinfo=_dt.timezone.utc)
        return int(ts.timestamp() * 1000)
    text = str(ts)
    return int(text) if text.lstrip("-").isdigit() else _millis(_dt.datetime.fromisoformat(text))


def read_topic(spark: SparkSession, cfg: dict, since=None) -> DataFrame:
    """Bounded read of a topic (IO3); ``since`` starts at a timestamp (IO4).

    For Kafka, ``since`` becomes ``startingTimestamp`` (applies to every
    partition); otherwise the read starts at the earliest offsets. For a
    file-backed topic it is a filter on ``timestamp`` that parquet pushes down.
    """
    if cfg["format"] == "kafka":
        reader = (spark.read.format("kafka")
                  .option("kafka.bootstrap.servers", cfg["servers"])
                  .option("subscribe", cfg["topic"]))
        if since is not None:
            reader = reader.option("startingTimestamp", str(_millis(since)))
        else:
            reader = reader.option("startingOffsets", "earliest")
        return reader.load().select("key", "value", "timestamp")
    df = spark.read.schema(TOPIC).parquet(cfg["path"]).select("key", "value", "timestamp")
    if since is not None:
        df = df.filter(F.col("timestamp") >= ts_lit(since, "timestamp"))
    return df


def stream_topic(spark: SparkSession, cfg: dict, starting="latest") -> DataFrame:
    """Streaming read of a topic (IO5): data loss tolerated; ``starting`` holds for a fresh checkpoint only.

    ``"latest"``: new records only, ``"earliest"``: all, else an instant: records from then on.
    A file-backed topic keeps no offsets: ``"latest"`` leaves out the files that are there when the
    query is defined (read as the largest record time in them, which ``latest_instant`` also gives
    a caller who restarts a query from its checkpoint and must pass the same start).
    """
    if cfg["format"] == "kafka":
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", cfg["servers"])
                  .option("subscribe", cfg["topic"])
                  .option("failOnDataLoss", "false"))
        reader = (reader.option("startingOffsets", starting) if starting in ("latest", "earliest")
                  else reader.option("startingTimestamp", str(_millis(starting))))
        return reader.load().select("key", "value", "timestamp")
    reader = spark.readStream.schema(TOPIC)
    if cfg.get("maxFilesPerTrigger"):
        reader = reader.option("maxFilesPerTrigger", str(cfg["maxFilesPerTrigger"]))
    records = reader.parquet(cfg["path"]).select("key", "value", "timestamp")
    if starting == "earliest":
        return records
    if starting == "latest":
        newest = latest_instant(spark, cfg)
        return records if newest is None else records.filter(F.col("timestamp") > ts_lit(newest, "timestamp"))
    return records.filter(F.col("timestamp") >= ts_lit(starting, "timestamp"))


def latest_instant(spark: SparkSession, cfg: dict) -> str | None:
    """The largest record time of a file-backed topic, as text (one value); None while it is empty."""
    return read_topic(spark, cfg).agg(F.date_format(F.max("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t")).first()["t"]


def write_batch(df: DataFrame, cfg: dict, batch_id: int) -> None:
    """Write one micro-batch of encoded records; on a file-backed topic a replayed batch replaces itself."""
    if cfg["format"] == "kafka":
        write_topic(df, cfg)
    else:
        (df.select("key", "value", "timestamp", F.lit(int(batch_id)).alias("batch_id")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(cfg["path"]))


def decode(df: DataFrame, schema: T.StructType, keep_ts: str | None = None) -> DataFrame:
    """Topic record -> typed columns (IO12): bytes -> string -> ``from_json`` -> flatten.

    Malformed JSON yields a row of nulls, never an error. ``keep_ts`` names a
    column that keeps the record's arrival timestamp.
    """
    parsed = F.from_json(F.col("value").cast("string"), schema, JSON_OPTIONS).alias("j")
    cols = [parsed]
    if keep_ts:
        cols.append(F.col("timestamp").alias(keep_ts))
    out = df.select(*cols).select("j.*", *([keep_ts] if keep_ts else []))
    return out


def encode(df: DataFrame, key: str = "symbol", timestamp: Column | str | None = None,
           value_cols: list[str] | None = None) -> DataFrame:
    """Columns -> topic record (IO13): key = the key column, value = JSON of all columns.

    Null fields are left out of the JSON (Spark's default), which ``decode``
    reads back as null. ``timestamp`` sets the record time of a file-backed
    topic (default: the time of writing, like a broker would); ``value_cols``
    limits the JSON to those columns.
    """
    ts = F.current_timestamp() if timestamp is None else (
        F.col(timestamp) if isinstance(timestamp, str) else timestamp)
    # zone-less timestamps are written as UTC instants, so they decode into TIMESTAMP fields
    fields = [F.col(f.name).cast("timestamp").alias(f.name)
              if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
              for f in df.schema.fields if value_cols is None or f.name in value_cols]
    return df.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*fields), JSON_OPTIONS).cast("binary").alias("value"),
        ts.cast("timestamp").alias("timestamp"),
    )


def write_topic(df: DataFrame, cfg: dict) -> None:
    """Bounded write of encoded records to a topic."""
    if cfg["format"] == "kafka":
        (df.select("key", "value").write.format("kafka")
         .option("kafka.bootstrap.servers", cfg["servers"])
         .option("topic", cfg["topic"]).save())
    else:
        df.select("key", "value", "timestamp").write.mode("append").parquet(cfg["path"])


def stream_to_topic(df: DataFrame, cfg: dict, checkpoint: str, trigger: dict | None = None,
                    query_name: str | None = None):
    """Streaming sink to a topic (IO10): append mode, mandatory durable checkpoint."""
    if not checkpoint:
        raise ValueError("a checkpoint location is required for a topic sink")
    if cfg["format"] == "kafka":
        writer = (df.select("key", "value").writeStream.format("kafka")
                  .option("kafka.bootstrap.servers", cfg["servers"])
                  .option("topic", cfg["topic"]))
    else:
        writer = (df.select("key", "value", "timestamp").writeStream.format("parquet")
                  .option("path", cfg["path"]))
    writer = writer.option("checkpointLocation", checkpoint).outputMode("append")
    if query_name:
        writer = writer.queryName(query_name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
