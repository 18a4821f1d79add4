"""Message and table schemas (hand-written, never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# Time-series API payload: one document per request, points as strings.
API_POINT = T.StructType([
    T.StructField("datetime", S), T.StructField("open", S), T.StructField("high", S),
    T.StructField("low", S), T.StructField("close", S), T.StructField("volume", S),
])
API_PAYLOAD = T.StructType([
    T.StructField("symbol", S),
    T.StructField("values", T.ArrayType(API_POINT)),
])

# Daily bar message (historical load topic).
BAR_MESSAGE = T.StructType([
    T.StructField("symbol", S), T.StructField("date", T.DateType()),
    T.StructField("close_price", S), T.StructField("volume", S),
])

# One-minute quote message.
QUOTE_MESSAGE = T.StructType([
    T.StructField(c, S) for c in ("symbol", "datetime", "open", "high", "low", "close", "volume")
])

QUOTE_FIELDS = ["symbol", "datetime", "open", "high", "low", "close", "volume"]
SMA_SIGNAL_FIELDS = QUOTE_FIELDS + [
    "short_term_avg", "long_term_avg", "short_above_long", "is_significant", "signal"]
COMBINED_SIGNAL_FIELDS = QUOTE_FIELDS + [
    "short_term_avg", "long_term_avg", "short_above_long", "is_significant",
    "sma_signal", "sentiment_signal", "combined_signal"]

# SMA signal message, read back with every field as a string.
SMA_SIGNAL_MESSAGE = T.StructType([T.StructField(c, S) for c in SMA_SIGNAL_FIELDS])
# Combined signal message, read back with every field as a string.
COMBINED_SIGNAL_MESSAGE = T.StructType([T.StructField(c, S) for c in COMBINED_SIGNAL_FIELDS])

# News message as published to the news topic.
NEWS_MESSAGE = T.StructType([
    T.StructField("symbol", S), T.StructField("title", S),
    T.StructField("publishedAt", T.TimestampType()), T.StructField("description", S),
    T.StructField("url", S), T.StructField("source_name", S), T.StructField("content", S),
])

# Raw news article as returned by a news search API.
ARTICLE = T.StructType([
    T.StructField("title", S), T.StructField("publishedAt", S),
    T.StructField("description", S), T.StructField("url", S), T.StructField("content", S),
    T.StructField("source", T.StructType([T.StructField("name", S)])),
])

# File-backed topic layout (same columns a Kafka source yields that we use).
TOPIC = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("timestamp", T.TimestampType()),
])
