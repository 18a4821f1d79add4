"""Price bars: payload unpacking, typing, resampling, top-k, back-fill and upsert.

IO1 IO2 P1 P2 P5 F3 A6 T1 T4 U0 (S5 is ``resample`` on a streaming frame).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.functions.timeutil import ts_lit


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------- payloads

def from_api_payload(df: DataFrame) -> DataFrame:
    """Daily API payloads -> typed daily bars (IO1 + P1).

    One row per point of ``values`` (a missing list counts as empty);
    ``datetime`` becomes ``date``, ``close`` becomes ``close_price``.
    """
    points = df.select("symbol", F.explode(F.coalesce(
        F.col("values"), F.array().cast(df.schema["values"].dataType))).alias("p"))
    return typed_bars(points.select(
        "symbol",
        F.col("p.datetime").alias("date"),
        F.col("p.close").alias("close_price"),
        F.col("p.volume").alias("volume"),
    ))


def quotes_from_api_payload(df: DataFrame) -> DataFrame:
    """One-minute quote payloads -> quote messages (IO2).

    Only the first point of ``values`` is used; an empty or missing list gives no row.
    """
    first = df.select("symbol", F.try_element_at(F.col("values"), F.lit(1)).alias("p"))
    return (first.filter(F.col("p").isNotNull())
            .select("symbol", *[F.col(f"p.{c}").alias(c) for c in
                                ("datetime", "open", "high", "low", "close", "volume")]))


def typed_bars(df: DataFrame) -> DataFrame:
    """Bar message -> typed bar (P1): ``date`` DATE, ``close_price`` DOUBLE, ``volume`` BIGINT.

    ``try_cast`` turns malformed numbers into nulls instead of failing the job
    (Spark is ANSI by default); BIGINT keeps volumes above 2^31-1, and a fractional
    volume text loses its fraction.
    """
    return df.select(
        "symbol",
        F.col("date").cast("string").try_cast("date").alias("date"),
        F.col("close_price").cast("string").try_cast("double").alias("close_price"),
        F.col("volume").cast("string").try_cast("decimal(38,6)").try_cast("bigint").alias("volume"),
    )


def typed_quotes(df: DataFrame) -> DataFrame:
    """Quote message -> typed quote (P2): OHLCV DOUBLE, ``datetime`` TIMESTAMP."""
    out = df
    for c in ("open", "high", "low", "close", "volume"):
        out = out.withColumn(c, F.col(c).cast("string").try_cast("double"))
    return out.withColumn("datetime", F.try_to_timestamp(F.col("datetime").cast("string")))


def load_bars(df: DataFrame, keep=()) -> DataFrame:
    """Stored bars -> indicator input (P5): ``symbol, date TIMESTAMP, close_price`` (+ ``keep``)."""
    return df.select("symbol", F.to_timestamp("date").alias("date"), "close_price", *keep)


# --------------------------------------------------------------------------- filters

def in_session(df: DataFrame, ts: str = "datetime", tz: str = "Asia/Jerusalem",
               start: str = "16:30:00", end: str = "23:00:00") -> DataFrame:
    """Keep rows whose local time of day in ``tz`` lies in [start, end].

    Both ends are inclusive and there is no weekday check. ``ts`` is a UTC
    wall-clock timestamp.
    """
    utc = F.col(ts).cast("timestamp_ntz")
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)
    tod = F.date_format(local, "HH:mm:ss.SSSSSS")
    return df.filter(tod.between(f"{start}.000000", f"{end}.000000"))


# --------------------------------------------------------------------------- resample

def _order_key(ts: str, tie: str) -> Column:
    """``(ts, tie)`` as one exact, order-preserving DECIMAL(38,0):
    ``epoch micros * 10^20 + (tie + 2^63)``.

    A struct ordering would force a sort-based aggregation over every tick;
    a fixed-width key keeps ``min_by`` / ``max_by`` in hash aggregation.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp")).cast("decimal(38,0)")
    shifted = F.col(tie).cast("decimal(38,0)") + F.lit(str(2 ** 63)).cast("decimal(38,0)")
    return (micros * F.lit(str(10 ** 20)).cast("decimal(38,0)") + shifted).cast("decimal(38,0)")


def resample(df: DataFrame, interval: str, ts: str = "datetime", price: str = "close",
             volume: str | None = "volume", key: str = "symbol",
             tie: str | None = None, watermark: str | None = None) -> DataFrame:
    """OHLCV bars per ``key`` and tumbling ``interval`` (A6; S5 on a stream).

    open / close are the first / last price by ``(ts, tie)``, high / low the
    extremes, volume the sum of ``volume`` (tick count when ``volume`` is None).
    All aggregates are partial-aggregation friendly, so each task combines its
    ticks before the shuffle and a hot symbol is spread over its many bars.
    ``watermark`` bounds late data on a stream (append mode emits closed bars).
    """
    src = df
    if watermark:
        src = src.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    whole = tie is not None and isinstance(df.schema[tie].dataType, T.IntegralType)
    # ties of other types (text) order by the pair itself
    order = _order_key(ts, tie) if whole else F.struct(ts, tie) if tie else F.col(ts)
    vol = F.sum(volume).cast("double") if volume else F.count(F.lit(1))
    return (src.groupBy(key, F.window(ts, interval).alias("bar"))
            .agg(F.min_by(price, order).alias("open"),
                 F.max(price).alias("high"),
                 F.min(price).alias("low"),
                 F.max_by(price, order).alias("close"),
                 vol.alias("volume"))
            .select(key, F.col("bar.start").alias("bar_start"), F.col("bar.end").alias("bar_end"),
                    "open", "high", "low", "close", "volume"))


# --------------------------------------------------------------------------- top-k

def latest_bars(df: DataFrame, n: int = 30, key: str = "symbol", order: str = "date") -> DataFrame:
    """The ``n`` latest rows per ``key``.

    ``row_number() <= n`` is planned as a WindowGroupLimit, which keeps only n
    rows per key in each task before the shuffle, so one hot symbol costs at
    most n rows per task downstream.
    """
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def backfill(df: DataFrame, n: int = 200, start=None, end=None, key: str = "symbol",
             order: str = "date") -> DataFrame:
    """Bounded back-fill (T4): the last ``n`` bars per key within [start, end]."""
    out = df
    if start is not None:
        out = out.filter(F.col(order) >= ts_lit(start, df.schema[order].dataType))
    if end is not None:
        out = out.filter(F.col(order) <= ts_lit(end, df.schema[order].dataType))
    return latest_bars(out, n, key, order)


# --------------------------------------------------------------------------- upsert

def merge_daily(existing: DataFrame, new: DataFrame, keys=("symbol", "date")) -> DataFrame:
    """Daily close upsert (U0): existing bars union new bars, the new bar wins per key.

    Unlike a plain append, re-running an update does not duplicate a bar. Of several
    new (or old) bars of one key the one with the larger values wins, compared column by
    column, however the rows are partitioned. Keep-last is an aggregate, so it combines
    map-side and never gathers one symbol in one task.
    """
    keys = list(keys)
    values = [c for c in existing.columns if c not in keys]
    both = (existing.select(*keys, *values).withColumn("_src", F.lit(0))
            .unionByName(new.select(*keys, *values).withColumn("_src", F.lit(1))))
    latest = both.groupBy(*keys).agg(F.max(F.struct("_src", *values)).alias("_v"))
    return latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])
