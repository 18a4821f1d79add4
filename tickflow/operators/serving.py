"""Serving queries over stored signals."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickflow.functions.sides import join_side, stored
from tickflow.functions.text import iso_format
from tickflow.functions.timeutil import ts_lit

DOCUMENT_COLUMNS = ["symbol", "kafka_datetime", "datetime", "open", "high", "low", "close", "volume",
                    "short_term_avg", "long_term_avg", "short_above_long", "is_significant",
                    "sma_signal", "sentiment_signal", "combined_signal"]


def normalize_symbol(c):
    """Requested symbol normalisation (P13): strip and upper-case."""
    return F.upper(F.trim(F.col(c) if isinstance(c, str) else c))


def latest_signals(df: DataFrame, n: int = 3, requests: DataFrame | None = None,
                   key: str = "symbol", order: str = "datetime", request_col: str = "symbol",
                   since=None) -> DataFrame:
    """The ``n`` latest signals per symbol (T3); optionally only requested symbols.

    ``requests`` is a table of requested symbols in any case / padding; they
    are matched on the normalised symbol with a semi join. The top-n is a
    WindowGroupLimit, trimmed per task before the shuffle. Signals of one time are
    told apart by all their values, so the rows are the same on every run. ``since`` (a
    date) limits a stored table to its ``day`` partitions from then on.
    """
    src = df if since is None else df.filter(F.col("day") >= ts_lit(since, "date"))
    if requests is not None:
        wanted = requests.select(normalize_symbol(request_col).alias("_want")).distinct()
        src = src.join(wanted, normalize_symbol(key) == F.col("_want"), "left_semi")
    ties = [F.col(c).desc() for c in sorted(df.columns) if c not in (key, order)]
    w = Window.partitionBy(key).orderBy(F.col(order).desc(), *ties)
    return src.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def _py_text(c):
    """Text of a value as a Python f-string shows it; null -> 'None'."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def signal_card(df: DataFrame) -> DataFrame:
    """Six-line signal card text (P12) next to the key columns."""
    card = F.concat_ws(
        "\n",
        F.concat(F.lit("Symbol: "), _py_text(F.col("symbol"))),
        F.concat(F.lit("Time: "), _py_text(iso_format("datetime"))),
        F.concat(F.lit("Price: "), _py_text(F.col("close"))),
        F.concat(F.lit("SMA_Signal: "), _py_text(F.col("sma_signal"))),
        F.concat(F.lit("Sentiment_Signal: "), _py_text(F.col("sentiment_signal"))),
        F.concat(F.lit("combined_Signal: "), _py_text(F.col("combined_signal"))),
    )
    return df.select("symbol", "datetime", card.alias("card"))


def signal_document(df: DataFrame, arrival: str = "kafka_timestamp") -> DataFrame:
    """Typed combined signal -> stored document (P14): ISO timestamps, document field names."""
    out = df.withColumn("kafka_datetime", iso_format(F.col(arrival).cast("timestamp_ntz")))
    out = out.withColumn("datetime", iso_format(F.col("datetime").cast("timestamp_ntz")))
    return out.select(*DOCUMENT_COLUMNS)


def session_start(as_of, hour: int = 9, minute: int = 30) -> _dt.datetime:
    """Start of the trading session on ``as_of``'s date (default 09:30)."""
    d = as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of)[:10])
    return _dt.datetime(d.year, d.month, d.day, hour, minute)


def chart_series(df: DataFrame, start, key: str = "symbol", ts: str = "datetime") -> DataFrame:
    """Chart data (F7 A5 P15): signals since ``start``, with the window's mean close and its label.

    ``df`` is the stored signal table, whose ``day`` partitions before ``start`` are pruned; text
    times of stored documents are read as timestamps. The mean is a per-symbol aggregate, stored
    and joined back as a side.
    """
    if dict(df.dtypes)[ts] == "string":
        df = df.withColumn(ts, F.try_to_timestamp(F.col(ts)).cast("timestamp_ntz"))
    win = df.filter(F.col(ts) >= ts_lit(start, df.schema[ts].dataType))
    if "day" in df.columns:
        win = win.filter(F.col("day") >= ts_lit(start, "timestamp_ntz").cast("date"))
    # the mean of exact decimals does not depend on the order of the rows
    mean = F.avg(F.col("close").try_cast("decimal(30,10)")).cast("double")
    means = stored(win.groupBy(key).agg(mean.alias("avg_close")), "chart-means")
    out = join_side(win, means, [key])
    return out.select(key, ts, "open", "high", "low", "close", "avg_close",
                      F.format_string("Average Price: $%.2f", F.col("avg_close")).alias("avg_label"))
