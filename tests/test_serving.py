"""Serving from stored signals: total order, text documents, day bounds."""

import datetime as dt

from pyspark.sql import functions as F

from tickflow.operators import serving as SV


def _rows(spark, times, cast="timestamp"):
    rows = [(s, t, float(c)) for s, t, c in times]
    df = spark.createDataFrame(rows, "symbol string, datetime timestamp, close double")
    df = df.withColumns({c: F.col("close") for c in ("open", "high", "low")})
    return df if cast == "timestamp" else df.withColumn("datetime", F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss"))


def test_latest_signals_of_one_time_are_always_the_same(spark):
    t = dt.datetime(2024, 1, 1, 10)
    df = _rows(spark, [("A", t, c) for c in range(9)])
    for n in (1, 3, 7):
        assert [r.close for r in SV.latest_signals(df.repartition(n), 3).collect()] == [8.0, 7.0, 6.0]


def test_chart_series_over_text_times_equals_typed(spark):
    times = [("A", dt.datetime(2024, 1, 29, h), h) for h in range(4, 16)] + [("B", dt.datetime(2024, 1, 28, 12), 5)]
    start = SV.session_start("2024-01-29")
    got = [sorted((r.symbol, r.close, r.avg_close) for r in SV.chart_series(_rows(spark, times, c), start).collect()) for c in ("timestamp", "text")]
    assert got[0] == got[1] and len(got[0]) == 6 and got[0][0][2] == 12.5
