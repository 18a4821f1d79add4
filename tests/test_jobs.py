"""Batch jobs not covered by a registered query on their own: B2 and B4."""

import pytest
import datetime as dt

from pyspark.sql import functions as F

from tickflow.plans import jobs as J
from tickflow.sources import schemas as SC


def test_update_daily_takes_latest_point(spark):
    existing = spark.createDataFrame([("A", dt.date(2024, 1, 2), 1.0, 10), ("A", dt.date(2024, 1, 3), 2.0, 20)],
                                     "symbol string, date date, close_price double, volume bigint")
    pts = [{"datetime": d, "open": c, "high": c, "low": c, "close": c, "volume": "5"}
           for d, c in (("2024-01-03", "2.5"), ("2024-01-04", "3.0"))]
    payloads = spark.createDataFrame([("A", pts)], SC.API_PAYLOAD)
    got = sorted((r.date.day, r.close_price, r.volume) for r in J.update_daily(existing, payloads).collect())
    # only the latest point (01-04) is the daily update; 01-03 keeps its stored bar
    assert got == [(2, 1.0, 10), (3, 2.0, 20), (4, 3.0, 5)]


def _news(spark, rows):
    schema = ("symbol string, title string, publishedAt timestamp, description string, url string, "
              "source_name string, content string, timestamp timestamp")
    return spark.createDataFrame(rows, schema)


def test_enrich_news_incremental_and_empty_partition(spark):
    day = dt.datetime(2024, 1, 5)
    t = [day + dt.timedelta(hours=h) for h in (1, 2, 3)]
    news = _news(spark, [("A", "t", t[0], "", f"u{i}", "s", "good day", t[i]) for i in range(3)])
    lex = spark.createDataFrame([("good", 0.5)], "term string, polarity double")
    mods = spark.createDataFrame([], "term string, factor double")
    # nothing enriched yet: everything after midnight is scored
    first = J.enrich_news(news, None, day, lex, mods)
    assert first.count() == 3 and {r.sentiment_score for r in first.collect()} == {0.5}
    assert {(r.year, r.month, r.day) for r in first.collect()} == {(2024, 1, 5)}
    # an empty enriched partition falls back to midnight instead of dropping everything
    empty = first.filter(F.lit(False))
    assert J.enrich_news(news, empty, day, lex, mods).count() == 3
    # rows up to the enriched maximum are skipped (strictly newer only)
    done = first.filter(F.col("timestamp") <= t[1])
    again = J.enrich_news(news, done, day, lex, mods).collect()
    assert [r.url for r in again] == ["u2"]


def test_day_sentiment_and_combined(spark):
    rows = [("A", 0.5, dt.datetime(2024, 1, 5, 9)), ("A", 0.4, dt.datetime(2024, 1, 5, 10)),
            ("B", -0.5, dt.datetime(2024, 1, 5, 9))]
    enriched = spark.createDataFrame(rows, "symbol string, sentiment_score float, timestamp timestamp")
    sent = {r.symbol: r.sentiment_signal for r in J.day_sentiment(enriched).collect()}
    assert sent == {"A": "buy", "B": "sell"}
    sma = spark.createDataFrame([("A", dt.datetime(2024, 1, 5, 15), "strong_buy"),
                                 ("B", dt.datetime(2024, 1, 5, 15), "buy"),
                                 ("A", dt.datetime(2024, 1, 6, 15), "sell")],
                                "symbol string, datetime timestamp, signal string")
    got = {(r.symbol, r.datetime.day): (r.sentiment_signal, r.combined_signal)
           for r in J.combined_signals(sma, J.day_sentiment(enriched)).collect()}
    assert got == {("A", 5): ("buy", "strong_buy"), ("B", 5): ("sell", "hold"), ("A", 6): (None, "sell")}


def test_text_start_becomes_kafka_milliseconds():
    from tickflow.sources.topics import _millis
    assert _millis("2024-01-25 08:00:00.000000") == 1706169600000 == _millis("1706169600000")


def test_marks_hide_no_failure_but_a_missing_table(spark, tmp_path):
    from tickflow.operators import incremental as I
    assert I.load_marks(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception):
        I.load_marks(spark, "nosuchfs://host/marks").count()


def test_fractional_volume_is_kept(spark):
    from tickflow.operators import bars as B
    rows = [("a", "2024-01-02", "1.5", "1234.0"), ("a", "2024-01-03", "1.5", "x")]
    got = B.typed_bars(spark.createDataFrame(rows, "symbol string, date string, close_price string, volume string")).collect()
    assert [r.volume for r in got] == [1234, None]
