"""F1, F2, F5, A4 and the ingest marks."""

import datetime as dt

from tickflow.operators import incremental as I


def test_news_window_branches(spark):
    as_of = dt.datetime(2024, 3, 10, 12, 0)
    marks = spark.createDataFrame(
        [("none", None), ("old", dt.datetime(2024, 3, 9, 11, 0)), ("new", dt.datetime(2024, 3, 9, 13, 0)),
         ("edge", dt.datetime(2024, 3, 9, 12, 0))],
        "symbol string, last_published_at timestamp_ntz")
    got = {r.symbol: r.window_from for r in I.news_window(marks, as_of).collect()}
    midnight = dt.datetime(2024, 3, 9)
    assert got == {"none": midnight, "old": midnight, "edge": midnight,
                   "new": dt.datetime(2024, 3, 9, 13, 1)}


def test_newer_than_strict_and_default(spark):
    rows = spark.createDataFrame(
        [("A", dt.datetime(2024, 1, 1, 10)), ("A", dt.datetime(2024, 1, 1, 11)), ("B", dt.datetime(2024, 1, 1, 9))],
        "symbol string, timestamp timestamp_ntz")
    marks = I.high_watermark(rows.filter("timestamp < '2024-01-01 10:30:00'"))
    got = sorted((r.symbol, r.timestamp.hour) for r in I.newer_than(rows, marks).collect())
    assert got == [("A", 11)]          # equal to the mark is not newer
    empty = marks.filter("false")
    day = dt.datetime(2024, 1, 1, 9, 30)
    got = sorted((r.symbol, r.timestamp.hour) for r in I.newer_than(rows, empty, default=day).collect())
    assert got == [("A", 10), ("A", 11)]


def test_since_inclusive(spark):
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10),), (dt.datetime(2024, 1, 1, 9, 59, 59),)],
                                 "kafka_timestamp timestamp_ntz")
    assert I.since(rows, "kafka_timestamp", dt.datetime(2024, 1, 1, 10)).count() == 1


def test_marks_roundtrip(spark, tmp_path):
    path = str(tmp_path / "marks")
    assert I.load_marks(spark, path).count() == 0               # first run: no marks
    fetched = spark.createDataFrame([("A", dt.datetime(2024, 1, 1, 10)), ("A", dt.datetime(2024, 1, 1, 12))],
                                    "symbol string, publishedAt timestamp")
    I.save_marks(I.next_mark(fetched), path)
    got = I.load_marks(spark, path).collect()
    assert len(got) == 1 and got[0].last_published_at.hour == 12


def test_cutoffs_do_not_depend_on_driver_time_zone(spark):
    import os
    import time

    from tickflow.functions.timeutil import ts_text
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 25, 0, 0),), (dt.datetime(2024, 1, 24, 23, 59),)],
                                 "kafka_timestamp timestamp_ntz")
    old = os.environ.get("TZ")
    try:
        for zone in ("America/New_York", "Asia/Tokyo", "UTC"):
            os.environ["TZ"] = zone
            time.tzset()
            assert I.since(rows, "kafka_timestamp", dt.datetime(2024, 1, 25)).count() == 1, zone
    finally:
        if old is None:
            os.environ.pop("TZ", None)
        else:
            os.environ["TZ"] = old
        time.tzset()
    aware = dt.datetime(2024, 1, 25, 2, 0, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    assert ts_text(aware) == "2024-01-25 00:00:00"
