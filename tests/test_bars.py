"""Bars: payload unpacking, typing, session edges, upsert and resample ties."""

import datetime as dt

from pyspark.sql import functions as F

from tickflow.operators import bars as B
from tickflow.sources import schemas as SC
from tickflow.sources import tables as TB


def pt(d, c, v="10"):
    return {"datetime": d, "open": c, "high": c, "low": c, "close": c, "volume": v}


def test_from_api_payload_and_empty(spark):
    rows = [("A", [pt("2024-01-02", "1.5"), pt("2024-01-03", "bad", "3000000000")]), ("B", []), ("C", None)]
    df = spark.createDataFrame(rows, SC.API_PAYLOAD)
    got = sorted(B.from_api_payload(df).collect(), key=lambda r: r.date)
    assert [(r.symbol, r.date, r.close_price, r.volume) for r in got] == [
        ("A", dt.date(2024, 1, 2), 1.5, 10), ("A", dt.date(2024, 1, 3), None, 3000000000)]


def test_quotes_first_point_only(spark):
    rows = [("A", [pt("2024-01-02 10:01:00", "2"), pt("2024-01-02 10:00:00", "1")]), ("B", [])]
    df = spark.createDataFrame(rows, SC.API_PAYLOAD)
    got = B.typed_quotes(B.quotes_from_api_payload(df)).collect()
    assert len(got) == 1 and got[0].close == 2.0 and got[0].symbol == "A"


def test_in_session_edges(spark):
    # January: Israel is UTC+2, so 14:30:00 UTC is 16:30:00 local
    ts = [dt.datetime(2024, 1, 10, 14, 29, 59, 999999), dt.datetime(2024, 1, 10, 14, 30),
          dt.datetime(2024, 1, 10, 21, 0), dt.datetime(2024, 1, 10, 21, 0, 0, 1)]
    df = spark.createDataFrame([(t,) for t in ts], "datetime timestamp_ntz")
    kept = [r.datetime for r in B.in_session(df).collect()]
    assert kept == ts[1:3]


def test_merge_daily_new_wins_and_no_duplicates(spark):
    ex = spark.createDataFrame([("A", dt.date(2024, 1, 1), 1.0, 1), ("A", dt.date(2024, 1, 2), 2.0, 2)],
                               "symbol string, date date, close_price double, volume bigint")
    new = spark.createDataFrame([("A", dt.date(2024, 1, 2), 9.0, 9), ("A", dt.date(2024, 1, 3), 3.0, 3)],
                                "symbol string, date date, close_price double, volume bigint")
    once = B.merge_daily(ex, new)
    twice = B.merge_daily(once, new)   # re-running the update changes nothing
    for res in (once, twice):
        got = sorted((r.date.day, r.close_price, r.volume) for r in res.collect())
        assert got == [(1, 1.0, 1), (2, 9.0, 9), (3, 3.0, 3)]


def test_resample_tie_break(spark):
    t = dt.datetime(2024, 1, 1, 10, 0, 30)
    rows = [("A", t, 2, 5.0, 1.0), ("A", t, 1, 4.0, 1.0), ("A", t.replace(second=50), 3, 6.0, 2.0)]
    df = spark.createDataFrame(rows, "symbol string, datetime timestamp_ntz, event_id long, close double, volume double")
    bar = B.resample(df, "1 minute", tie="event_id").first()
    assert (bar.open, bar.high, bar.low, bar.close, bar.volume) == (4.0, 6.0, 4.0, 6.0, 4.0)


def test_latest_and_backfill(spark):
    rows = [("A", dt.date(2024, 1, d), float(d)) for d in range(1, 31)]
    df = spark.createDataFrame(rows, "symbol string, date date, close_price double")
    assert sorted(r.date.day for r in B.latest_bars(df, 3).collect()) == [28, 29, 30]
    got = sorted(r.date.day for r in B.backfill(df, 5, start="2024-01-03", end="2024-01-20").collect())
    assert got == [16, 17, 18, 19, 20]


def test_symbols_that_look_numeric_stay_text(spark, tmp_path):
    path, day = str(tmp_path / "bars"), dt.date(2024, 1, 2)
    df = spark.createDataFrame([("0700", day, 1.5, 10), ("0005", day, 2.5, 20)], "symbol string, date date, close_price double, volume bigint")
    TB.replace_bars(df, path)
    got = TB.read_table(spark, path)
    assert {f.name: f.dataType.simpleString() for f in got.schema} == {
        "symbol": "string", "date": "date", "close_price": "double", "volume": "bigint", "year": "int", "month": "int"}
    assert sorted((r.symbol, r.close_price, r.year) for r in got.collect()) == [("0005", 2.5, 2024), ("0700", 1.5, 2024)]
    assert got.filter("symbol = '0700'").count() == 1


def test_resample_orders_ties_by_a_text_column(spark):
    t = dt.datetime(2024, 1, 1, 10)
    df = spark.createDataFrame([("A", t, 1.0, "b"), ("A", t, 2.0, "a"), ("A", t, 3.0, "c")], "symbol string, datetime timestamp, close double, id string")
    r = B.resample(df, "1 day", volume=None, tie="id").first()
    assert (r.open, r.close) == (2.0, 3.0)


def test_merge_daily_winner_does_not_depend_on_partitions(spark):
    day = dt.date(2024, 1, 2)
    schema = "symbol string, date date, close_price double, volume bigint"
    new = spark.createDataFrame([("A", day, c, v) for c, v in ((1.5, 7), (2.5, 3), (2.5, 9), (None, 99))], schema)
    old = spark.createDataFrame([("A", day, 9.0, 9)], schema)
    got = {tuple(B.merge_daily(old, new.repartition(n)).first()) for n in (1, 2, 3, 7)}
    assert got == {("A", day, 2.5, 9)}
