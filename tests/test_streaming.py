"""Streaming: sink restart without loss or duplicates; S5 on closed windows; S6 dedupe."""

import datetime as dt

from pyspark.sql import functions as F

from tickflow.operators import serving as SV
from tickflow.session import work_path
from tickflow.sources import schemas as SC
from tickflow.sources import tables as TB
from tickflow.sources import topics as TP
from tickflow.streaming import jobs as SJ


def _combined_rows(spark, start, n):
    rows = []
    for i in range(n):
        t = start + dt.timedelta(minutes=i)
        rows.append(("A" if i % 2 else "B", t, 1.0, 2.0, 0.5, 1.5 + i, 10.0, 1.2, 1.1, True, False,
                     "buy", "hold" if i % 3 else None, "buy"))
    schema = ("symbol string, datetime timestamp_ntz, open double, high double, low double, close double, "
              "volume double, short_term_avg double, long_term_avg double, short_above_long boolean, "
              "is_significant boolean, sma_signal string, sentiment_signal string, combined_signal string")
    return spark.createDataFrame(rows, schema)


def test_signal_sink_restart_no_loss_no_duplicates(spark):
    topic = {"format": "file", "path": work_path(spark, "t-combined")}
    out, ckpt = work_path(spark, "t-docs"), work_path(spark, "t-ckpt")
    first = _combined_rows(spark, dt.datetime(2024, 1, 1, 10), 50)
    TP.write_topic(TP.encode(first, "symbol", timestamp="datetime"), topic)
    SJ.stream_signal_sink(spark, topic, out, ckpt, wait=True)
    # the job stops; new records arrive; it restarts on the same checkpoint
    second = _combined_rows(spark, dt.datetime(2024, 1, 2, 10), 30)
    TP.write_topic(TP.encode(second, "symbol", timestamp="datetime"), topic)
    SJ.stream_signal_sink(spark, topic, out, ckpt, wait=True)
    SJ.stream_signal_sink(spark, topic, out, ckpt, wait=True)     # nothing new: no-op
    rest = TB.read_signals(spark, out)
    assert dict(rest.dtypes)["datetime"] == "timestamp" and dict(rest.dtypes)["day"] == "date"
    docs = SV.signal_document(rest)
    assert docs.count() == 80
    assert docs.select("datetime").distinct().count() == 80
    r = docs.filter(F.col("datetime") == "2024-01-01T10:01:00").first()
    assert r.kafka_datetime == "2024-01-01T10:01:00" and r.short_above_long is True and r.sentiment_signal == "hold"


def test_decode_malformed_is_null(spark):
    df = spark.createDataFrame([(b"k", b"{not json", dt.datetime(2024, 1, 1))], SC.TOPIC)
    r = TP.decode(df, SC.QUOTE_MESSAGE).first()
    assert r.symbol is None and r.close is None


def test_stream_dedupe_within_watermark(spark):
    src = work_path(spark, "t-news")
    t0 = dt.datetime(2024, 1, 1, 10)
    rows = [("A", "Hello", t0), ("A", "hello", t0 + dt.timedelta(minutes=5)), ("B", "hello", t0),
            ("A", "other", t0)]
    spark.createDataFrame(rows, "symbol string, title string, publishedAt timestamp").write.parquet(src)
    stream = spark.readStream.schema("symbol string, title string, publishedAt timestamp").parquet(src)
    out, ckpt = work_path(spark, "t-news-out"), work_path(spark, "t-news-ckpt")
    q = (SJ.dedupe_stream(stream).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.symbol, r.title_key) for r in spark.read.parquet(out).collect())
    assert got == [("A", "hello"), ("A", "other"), ("B", "hello")]


def test_stream_dedupe_by_arrival_over_several_batches(spark):
    """Articles arrive in another order than they were published; no title is lost to the watermark."""
    src, t0 = work_path(spark, "t-news-arrival"), dt.datetime(2024, 1, 1)
    schema = "symbol string, title string, publishedAt timestamp, timestamp timestamp"
    for batch in range(6):
        rows = [("A", f"Title {(batch * 7 + i) % 20}", t0 + dt.timedelta(days=(i * 37 + batch * 11) % 60), t0 + dt.timedelta(hours=2 * batch)) for i in range(12)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = work_path(spark, "t-news-arrival-out")
    q = (SJ.dedupe_stream(stream).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", work_path(spark, "t-news-arrival-ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 6
    assert sorted(r.title_key for r in spark.read.parquet(out).collect()) == sorted(f"title {i}" for i in range(20))


def _quotes(spark, topic, day, closes):
    rows = [(s, dt.datetime(2024, 1, day, 10, i), str(c)) for i, (s, c) in enumerate(closes)]
    q = spark.createDataFrame(rows, "symbol string, datetime timestamp_ntz, close string")
    q = q.selectExpr("symbol", "cast(datetime as string) as datetime", "close as open", "close as high", "close as low", "close", "'1' as volume", "datetime as at")
    TP.write_topic(TP.encode(q, "symbol", timestamp="at", value_cols=SC.QUOTE_FIELDS), topic)


def _snapshot(spark, level):
    return spark.createDataFrame([("A", level, level - 1, True, "hold", True)],
                                 "symbol string, short_term_avg double, long_term_avg double, short_above_long boolean, position string, is_significant boolean")


def test_sides_are_read_anew_for_each_batch_and_a_replay_replaces_itself(spark):
    topic, out = ({"format": "file", "path": work_path(spark, n)} for n in ("t-quotes", "t-sma"))
    ckpt, side = work_path(spark, "t-ckpt"), []
    for day, level in ((1, 5.0), (2, 20.0), (3, 1.0)):
        _quotes(spark, topic, day, [("A", 10.0), ("Z", 10.0)])
        side.append(_snapshot(spark, level))
        SJ.stream_sma_signals(spark, topic, out, None, ckpt, wait=True, starting="earliest", refresh=lambda: side[-1])
    read = lambda: sorted((r.datetime[:10], r.signal) for r in TP.decode(TP.read_topic(spark, out), SC.SMA_SIGNAL_MESSAGE).collect())
    assert read() == [("2024-01-01", "strong_buy"), ("2024-01-02", "hold"), ("2024-01-03", "strong_buy")]
    again = TP.encode(spark.createDataFrame([("A", "x")], "symbol string, signal string"), timestamp=F.lit("2024-01-09").cast("timestamp"))
    for _ in range(2):
        TP.write_batch(again, out, 2)
    assert [r.signal for r in TP.decode(TP.read_topic(spark, out), SC.SMA_SIGNAL_MESSAGE).collect()].count("x") == 1


def test_stream_starts(spark):
    topic = {"format": "file", "path": work_path(spark, "t-starts")}
    _quotes(spark, topic, 1, [("A", 1.0)])
    _quotes(spark, topic, 2, [("A", 2.0)])

    def run(starting, more=False):
        out = {"format": "file", "path": work_path(spark, "t-starts-out")}
        stream = TP.stream_topic(spark, topic, starting)
        if more:
            _quotes(spark, topic, 3, [("A", 3.0)])
        TP.stream_to_topic(stream, out, work_path(spark, "t-starts-ckpt"), {"availableNow": True}).awaitTermination()
        return sorted(r.close for r in TP.decode(TP.read_topic(spark, out), SC.QUOTE_MESSAGE).collect())
    assert run("earliest") == ["1.0", "2.0"]
    assert run(dt.datetime(2024, 1, 2)) == ["2.0"]
    assert run("latest", more=True) == ["3.0"]


def test_compaction_bounds_the_files(spark):
    path, out = work_path(spark, "t-signals"), work_path(spark, "t-compact")
    for run in range(3):
        for batch in range(4):
            TB.signal_sink(path, run_id=lambda: f"run-{run}")(_combined_rows(spark, dt.datetime(2024, 1, 1 + batch % 2, 10), 5), batch)
    TB.compact_signals(spark, path, out)
    rows = lambda p: sorted(map(str, TB.read_signals(spark, p).collect()))
    assert rows(path) == rows(out) and len(rows(out)) == 60
    assert len(spark.read.parquet(out).inputFiles()) <= 4 < len(spark.read.parquet(path).inputFiles())
