"""Physical-plan shape: the properties the operators are designed for."""

import re

from pyspark.sql import functions as F

from tickflow.operators import incremental as I
from tickflow.operators import news as N
from tickflow.operators import serving as SV
from tickflow.operators import signals as SG
from tickflow.plans import fixtures as FX
from tickflow.plans import jobs as J
from tickflow.session import work_path
from tickflow.sources import schemas as SC
from tickflow.sources import tables as TB

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")  # no "..." in scans
    return df._jdf.queryExecution().executedPlan().toString()


def test_snapshot_windows_share_one_exchange_after_partial_topk(spark):
    p = plan(J.indicator_snapshot(FX.history_bars(spark, SF)))
    # the window part: partial top-30 -> one exchange on symbol -> final top-30 -> windows
    assert re.search(r"WindowGroupLimit \[symbol#\d+\].*Partial", p)
    assert re.search(r"WindowGroupLimit \[symbol#\d+\].*Final", p)
    assert len(re.findall(r"Exchange hashpartitioning\(symbol#\d+, \d+\)", p)) == 1


def test_live_cutoff_is_pushed_into_the_scan(spark):
    quotes = FX.ticks(spark, SF)
    p = plan(J.sma_signals(quotes, J.indicator_snapshot(FX.history_bars(spark, SF)), start=FX.LIVE_START))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,2024-01-25", p)


def test_day_read_prunes_partitions(spark):
    path = work_path(spark, "plan-news")
    n = FX.news(spark, SF).select(*J.NEWS_COLUMNS)
    TB.append_partitions(TB.with_date_parts(n, "timestamp", day=True), path, ["symbol", "year", "month", "day"])
    p = plan(TB.read_day(spark, path, "2024-01-25"))
    assert re.search(r"PartitionFilters: \[[^\]]*\(day#\d+ = 25\)", p)


def test_scans_read_only_used_columns(spark):
    p = plan(FX.long_bars(spark, SF).select("symbol", "close_price"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert "o_custkey" not in schema and "o_orderstatus" not in schema


def test_sentiment_scoring_moves_no_text(spark):
    from tickflow.operators import sentiment as SE
    d = FX.table(spark, SF, "documents")
    p = plan(SE.score(d, FX.lexicon(spark), FX.modifiers(spark), text="text").select("doc_id", "sentiment_score"))
    # the lexicon is broadcast; below the exchanges the text is only read and hashed
    assert "BroadcastHashJoin [tok" in p
    below = [re.sub(r"xxhash64\([^()]*\)", "", p[m.start():].split("\n")[1]) for m in re.finditer("Exchange hashpartitioning", p)]
    assert below and not [x for x in below if re.search(r"[\[ ]text#\d+[,\]]", x)]
    assert not re.search(r"CASE WHEN isnotnull\(text#", p)


def test_large_sides_are_joined_under_salts(spark):
    """With a threshold of one byte no quote and no article is exchanged on the symbol alone."""
    from tickflow.functions import sides
    quotes, snap = FX.ticks(spark, SF), J.indicator_snapshot(FX.history_bars(spark, SF))
    n = FX.news(spark, SF).select(*J.NEWS_COLUMNS)
    marks = I.high_watermark(n, "timestamp")
    made = {"j1": lambda: J.sma_signals(quotes, snap), "f2": lambda: I.newer_than(n, marks, "timestamp"),
            "j2": lambda: SG.attach_sentiment(quotes.withColumn("day", F.to_date("datetime")), sides.stored(FX.news(spark, SF).select(
                "symbol", F.to_date("timestamp").alias("day"), F.lit("buy").alias("sentiment_signal")).distinct())),
            "a5": lambda: SV.chart_series(quotes, "2024-01-01")}
    rows = lambda df: sorted(map(str, df.collect()))
    small = {k: (plan(f()), rows(f())) for k, f in made.items()}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
        large = {k: (plan(f()), rows(f())) for k, f in made.items()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    for k in made:
        assert "Exchange hashpartitioning" not in small[k][0] and "BroadcastHashJoin" in small[k][0], k
        assert "_salt#" in large[k][0] and not re.search(r"Exchange hashpartitioning\(symbol#\d+, \d+\)", large[k][0]), k
        assert small[k][1] == large[k][1], k


def test_daily_update_reads_only_touched_partitions(spark):
    path = work_path(spark, "plan-bars")
    TB.replace_bars(FX.long_bars(spark, SF), path)
    pts = [{"datetime": "1997-03-05", "open": "1", "high": "1", "low": "1", "close": "1", "volume": "5"}]
    p = plan(J.merged_months(spark, path, spark.createDataFrame([("1-URGENT", pts)], SC.API_PAYLOAD)))
    assert re.search(r"PartitionFilters: \[[^\n]*dynamicpruning", p)


def test_stored_signals_prune_days_and_news_window_is_pushed(spark):
    path = work_path(spark, "plan-signals")
    TB.signal_sink(path)(FX.ticks(spark, SF).withColumn("datetime", F.col("datetime").cast("timestamp")), 0)
    p = plan(SV.latest_signals(TB.read_signals(spark, path), 3, since="2024-01-29"))
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ >= 2024-01-29", p)
    news = work_path(spark, "plan-news")
    FX.news(spark, SF).select(*J.NEWS_COLUMNS).write.parquet(news)
    weights, languages = N.train_language_profiles(FX.table(spark, SF, "documents"))
    msgs, _ = J.prepare_news(spark.read.parquet(news), I.next_mark(FX.news(spark, SF)), "2024-01-25 20:00:00", weights, languages)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(publishedAt,2024-01-24", plan(msgs))
