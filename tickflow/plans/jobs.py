"""End-to-end batch jobs (B1-B8), each a composition of tickflow operators.

Every job handles all symbols in one plan. The driver gets single values only (a start time, the
number of languages), never rows. Side tables are stored before they are joined (``functions/sides.py``).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.functions.sides import join_side, stored
from tickflow.functions.timeutil import ts_lit
from tickflow.operators import bars as B
from tickflow.operators import incremental as I
from tickflow.operators import indicators as IND
from tickflow.operators import news as N
from tickflow.operators import sentiment as SE
from tickflow.operators import signals as SG
from tickflow.sources import schemas as SC
from tickflow.sources import tables as TB
from tickflow.sources import topics as TP

SMA_OUTPUT = ["symbol", "datetime", "open", "high", "low", "close", "volume",
              "short_term_avg", "long_term_avg", "short_above_long", "is_significant", "signal"]
NEWS_COLUMNS = ["symbol", "title", "publishedAt", "description", "url", "source_name", "content",
                "timestamp"]


# --------------------------------------------------------------------------- price path

def load_bars(spark: SparkSession, topic: dict, path: str, mode: str = "month") -> None:
    """B1: bar topic -> typed bars -> ``symbol/year/month`` table.

    ``mode="month"`` replaces the loaded months, ``"symbol"`` the whole history of the loaded symbols.
    """
    bars = B.typed_bars(TP.decode(TP.read_topic(spark, topic), SC.BAR_MESSAGE))
    {"month": TB.replace_bars, "symbol": TB.replace_symbols}[mode](bars, path)


MONTH = ["symbol", "year", "month"]


def update_daily(existing: DataFrame, payloads: DataFrame) -> DataFrame:
    """B2 without a write: the latest point of each daily payload upserted into the given bars."""
    new = B.latest_bars(B.from_api_payload(payloads), 1)
    return B.merge_daily(existing.select("symbol", "date", "close_price", "volume"), new)


def merged_months(spark: SparkSession, path: str, payloads: DataFrame) -> DataFrame:
    """The months that the latest points of ``payloads`` touch, each with its bars after the upsert.

    Only these ``(symbol, year, month)`` partitions of the table are read: the keys are joined on the
    partition columns (dynamic partition pruning).
    """
    new = TB.with_date_parts(B.latest_bars(B.from_api_payload(payloads), 1).filter(F.col("date").isNotNull()), "date")
    new = stored(new, "daily-points")
    touched = stored(new.select(*MONTH).distinct(), "touched-months")
    # the planner prunes partitions by a side with a comparison in it; every month passes this one
    old = join_side(TB.read_table(spark, path), touched.filter("month >= 1"), MONTH, "left_semi").filter(F.col("date").isNotNull())
    values = ["symbol", "date", "close_price", "volume"]
    return TB.with_date_parts(B.merge_daily(old.select(*values), new.select(*values)), "date")


def store_daily_update(spark: SparkSession, path: str, payloads: DataFrame) -> None:
    """B2: the latest point of each daily payload upserted into the stored bars.

    Read-modify-write of the touched months: they are staged whole, then replaced, so a failed run
    leaves the table as it was and a repeated run changes nothing. Other months are not touched.
    """
    TB.replace_partitions(stored(merged_months(spark, path, payloads), "daily-update"), path, MONTH)


def indicator_snapshot(bars: DataFrame, lookback: int | None = 30, short: int = IND.SHORT,
                       long: int = IND.LONG, threshold: float = IND.THRESHOLD,
                       order: str = "date", price: str = "close_price") -> DataFrame:
    """Last ``lookback`` bars -> SMAs -> crossover -> latest row -> snapshot per symbol."""
    ind = IND.indicators(bars, short, long, order=order, price=price, lookback=lookback)
    return IND.snapshot(ind, order=order, threshold=threshold)


def sma_signals(quotes: DataFrame, snap: DataFrame, start=None, arrival: str = "datetime") -> DataFrame:
    """S1 as a batch: quotes since ``start`` (F1) + snapshot (J1) -> SMA signal."""
    q = I.since(quotes, arrival, start) if start is not None else quotes
    joined = SG.attach_snapshot(q, stored(snap, "snapshot"))
    return joined.withColumn("signal", SG.sma_signal()).select(*SMA_OUTPUT)


# --------------------------------------------------------------------------- news path

def prepare_news(articles: DataFrame, marks: DataFrame, as_of, weights: DataFrame,
                 languages: DataFrame):
    """Fetch window (F5) -> new mark (A4) -> language (F4) -> dedupe (W4) -> clean.

    Returns ``(messages, next_marks)``. The new mark is taken over every
    fetched article, skipped ones included. No window starts before the day before ``as_of``, so that
    bound goes to the scan as a literal; symbols without a mark start there. Titles are
    de-duplicated and their language is detected on thin rows, then the bodies of the
    survivors are fetched once.
    """
    earliest = F.date_sub(F.to_date(ts_lit(as_of)), 1).cast("timestamp_ntz")
    recent = articles.filter(F.col("publishedAt") >= earliest.cast(articles.schema["publishedAt"].dataType))
    windows = stored(I.news_window(marks, as_of).select("symbol", F.col("window_from").alias("_from")), "windows")
    fetched = (join_side(recent, windows, ["symbol"], "left")
               .filter(F.col("publishedAt").cast("timestamp_ntz") >= F.coalesce("_from", earliest)).drop("_from"))
    nxt = I.next_mark(fetched)
    # The language is a function of the lower-cased title, which is also the
    # dedupe key: all copies of a title share one language, so de-duplicating
    # before detecting keeps exactly the same survivors (language-then-dedupe
    # order of the original) while detecting - and shuffling - fewer articles.
    english = N.keep_language(N.detect_language(N.first_titles(fetched), weights, languages))
    return N.normalize(N.fetch_rows(fetched, english)), nxt


def load_news(spark: SparkSession, topic: dict, path: str, stored: DataFrame | None = None,
              symbols: list[str] | None = None) -> bool:
    """News topic -> rows newer than the stored per-symbol maximum -> day partitions.

    ``stored`` is the current table (None on a first run). Returns False when
    there was nothing new to append. The topic is read from the oldest stored
    maximum on only when all ``symbols`` asked for have one; a symbol without stored
    rows needs the topic from its start.
    """
    since = None
    marks = None
    if stored is not None:
        marks = I.high_watermark(stored, "timestamp")
        # start offset (IO4): the oldest per-symbol maximum, one value; the strict
        # per-symbol filter below removes what is read twice
        if symbols:
            oldest = marks.filter(F.col("symbol").isin(symbols)).agg(
                F.count(F.lit(1)).alias("n"), F.date_format(F.min("max_timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("since")).first()
            since = oldest["since"] if oldest["n"] == len(set(symbols)) else None
    msgs = TP.decode(TP.read_topic(spark, topic, since), SC.NEWS_MESSAGE, keep_ts="timestamp")
    new = I.newer_than(msgs, marks, "timestamp") if marks is not None else msgs
    out = TB.with_date_parts(new.select(*NEWS_COLUMNS), "timestamp", day=True)
    return TB.append_partitions(out, path, ["symbol", "year", "month", "day"])


DAY = ["symbol", "year", "month", "day"]


def _row_key(df: DataFrame) -> DataFrame:
    """``row_key``: a 128-bit hash of the news columns."""
    if "row_key" in df.columns:
        return df
    return df.withColumn("row_key", F.concat_ws(":", *[F.hex(F.xxhash64(F.lit(k), *NEWS_COLUMNS)) for k in (0, 1)]))


def enrich_news(news_day: DataFrame, enriched_day: DataFrame | None, day_start, lexicon: DataFrame,
                modifiers: DataFrame) -> DataFrame:
    """One day's news that is not enriched yet, scored (U1), with date parts and ``row_key``.

    Rows are told apart by a hash of their columns, not by the largest time seen, so an article
    that arrives late is not lost and one that arrives twice is not repeated. An empty or absent
    enriched partition leaves all rows from ``day_start`` on.
    """
    new = _row_key(news_day.select(*NEWS_COLUMNS).filter(F.col("timestamp") >= ts_lit(day_start, news_day.schema["timestamp"].dataType)))
    if enriched_day is not None:
        known = stored(_row_key(enriched_day).select("row_key").distinct(), "known-rows")
        new = join_side(new, known, ["row_key"], "left_anti")
    scored = SE.score(new.dropDuplicates(["row_key"]), lexicon, modifiers)
    return TB.with_date_parts(scored, "timestamp", day=True)


def append_enriched(spark: SparkSession, news_path: str, enriched_path: str, day, run: str, lexicon: DataFrame,
                    modifiers: DataFrame) -> bool:
    """B4 with its write: exactly once per day and ``run``. Returns whether there was anything new.

    The enriched table is partitioned by day and run, and a run replaces its own partitions; what other
    runs have enriched is left out. So a run repeated after a failure, or after success, leaves one copy.
    """
    try:
        known = TB.read_day(spark, enriched_path, day).filter(F.col("run").cast("string") != run)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # a first run
            raise
        known = None
    fresh = enrich_news(TB.read_day(spark, news_path, day), known, day, lexicon, modifiers).withColumn("run", F.lit(run))
    staged = stored(fresh, "enriched")
    if staged.isEmpty():
        return False
    TB.replace_partitions(staged, enriched_path, [*DAY, "run"])
    return True


def day_sentiment(enriched: DataFrame, strong_first: bool = False) -> DataFrame:
    """Sentiment aggregate (A1) and signal (C2) per symbol and arrival day."""
    e = enriched.withColumn("day", F.to_date("timestamp"))
    agg = SE.aggregate(e, keys=("symbol", "day"))
    return agg.withColumn("sentiment_signal", SG.sentiment_signal(strong_first=strong_first))


def combined_signals(sma: DataFrame, sentiment: DataFrame) -> DataFrame:
    """S2 as a batch: SMA signals + that day's sentiment (J2) -> combined signal."""
    s = sma.withColumnRenamed("signal", "sma_signal").withColumn("day", F.to_date("datetime"))
    joined = SG.attach_sentiment(s, stored(sentiment.select("symbol", "day", "sentiment_signal"), "day-sentiment"))
    return joined.withColumn("combined_signal", SG.combined_signal()).drop("day")
