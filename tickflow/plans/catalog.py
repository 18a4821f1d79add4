"""Registered queries and their DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs a tickflow operator or job on
the driver's tables (derived as in ``tickflow.plans.fixtures``);
``ORACLE[name]`` is the same result written independently in SQL over the
pre-registered views. Floating results are rounded to 4 decimals on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.operators import bars as B
from tickflow.operators import indicators as IND
from tickflow.plans import fixtures as FX
from tickflow.plans import jobs as J

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --------------------------------------------------------------------------- shared SQL

SQL_TICKS = """ticks AS (
    SELECT 'src' || CAST(user_id % 20 AS VARCHAR) AS symbol, ts AS datetime, event_id,
           value AS close
    FROM events)"""

def sql_history(before: str) -> str:
    return f"""history AS (
    SELECT symbol, date_trunc('day', datetime) AS date,
           arg_max(close, {{'t': datetime, 'e': event_id}}) AS close_price
    FROM ticks WHERE datetime < TIMESTAMP '{before}'
    GROUP BY 1, 2)"""


SQL_HISTORY = sql_history("2024-01-25")

SQL_LONG_BARS = """long_bars AS (
    SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date,
           arg_max(o_totalprice, o_orderkey) AS close_price, count(*) AS volume
    FROM orders GROUP BY 1, 2)"""


def sql_indicators(src: str, lookback: int | None) -> str:
    """Indicator CTEs over ``src(symbol, date, close_price)``; averages on exact decimals."""
    limit = (f"QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= {lookback}"
             if lookback else "")
    return f"""ind_base AS (SELECT symbol, date, close_price FROM {src} {limit}),
ind_sma AS (
    SELECT symbol, date, close_price,
           avg(CAST(close_price AS DECIMAL(18,2))) OVER (PARTITION BY symbol ORDER BY date
               ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS sma_short,
           avg(CAST(close_price AS DECIMAL(18,2))) OVER (PARTITION BY symbol ORDER BY date
               ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS sma_long
    FROM ind_base),
ind_flag AS (SELECT *, CASE WHEN sma_short > sma_long THEN 1 ELSE 0 END AS short_above_long FROM ind_sma),
ind AS (SELECT *, short_above_long - lag(short_above_long) OVER (PARTITION BY symbol ORDER BY date)
               AS position FROM ind_flag)"""


SQL_SNAPSHOT = """snap AS (
    SELECT symbol, sma_short AS short_term_avg, sma_long AS long_term_avg,
           short_above_long = 1 AS short_above_long,
           CASE WHEN position = 1 THEN 'buy' WHEN position = -1 THEN 'sell' ELSE 'hold' END AS position,
           coalesce(abs(sma_short - sma_long) / nullif(sma_long, 0) > 0.03, false) AS is_significant
    FROM ind QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1)"""

def sql_sma_signal_case(c="close", s="short_term_avg", l="long_term_avg", a="short_above_long",
                        g="is_significant", p="position") -> str:
    """The C1 rule as one SQL CASE over the named columns."""
    return f"""CASE
    WHEN {a} IS NULL OR {g} IS NULL THEN NULL
    WHEN {a} AND {g} AND {c} > {s} THEN 'strong_buy'
    WHEN {a} AND {g} THEN 'hold'
    WHEN {a} AND {c} > {s} AND {p} = 'buy' THEN 'strong_buy'
    WHEN {a} AND {c} > {s} AND {p} <> 'buy' THEN 'buy'
    WHEN {a} AND {c} < {l} AND {p} <> 'buy' THEN 'sell'
    WHEN {a} THEN 'hold'
    WHEN {g} AND {c} < {s} THEN 'strong_sell'
    WHEN {g} THEN 'hold'
    WHEN {c} < {s} AND {p} = 'sell' THEN 'strong_sell'
    WHEN {c} < {s} AND {p} <> 'sell' THEN 'sell'
    WHEN {c} > {l} AND {p} <> 'sell' THEN 'buy'
    ELSE 'hold' END"""


def sql_sma_signals(where: str) -> str:
    return f"""sma_signals AS (
    SELECT symbol, datetime, open, high, low, close, volume, short_term_avg, long_term_avg,
           short_above_long, is_significant, {sql_sma_signal_case()} AS signal
    FROM (SELECT q.symbol, q.datetime, q.close AS open, q.close AS high, q.close AS low, q.close,
                 1.0 AS volume, sn.short_term_avg, sn.long_term_avg, sn.short_above_long,
                 sn.is_significant, sn.position
          FROM ticks q JOIN snap sn USING (symbol)
          WHERE {where}))"""


SQL_SMA_SIGNALS = sql_sma_signals("q.datetime >= TIMESTAMP '2024-01-25'")


# --------------------------------------------------------------------------- price queries

def _sma_signal_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    snap = J.indicator_snapshot(FX.history_bars(spark, sf_dir), lookback=30)
    quotes = FX.ticks(spark, sf_dir)
    return J.sma_signals(quotes, snap, start=FX.LIVE_START)


@register("sma_signal", f"""WITH {SQL_TICKS}, {SQL_HISTORY}, {sql_indicators('history', 30)},
{SQL_SNAPSHOT}, {SQL_SMA_SIGNALS}
SELECT symbol, datetime, open, high, low, close, volume,
       round(short_term_avg, 4) AS short_term_avg, round(long_term_avg, 4) AS long_term_avg,
       short_above_long, is_significant, signal
FROM sma_signals""")
def q_sma_signal(spark, sf_dir):
    return FX.rounded(_sma_signal_frame(spark, sf_dir), ["short_term_avg", "long_term_avg"])


@register("bars_resample_daily", f"""WITH {SQL_TICKS}
SELECT symbol, date_trunc('day', datetime) AS bar_start,
       date_trunc('day', datetime) + INTERVAL 1 DAY AS bar_end,
       arg_min(close, {{'t': datetime, 'e': event_id}}) AS open, max(close) AS high,
       min(close) AS low, arg_max(close, {{'t': datetime, 'e': event_id}}) AS close,
       CAST(count(*) AS DOUBLE) AS volume
FROM ticks GROUP BY 1, 2, 3""")
def q_bars_resample_daily(spark, sf_dir):
    return B.resample(FX.ticks(spark, sf_dir), "1 day", ts="datetime", price="close",
                      volume="volume", tie="event_id")


@register("bars_resample_minute", f"""WITH {SQL_TICKS}
SELECT symbol, date_trunc('minute', datetime) AS bar_start,
       date_trunc('minute', datetime) + INTERVAL 1 MINUTE AS bar_end,
       arg_min(close, {{'t': datetime, 'e': event_id}}) AS open, max(close) AS high,
       min(close) AS low, arg_max(close, {{'t': datetime, 'e': event_id}}) AS close,
       CAST(count(*) AS DOUBLE) AS volume
FROM ticks GROUP BY 1, 2, 3""")
def q_bars_resample_minute(spark, sf_dir):
    return B.resample(FX.ticks(spark, sf_dir), "1 minute", ts="datetime", price="close",
                      volume="volume", tie="event_id")


@register("indicator_snapshot", f"""WITH {SQL_TICKS}, {SQL_HISTORY}, {sql_indicators('history', 30)},
{SQL_SNAPSHOT}
SELECT symbol, round(short_term_avg, 4) AS short_term_avg, round(long_term_avg, 4) AS long_term_avg,
       short_above_long, position, is_significant
FROM snap""")
def q_indicator_snapshot(spark, sf_dir):
    snap = J.indicator_snapshot(FX.history_bars(spark, sf_dir), lookback=30)
    return FX.rounded(snap, ["short_term_avg", "long_term_avg"])


@register("sma_short_long", f"""WITH {SQL_LONG_BARS}, {sql_indicators('long_bars', None)}
SELECT symbol, CAST(date AS TIMESTAMP) AS date, close_price, round(sma_short, 4) AS sma_short,
       round(sma_long, 4) AS sma_long
FROM ind""")
def q_sma_short_long(spark, sf_dir):
    ind = IND.indicators(FX.long_bars(spark, sf_dir), block="year")
    return FX.comparable(FX.rounded(ind.select("symbol", "date", "close_price", "sma_short", "sma_long"),
                                    ["sma_short", "sma_long"]))


@register("sma_crossover", f"""WITH {SQL_LONG_BARS}, {sql_indicators('long_bars', None)}
SELECT symbol, CAST(date AS TIMESTAMP) AS date, CAST(short_above_long AS BIGINT) AS short_above_long,
       CAST(position AS DOUBLE) AS position
FROM ind""")
def q_sma_crossover(spark, sf_dir):
    ind = IND.indicators(FX.long_bars(spark, sf_dir), block="year")
    return FX.comparable(ind.select("symbol", "date", "short_above_long",
                                    F.col("position").cast("double").alias("position")))


# --------------------------------------------------------------------------- payloads, envelopes, tables

def _daily_payloads(bars: DataFrame) -> DataFrame:
    """Daily bars as API payloads, one per symbol and month (ascending points)."""
    point = F.struct(
        F.col("date").cast("string").alias("datetime"),
        F.col("close_price").cast("string").alias("open"),
        F.col("close_price").cast("string").alias("high"),
        F.col("close_price").cast("string").alias("low"),
        F.col("close_price").cast("string").alias("close"),
        F.col("volume").cast("string").alias("volume"))
    return (bars.groupBy("symbol", F.date_trunc("month", F.col("date").cast("timestamp_ntz")).alias("m"))
            .agg(F.sort_array(F.collect_list(point)).alias("values")).drop("m"))


def _status_f_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revised daily bars: the same derivation over finished orders only."""
    o = FX.table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return (o.groupBy(F.col("o_orderpriority").alias("symbol"),
                      F.col("o_orderdate").cast("date").alias("date"))
            .agg(F.max_by("o_totalprice", "o_orderkey").alias("close_price"),
                 F.count(F.lit(1)).alias("volume")))


SQL_LONG_BARS_TS = f"""{SQL_LONG_BARS}
SELECT symbol, CAST(date AS TIMESTAMP) AS date, close_price, volume FROM long_bars"""

SQL_STATUS_F = """upd AS (
    SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date,
           arg_max(o_totalprice, o_orderkey) AS close_price, count(*) AS volume
    FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)"""


@register("bars_from_payload", f"WITH {SQL_LONG_BARS_TS}")
def q_bars_from_payload(spark, sf_dir):
    return FX.comparable(B.from_api_payload(_daily_payloads(FX.long_bars(spark, sf_dir))))


@register("quotes_from_payload", f"""WITH {SQL_TICKS},
mb AS (
    SELECT symbol, date_trunc('minute', datetime) AS bar_start,
           arg_min(close, {{'t': datetime, 'e': event_id}}) AS open, max(close) AS high,
           min(close) AS low, arg_max(close, {{'t': datetime, 'e': event_id}}) AS close,
           CAST(count(*) AS DOUBLE) AS volume
    FROM ticks GROUP BY 1, 2)
SELECT symbol, bar_start AS datetime, open, high, low, close, volume FROM mb
QUALIFY row_number() OVER (PARTITION BY symbol, date_trunc('hour', bar_start) ORDER BY bar_start DESC) = 1""")
def q_quotes_from_payload(spark, sf_dir):
    mb = B.resample(FX.ticks(spark, sf_dir), "1 minute", ts="datetime", price="close",
                    volume="volume", tie="event_id")
    point = F.struct(
        F.date_format("bar_start", "yyyy-MM-dd HH:mm:ss").alias("datetime"),
        *[F.col(c).cast("string").alias(c) for c in ("open", "high", "low", "close", "volume")])
    # one payload per symbol and hour, newest point first (as the API returns it)
    payloads = (mb.groupBy("symbol", F.date_trunc("hour", "bar_start").alias("h"))
                .agg(F.sort_array(F.collect_list(point), asc=False).alias("values")).drop("h"))
    return FX.comparable(B.typed_quotes(B.quotes_from_api_payload(payloads)))


@register("envelope_roundtrip", f"WITH {SQL_LONG_BARS_TS}")
def q_envelope_roundtrip(spark, sf_dir):
    from tickflow.session import work_path
    from tickflow.sources import schemas as SC
    from tickflow.sources import topics as TP
    topic = {"format": "file", "path": work_path(spark, "bar-topic")}
    msgs = FX.long_bars(spark, sf_dir).select(
        "symbol", "date", F.col("close_price").cast("string").alias("close_price"),
        F.col("volume").cast("string").alias("volume"))
    TP.write_topic(TP.encode(msgs, "symbol", timestamp=F.col("date").cast("timestamp")), topic)
    back = TP.decode(TP.read_topic(spark, topic), SC.BAR_MESSAGE)
    return FX.comparable(B.typed_bars(back))


@register("bars_date_parts", f"""WITH {SQL_LONG_BARS}
SELECT symbol, CAST(date AS TIMESTAMP) AS date, close_price,
       CAST(year(date) AS BIGINT) AS year, CAST(month(date) AS BIGINT) AS month
FROM long_bars""")
def q_bars_date_parts(spark, sf_dir):
    from tickflow.sources.tables import with_date_parts
    parted = with_date_parts(FX.long_bars(spark, sf_dir), "date")
    return FX.comparable(B.load_bars(parted, keep=("year", "month")))


@register("bars_latest_30", f"""WITH {SQL_LONG_BARS}
SELECT symbol, CAST(date AS TIMESTAMP) AS date, close_price, volume FROM long_bars
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 30""")
def q_bars_latest_30(spark, sf_dir):
    return FX.comparable(B.latest_bars(FX.long_bars(spark, sf_dir), 30))


@register("bars_backfill_200", f"""WITH {SQL_LONG_BARS}
SELECT symbol, CAST(date AS TIMESTAMP) AS date, close_price, volume FROM long_bars
WHERE date <= DATE '2000-12-31'
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 200""")
def q_bars_backfill_200(spark, sf_dir):
    return FX.comparable(B.backfill(FX.long_bars(spark, sf_dir), 200, end="2000-12-31"))


@register("bars_merge_daily", f"""WITH {SQL_LONG_BARS}, {SQL_STATUS_F},
new AS (SELECT * FROM upd),
ex AS (SELECT * FROM long_bars)
SELECT symbol, CAST(date AS TIMESTAMP) AS date, close_price, volume FROM new
UNION ALL
SELECT symbol, CAST(date AS TIMESTAMP) AS date, close_price, volume FROM ex
WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.symbol = ex.symbol AND new.date = ex.date)""")
def q_bars_merge_daily(spark, sf_dir):
    payloads = _daily_payloads(_status_f_bars(spark, sf_dir))
    return FX.comparable(B.merge_daily(FX.long_bars(spark, sf_dir), B.from_api_payload(payloads)))


@register("bars_replace_partition", f"""WITH {SQL_LONG_BARS}, {SQL_STATUS_F},
load2 AS (SELECT * FROM upd WHERE year(date) = 1996)
SELECT symbol, CAST(date AS TIMESTAMP) AS date, close_price, volume,
       CAST(year(date) AS BIGINT) AS year, CAST(month(date) AS BIGINT) AS month FROM load2
UNION ALL
SELECT symbol, CAST(date AS TIMESTAMP) AS date, close_price, volume,
       CAST(year(date) AS BIGINT) AS year, CAST(month(date) AS BIGINT) AS month FROM long_bars b
WHERE NOT EXISTS (SELECT 1 FROM load2 WHERE load2.symbol = b.symbol
                  AND year(load2.date) = year(b.date) AND month(load2.date) = month(b.date))""")
def q_bars_replace_partition(spark, sf_dir):
    from tickflow.session import work_path
    from tickflow.sources import tables as TB
    from tickflow.sources import topics as TP
    path = work_path(spark, "bars")

    def as_topic(bars, name):
        topic = {"format": "file", "path": work_path(spark, name)}
        msgs = bars.select("symbol", "date", F.col("close_price").cast("string").alias("close_price"),
                           F.col("volume").cast("string").alias("volume"))
        TP.write_topic(TP.encode(msgs, "symbol", timestamp=F.col("date").cast("timestamp")), topic)
        return topic

    J.load_bars(spark, as_topic(FX.long_bars(spark, sf_dir), "bars-load1"), path)
    J.load_bars(spark, as_topic(_status_f_bars(spark, sf_dir)
                                .filter(F.year("date") == 1996), "bars-load2"), path)
    return FX.comparable(TB.read_table(spark, path).select(
        "symbol", "date", "close_price", "volume", "year", "month"))


def _bar_topic(spark: SparkSession, bars: DataFrame, name: str) -> dict:
    """Bars as messages on a file-backed topic."""
    from tickflow.session import work_path
    from tickflow.sources import topics as TP
    topic = {"format": "file", "path": work_path(spark, name)}
    msgs = bars.select("symbol", "date", F.col("close_price").cast("string").alias("close_price"),
                       F.col("volume").cast("string").alias("volume"))
    TP.write_topic(TP.encode(msgs, "symbol", timestamp=F.col("date").cast("timestamp")), topic)
    return topic


@register("bars_replace_symbol", f"""WITH {SQL_LONG_BARS}, {SQL_STATUS_F},
load2 AS (SELECT * FROM upd WHERE year(date) = 1996 AND symbol <> '5-LOW')
SELECT symbol, CAST(date AS TIMESTAMP) AS date, close_price, volume FROM load2
UNION ALL
SELECT symbol, CAST(date AS TIMESTAMP) AS date, close_price, volume FROM long_bars
WHERE symbol NOT IN (SELECT symbol FROM load2)""")
def q_bars_replace_symbol(spark, sf_dir):
    """A second load of one year for all symbols but one: their other years go, the one keeps its own."""
    from tickflow.session import work_path
    from tickflow.sources import tables as TB
    path = work_path(spark, "bars")
    J.load_bars(spark, _bar_topic(spark, FX.long_bars(spark, sf_dir), "bars-load1"), path)
    year = _status_f_bars(spark, sf_dir).filter((F.year("date") == 1996) & (F.col("symbol") != "5-LOW"))
    J.load_bars(spark, _bar_topic(spark, year, "bars-load2"), path, mode="symbol")
    return FX.comparable(TB.read_bars(spark, path).select("symbol", "date", "close_price", "volume"))


@register("daily_update", f"""WITH {SQL_LONG_BARS}, {SQL_STATUS_F},
new AS (
    SELECT * FROM upd QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1
    UNION ALL
    SELECT symbol, max(date) + 31, arg_max(close_price, date) + 1, 7 FROM long_bars GROUP BY symbol)
SELECT symbol, CAST(date AS TIMESTAMP) AS date, close_price, volume, CAST(year(date) AS BIGINT) AS year,
       CAST(month(date) AS BIGINT) AS month
FROM (SELECT * FROM new UNION ALL
      SELECT * FROM long_bars b WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.symbol = b.symbol AND new.date = b.date))""")
def q_daily_update(spark, sf_dir):
    """Two updates of the stored table: a revised bar inside a stored month, then a bar of a new month, twice."""
    from tickflow.session import work_path
    from tickflow.sources import tables as TB
    path, bars = work_path(spark, "bars"), FX.long_bars(spark, sf_dir)
    TB.replace_bars(bars, path)
    following = bars.groupBy("symbol").agg(F.max("date").alias("last"), F.max_by("close_price", "date").alias("close_price")).select(
        "symbol", F.date_add("last", 31).alias("date"), (F.col("close_price") + 1).alias("close_price"), F.lit(7).alias("volume"))
    for day in (_status_f_bars(spark, sf_dir), following, following):
        J.store_daily_update(spark, path, _daily_payloads(day))
    return FX.comparable(TB.read_bars(spark, path).select("symbol", "date", "close_price", "volume", "year", "month"))


@register("quotes_in_session", f"""WITH {SQL_TICKS}
SELECT symbol, datetime, close FROM ticks
WHERE strftime(timezone('Asia/Jerusalem', datetime AT TIME ZONE 'UTC'), '%H:%M:%S.%f')
      BETWEEN '16:30:00.000000' AND '23:00:00.000000'""")
def q_quotes_in_session(spark, sf_dir):
    return B.in_session(FX.ticks(spark, sf_dir), "datetime").select("symbol", "datetime", "close")


# --------------------------------------------------------------------------- news

SQL_NEWS = """news AS (
    SELECT doc_id, source AS symbol, split_part(text, chr(10), 1) AS title,
           TIMESTAMP '2024-01-25' + to_minutes(CAST(doc_id AS BIGINT)) AS publishedAt,
           CASE WHEN strpos(text, chr(10)) = 0 THEN '' ELSE substr(text, strpos(text, chr(10)) + 1) END AS description,
           'https://example.org/d/' || CAST(doc_id AS VARCHAR) AS url,
           'documents' AS source_name, text AS content,
           TIMESTAMP '2024-01-25' + to_minutes(CAST(doc_id AS BIGINT))
               + to_seconds(CAST(doc_id % 7 AS BIGINT)) AS timestamp,
           lang
    FROM documents)"""

WS = (r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")


def sql_clean(x: str) -> str:
    return (f"trim(regexp_replace(replace(replace(regexp_replace(coalesce({x}, ''), "
            f"'http[^{WS}]+', '', 'g'), chr(10), ' '), '\\', ''), '[{WS}]+', ' ', 'g'))")


def _page_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw web pages as articles: a backslash after every paragraph end and a
    no-break space after every paragraph start are injected into the body."""
    p = FX.table(spark, sf_dir, "pages")
    body = F.replace(F.replace(F.col("html"), F.lit("</p>"), F.lit("</p>\\")),
                     F.lit("<p>"), F.lit("<p> "))
    return p.select(
        "page_id", F.lit("pages").alias("symbol"), F.col("url").alias("title"),
        F.lit(None).cast("timestamp").alias("publishedAt"),
        body.alias("description"), "url",
        F.struct(F.regexp_extract("url", "//([^/]+)", 1).alias("name")).alias("source"),
        body.alias("content"))


@register("news_normalize_clean", f"""WITH pa AS (
    SELECT page_id, url AS title, url, regexp_extract(url, '//([^/]+)', 1) AS source_name,
           replace(replace(html, '</p>', '</p>\\'), '<p>', '<p>' || chr(160)) AS body
    FROM pages)
SELECT page_id, title, {sql_clean('body')} AS description, url, source_name,
       {sql_clean('body')} AS content
FROM pa""")
def q_news_normalize_clean(spark, sf_dir):
    from tickflow.operators import news as N
    norm = N.normalize(_page_articles(spark, sf_dir), keep=("page_id",))
    return norm.select("page_id", "title", "description", "url", "source_name", "content")


@register("news_dedupe_title", f"""WITH {SQL_NEWS}
SELECT doc_id, symbol, title, publishedAt, url FROM news
QUALIFY row_number() OVER (PARTITION BY symbol, lower(title) ORDER BY publishedAt, url) = 1""")
def q_news_dedupe_title(spark, sf_dir):
    from tickflow.operators import news as N
    n = FX.news(spark, sf_dir).select("doc_id", "symbol", "title", "publishedAt", "url")
    return N.dedupe(n)


MARK_CUT = "2024-01-25 08:00:00"
FETCH_AS_OF = "2024-01-25 20:00:00"


@register("news_fetch_window", f"""WITH {SQL_NEWS},
marks AS (SELECT symbol, max(publishedAt) AS last_published_at FROM news
          WHERE publishedAt < TIMESTAMP '{MARK_CUT}' GROUP BY symbol),
syms AS (SELECT DISTINCT symbol FROM news),
win AS (
    SELECT s.symbol, m.last_published_at,
           CASE WHEN m.last_published_at > TIMESTAMP '{FETCH_AS_OF}' - INTERVAL 1 DAY
                THEN m.last_published_at + INTERVAL 1 MINUTE
                ELSE CAST(CAST(TIMESTAMP '{FETCH_AS_OF}' AS DATE) - INTERVAL 1 DAY AS TIMESTAMP) END
               AS window_from
    FROM syms s LEFT JOIN marks m USING (symbol))
SELECT w.symbol, w.last_published_at, w.window_from, max(n.publishedAt) AS next_mark,
       count(n.doc_id) AS fetched
FROM win w LEFT JOIN news n ON n.symbol = w.symbol AND n.publishedAt >= w.window_from
GROUP BY 1, 2, 3""")
def q_news_fetch_window(spark, sf_dir):
    from tickflow.operators import incremental as I
    from tickflow.session import work_path
    n = FX.news(spark, sf_dir)
    path = work_path(spark, "marks")
    # previous run's marks, stored and read back (IO14)
    I.save_marks(I.next_mark(n.filter(F.col("publishedAt") < F.lit(MARK_CUT).cast("timestamp_ntz"))), path)
    marks = I.load_marks(spark, path)
    win = I.news_window(n.select("symbol").distinct().join(marks, "symbol", "left"), FETCH_AS_OF)
    fetched = n.join(win.select("symbol", "window_from"), "symbol").filter(
        F.col("publishedAt") >= F.col("window_from"))
    stats = fetched.groupBy("symbol").agg(F.max("publishedAt").alias("next_mark"),
                                          F.count(F.lit(1)).alias("fetched"))
    out = win.join(stats, "symbol", "left").select(
        "symbol", "last_published_at", "window_from", "next_mark",
        F.coalesce("fetched", F.lit(0)).alias("fetched"))
    return FX.comparable(out)


@register("news_match_symbols", f"""WITH {SQL_NEWS},
art AS (SELECT url, regexp_extract_all(lower(concat_ws(' ', coalesce(title, ''), coalesce(description, ''))),
                                       '[a-z0-9]+') AS toks FROM news),
comp AS (SELECT symbol, list_distinct(regexp_extract_all(lower(company), '[a-z0-9]+')) AS ctoks
         FROM (VALUES {', '.join(f"('{s}', '{c}')" for s, c in FX.COMPANIES)}) c(symbol, company))
SELECT a.url, c.symbol FROM art a, comp c
WHERE list_contains(a.toks, lower(c.symbol))
   OR (len(c.ctoks) > 0 AND list_has_all(a.toks, c.ctoks) AND list_contains(a.toks, '{FX.COMPANY_SUFFIX}'))""")
def q_news_match_symbols(spark, sf_dir):
    from tickflow.operators import news as N
    return N.match_symbols(FX.news(spark, sf_dir), FX.companies(spark), id_cols=("url",),
                           suffix=FX.COMPANY_SUFFIX)


STORED_CUT = "2024-01-25 08:00:00"


@register("news_incremental", f"""WITH {SQL_NEWS},
stored AS (SELECT * FROM news WHERE timestamp < TIMESTAMP '{STORED_CUT}' AND lang = 'en'),
marks AS (SELECT symbol, max(timestamp) AS m FROM stored GROUP BY symbol),
new AS (SELECT n.* FROM news n LEFT JOIN marks USING (symbol) WHERE m IS NULL OR n.timestamp > m),
allrows AS (SELECT * FROM stored UNION ALL SELECT * FROM new)
SELECT symbol, url, publishedAt, timestamp, CAST(year(timestamp) AS BIGINT) AS year,
       CAST(month(timestamp) AS BIGINT) AS month, CAST(day(timestamp) AS BIGINT) AS day
FROM allrows""")
def q_news_incremental(spark, sf_dir):
    from tickflow.session import work_path
    from tickflow.sources import tables as TB
    from tickflow.sources import topics as TP
    n = FX.news(spark, sf_dir)
    path = work_path(spark, "news")
    first = n.filter((F.col("timestamp") < F.lit(STORED_CUT).cast("timestamp_ntz")) & (F.col("lang") == "en"))
    TB.append_partitions(TB.with_date_parts(first.select(*J.NEWS_COLUMNS), "timestamp", day=True),
                         path, ["symbol", "year", "month", "day"])
    topic = {"format": "file", "path": work_path(spark, "news-topic")}
    TP.write_topic(TP.encode(n, "symbol", timestamp="timestamp", value_cols=[
        "symbol", "title", "publishedAt", "description", "url", "source_name", "content"]), topic)
    J.load_news(spark, topic, path, stored=TB.read_table(spark, path))
    out = TB.read_table(spark, path).select("symbol", "url", "publishedAt", "timestamp", "year", "month", "day")
    return FX.comparable(out)


@register("news_day_partition", f"""WITH {SQL_NEWS}
SELECT symbol, url, timestamp, CAST(year(timestamp) AS BIGINT) AS year,
       CAST(month(timestamp) AS BIGINT) AS month, CAST(day(timestamp) AS BIGINT) AS day
FROM news WHERE CAST(timestamp AS DATE) = DATE '2024-01-25'""")
def q_news_day_partition(spark, sf_dir):
    from tickflow.session import work_path
    from tickflow.sources import tables as TB
    path = work_path(spark, "news-days")
    n = FX.news(spark, sf_dir).select(*J.NEWS_COLUMNS)
    TB.append_partitions(TB.with_date_parts(n, "timestamp", day=True), path,
                         ["symbol", "year", "month", "day"])
    day = TB.read_day(spark, path, "2024-01-25")
    return FX.comparable(day.select("symbol", "url", "timestamp", "year", "month", "day"))


SQL_LANGUAGE = f"""{SQL_NEWS},
ldocs AS (SELECT lang, lower(text) AS t FROM documents WHERE lang IS NOT NULL),
lgrams AS (SELECT lang, substr(t, i, 3) AS g FROM ldocs, range(1, length(t) - 1) r(i)),
lcounts AS (SELECT g, lang, count(*) AS n FROM lgrams GROUP BY 1, 2),
lv AS (SELECT count(DISTINCT g) AS v FROM lcounts),
ltot AS (SELECT lang, sum(n) AS total FROM lcounts GROUP BY lang),
lnd AS (SELECT lang, count(*) AS docs FROM ldocs GROUP BY lang),
lall AS (SELECT count(*) AS a FROM ldocs),
langs AS (SELECT lnd.lang, ln(lnd.docs / lall.a) AS prior, ln(coalesce(ltot.total, 0) + lv.v) AS log_denom
          FROM lnd LEFT JOIN ltot USING (lang), lv, lall),
ttl AS (SELECT url, lower(coalesce(title, '')) AS t FROM news),
tg AS (SELECT url, substr(t, i, 3) AS g, count(*) AS c FROM ttl, range(1, length(t) - 1) r(i) GROUP BY 1, 2),
tseen AS (SELECT tg.url, lc.lang, sum(tg.c * ln(lc.n + 1)) AS s FROM tg JOIN lcounts lc USING (g) GROUP BY 1, 2),
tscore AS (SELECT t.url, l.lang,
                  l.prior - greatest(length(t.t) - 2, 0) * l.log_denom + coalesce(s.s, 0) AS score
           FROM ttl t CROSS JOIN langs l LEFT JOIN tseen s ON s.url = t.url AND s.lang = l.lang),
tbest AS (SELECT url, lang FROM tscore QUALIFY row_number() OVER (PARTITION BY url ORDER BY score DESC, lang) = 1),
detected AS (SELECT n.url, n.lang,
                    CASE WHEN length(lower(coalesce(n.title, ''))) > 2 THEN b.lang END AS language
             FROM news n LEFT JOIN tbest b USING (url))"""


def _detected(spark, sf_dir):
    from tickflow.operators import news as N
    from tickflow.session import work_path
    weights, languages = N.train_language_profiles(FX.table(spark, sf_dir, "documents"),
                                                   path=work_path(spark, "language-profiles"))
    n = FX.news(spark, sf_dir)
    return N.detect_language(n.select("url", "lang", "title"), weights, languages)


@register("news_language", f"""WITH {SQL_LANGUAGE}
SELECT url, lang, language, coalesce(language = 'en', false) AS is_english FROM detected""")
def q_news_language(spark, sf_dir):
    d = _detected(spark, sf_dir)
    return d.select("url", "lang", "language",
                    F.coalesce(F.col("language") == "en", F.lit(False)).alias("is_english"))


# --------------------------------------------------------------------------- sentiment

SQL_LEXICON = f"""lex AS (SELECT * FROM (VALUES {', '.join(f"('{t}', {p})" for t, p in FX.LEXICON)}) x(term, polarity)),
mods AS (SELECT * FROM (VALUES {', '.join(f"('{t}', {p})" for t, p in FX.MODIFIERS)}) x(term, factor))"""


SQL_WORDS_LEXICON = """lex AS (SELECT DISTINCT w AS term, (length(w) % 7 - 3) / 4.0 AS polarity
         FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z'']+')) AS w FROM documents)),
""" + SQL_LEXICON.split("),\n", 1)[1]


def sql_scores(src: str, id_col: str, text_col: str, lexicon: str = SQL_LEXICON) -> str:
    """CTE ``scores(id, sentiment_score FLOAT)`` for the texts of ``src``."""
    return f"""{lexicon},
sd AS (SELECT {id_col} AS sid, {text_col} AS stext,
              regexp_extract_all(lower({text_col}), '[a-z'']+') AS toks FROM {src}),
st AS (SELECT sid, toks[i] AS tok, CASE WHEN i > 1 THEN toks[i - 1] END AS prev
       FROM sd, range(1, len(toks) + 1) r(i)),
sv AS (SELECT sid, CAST(lex.polarity AS DECIMAL(18, 6)) * CAST(coalesce(mods.factor, 1.0) AS DECIMAL(18, 6)) AS val
       FROM st JOIN lex ON st.tok = lex.term LEFT JOIN mods ON st.prev = mods.term),
sagg AS (SELECT sid, CAST(sum(val) AS DOUBLE) / count(*) AS m FROM sv GROUP BY sid),
scores AS (SELECT sd.sid,
                  CASE WHEN sd.stext IS NULL THEN NULL
                       ELSE CAST(greatest(-1.0, least(1.0, coalesce(sagg.m, 0.0))) AS FLOAT) END
                      AS sentiment_score
           FROM sd LEFT JOIN sagg USING (sid))"""


def _scored_news(spark, sf_dir):
    from tickflow.operators import sentiment as SE
    n = FX.news(spark, sf_dir)
    return SE.score(n, FX.lexicon(spark), FX.modifiers(spark))


@register("sentiment_score", f"""WITH {sql_scores('documents', 'doc_id', 'text')}
SELECT sid AS doc_id, round(CAST(sentiment_score AS DOUBLE), 4) AS sentiment_score FROM scores""")
def q_sentiment_score(spark, sf_dir):
    from tickflow.operators import sentiment as SE
    d = FX.table(spark, sf_dir, "documents")
    s = SE.score(d, FX.lexicon(spark), FX.modifiers(spark), text="text")
    return FX.rounded(s.select("doc_id", "sentiment_score"), ["sentiment_score"])


@register("sentiment_score_words", f"""WITH {sql_scores('documents', 'doc_id', 'text', SQL_WORDS_LEXICON)}
SELECT sid AS doc_id, round(CAST(sentiment_score AS DOUBLE), 4) AS sentiment_score FROM scores""")
def q_sentiment_score_words(spark, sf_dir):
    from tickflow.operators import sentiment as SE
    s = SE.score(FX.table(spark, sf_dir, "documents"), FX.words_lexicon(spark, sf_dir), FX.modifiers(spark), text="text")
    return FX.rounded(s.select("doc_id", "sentiment_score"), ["sentiment_score"])


SQL_DAY_SENTIMENT = f"""{SQL_NEWS}, {sql_scores('news', 'doc_id', 'content')},
enriched AS (SELECT n.symbol, CAST(n.timestamp AS DATE) AS day, s.sentiment_score
             FROM news n JOIN scores s ON s.sid = n.doc_id),
sagg2 AS (
    SELECT symbol, day,
           count(*) FILTER (WHERE sentiment_score > 0) AS positive_count,
           avg(sentiment_score) FILTER (WHERE sentiment_score > 0) AS positive_avg_score,
           count(*) FILTER (WHERE sentiment_score < 0) AS negative_count,
           avg(sentiment_score) FILTER (WHERE sentiment_score < 0) AS negative_avg_score,
           count(*) FILTER (WHERE sentiment_score = 0) AS neutral_count,
           count(*) AS total_count
    FROM enriched GROUP BY 1, 2),
day_sent AS (
    SELECT symbol, day, positive_count, positive_count / total_count * 100 AS positive_percentage,
           positive_avg_score, negative_count, negative_count / total_count * 100 AS negative_percentage,
           negative_avg_score, neutral_count
    FROM sagg2),
day_signal AS (
    SELECT *, CASE
        WHEN (positive_percentage > 50 AND positive_avg_score > 0.3) OR positive_percentage = 100 THEN 'buy'
        WHEN positive_percentage > 55 AND positive_avg_score > 0.6 THEN 'strong_buy'
        WHEN (negative_percentage > 50 AND negative_avg_score < -0.3) OR negative_percentage = 100 THEN 'sell'
        WHEN negative_percentage > 55 AND negative_avg_score < -0.6 THEN 'strong_sell'
        ELSE 'hold' END AS sentiment_signal
    FROM day_sent)"""


@register("sentiment_aggregate", f"""WITH {SQL_DAY_SENTIMENT}
SELECT symbol, CAST(day AS TIMESTAMP) AS day, positive_count, round(positive_percentage, 4) AS positive_percentage,
       round(positive_avg_score, 4) AS positive_avg_score, negative_count,
       round(negative_percentage, 4) AS negative_percentage, round(negative_avg_score, 4) AS negative_avg_score,
       neutral_count
FROM day_sent""")
def q_sentiment_aggregate(spark, sf_dir):
    from tickflow.operators import sentiment as SE
    e = _scored_news(spark, sf_dir).withColumn("day", F.to_date("timestamp"))
    agg = SE.aggregate(e, keys=("symbol", "day"))
    return FX.comparable(FX.rounded(agg, ["positive_percentage", "positive_avg_score",
                                          "negative_percentage", "negative_avg_score"]))


@register("sentiment_signal", f"""WITH {SQL_DAY_SENTIMENT}
SELECT symbol, CAST(day AS TIMESTAMP) AS day, positive_count, negative_count, neutral_count, sentiment_signal
FROM day_signal""")
def q_sentiment_signal(spark, sf_dir):
    s = J.day_sentiment(_scored_news(spark, sf_dir))
    return FX.comparable(s.select("symbol", "day", "positive_count", "negative_count", "neutral_count",
                                  "sentiment_signal"))


@register("news_enrich", f"""WITH {SQL_NEWS}, {sql_scores('news', 'doc_id', 'content')}
SELECT n.symbol, n.url, n.timestamp, round(CAST(s.sentiment_score AS DOUBLE), 4) AS sentiment_score,
       CAST(year(timestamp) AS BIGINT) AS year, CAST(month(timestamp) AS BIGINT) AS month, CAST(day(timestamp) AS BIGINT) AS day
FROM news n JOIN scores s ON s.sid = n.doc_id WHERE CAST(n.timestamp AS DATE) = DATE '2024-01-25'""")
def q_news_enrich(spark, sf_dir):
    """The day's later news is enriched first; its earlier news arrives late; the second run is repeated."""
    from tickflow.session import work_path
    from tickflow.sources import tables as TB
    news, enriched = work_path(spark, "news"), work_path(spark, "news-enriched")
    n = TB.with_date_parts(FX.news(spark, sf_dir).select(*J.NEWS_COLUMNS), "timestamp", day=True)
    late = F.col("timestamp") < F.lit(STORED_CUT).cast("timestamp_ntz")
    for rows, runs in ((n.filter(~late), ["run-1"]), (n.filter(late), ["run-2", "run-2", "run-3"])):
        TB.append_partitions(rows, news, J.DAY)
        for run in runs:
            J.append_enriched(spark, news, enriched, "2024-01-25", run, FX.lexicon(spark), FX.modifiers(spark))
    out = TB.read_table(spark, enriched).select("symbol", "url", "timestamp", "sentiment_score", "year", "month", "day")
    return FX.comparable(FX.rounded(out, ["sentiment_score"]))


# --------------------------------------------------------------------------- combined + serving

# Combined signal by (SMA signal, sentiment signal), all 25 cells written out
# here, apart from the operator's table that they check.
SQL_MATRIX_ROWS = """
    ('strong_buy', 'strong_buy', 'strong_buy'), ('strong_buy', 'buy', 'strong_buy'),
    ('strong_buy', 'hold', 'buy'), ('strong_buy', 'sell', 'buy'), ('strong_buy', 'strong_sell', 'hold'),
    ('buy', 'strong_buy', 'strong_buy'), ('buy', 'buy', 'buy'),
    ('buy', 'hold', 'buy'), ('buy', 'sell', 'hold'), ('buy', 'strong_sell', 'hold'),
    ('hold', 'strong_buy', 'buy'), ('hold', 'buy', 'hold'),
    ('hold', 'hold', 'hold'), ('hold', 'sell', 'hold'), ('hold', 'strong_sell', 'sell'),
    ('sell', 'strong_buy', 'hold'), ('sell', 'buy', 'hold'),
    ('sell', 'hold', 'sell'), ('sell', 'sell', 'sell'), ('sell', 'strong_sell', 'strong_sell'),
    ('strong_sell', 'strong_buy', 'hold'), ('strong_sell', 'buy', 'sell'),
    ('strong_sell', 'hold', 'sell'), ('strong_sell', 'sell', 'strong_sell'),
    ('strong_sell', 'strong_sell', 'strong_sell')"""

SQL_COMBINED = f"""{SQL_TICKS}, {SQL_HISTORY}, {sql_indicators('history', 30)}, {SQL_SNAPSHOT},
{SQL_SMA_SIGNALS}, {SQL_DAY_SENTIMENT},
combined AS (
    SELECT s.symbol, s.datetime, s.open, s.high, s.low, s.close, s.volume, s.short_term_avg,
           s.long_term_avg, s.short_above_long, s.is_significant, s.signal AS sma_signal,
           d.sentiment_signal,
           CASE WHEN d.sentiment_signal IS NULL THEN s.signal
                ELSE coalesce(m.combined, s.signal) END AS combined_signal
    FROM sma_signals s
    LEFT JOIN day_signal d ON d.symbol = s.symbol AND d.day = CAST(s.datetime AS DATE)
    LEFT JOIN (VALUES {SQL_MATRIX_ROWS}) m(sma, sent, combined)
      ON m.sma = s.signal AND m.sent = d.sentiment_signal)"""


def _combined_frame(spark, sf_dir):
    sma = _sma_signal_frame(spark, sf_dir)
    sent = J.day_sentiment(_scored_news(spark, sf_dir))
    return J.combined_signals(sma, sent)


@register("combined_signal", f"""WITH {SQL_COMBINED}
SELECT symbol, datetime, close, round(short_term_avg, 4) AS short_term_avg,
       round(long_term_avg, 4) AS long_term_avg, sma_signal, sentiment_signal, combined_signal
FROM combined""")
def q_combined_signal(spark, sf_dir):
    c = _combined_frame(spark, sf_dir)
    return FX.rounded(c.select("symbol", "datetime", "close", "short_term_avg", "long_term_avg",
                               "sma_signal", "sentiment_signal", "combined_signal"),
                      ["short_term_avg", "long_term_avg"])


def _stored_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The signal table that S3 has written (S1 -> S2 -> S3)."""
    from tickflow.session import work_path
    from tickflow.sources import tables as TB
    from tickflow.streaming import jobs as SJ
    path = work_path(spark, "signals")
    SJ.stream_signal_sink(spark, _run_s2(spark, sf_dir), path, work_path(spark, "ckpt-s3"), wait=True)
    return TB.read_signals(spark, path)


@register("signals_latest_3", f"""WITH {SQL_COMBINED}
SELECT symbol, datetime, close, sma_signal, sentiment_signal, combined_signal FROM combined
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) <= 3""")
def q_signals_latest_3(spark, sf_dir):
    from tickflow.operators import serving as SV
    c = _stored_signals(spark, sf_dir)
    # requests as a user would type them: padded, upper-case
    requests = c.select(F.concat(F.lit("  "), F.upper("symbol"), F.lit(" ")).alias("symbol")).distinct()
    top = SV.latest_signals(c, 3, requests=requests)
    return FX.comparable(top.select("symbol", "datetime", "close", "sma_signal", "sentiment_signal", "combined_signal"))


def _sql_iso(x: str) -> str:
    return (f"CASE WHEN strftime({x}, '%f') = '000000' THEN strftime({x}, '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime({x}, '%Y-%m-%dT%H:%M:%S.%f') END")


@register("signal_card", f"""WITH {SQL_COMBINED},
top AS (SELECT * FROM combined QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) <= 3)
SELECT symbol, datetime,
       'Symbol: ' || symbol || chr(10) || 'Time: ' || {_sql_iso('datetime')} || chr(10) ||
       'Price: ' || CAST(close AS VARCHAR) || chr(10) || 'SMA_Signal: ' || coalesce(sma_signal, 'None') ||
       chr(10) || 'Sentiment_Signal: ' || coalesce(sentiment_signal, 'None') || chr(10) ||
       'combined_Signal: ' || coalesce(combined_signal, 'None') AS card
FROM top""")
def q_signal_card(spark, sf_dir):
    from tickflow.operators import serving as SV
    return FX.comparable(SV.signal_card(SV.latest_signals(_stored_signals(spark, sf_dir), 3)))


CHART_AS_OF = "2024-01-29"


@register("chart_series", f"""WITH {SQL_COMBINED},
win AS (SELECT * FROM combined WHERE datetime >= TIMESTAMP '{CHART_AS_OF} 09:30:00'),
means AS (SELECT symbol, avg(CAST(close AS DECIMAL(18, 4))) AS avg_close FROM win GROUP BY symbol)
SELECT w.symbol, w.datetime, w.open, w.high, w.low, w.close, round(m.avg_close, 4) AS avg_close,
       'Average Price: $' || CAST(round(CAST(m.avg_close AS DECIMAL(38, 10)), 2) AS VARCHAR) AS avg_label
FROM win w JOIN means m USING (symbol)""")
def q_chart_series(spark, sf_dir):
    from tickflow.operators import serving as SV
    s = SV.chart_series(_stored_signals(spark, sf_dir), SV.session_start(CHART_AS_OF))
    return FX.comparable(FX.rounded(s, ["avg_close"]))


# --------------------------------------------------------------------------- streaming

def _quote_topic(spark: SparkSession, sf_dir: str) -> dict:
    """All ticks as quote messages on a file-backed topic; arrival time = tick time."""
    from tickflow.session import work_path
    from tickflow.sources import topics as TP
    topic = {"format": "file", "path": work_path(spark, "quote-topic")}
    msgs = FX.ticks(spark, sf_dir).select("symbol", "datetime", "open", "high", "low", "close", "volume")
    TP.write_topic(TP.encode(msgs, "symbol", timestamp="datetime"), topic)
    return topic


def _run_s1(spark, sf_dir) -> dict:
    from tickflow.session import work_path
    from tickflow.streaming import jobs as SJ
    out = {"format": "file", "path": work_path(spark, "sma-topic")}
    snap = J.indicator_snapshot(FX.history_bars(spark, sf_dir), lookback=30)
    SJ.stream_sma_signals(spark, _quote_topic(spark, sf_dir), out, snap, work_path(spark, "ckpt-s1"),
                          work_path(spark, "snapshot"), start=FX.LIVE_START, wait=True, starting="earliest")
    return out


def _run_s2(spark, sf_dir) -> dict:
    from tickflow.session import work_path
    from tickflow.streaming import jobs as SJ
    sma_topic = _run_s1(spark, sf_dir)
    out = {"format": "file", "path": work_path(spark, "combined-topic")}
    sent = J.day_sentiment(_scored_news(spark, sf_dir))
    SJ.stream_combined_signals(spark, sma_topic, out, sent, work_path(spark, "ckpt-s2"),
                               work_path(spark, "day-sentiment"), wait=True, starting=FX.LIVE_START)
    return out


@register("stream_sma_signals", ORACLE["sma_signal"])
def q_stream_sma_signals(spark, sf_dir):
    from tickflow.operators import signals as SG
    from tickflow.sources import schemas as SC
    from tickflow.sources import topics as TP
    out = _run_s1(spark, sf_dir)
    back = SG.typed_signals(TP.decode(TP.read_topic(spark, out), SC.SMA_SIGNAL_MESSAGE))
    return FX.comparable(FX.rounded(back, ["short_term_avg", "long_term_avg"]))


@register("stream_combined_signals", ORACLE["combined_signal"])
def q_stream_combined_signals(spark, sf_dir):
    from tickflow.operators import signals as SG
    from tickflow.sources import schemas as SC
    from tickflow.sources import topics as TP
    out = _run_s2(spark, sf_dir)
    back = SG.typed_signals(TP.decode(TP.read_topic(spark, out), SC.COMBINED_SIGNAL_MESSAGE))
    back = back.select("symbol", "datetime", "close", "short_term_avg", "long_term_avg",
                       "sma_signal", "sentiment_signal", "combined_signal")
    return FX.comparable(FX.rounded(back, ["short_term_avg", "long_term_avg"]))


@register("stream_signal_sink", f"""WITH {SQL_COMBINED}
SELECT symbol, {_sql_iso('datetime')} AS kafka_datetime, {_sql_iso('datetime')} AS datetime,
       open, high, low, close, volume, round(short_term_avg, 4) AS short_term_avg,
       round(long_term_avg, 4) AS long_term_avg, short_above_long, is_significant,
       sma_signal, sentiment_signal, combined_signal
FROM combined""")
def q_stream_signal_sink(spark, sf_dir):
    from tickflow.operators import serving as SV
    docs = SV.signal_document(_stored_signals(spark, sf_dir))
    return FX.comparable(FX.rounded(docs, ["short_term_avg", "long_term_avg"]))


@register("sink_two_runs", f"""WITH {SQL_COMBINED}
SELECT symbol, CAST(CAST(datetime AS DATE) AS TIMESTAMP) AS day, 2 * count(*) AS n, 2 * count(*) AS n_compacted
FROM combined GROUP BY 1, 2""")
def q_sink_two_runs(spark, sf_dir):
    """Two sink queries with checkpoints of their own over one topic: both runs' rows are there, before and after compaction."""
    from tickflow.session import work_path
    from tickflow.sources import tables as TB
    from tickflow.streaming import jobs as SJ
    topic, path, small = _run_s2(spark, sf_dir), work_path(spark, "signals"), work_path(spark, "signals-compacted")
    for run in (1, 2):
        SJ.stream_signal_sink(spark, topic, path, work_path(spark, f"ckpt-s3-{run}"), wait=True)
    TB.compact_signals(spark, path, small)
    count = lambda p, name: TB.read_signals(spark, p).groupBy("symbol", "day").agg(F.count(F.lit(1)).alias(name))
    return FX.comparable(count(path, "n").join(count(small, "n_compacted"), ["symbol", "day"], "full"))


# days from which a new snapshot holds
REFRESH_DAYS = ["2024-01-25", "2024-01-27", "2024-01-29"]


def _sql_refreshed() -> str:
    parts = []
    for day, end in zip(REFRESH_DAYS, [*REFRESH_DAYS[1:], "9999-01-01"]):
        parts.append(f"""SELECT * FROM (WITH {SQL_TICKS}, {sql_history(day)}, {sql_indicators('history', 30)}, {SQL_SNAPSHOT},
{sql_sma_signals(f"q.datetime >= TIMESTAMP '{day}' AND q.datetime < TIMESTAMP '{end}'")}
SELECT symbol, datetime, open, high, low, close, volume, round(short_term_avg, 4) AS short_term_avg,
       round(long_term_avg, 4) AS long_term_avg, short_above_long, is_significant, signal FROM sma_signals)""")
    return "\nUNION ALL\n".join(parts)


@register("stream_sma_refresh", _sql_refreshed())
def q_stream_sma_refresh(spark, sf_dir):
    """S1 over three batches of one checkpoint, with a newer snapshot stored before each."""
    from tickflow.functions.sides import stored
    from tickflow.operators import signals as SG
    from tickflow.session import work_path
    from tickflow.sources import schemas as SC
    from tickflow.sources import topics as TP
    from tickflow.streaming import jobs as SJ
    quotes, out = ({"format": "file", "path": work_path(spark, n)} for n in ("quote-topic", "sma-topic"))
    versions, checkpoint = [], work_path(spark, "ckpt-s1-refresh")
    t = FX.ticks(spark, sf_dir).select("symbol", "datetime", "open", "high", "low", "close", "volume")
    for day, end in zip(REFRESH_DAYS, [*REFRESH_DAYS[1:], "9999-01-01"]):
        part = t.filter((F.col("datetime") >= F.lit(day).cast("timestamp_ntz")) & (F.col("datetime") < F.lit(end).cast("timestamp_ntz")))
        TP.write_topic(TP.encode(part, "symbol", timestamp="datetime"), quotes)
        versions.append(stored(J.indicator_snapshot(FX.history_bars(spark, sf_dir, day), lookback=30), "snapshot"))
        SJ.stream_sma_signals(spark, quotes, out, None, checkpoint, wait=True, starting="earliest", refresh=lambda: versions[-1])
    back = SG.typed_signals(TP.decode(TP.read_topic(spark, out), SC.SMA_SIGNAL_MESSAGE))
    return FX.comparable(FX.rounded(back, ["short_term_avg", "long_term_avg"]))


@register("stream_resample", f"""WITH {SQL_TICKS}
SELECT symbol, date_trunc('day', datetime) AS bar_start,
       date_trunc('day', datetime) + INTERVAL 1 DAY AS bar_end,
       arg_min(close, {{'t': datetime, 'e': event_id}}) AS open, max(close) AS high,
       min(close) AS low, arg_max(close, {{'t': datetime, 'e': event_id}}) AS close,
       CAST(count(*) AS DOUBLE) AS volume
FROM ticks GROUP BY 1, 2, 3
HAVING date_trunc('day', datetime) + INTERVAL 1 DAY
       <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def q_stream_resample(spark, sf_dir):
    from tickflow.session import work_path
    from tickflow.streaming import jobs as SJ
    src = work_path(spark, "tick-files")
    t = FX.ticks(spark, sf_dir).withColumn("datetime", F.col("datetime").cast("timestamp"))
    t.write.parquet(src)
    stream = spark.readStream.schema(t.schema).parquet(src)
    out = work_path(spark, "stream-bars")
    SJ.stream_resample(stream, out, work_path(spark, "ckpt-s5"), interval="1 day", watermark="1 hour",
                       tie="event_id", wait=True)
    return FX.comparable(spark.read.parquet(out))


@register("stream_dedupe", f"""WITH {SQL_NEWS}
SELECT DISTINCT symbol, lower(title) AS title_key FROM news""")
def q_stream_dedupe(spark, sf_dir):
    from tickflow.session import work_path
    from tickflow.streaming import jobs as SJ
    src = work_path(spark, "news-files")
    FX.news(spark, sf_dir).select("symbol", "title", "publishedAt", "url").write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    out, ckpt = work_path(spark, "news-dedupe"), work_path(spark, "ckpt-s6")
    q = (SJ.dedupe_stream(stream).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    # which copy survives depends on arrival order; the surviving keys do not
    return spark.read.parquet(out).select("symbol", "title_key")


@register("news_prepare", f"""WITH {SQL_LANGUAGE},
marks AS (SELECT symbol, max(publishedAt) AS last_published_at FROM news
          WHERE publishedAt < TIMESTAMP '{MARK_CUT}' GROUP BY symbol),
win AS (
    SELECT s.symbol,
           CASE WHEN m.last_published_at > TIMESTAMP '{FETCH_AS_OF}' - INTERVAL 1 DAY
                THEN m.last_published_at + INTERVAL 1 MINUTE
                ELSE CAST(CAST(TIMESTAMP '{FETCH_AS_OF}' AS DATE) - INTERVAL 1 DAY AS TIMESTAMP) END
               AS window_from
    FROM (SELECT DISTINCT symbol FROM news) s LEFT JOIN marks m USING (symbol)),
fetched AS (SELECT n.* FROM news n JOIN win w ON n.symbol = w.symbol AND n.publishedAt >= w.window_from),
eng AS (SELECT f.* FROM fetched f JOIN detected d USING (url) WHERE d.language = 'en'),
dd AS (SELECT * FROM eng
       QUALIFY row_number() OVER (PARTITION BY symbol, lower(coalesce(title, '')) ORDER BY publishedAt, url) = 1)
SELECT symbol, title, publishedAt, {sql_clean('description')} AS description, url, source_name,
       {sql_clean('content')} AS content
FROM dd""")
def q_news_prepare(spark, sf_dir):
    from tickflow.operators import incremental as I
    from tickflow.operators import news as N
    from tickflow.session import work_path
    n = FX.news(spark, sf_dir)
    marks = I.next_mark(n.filter(F.col("publishedAt") < F.lit(MARK_CUT).cast("timestamp_ntz")))
    weights, languages = N.train_language_profiles(FX.table(spark, sf_dir, "documents"),
                                                   path=work_path(spark, "language-profiles"))
    articles = n.select("symbol", "title", "publishedAt", "description", "url", "source_name", "content")
    msgs, _ = J.prepare_news(articles, marks, FETCH_AS_OF, weights, languages)
    return FX.comparable(msgs)
