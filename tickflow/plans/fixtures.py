"""Derivations of tickflow inputs from the driver's test tables.

The same derivations are written in SQL in ``tickflow.plans.catalog`` for the
DuckDB oracle. Every derived input grows with its source table.

* ticks       - ``events``: symbol = 'src' || (user_id % 20), datetime = ts, close = value
* history     - day bars (last tick per day) of ticks before LIVE_START
* live quotes - ticks from LIVE_START on (arrival time = ts)
* long bars   - ``orders``: symbol = o_orderpriority, date = o_orderdate,
                close_price = price of the highest order key that day, volume = orders that day
* news        - ``documents``: symbol = source, title = first line, description = the other lines,
                content = whole text, publishedAt = LIVE_START + doc_id minutes,
                arrival timestamp = publishedAt + (doc_id % 7) seconds
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.functions.timeutil import ts_lit
from tickflow.operators import bars as B
from tickflow.session import apply_defaults

LIVE_START = _dt.datetime(2024, 1, 25)
N_TICK_SYMBOLS = 20

# Company names for the symbol-matching fixture, chosen among
# frequent tokens of the English documents, and the suffix token used with them.
COMPANIES = [("src1", "was"), ("src2", "with"), ("src3", "that for"), ("src4", "you")]
COMPANY_SUFFIX = "the"

# The sentiment lexicon of the fixture and its modifiers.
LEXICON = [("for", 0.9), ("with", -0.9), ("was", 0.7), ("that", -0.5), ("you", 0.4)]
MODIFIERS = [("and", -0.5), ("the", 1.3), ("not", -0.5), ("very", 1.3)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_defaults(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("src"), (F.col("user_id") % N_TICK_SYMBOLS).cast("string")).alias("symbol"),
        F.col("ts").cast("timestamp_ntz").alias("datetime"),
        "event_id",
        F.col("value").alias("open"), F.col("value").alias("high"), F.col("value").alias("low"),
        F.col("value").alias("close"), F.lit(1.0).alias("volume"),
    )


def history_bars(spark: SparkSession, sf_dir: str, before=LIVE_START) -> DataFrame:
    t = ticks(spark, sf_dir).filter(F.col("datetime") < ts_lit(before))
    day = B.resample(t, "1 day", ts="datetime", price="close", volume="volume", tie="event_id")
    return day.select("symbol", F.col("bar_start").alias("date"), "close", "volume") \
        .withColumnRenamed("close", "close_price")


def live_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir)
    return t.filter(F.col("datetime") >= ts_lit(LIVE_START))


def long_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderpriority").alias("symbol"),
                      F.col("o_orderdate").cast("date").alias("date"))
            .agg(F.max_by("o_totalprice", "o_orderkey").alias("close_price"),
                 F.count(F.lit(1)).alias("volume")))


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    published = F.timestamp_add("MINUTE", F.col("doc_id"), ts_lit(LIVE_START))
    return d.select(
        "doc_id",
        F.col("source").alias("symbol"),
        F.substring_index("text", "\n", 1).alias("title"),
        published.alias("publishedAt"),
        F.expr("if(instr(text, '\\n') = 0, '', substring(text, instr(text, '\\n') + 1))").alias("description"),
        F.concat(F.lit("https://example.org/d/"), F.col("doc_id").cast("string")).alias("url"),
        F.lit("documents").alias("source_name"),
        F.col("text").alias("content"),
        F.timestamp_add("SECOND", F.col("doc_id") % 7, published).alias("timestamp"),
        "lang",
    )


def words_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lexicon of every word of the documents (thousands of terms, growing with the table):
    polarity = (length mod 7 - 3) / 4."""
    words = table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z']+"), F.lit(0))).alias("term"))
    return words.distinct().select("term", ((F.length("term") % 7 - 3) / 4.0).alias("polarity"))


def companies(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COMPANIES, "symbol string, company string")


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, "term string, polarity double")


def modifiers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MODIFIERS, "term string, factor double")


def to_ntz(df: DataFrame) -> DataFrame:
    """Zone-less timestamps for comparison with the oracle."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


def comparable(df: DataFrame) -> DataFrame:
    """Output types that compare unambiguously with the oracle: timestamps (not dates,
    not zone-aware), BIGINT for non-null integers and DOUBLE for nullable ones."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DateType, T.TimestampType)):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def rounded(df: DataFrame, cols, digits: int = 4) -> DataFrame:
    out = df
    for c in cols:
        out = out.withColumn(c, F.round(F.col(c).cast("double"), digits))
    return out
