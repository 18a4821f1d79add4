"""Incremental processing: cut-offs, high-watermarks, fetch windows, ingest marks
(F1 F2 F5 A2 A4 IO14)."""

from __future__ import annotations


from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.functions.sides import join_side, stored
from tickflow.functions.timeutil import ts_lit

MARK_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("last_published_at", T.TimestampType()),
])


def since(df: DataFrame, col: str, start) -> DataFrame:
    """Arrival cut-off (F1): rows with ``col >= start`` (an explicit instant, never the clock)."""
    return df.filter(F.col(col) >= ts_lit(start, df.schema[col].dataType))


def high_watermark(df: DataFrame, col: str = "timestamp", keys=("symbol",),
                   out: str = "max_timestamp") -> DataFrame:
    """Largest ``col`` per key (A2): one row per key, combined map-side."""
    return df.groupBy(*keys).agg(F.max(col).alias(out))


def newer_than(df: DataFrame, marks: DataFrame, col: str = "timestamp", keys=("symbol",),
               mark_col: str = "max_timestamp", default=None) -> DataFrame:
    """Incremental filter (F2): rows strictly newer than their key's stored mark.

    Keys without a mark keep every row - or, with ``default``, rows newer than
    it (a null mark falls back to the default instead of dropping everything).
    The marks are stored and joined as a side: ``df`` is not exchanged on its keys.
    """
    joined = join_side(df, stored(marks.select(*keys, F.col(mark_col).alias("_mark")), "marks"), keys, "left")
    mark = F.col("_mark")
    if default is not None:
        mark = F.coalesce(mark, ts_lit(default, df.schema[col].dataType))
    return joined.filter(mark.isNull() | (F.col(col) > mark)).drop("_mark")


def news_window(marks: DataFrame, as_of, mark_col: str = "last_published_at") -> DataFrame:
    """News fetch window start per symbol.

    mark later than ``as_of - 1 day`` -> mark + 1 minute; otherwise (or no
    mark) -> midnight of the day before ``as_of``.
    """
    as_of_ts = ts_lit(as_of)
    mark = F.col(mark_col).cast("timestamp_ntz")
    default = F.date_sub(F.to_date(as_of_ts), 1).cast("timestamp_ntz")
    recent = mark > as_of_ts - F.expr("INTERVAL 1 DAY")
    return marks.withColumn("window_from", F.when(recent, mark + F.expr("INTERVAL 1 MINUTE"))
                            .otherwise(default))


def next_mark(fetched: DataFrame, col: str = "publishedAt", keys=("symbol",),
              out: str = "last_published_at") -> DataFrame:
    """New ingest mark (A4): newest ``publishedAt`` among all fetched articles, skipped ones included."""
    return fetched.groupBy(*keys).agg(F.max(col).alias(out))


def load_marks(spark: SparkSession, path: str) -> DataFrame:
    """Stored ingest marks (IO14); an absent table reads as no marks."""
    try:
        return spark.read.schema(MARK_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # only a missing folder is a first run
            raise
        return spark.createDataFrame([], MARK_SCHEMA)


def save_marks(marks: DataFrame, path: str) -> None:
    """Upsert the stored marks by symbol (IO14): symbols present in ``marks`` get the new value.

    The table is small files of one folder, not a folder per symbol: old and new marks are merged into
    a staged copy first, which then takes the table's place.
    """
    spark = marks.sparkSession
    new = marks.select("symbol", F.col("last_published_at").cast("timestamp").alias("last_published_at")).withColumn("_new", F.lit(1))
    both = load_marks(spark, path).withColumn("_new", F.lit(0)).unionByName(new)
    merged = both.groupBy("symbol").agg(F.max(F.struct("_new", "last_published_at")).alias("m")).select("symbol", "m.last_published_at")
    stored(merged, "marks").write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
