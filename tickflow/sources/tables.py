"""Parquet tables: reads, partition reads, partitioned writes, the signal sink (IO6-IO9, IO11, P4)."""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.functions.sides import stored


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table read (IO6); partition columns come from the folder names.

    A symbol is text even where every folder name looks like a number (``symbol=0700``),
    which Spark's inference of partition types would read as an integer.
    """
    found = spark.read.parquet(path)
    if all(f.name != "symbol" or isinstance(f.dataType, T.StringType) for f in found.schema):
        return found
    fields = [T.StructField("symbol", T.StringType()) if f.name == "symbol" else f for f in found.schema]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def with_date_parts(df: DataFrame, col: str | Column, day: bool = False) -> DataFrame:
    """Add INT ``year``, ``month`` (and ``day``) of a date/timestamp column."""
    c = F.col(col) if isinstance(col, str) else col
    out = df.withColumn("year", F.year(c).cast("int")).withColumn("month", F.month(c).cast("int"))
    if day:
        out = out.withColumn("day", F.dayofmonth(c).cast("int"))
    return out


def read_day(spark: SparkSession, path: str, as_of) -> DataFrame:
    """Read one ``year/month/day`` partition of a table (IO7).

    Expressed as a filter on the partition columns, so Catalyst prunes the
    other folders (``PartitionFilters`` in the plan) instead of us building a
    path string.
    """
    d = as_of.date() if isinstance(as_of, _dt.datetime) else as_of
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d[:10])
    return (read_table(spark, path)
            .filter((F.col("year") == d.year) & (F.col("month") == d.month)
                    & (F.col("day") == d.day)))


def cluster_for_write(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Cluster rows by the output partition columns before a partitioned write.

    Without it every task writes a file into every partition it touches
    (tasks x partitions small files). ``rebalance`` is AQE's partitioning for
    writes: rows stay clustered by the partition columns, and a skewed
    partition (one hot symbol-day) is split over several tasks at runtime
    instead of landing in one.
    """
    return df.hint("rebalance", *partition_by)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Partitioned overwrite that replaces only the partitions present in ``df`` (IO8)."""
    (cluster_for_write(df, partition_by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))


def replace_bars(df: DataFrame, path: str) -> None:
    """Store daily bars under ``symbol/year/month``, replacing the loaded months (IO8)."""
    replace_partitions(with_date_parts(df, "date"), path, ["symbol", "year", "month"])


def replace_symbols(df: DataFrame, path: str) -> None:
    """Store daily bars so that each loaded symbol's *whole* history is the load (IO8, symbol mode).

    Months of these symbols that the load lacks go too. The months to write and to clear are staged
    as one table first: an empty month is a partition whose file has no bar, which the dynamic
    overwrite puts in place of the old one.
    """
    spark = df.sparkSession
    new = with_date_parts(df, "date")
    keys = ["symbol", "year", "month"]
    try:
        old = read_table(spark, path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # a first load
            raise
        replace_partitions(new, path, keys)
        return
    months = old.select(*keys).distinct().join(new.select("symbol").distinct(), "symbol", "left_semi")
    gone = months.join(new.select(*keys).distinct(), keys, "left_anti")
    values = [c for c in new.columns if c not in keys]
    cleared = gone.select(*[F.lit(None).cast(new.schema[c].dataType).alias(c) for c in values], *keys)
    replace_partitions(stored(new.select(*values, *keys).unionByName(cleared), "bars-load"), path, keys)


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    """Stored bars without the marks that cleared months leave (a bar has a date)."""
    return read_table(spark, path).filter(F.col("date").isNotNull())


def append_partitions(df: DataFrame, path: str, partition_by: list[str]) -> bool:
    """Partitioned append, skipped when there is nothing to write (IO9).

    ``isEmpty`` stops at the first row instead of counting the whole input.
    """
    if df.isEmpty():
        return False
    (cluster_for_write(df, partition_by).write.mode("append")
     .partitionBy(*partition_by).parquet(path))
    return True


SIGNAL_PARTITIONS = ["day", "run_id", "batch_id"]


def signal_sink(path: str, run_id=None):
    """Idempotent ``foreachBatch`` writer for typed signals (IO11, S4).

    Signals rest with real timestamps under ``day/run_id/batch_id``. Each micro-batch has its own
    partitions and overwrites them, so a batch re-run after a failure replaces its own output
    instead of duplicating it. ``run_id()`` names the streaming query (its id lives in
    the checkpoint), so that a new checkpoint, whose batches count from 0 again, adds
    partitions of its own.
    """
    def _write(batch: DataFrame, batch_id: int) -> None:
        keyed = batch.withColumns({"day": F.to_date("datetime"), "run_id": F.lit(run_id() if run_id else "run"), "batch_id": F.lit(int(batch_id))})
        (keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*SIGNAL_PARTITIONS).parquet(path))
    return _write


def read_signals(spark: SparkSession, path: str) -> DataFrame:
    """The stored signals with their ``day`` partition, whatever runs and batches wrote them."""
    found = spark.read.parquet(path)
    fields = [T.StructField(f.name, {"day": T.DateType(), "run_id": T.StringType()}.get(f.name, f.dataType)) for f in found.schema]
    return spark.read.schema(T.StructType(fields)).parquet(path).drop("run_id", "batch_id")


def compact_signals(spark: SparkSession, path: str, out: str) -> None:
    """Daily compaction (IO11): the signals of ``path`` as one run and batch a day under ``out``.

    The compacted table is a new folder, so readers of the old one and a job that fails half-way
    see whole tables only; a large day is still several files.
    """
    whole = read_signals(spark, path).withColumns({"run_id": F.lit("compacted"), "batch_id": F.lit(0)})
    cluster_for_write(whole, ["day"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*SIGNAL_PARTITIONS).parquet(out)
