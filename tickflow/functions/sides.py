"""Joins of a large table with a side table (a snapshot, day sentiment, marks, a lexicon).

A side is stored first, so that the planner knows its bytes before it plans the join. A side within
``spark.sql.autoBroadcastJoinThreshold`` is then broadcast and the large table does not move. A
larger one is copied under ``SALTS`` salts and joined on key and salt, each large row drawing one salt
from its own columns: no task gets all rows of a hot key, and a lost task draws the same salts again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.session import work_path

#: Copies of a side that is too large to broadcast; a hot key's rows are dealt over as many tasks.
SALTS = 32


def stored(side: DataFrame, name: str = "side", path: str | None = None) -> DataFrame:
    """Write ``side`` once to the shared folder and read it back; its size in bytes is then known."""
    path = path or work_path(side.sparkSession, name)
    side.write.mode("overwrite").parquet(path)
    return side.sparkSession.read.schema(side.schema).parquet(path)


def threshold(spark) -> int:
    """Bytes up to which the planner broadcasts (-1: never)."""
    text = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold")).strip().lower()
    for unit, size in (("kb", 2 ** 10), ("mb", 2 ** 20), ("gb", 2 ** 30), ("k", 2 ** 10), ("m", 2 ** 20), ("g", 2 ** 30), ("b", 1)):
        if text.endswith(unit):
            return int(text[:-len(unit)]) * size
    return int(text)


def known_bytes(side: DataFrame) -> int:
    """The planner's size of a side; file sizes for a stored one."""
    return int(side._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def join_side(large: DataFrame, side: DataFrame, keys, how: str = "inner") -> DataFrame:
    """``large`` joined (inner, left, left_semi, left_anti) with a stored ``side`` on ``keys``."""
    keys = list(keys)
    if known_bytes(side) <= threshold(large.sparkSession):
        return large.join(F.broadcast(side), keys, how)
    copies = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = large.withColumn("_salt", F.pmod(F.xxhash64(*large.columns), F.lit(SALTS)).cast("int"))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")
