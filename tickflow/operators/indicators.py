"""Moving averages, crossover flags and the indicator snapshot.

Row-based windows need every row of a symbol in time order. Partitioning the
window by ``symbol`` alone would put a hot symbol (a third of all bars, say)
into one task. For the full-history table we instead partition by
``(symbol, block)`` - a calendar block such as a year of daily bars - and give
every block a *halo*: copies of the rows just before it that its first frames
reach into. The halo of a block is found from the per-block tails (the last
``h`` rows of each block, a WindowGroupLimit that trims before the shuffle), so
the main data is shuffled once and each window task holds one block plus ``h``
rows. The result is exactly the full-history window result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHORT = 5
LONG = 10
THRESHOLD = 0.03


def _frames(df: DataFrame, part: list, order: str, price: str, short: int, long: int) -> DataFrame:
    """SMA short/long, trend flag and crossover position over windows partitioned by ``part``."""
    w = Window.partitionBy(*part).orderBy(order)
    # means of exact decimals: on flat prices both are equal, and no flag flips on a last bit
    exact = F.col(price).try_cast("decimal(30,10)")
    out = (df.withColumn("sma_short", F.avg(exact).over(w.rowsBetween(-(short - 1), 0)))
           .withColumn("sma_long", F.avg(exact).over(w.rowsBetween(-(long - 1), 0))))
    out = out.withColumn("short_above_long",
                         F.when(F.col("sma_short") > F.col("sma_long"), 1).otherwise(0))
    out = out.withColumns({c: F.col(c).cast("double") for c in ("sma_short", "sma_long")})
    return out.withColumn("position",
                          F.col("short_above_long") - F.lag("short_above_long", 1).over(w))


def _block_column(order: str, block) -> Column:
    if isinstance(block, Column):
        return block
    return F.date_trunc(block, F.col(order).cast("timestamp_ntz"))


def with_halo(df: DataFrame, key: str, order: str, block, halo: int) -> DataFrame:
    """Rows tagged with ``_block`` plus, per block, copies of the ``halo`` rows before it.

    Copies carry ``_halo = true`` and the block they serve. Exact for any
    block sizes: the ``halo`` rows before a block lie in the tails of the
    blocks before it, which is what the tail window looks at.
    """
    cols = df.columns
    tagged = df.withColumn("_block", _block_column(order, block))
    w_tail = Window.partitionBy(key, "_block").orderBy(F.col(order).desc())
    tails = (tagged.withColumn("_rn", F.row_number().over(w_tail))
             .filter(F.col("_rn") <= halo).drop("_rn"))
    w_key = Window.partitionBy(key).orderBy(order)
    before = (tails
              .withColumn("_prev", F.collect_list(F.struct(*cols))
                          .over(w_key.rowsBetween(-halo, -1)))
              .withColumn("_prev_block", F.lag("_block", 1).over(w_key))
              # the earliest tail row of each block carries that block's halo
              .filter(F.col("_prev_block").isNull() | (F.col("_prev_block") != F.col("_block"))))
    halo_rows = (before.select("_block", F.explode("_prev").alias("_r"))
                 .select(*[F.col(f"_r.{c}").alias(c) for c in cols], "_block")
                 .withColumn("_halo", F.lit(True)))
    return tagged.withColumn("_halo", F.lit(False)).unionByName(halo_rows)


def indicators(bars: DataFrame, short: int = SHORT, long: int = LONG, key: str = "symbol",
               order: str = "date", price: str = "close_price", lookback: int | None = None,
               block: str | Column = "year") -> DataFrame:
    """Per-bar SMAs, trend flag and crossover position.

    * ``sma_short`` / ``sma_long``: mean of the last ``short`` / ``long`` rows;
      the first rows of a series average the rows they have (partial frames).
    * ``short_above_long``: 1 when ``sma_short > sma_long`` else 0.
    * ``position``: flag minus the previous flag (null on the first row).

    ``lookback=n`` first keeps the last n bars per key (T1) - frames then start
    at the oldest kept bar, as in the reference snapshot job. Without a
    lookback the full history is computed with the block + halo plan above;
    ``block`` is a ``date_trunc`` unit (``"year"`` suits daily bars, ``"day"``
    minute bars) or a Column.
    """
    base = bars.select(key, order, price)
    if lookback is not None:
        from tickflow.operators.bars import latest_bars
        return _frames(latest_bars(base, lookback, key, order), [key], order, price, short, long)
    halo = max(short, long)  # long - 1 rows for the frames, one more for the lag
    rows = with_halo(base, key, order, block, halo)
    out = _frames(rows, [key, "_block"], order, price, short, long)
    return out.filter(~F.col("_halo")).drop("_halo", "_block")


def position_label(c) -> Column:
    """Crossover position -> label (P10): 1 buy, -1 sell, anything else (null too) hold."""
    p = F.col(c) if isinstance(c, str) else c
    return F.when(p == 1, "buy").when(p == -1, "sell").otherwise("hold")


def significance(short_col, long_col, threshold: float = THRESHOLD) -> Column:
    """``|short - long| / long > threshold`` (P11); a zero or null long average is not significant."""
    s = F.col(short_col) if isinstance(short_col, str) else short_col
    lg = F.col(long_col) if isinstance(long_col, str) else long_col
    return F.coalesce(F.try_divide(F.abs(s - lg), lg) > F.lit(threshold), F.lit(False))


def snapshot(ind: DataFrame, key: str = "symbol", order: str = "date",
             threshold: float = THRESHOLD) -> DataFrame:
    """Latest indicator row per key, as the five values a signal needs.

    ``max_by`` over a struct is an aggregate, so it reduces each task's rows
    before the shuffle instead of sorting a symbol's history.
    """
    last = ind.groupBy(key).agg(F.max_by(
        F.struct("sma_short", "sma_long", "short_above_long", "position"), F.col(order)).alias("r"))
    return last.select(
        key,
        F.col("r.sma_short").alias("short_term_avg"),
        F.col("r.sma_long").alias("long_term_avg"),
        (F.col("r.short_above_long") == 1).alias("short_above_long"),
        position_label("r.position").alias("position"),
        significance("r.sma_short", "r.sma_long", threshold).alias("is_significant"),
    )
