"""Decision rules and the joins that feed them."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.functions.sides import join_side

SIGNALS = ("strong_buy", "buy", "hold", "sell", "strong_sell")

# Combined signal by (SMA signal, sentiment signal), one line per
# SMA signal, sentiment in the order strong_buy, buy, hold, sell, strong_sell.
COMBINED_MATRIX = {
    "strong_buy":  ("strong_buy", "strong_buy", "buy", "buy", "hold"),
    "buy":         ("strong_buy", "buy", "buy", "hold", "hold"),
    "hold":        ("buy", "hold", "hold", "hold", "sell"),
    "sell":        ("hold", "hold", "sell", "sell", "strong_sell"),
    "strong_sell": ("hold", "sell", "sell", "strong_sell", "strong_sell"),
}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sma_signal(close="close", short="short_term_avg", long="long_term_avg",
               above="short_above_long", significant="is_significant",
               position="position") -> Column:
    """SMA signal (C1) as one flat CASE.

    above & significant:   close > short -> strong_buy, else hold
    above & !significant:  close > short & pos = buy -> strong_buy;
                           close > short -> buy; close < long & pos != buy -> sell; else hold
    !above & significant:  close < short -> strong_sell, else hold
    !above & !significant: close < short & pos = sell -> strong_sell;
                           close < short -> sell; close > long & pos != sell -> buy; else hold
    Comparisons are strict; a null close lands on hold; a null flag gives null.
    """
    c, s, lg, a, g, p = map(_c, (close, short, long, above, significant, position))
    return (F.when(a.isNull() | g.isNull(), F.lit(None).cast("string"))
            .when(a & g & (c > s), "strong_buy")
            .when(a & g, "hold")
            .when(a & (c > s) & (p == "buy"), "strong_buy")
            .when(a & (c > s) & (p != "buy"), "buy")
            .when(a & (c < lg) & (p != "buy"), "sell")
            .when(a, "hold")
            .when(g & (c < s), "strong_sell")
            .when(g, "hold")
            .when((c < s) & (p == "sell"), "strong_sell")
            .when((c < s) & (p != "sell"), "sell")
            .when((c > lg) & (p != "sell"), "buy")
            .otherwise("hold"))


def sentiment_signal(pos_pct="positive_percentage", pos_avg="positive_avg_score",
                     neg_pct="negative_percentage", neg_avg="negative_avg_score",
                     strong_first: bool = False) -> Column:
    """Sentiment signal (C2), first match wins.

    buy: (pos% > 50 and pos_avg > 0.3) or pos% = 100; strong_buy: pos% > 55 and
    pos_avg > 0.6; sell / strong_sell mirror them on the negative side; else
    hold. As in the reference, buy / sell are tested first, so the strong arms
    can only fire with ``strong_first=True``.
    """
    pp, pa, np_, na = map(_c, (pos_pct, pos_avg, neg_pct, neg_avg))
    arms = [
        ("buy", ((pp > 50) & (pa > 0.3)) | (pp == 100)),
        ("strong_buy", (pp > 55) & (pa > 0.6)),
        ("sell", ((np_ > 50) & (na < -0.3)) | (np_ == 100)),
        ("strong_sell", (np_ > 55) & (na < -0.6)),
    ]
    if strong_first:
        arms = [arms[1], arms[0], arms[3], arms[2]]
    out = None
    for label, cond in arms:
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise("hold")


def _matrix_map() -> Column:
    entries = [(F.lit(f"{sma}|{sent}"), F.lit(val))
               for sma, row in COMBINED_MATRIX.items() for sent, val in zip(SIGNALS, row)]
    return F.create_map(*chain.from_iterable(entries))


def combined_signal(sma="sma_signal", sentiment="sentiment_signal") -> Column:
    """Combined signal (C3): matrix lookup; a null or unknown side keeps the SMA signal."""
    key = F.concat_ws("|", _c(sma), _c(sentiment))
    hit = F.try_element_at(_matrix_map(), key)
    return F.when(_c(sma).isNull() | _c(sentiment).isNull(), _c(sma)).otherwise(
        F.coalesce(hit, _c(sma)))


def attach_snapshot(quotes: DataFrame, snap: DataFrame, key: str = "symbol") -> DataFrame:
    """Attach each symbol's indicator snapshot to its quotes (J1): inner equi-join.

    Quotes of a symbol without history give no row. ``snap`` is a stored side
    (``sides.stored``): broadcast when its bytes allow, else joined under salts, so
    that quotes are never exchanged on the symbol alone.
    """
    return join_side(quotes, snap, [key])


def attach_sentiment(signals: DataFrame, sentiment: DataFrame, keys=("symbol", "day")) -> DataFrame:
    """Attach the day sentiment signal (a stored side) to SMA signals (J2): left equi-join, null when no news."""
    return join_side(signals, sentiment, keys, "left")


def typed_signals(df: DataFrame) -> DataFrame:
    """Signal message strings -> types (P2 + P3): prices and averages DOUBLE, flags BOOLEAN."""
    out = df
    for c in ("open", "high", "low", "close", "volume", "short_term_avg", "long_term_avg"):
        if c in df.columns:
            out = out.withColumn(c, F.col(c).cast("string").try_cast("double"))
    for c in ("short_above_long", "is_significant"):
        if c in df.columns:
            out = out.withColumn(c, F.col(c).cast("string").try_cast("boolean"))
    if "datetime" in df.columns:
        out = out.withColumn("datetime", F.try_to_timestamp(F.col("datetime").cast("string")))
    return out
