"""Decision rules C1, C2, C3 over every cell, with equality and null edges."""

import itertools

from pyspark.sql import functions as F

from tickflow.operators import signals as SG


def c1_expected(above, sig, pos, close, short, long):
    if above is None or sig is None:
        return None
    gt_s = close is not None and close > short
    lt_s = close is not None and close < short
    gt_l = close is not None and close > long
    lt_l = close is not None and close < long
    if above and sig:
        return "strong_buy" if gt_s else "hold"
    if above:
        if gt_s and pos == "buy":
            return "strong_buy"
        if gt_s:
            return "buy"
        if lt_l and pos != "buy":
            return "sell"
        return "hold"
    if sig:
        return "strong_sell" if lt_s else "hold"
    if lt_s and pos == "sell":
        return "strong_sell"
    if lt_s:
        return "sell"
    if gt_l and pos != "sell":
        return "buy"
    return "hold"


def test_sma_signal_all_cells(spark):
    cases = []
    for above, sig, pos, (short, long), close in itertools.product(
            [True, False, None], [True, False, None], ["buy", "sell", "hold"],
            [(10.0, 10.5), (10.0, 9.5)], [None, 9.0, 9.5, 10.0, 10.25, 10.5, 11.0]):
        cases.append((above, sig, pos, close, short, long))
    df = spark.createDataFrame(cases, "short_above_long boolean, is_significant boolean, position string, "
                                      "close double, short_term_avg double, long_term_avg double")
    got = df.withColumn("signal", SG.sma_signal()).collect()
    assert len(got) == len(cases)
    for r in got:
        exp = c1_expected(r.short_above_long, r.is_significant, r.position, r.close,
                          r.short_term_avg, r.long_term_avg)
        assert r.signal == exp, r


def test_sentiment_signal_thresholds(spark):
    rows = [
        (50.0, 0.9, 0.0, None, "hold"),        # 50 % is not > 50
        (50.1, 0.3, 0.0, None, "hold"),        # 0.3 is not > 0.3
        (50.1, 0.31, 0.0, None, "buy"),
        (100.0, 0.01, 0.0, None, "buy"),       # all positive
        (56.0, 0.7, 0.0, None, "buy"),         # strong arm hidden behind buy
        (0.0, None, 50.1, -0.31, "sell"),
        (0.0, None, 100.0, -0.01, "sell"),
        (0.0, None, 56.0, -0.7, "sell"),
        (0.0, None, 55.0, -0.9, "sell"),
        (0.0, None, 50.0, -0.9, "hold"),
        (None, None, None, None, "hold"),
    ]
    df = spark.createDataFrame(rows, "positive_percentage double, positive_avg_score double, "
                                     "negative_percentage double, negative_avg_score double, exp string")
    for r in df.withColumn("s", SG.sentiment_signal()).collect():
        assert r.s == r.exp, r
    strong = df.withColumn("s", SG.sentiment_signal(strong_first=True)).collect()
    by_key = {(r.positive_percentage, r.positive_avg_score, r.negative_percentage, r.negative_avg_score): r.s
              for r in strong}
    assert by_key[(56.0, 0.7, 0.0, None)] == "strong_buy"
    assert by_key[(0.0, None, 56.0, -0.7)] == "strong_sell"
    assert by_key[(0.0, None, 55.0, -0.9)] == "sell"     # 55 is not > 55


def test_float_score_edge(spark):
    # a FLOAT 0.3 widened to double is above the double 0.3 threshold
    df = spark.createDataFrame([(0.3,)], "s float").select(
        (F.col("s").cast("double") > 0.3).alias("above"))
    assert df.first().above is True


def test_combined_signal_matrix(spark):
    rows = [(a, b) for a in SG.SIGNALS for b in SG.SIGNALS]
    rows += [(None, "buy"), ("buy", None), ("sell", None), ("buy", "unknown"), ("odd", "buy"), (None, None)]
    df = spark.createDataFrame(rows, "sma_signal string, sentiment_signal string")
    got = {(r.sma_signal, r.sentiment_signal): r.combined_signal
           for r in df.withColumn("combined_signal", SG.combined_signal()).collect()}
    for a, row in SG.COMBINED_MATRIX.items():
        for b, v in zip(SG.SIGNALS, row):
            assert got[(a, b)] == v
    assert got[(None, "buy")] is None
    assert got[("buy", None)] == "buy"
    assert got[("sell", None)] == "sell"
    assert got[("buy", "unknown")] == "buy"
    assert got[("odd", "buy")] == "odd"
    # spot checks of the rule's corners
    assert got[("strong_buy", "strong_sell")] == "hold"
    assert got[("strong_sell", "strong_buy")] == "hold"
    assert got[("hold", "strong_sell")] == "sell"
