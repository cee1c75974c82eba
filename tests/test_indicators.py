"""Indicators by hand, against pandas, and their properties."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barflow.operators.indicators import (
    GOLD_COLUMNS, continue_gold, engineered, engineered_columns, gold, macd_columns, with_averages, with_calendar,
)
from barflow.schemas import BARS
from helpers import collected

TINY = [1, 2, 3, 2, 1, 2, 3, 4, 3, 2]


def expected_gold(g):
    c, v = g.close, g.volume
    out = pd.DataFrame({"date": g.date})
    for n in (5, 10, 21, 63):
        out[f"sma_{n}"] = c.rolling(n).mean()
    slow, fast = c.ewm(span=26, adjust=False).mean(), c.ewm(span=12, adjust=False).mean()
    out["ema_12"], out["ema_26"] = fast, slow
    logs = np.log(c / c.shift(1))
    for n in (21, 63):
        out[f"volatility_{n}d"] = logs.rolling(n).std() * np.sqrt(252)
    ranges = pd.concat([g.high - g.low, (g.high - c.shift()).abs(), (g.low - c.shift()).abs()], axis=1)
    out["atr_14"] = ranges.max(axis=1).rolling(14).mean()
    change = c.diff().fillna(0)
    for n in (14, 7):
        up, down = change.clip(lower=0).rolling(n).mean(), (-change).clip(lower=0).rolling(n).mean()
        out[f"rsi_{n}"] = 100 - 100 / (1 + up / down.where(down > 0))
    out["macd"] = fast - slow
    out["macd_signal"] = out.macd.ewm(span=9, adjust=False).mean()
    out["macd_histogram"] = out.macd - out.macd_signal
    mid, dev = c.rolling(20).mean(), c.rolling(20).std()
    out["bb_upper"], out["bb_lower"] = mid + 2 * dev, mid - 2 * dev
    out["bb_width"] = 4 * dev / mid
    out["bb_position"] = (c - out.bb_lower) / (4 * dev)
    out["volume_sma_21"] = v.rolling(21).mean()
    out["volume_ratio_21"] = v / out.volume_sma_21
    out["obv"] = (np.sign(c.diff()) * v).fillna(0).cumsum()
    for k in (1, 5, 21):
        out[f"return_{k}d"] = c / c.shift(k) - 1
        out[f"close_lag_{k}"] = c.shift(k)
    out["future_return_5d"] = c.shift(-5) / c - 1
    out["target_direction_5d"] = (out.future_return_5d > 0).astype(float).where(out.future_return_5d.notna())
    return out


def test_gold_equals_pandas(spark, random_bars):
    got = collected(gold(spark.createDataFrame(random_bars, BARS), warm=False))
    assert list(got.columns) == ["symbol", "date", *GOLD_COLUMNS]
    for symbol, g in random_bars.groupby("symbol"):
        want = expected_gold(g.reset_index(drop=True))
        mine = got[got.symbol == symbol].reset_index(drop=True)
        for c in GOLD_COLUMNS:
            np.testing.assert_allclose(mine[c].astype(float), want[c], rtol=1e-9, atol=1e-9, equal_nan=True, err_msg=c)


def test_warm_rows_have_full_history(spark, random_bars):
    got = collected(gold(spark.createDataFrame(random_bars, BARS)))
    for symbol, n in (("HOT", 900), ("B", 120)):
        assert (got.symbol == symbol).sum() == n - 63
    assert got[["sma_63", "volatility_63d", "rsi_14"]].notna().all().all()
    assert (got.symbol == "C").sum() == 0


def test_engineered_set(spark, random_bars):
    names = engineered_columns()
    assert len(names) == len(set(names)) == 77
    got = collected(engineered(spark.createDataFrame(random_bars, BARS)))
    assert got[names].notna().all().all()
    g = random_bars[random_bars.symbol == "HOT"].reset_index(drop=True)
    mine = got[got.symbol == "HOT"].reset_index(drop=True)
    at = g.date.isin(mine.date)
    returns = g.close / g.close.shift(1) - 1
    np.testing.assert_allclose(mine.return_lag_21, returns.shift(21)[at], rtol=1e-9)
    np.testing.assert_allclose(mine.zscore_10, ((g.close - g.close.rolling(10).mean()) / g.close.rolling(10).std())[at])
    span = g.close.rolling(21).max() - g.close.rolling(21).min()
    np.testing.assert_allclose(mine.range_position_21, ((g.close - g.close.rolling(21).min()) / span)[at])
    term = 0.5 * np.log(g.high / g.low) ** 2 - (2 * np.log(2) - 1) * np.log(g.close / g.open) ** 2
    np.testing.assert_allclose(mine.gk_volatility, np.sqrt(term.rolling(21).mean() * 252)[at])


def test_tiny_by_hand(bars):
    got = collected(gold(bars({"A": TINY}), warm=False))
    assert got.sma_5[3:6].tolist()[1:] == [1.8, 2.0]
    assert got.obv.tolist() == [0, 10, 20, 10, 0, 10, 20, 30, 20, 10]
    # Gains 1+1+0+0+1+1 and losses 1+1 of rows 1..7, the first change being 0.
    assert got.rsi_7[6] == pytest.approx(100 - 100 / (1 + 4 / 2))
    assert pd.isna(got.rsi_7[5])
    assert got.future_return_5d[4] == 1.0 and got.target_direction_5d[4] == 1
    assert got.target_direction_5d[5:].isna().all()


def test_tail_label_zero(bars):
    got = collected(gold(bars({"A": TINY}), warm=False, tail_label="zero"))
    assert (got.target_direction_5d[5:] == 0).all() and got.future_return_5d[5:].isna().all()
    with pytest.raises(ValueError):
        gold(bars({"A": TINY}), tail_label="other")


def test_rise_flat_short_one(bars):
    got = collected(engineered(bars({"RISE": range(1, 31), "FLAT": [5] * 30, "SHORT": range(1, 21), "ONE": [7]}), complete=False))
    rise, flat = got[got.symbol == "RISE"], got[got.symbol == "FLAT"]
    assert rise.rsi_14.isna().all()
    assert (flat.std_21.dropna() == 0).all() and flat.std_21.notna().any()
    for c in ("zscore_5", "range_position_5", "bb_position"):
        assert flat[c].isna().all()
    assert got[got.symbol == "SHORT"][["sma_21", "sma_63"]].isna().all().all()
    one = got[got.symbol == "ONE"].iloc[0]
    assert pd.isna(one.close_lag_1) and one.obv == 0 and one.macd == 0
    assert not np.isinf(got.select_dtypes("number").to_numpy(dtype=float)).any()


def test_first_true_range_is_high_minus_low(bars):
    got = collected(engineered(bars({"A": [5] * 14}), complete=False))
    assert got.atr_14[13] == 2.0


def test_no_look_ahead_and_symbol_independence(spark, random_bars):
    full = spark.createDataFrame(random_bars, BARS)
    cut = random_bars[random_bars.symbol == "B"].date.iloc[90]
    features = [c for c in GOLD_COLUMNS if c not in ("target_direction_5d", "future_return_5d")]
    whole = collected(gold(full).filter((F.col("symbol") == "B") & (F.col("date") <= cut)))
    part = collected(gold(full.filter((F.col("symbol") == "B") & (F.col("date") <= cut))))
    pd.testing.assert_frame_equal(whole[["date", *features]], part[["date", *features]])


def test_signal_is_the_average_of_the_macd(spark, random_bars):
    got = collected(with_averages(spark.createDataFrame(random_bars, BARS)))
    assert set(macd_columns()) <= set(got.columns)
    for _, g in got.groupby("symbol"):
        np.testing.assert_allclose(g.macd_signal, g.macd.ewm(span=9, adjust=False).mean(), atol=1e-11)


def test_calendar(spark):
    days = pd.date_range("2020-01-27", periods=70)
    df = spark.createDataFrame([(d.date(),) for d in days], "date date")
    got = collected(with_calendar(df), "date")
    assert (got.day_of_week == days.dayofweek).all() and (got.quarter == days.quarter).all()
    assert (got.is_month_end == days.is_month_end).all() and (got.is_month_start == days.is_month_start).all()


def test_continued_features_equal_a_rebuild(spark, random_bars):
    bars = spark.createDataFrame(random_bars, BARS)
    cut = F.lit(dt.date(2023, 6, 1))
    # B is new after the cut and C has no stored row; HOT continues from its stored state.
    stored = gold(bars.filter((F.col("date") < cut) & (F.col("symbol") == "HOT"))).cache()
    final = stored.orderBy(F.desc("date")).collect()[5].date
    got = collected(continue_gold(bars, stored))
    want = collected(gold(bars).filter((F.col("symbol") != "HOT") | (F.col("date") > F.lit(final))))
    assert got[["symbol", "date"]].equals(want[["symbol", "date"]]) and len(got[got.symbol == "HOT"]) > 100
    for c in GOLD_COLUMNS:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9, err_msg=c)
