import datetime as dt
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barflow.operators import clean
from barflow.functions import scalars
from barflow.functions.series import Series
from barflow.schemas import BRONZE, overflows, to_stored_precision
from helpers import START, collected


def raw(spark, rows, symbol="A"):
    """Rows of (day offset, open, high, low, close, volume[, hour of ingest])."""
    full = []
    for r in rows:
        day, o, h, l, c, v, *hour = r
        hour = hour[0] if hour else 0
        full.append((symbol, START + dt.timedelta(days=day), o, h, l, c, c, v, "s",
                     dt.datetime(2021, 1, 1, hour), f"b{hour}"))
    return spark.createDataFrame(full, BRONZE)


def test_dedup_keeps_newest_of_very_many(spark):
    hot = spark.range(50_000).select(
        F.lit("A").alias("symbol"), F.lit(START).alias("date"), F.col("id").alias("ingested_at"),
        F.lit("s").alias("source"), (F.col("id") * 2).alias("close"))
    assert [tuple(r) for r in clean.dedup_last(hot).collect()] == [("A", START, 49_999, "s", 99_998)]
    assert clean.dedup_first(hot, ["symbol", "date"]).first().close == 0


def test_silver_scores_before_fill_and_swaps_after(spark):
    df = raw(spark, [
        (0, 10.0, 12.0, 9.0, 11.0, 5),
        (1, None, 8.0, 9.0, 12.0, 0),      # open missing, volume 0, high below low
        (2, 10.0, 12.0, 9.0, None, None),  # close missing, volume unknown
        (3, 10.0, 12.0, 9.0, 24.0, 5),
        (3, 10.0, 12.0, 9.0, 22.0, 5, 1),  # second delivery wins
    ])
    got = collected(clean.silver(df))
    assert got.quality_score.tolist() == [Decimal("1.00"), Decimal("0.30"), Decimal("0.70"), Decimal("1.00")]
    assert got.is_imputed.tolist() == [False, True, True, False]
    assert got.high[1] == 9.0 and got.low[1] == 8.0 and got.open[1] == 10.0
    assert got.close.tolist() == [11.0, 12.0, 12.0, 22.0] and got.volume.tolist() == [5, 0, 0, 5]
    assert pd.isna(got.return_simple[0]) and got.return_simple[3] == pytest.approx(22 / 12 - 1)
    assert got.batch_id.tolist() == ["b0", "b0", "b0", "b1"]


def test_leading_unknown_prices_go_to_quarantine(spark):
    df = raw(spark, [(0, 1.0, None, 1.0, None, 5), (1, 1.0, None, 1.0, 2.0, 5), (2, 1.0, 3.0, 1.0, 3.0, 5)])
    assert collected(clean.silver(df)).close.tolist() == [3.0]
    held = collected(clean.quarantine(df)).close
    assert held.isna().tolist() == [True, False] and held[1] == 2.0


def test_impute_strategies(spark):
    df = raw(spark, [
        (0, None, 1.0, 1.0, None, None), (1, 1.0, 1.0, 1.0, 10.0, 4), (2, 1.0, 1.0, 1.0, None, 4),
        (6, 1.0, 1.0, 1.0, 20.0, 4), (7, 1.0, 1.0, 1.0, None, 8)])
    small = Series(slots=2)
    assert collected(clean.impute(df, "ffill", small)).close.tolist() == [10, 10, 10, 20, 20]
    got = collected(clean.impute(df, "interpolate", small))
    assert got.close.tolist() == [10, 10, 12, 20, 20] and got.volume.tolist()[0] == 4
    assert collected(clean.impute(df, "drop")).close.tolist() == [10.0, 20.0]
    with pytest.raises(ValueError, match="unknown missing value strategy"):
        clean.impute(df, "guess")


def test_null_audit(spark):
    df = raw(spark, [(0, None, 1.0, 1.0, None, None), (1, 1.0, 1.0, 1.0, 10.0, 4)])
    assert tuple(clean.null_audit(df, clean.impute(df, "ffill")).first()) == ("A", 3, 0)


def test_outliers(bars):
    closes = [100 + (i % 2) for i in range(60)] + [1000] + [1000 + (i % 2) for i in range(20)]
    df = bars({"A": closes})
    got = collected(clean.preprocess(df, "ffill", outliers=True))
    want = pd.Series([float(c) for c in closes]).pct_change()
    keep = want.isna() | want.between(want.mean() - 4 * want.std(), want.mean() + 4 * want.std())
    assert len(got) == keep.sum() == 80


def test_coercion(spark):
    df = spark.createDataFrame([("1.5", "x", "7"), ("NaN", "2", "8.0")], "open string, close string, volume string")
    got = clean.coerce_numeric(df).collect()
    assert [tuple(r) for r in got] == [(1.5, None, 7), (None, 2.0, 8)]


def test_assert_clean(bars):
    clean.assert_clean(bars({"A": [1, 2]}))
    with pytest.raises(ValueError, match="non_positive_close"):
        clean.assert_clean(bars({"A": [1, 0]}))
    with pytest.raises(ValueError, match="repeated_days"):
        clean.assert_clean(bars({"A": [1]}).unionByName(bars({"A": [2]})))


def test_business_days_follow_pandas(spark):
    days = pd.date_range("2024-03-01", periods=14)
    df = spark.createDataFrame([(d.date(),) for d in days], "date date")
    for n in (1, 3, 4, 5, 6, 13):
        got = collected(df.select("date", scalars.add_business_days(F.col("date"), n).alias("t")), "date")
        assert [d + pd.offsets.BDay(n) for d in days] == [pd.Timestamp(t) for t in got.t]


def test_strings(spark):
    df = spark.createDataFrame([(" abcd4.sa, efgh3.sa ,, ",)], "t string")
    assert df.select(scalars.split_symbols(F.col("t"))).first()[0] == ["abcd4.sa", "efgh3.sa"]
    assert df.select(scalars.artifact_symbol(F.lit("abcd4.sa"))).first()[0] == "ABCD4_SA"


def test_stored_precision(spark):
    df = spark.createDataFrame([(0.00005, 55.126), (1e12, 12345.0)], "close double, rsi_14 double")
    got = to_stored_precision(df).collect()
    assert got[0].close == Decimal("0.0001") and got[1].close is None and got[1].rsi_14 is None
    assert df.agg(overflows(df).alias("n")).first().n == 2
