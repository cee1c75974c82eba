"""Piecewise series operators against pandas, with pieces far smaller than the series."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barflow.functions.series import (
    Series, in_blocks, in_recent_days, last_rows, number_rows, spread_join, with_next, with_previous,
    with_running_total, with_scans,
)
from barflow.operators.reports import latest_rows
from barflow.schemas import BARS
from helpers import collected

SMALL = Series(slots=16)
#: Two groups of levels above the buckets, and groups shorter than the series.
LEVELS = Series(slots=2, fan=128)


@pytest.fixture(scope="module")
def data(spark, random_bars):
    return spark.createDataFrame(random_bars, BARS).cache()


def by_symbol(frame):
    return [g.reset_index(drop=True) for _, g in frame.groupby("symbol")]


@pytest.mark.parametrize("series", [SMALL, LEVELS])
def test_row_numbers_run_over_pieces(data, series):
    got = collected(number_rows(data, series))
    for g in by_symbol(got):
        assert (g.row_pos == np.arange(len(g))).all()
        assert (g.row_total == len(g)).all()


def test_last_rows(data):
    got = collected(last_rows(data, 7, SMALL))
    want = collected(data).groupby("symbol").tail(7).reset_index(drop=True)
    assert (got[want.columns] == want).all().all()
    assert sorted(got.recency.unique()) == list(range(1, 8))


@pytest.mark.parametrize("series", [SMALL, LEVELS])
def test_carry_forward_and_back(data, series):
    sparse = data.withColumn("x", F.when(F.pmod(F.xxhash64("symbol", "date"), F.lit(40)) == 0, F.col("close")))
    got = collected(with_next(with_previous(sparse, {"p": F.col("x")}, series), {"n": F.col("x")}, series))
    assert got.x.notna().any() and got.p.isna().any()
    for g in by_symbol(got):
        pd.testing.assert_series_equal(g.p, g.x.ffill().shift(1), check_names=False)
        pd.testing.assert_series_equal(g.n, g.x.bfill().shift(-1), check_names=False)


@pytest.mark.parametrize("series", [SMALL, LEVELS])
def test_running_total(data, series):
    got = collected(with_running_total(data, {"t": F.col("volume")}, series))
    for g in by_symbol(got):
        assert (g.t == g.volume.cumsum()).all()


@pytest.mark.parametrize("series", [Series(slots=8), SMALL, LEVELS, Series()])
def test_exponential_averages_and_balance(data, series):
    spans = {"one": 1, "two": 2, "nine": 9, "slow": 300}
    got = collected(with_scans(data, spans, balance=("obv", "volume"), series=series))
    for g in by_symbol(got):
        for name, span in spans.items():
            want = g.close.ewm(span=span, adjust=False).mean()
            np.testing.assert_allclose(g[name], want, rtol=1e-12)
        want = (np.sign(g.close.diff()) * g.volume).fillna(0).cumsum()
        np.testing.assert_allclose(g.obv, want)
        assert (g.row_pos == np.arange(len(g))).all()


@pytest.mark.parametrize("series", [SMALL, LEVELS])
def test_scan_continues_from_a_seed(data, series):
    spans = {"fast": 9, "slow": 26}
    whole = collected(with_scans(data, spans, balance=("obv", "volume"), series=series))
    split = "2022-03-05"
    head = with_scans(data.filter(F.col("date") < split), spans, balance=("obv", "volume"), series=series)
    tail = with_scans(
        data.filter(F.col("date") >= split), spans, balance=("obv", "volume"), series=series, seed=latest_rows(head))
    got = collected(head.unionByName(tail))
    for c in ("fast", "slow", "obv", "row_pos"):
        np.testing.assert_allclose(got[c], whole[c], rtol=1e-12)


def test_scan_refuses_nulls(bars):
    with pytest.raises(Exception, match="must be filled"):
        with_scans(bars({"A": [1, None, 3]}), {"e": 9}).collect()


@pytest.mark.parametrize("n", [2, 3, 4, 5, 14, 20, 21, 63, 64, 70])
def test_rolling_equals_pandas(data, n):
    def compute(f):
        for name in ("mean", "std", "min", "max"):
            f.out(name, getattr(f, name)("close", n))

    got = collected(in_blocks(data, compute, before=n - 1, block=80, series=SMALL))
    for g in by_symbol(got):
        r = g.close.rolling(n)
        for name in ("mean", "min", "max"):
            np.testing.assert_allclose(g[name], getattr(r, name)(), rtol=1e-12, equal_nan=True)
        # Window by window: the online deviation of pandas is less exact.
        std = r.apply(lambda x: x.std(ddof=1), raw=True)
        np.testing.assert_allclose(g["std"], std, rtol=1e-11, equal_nan=True)


def test_rolling_needs_a_full_window_of_values(bars):
    def compute(f):
        f.out("mean", f.mean("close", 3))
        f.out("max", f.max("close", 3))

    got = collected(in_blocks(bars({"A": [1, 2, 3, None, 5, 6, 7]}), compute, before=2))
    assert [None if pd.isna(v) else v for v in got["mean"]] == [None, None, 2, None, None, None, 6]
    assert [None if pd.isna(v) else v for v in got["max"]] == [None, None, 3, None, None, None, 7]


def test_flat_frames_have_no_deviation(bars):
    got = collected(in_blocks(bars({"A": [0.1 + 0.2] * 40}), lambda f: f.out("s", f.std("close", 21)), before=20))
    assert got.s.notna().sum() == 20 and (got.s.dropna() == 0).all()


def test_lag_and_lead_cross_blocks(data):
    def compute(f):
        f.out("back", f.lag("close", 21))
        f.out("ahead", f.lead("close", 5))

    got = collected(in_blocks(data, compute, before=21, after=5, block=25, series=SMALL))
    assert len(got) == data.count()
    for g in by_symbol(got):
        np.testing.assert_array_equal(g.back, g.close.shift(21))
        np.testing.assert_array_equal(g.ahead, g.close.shift(-5))


def test_calendar_frame(data):
    got = collected(in_recent_days(data, {"m": F.avg("close"), "n": F.count("close")}, 10, SMALL))
    for g in by_symbol(got):
        r = g.set_index(pd.to_datetime(g.date)).close.rolling("10D")
        np.testing.assert_allclose(g.m, r.mean().values)
        assert (g.n == r.count().values).all()


def test_spread_join_keeps_join_semantics(spark, data):
    small = spark.createDataFrame([("HOT", 1), ("C", 3)], "symbol string, k int")
    assert spread_join(data, small, ["symbol"]).count() == 940
    assert spread_join(data, small, ["symbol"], "left").count() == 1060
    assert spread_join(data, small, ["symbol"], "left_anti").select("symbol").distinct().collect()[0][0] == "B"


def test_hourly_series(spark):
    rows = spark.range(500).select(
        F.lit("A").alias("symbol"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 7200).alias("bar_time"),
        F.col("id").cast("double").alias("close"),
    )
    hourly = Series(order="bar_time", step_seconds=3600, slots=24)
    got = collected(number_rows(rows, hourly), "bar_time")
    assert (got.row_pos == got.close).all()


@pytest.mark.parametrize("years", [1, 9999])
def test_series_over_the_whole_time_axis(spark, years):
    """Days before 1970 and the far ends of the axis meet in the last level."""
    days = spark.range(0, years * 365, 1 if years == 1 else 61).select(
        F.lit("A").alias("symbol"), (F.col("id") % 89 + 1).cast("double").alias("close"),
        F.date_add(F.lit("0001-01-01" if years > 1 else "1969-08-01").cast("date"), F.col("id").cast("int")).alias("date"))
    got = with_scans(days, {"e": 20}, series=Series(slots=8, fan=64)).orderBy("row_pos").select("row_pos", "close", "e").toPandas()
    assert (got.row_pos == np.arange(len(got))).all() and len(got) == -(-years * 365 // (1 if years == 1 else 61))
    np.testing.assert_allclose(got.e, got.close.ewm(span=20, adjust=False).mean(), rtol=1e-12)


def test_ten_million_seconds_of_one_series(spark):
    """A grid of seconds: 20,000 buckets of one series, scanned in groups of the fan."""
    seconds = spark.range(10_000_000).select(
        F.lit("HOT").alias("symbol"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("bar_time"),
        (F.col("id") % 97 + 1).cast("double").alias("close"), F.lit(1).alias("volume"))
    grid = Series(order="bar_time", step_seconds=1)
    assert grid.buckets > grid.fan
    got = with_scans(seconds, {"e": 3, "slow": 5000}, balance=("obv", "volume"), series=grid)
    id_ = F.unix_seconds("bar_time") - 1_700_000_000
    rows, wrong, total = got.agg(
        F.count(F.lit(1)), F.count_if(F.col("row_pos") != id_), F.max("row_total")).first()
    assert (rows, wrong, total) == (10_000_000, 0, 10_000_000)
    close = pd.Series(np.arange(10_000_000) % 97 + 1.0)
    obv = np.sign(close.diff()).fillna(0).cumsum()
    want = {k: close.ewm(span=span, adjust=False).mean() for k, span in (("e", 3), ("slow", 5000))}
    some = got.filter(F.pmod(id_, F.lit(99_991)) == 0).toPandas()
    for k, series in {**want, "obv": obv}.items():
        np.testing.assert_allclose(some[k], series.to_numpy()[some.row_pos], rtol=1e-9)


def test_no_task_gets_a_whole_hot_series(spark):
    """The widest group of any window over rows is one bucket or block, not the series."""
    days = spark.range(20_000).select(
        F.lit("HOT").alias("symbol"),
        F.date_add(F.lit("1960-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
        (F.col("id") % 97 + 1).cast("double").alias("close"),
    )
    plan = in_blocks(days, lambda f: f.out("m", f.mean("close", 5)), before=4)
    text = plan._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in text.splitlines() if "Window [" in line]
    over_rows = [line for line in windows if "_bucket" in line.rsplit("], [", 1)[0] or "_block" in line]
    assert over_rows
    # Windows over the symbol alone only see bucket summaries.
    for line in windows:
        if line not in over_rows:
            assert "sum(n" in line
    assert plan.count() == 20_000
