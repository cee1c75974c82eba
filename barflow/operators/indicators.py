"""Technical indicators and the two feature sets, for all symbols in one plan.

Order of work: prefix operators on buckets (exponential averages, on-balance volume, row position),
then one pass over blocks in which all finite frames share one shuffle and one sort.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.functions.scalars import log_ratio, ratio
from barflow.functions.series import (
    DAILY, POSITION, TOTAL, Frames, Series, in_blocks, last_rows, spread_join, with_scans,
)
from barflow.session import staged

TRADING_DAYS = 252
RETURNS = (1, 5, 21)
LAGS = (1, 2, 3, 5, 10, 21)
WINDOWS = (5, 10, 21, 63)
BAND = 20
HORIZON = 5
HISTORY = max(WINDOWS)  # rows before a bar that its frames reach: the longest frame, and one change

# Fixed column lists: the stored feature row, and the wider engineered set.
GOLD_FEATURES = (
    "sma_5", "sma_10", "sma_21", "sma_63", "ema_12", "ema_26",
    "volatility_21d", "volatility_63d", "atr_14", "rsi_14", "rsi_7",
    "macd", "macd_signal", "macd_histogram",
    "bb_upper", "bb_lower", "bb_width", "bb_position",
    "volume_sma_21", "volume_ratio_21", "obv",
    "return_1d", "return_5d", "return_21d",
    "close_lag_1", "close_lag_5", "close_lag_21",
)
GOLD_TARGETS = ("target_direction_5d", "future_return_5d")
GOLD_COLUMNS = (*GOLD_FEATURES, *GOLD_TARGETS)

EMA_SPANS = {"ema_9": 9, "ema_12": 12, "ema_26": 26}


def _signal_weights(span: int) -> tuple[float, float]:
    """Weights (slow, fast) with which ema9(ema_span) = slow * ema_span - fast * ema_9.

    An average of an average is a weighted difference of the two: with a = 2/(span+1) and r = 1-a,
    ema9(ema_s) = (a9*r_s*ema_s - a_s*r9*ema_9) / (r_s - r9).
    """
    a, a9 = 2.0 / (span + 1), 2.0 / (9 + 1)
    r, r9 = 1.0 - a, 1.0 - a9
    return a9 * r / (r - r9), a * r9 / (r - r9)


def macd_columns() -> dict[str, Column]:
    """MACD, its 9-row signal and the histogram from the averages of span 9, 12 and 26.

    The signal is the average of span 9 over ``ema_12 - ema_26``; it needs no second recursion.
    """
    (slow_12, fast_12), (slow_26, fast_26) = _signal_weights(12), _signal_weights(26)
    macd = F.col("ema_12") - F.col("ema_26")
    signal = (slow_12 * F.col("ema_12") - fast_12 * F.col("ema_9")) - (
        slow_26 * F.col("ema_26") - fast_26 * F.col("ema_9")
    )
    return {"macd": macd, "macd_signal": signal, "macd_histogram": macd - signal}


def _ema_9_of_signal() -> Column:
    """The average of span 9 that stored columns imply (the signal solved for it)."""
    (slow_12, fast_12), (slow_26, fast_26) = _signal_weights(12), _signal_weights(26)
    rest = slow_12 * F.col("_ema_12") - slow_26 * F.col("_ema_26") - F.col("_macd_signal")
    return rest / (fast_12 - fast_26)


def with_averages(df: DataFrame, series: Series = DAILY) -> DataFrame:
    """ema_9/12/26, macd, macd_signal, macd_histogram, obv, row_pos and row_total."""
    scanned = with_scans(df, EMA_SPANS, balance=("obv", "volume"), series=series)
    return scanned.withColumns(macd_columns())


def lags(f: Frames, columns: Sequence[str] = ("close", "volume"), periods: Sequence[int] = LAGS) -> None:
    for c in columns:
        for k in periods:
            f.out(f"{c}_lag_{k}", f.lag(c, k))


def return_lags(f: Frames, periods: Sequence[int] = LAGS) -> None:
    """Daily return k rows ago, from the two closes it was made of."""
    for k in periods:
        f.out(f"return_lag_{k}", ratio(f.lag("close", k), f.lag("close", k + 1)) - 1)


def returns(f: Frames, periods: Sequence[int] = RETURNS, log_periods: Sequence[int] = (1, 5)) -> None:
    close = F.col("close")
    for k in periods:
        f.out(f"return_{k}d", ratio(close, f.lag("close", k)) - 1)
    for k in log_periods:
        f.out(f"log_return_{k}d", log_ratio(close, f.lag("close", k)))


def sma(f: Frames, windows: Sequence[int] = WINDOWS) -> None:
    for n in windows:
        f.out(f"sma_{n}", f.mean("close", n))


def rolling_stats(f: Frames, windows: Sequence[int] = WINDOWS) -> None:
    """Per window: std, z-score, min, max and position in the range (null when flat)."""
    close = F.col("close")
    for n in windows:
        low, high, dev = f.min("close", n), f.max("close", n), f.std("close", n)
        f.out(f"std_{n}", dev)
        f.out(f"zscore_{n}", ratio(close - f.mean("close", n), dev))
        f.out(f"rolling_min_{n}", low)
        f.out(f"rolling_max_{n}", high)
        f.out(f"range_position_{n}", ratio(close - low, high - low))


def volume_stats(f: Frames, windows: Sequence[int] = WINDOWS) -> None:
    for n in windows:
        mean = f.mean("volume", n)
        f.out(f"volume_sma_{n}", mean)
        f.out(f"volume_ratio_{n}", ratio(F.col("volume"), mean))


def rsi(f: Frames, periods: Sequence[int] = (14, 7)) -> None:
    """Relative strength index on simple means; null when there was no loss.

    The first change of a series counts as zero, so the first value is at row n.
    """
    change = F.col("close") - f.lag("close")
    gain = f.row("_gain", F.when(change > 0, change).otherwise(0.0))
    loss = f.row("_loss", F.when(change < 0, -change).otherwise(0.0))
    for n in periods:
        strength = ratio(f.mean(gain, n), f.mean(loss, n))
        f.out(f"rsi_{n}", 100 - ratio(F.lit(100.0), 1 + strength))


def bollinger(f: Frames, n: int = BAND) -> None:
    close, mid = F.col("close"), f.mean("close", n)
    dev = f.std("close", n)
    upper, lower = mid + 2 * dev, mid - 2 * dev
    f.out("bb_upper", upper)
    f.out("bb_lower", lower)
    f.out("bb_width", ratio(upper - lower, mid))
    f.out("bb_position", ratio(close - lower, upper - lower))


def atr(f: Frames, n: int = 14) -> None:
    """Mean true range; ``greatest`` skips the null previous close of the first row."""
    high, low, prev = F.col("high"), F.col("low"), f.lag("close")
    true_range = f.row("_range", F.greatest(high - low, F.abs(high - prev), F.abs(low - prev)))
    f.out(f"atr_{n}", f.mean(true_range, n))


def volatility(f: Frames, windows: Sequence[int] = (21, 63), log_return: str | None = None) -> None:
    """Realised volatility per year, from a stored log return column or from closes."""
    if log_return is None:
        log_return = f.row("_log_return", log_ratio(F.col("close"), f.lag("close")))
    for n in windows:
        f.out(f"volatility_{n}d", f.std(log_return, n) * math.sqrt(TRADING_DAYS))


def range_volatility(f: Frames, n: int = 21) -> None:
    """Garman-Klass volatility per year, and the range of the day relative to its open."""
    opened, high, low, close = (F.col(c) for c in ("open", "high", "low", "close"))
    high_low, close_open = F.pow(log_ratio(high, low), 2), F.pow(log_ratio(close, opened), 2)
    term = f.row("_term", 0.5 * high_low - (2 * math.log(2) - 1) * close_open)
    variance = f.mean(term, n) * TRADING_DAYS
    f.out("gk_volatility", F.when(variance >= 0, F.sqrt(variance)))
    f.out("intraday_range", ratio(high - low, opened))


def target(
    f: Frames, horizon: int = HORIZON, tail_label: str = "null",
    names: tuple[str, str] = ("target_direction_5d", "future_return_5d"),
) -> None:
    """Future return and its direction.

    The last ``horizon`` rows have no future: their label is null, or 0 with ``tail_label="zero"``.
    """
    if tail_label not in ("null", "zero"):
        raise ValueError(f"tail_label is 'null' or 'zero', got {tail_label!r}")
    future = ratio(f.lead("close", horizon), F.col("close")) - 1
    label = (future > 0).cast("int")
    f.out(names[0], F.coalesce(label, F.lit(0)) if tail_label == "zero" else label)
    f.out(names[1], future)


def with_calendar(df: DataFrame) -> DataFrame:
    day = F.col("date")
    return df.withColumns({
        "day_of_week": F.weekday(day),
        "month": F.month(day),
        "quarter": F.quarter(day),
        "is_month_start": (F.dayofmonth(day) == 1).cast("int"),
        "is_month_end": (F.last_day(day) == day).cast("int"),
    })


def _feature_rows(
    averaged: DataFrame, horizon: int, tail_label: str, warm: bool, series: Series,
    only: Column | None = None,
) -> DataFrame:
    """The stored feature row from bars that already have the prefix columns."""
    stored = "return_log" if "return_log" in averaged.columns else None

    def compute(f: Frames) -> None:
        sma(f)
        volatility(f, log_return=stored)
        atr(f)
        rsi(f)
        bollinger(f)
        volume_stats(f, windows=(21,))
        returns(f, log_periods=())
        lags(f, ("close",), RETURNS)
        target(f, horizon, tail_label)
        if warm:
            # Means are known exactly where sma_63 and volatility_63d are, and cheaper to test.
            f.require(f.mean("close", 63).isNotNull() & f.mean(stored or "_log_return", 63).isNotNull())
            f.require(f.mean("_loss", 14) > 0)
        if only is not None:
            f.require(only)

    featured = in_blocks(averaged, compute, before=HISTORY, after=horizon, series=series)
    return featured.select(*series.keys, series.order, *GOLD_COLUMNS)


def gold(
    silver: DataFrame, horizon: int = HORIZON, tail_label: str = "null", warm: bool = True,
    series: Series = DAILY,
) -> DataFrame:
    """Feature row per bar (27 features, 2 targets); ``warm`` keeps rows with full history only."""
    return _feature_rows(with_averages(silver, series), horizon, tail_label, warm, series)


def continue_gold(
    silver: DataFrame, stored: DataFrame, horizon: int = HORIZON, series: Series = DAILY
) -> DataFrame:
    """Feature rows to write after ``stored``: new bars, and stored rows whose target was still open.

    The prefix columns continue from the newest stored row that is final, and the frames reach back
    over the bars they need, so the history before them is not computed again. A series with too few
    stored rows is computed as a whole. The bars in question are staged, as several branches read them.
    """
    state = ("ema_12", "ema_26", "macd_signal", "obv")
    recent = last_rows(stored.select("symbol", "date", *state), horizon + 1 + HISTORY, series)
    final = F.col("recency") == horizon + 1
    marks = recent.groupBy("symbol").agg(
        F.max(F.when(final, F.col("date"))).alias("_final"),
        F.max(F.when(F.col("recency") == horizon + 1 + HISTORY, F.col("date"))).alias("_reach"),
        *[F.max(F.when(final, F.col(c))).alias(f"_{c}") for c in state],
    )
    # Without bars to reach back over, the whole series is new.
    marks = staged(marks.filter(F.col("_reach").isNotNull()), "marks")
    bars = staged((
        spread_join(silver, marks.select("symbol", "_final", "_reach"), ["symbol"], "left")
        .filter(F.col("_reach").isNull() | (F.col("date") >= F.col("_reach")))
        .withColumn("_new", F.col("_reach").isNull() | (F.col("date") > F.col("_final")))
        .drop("_final", "_reach")
    ), "recent-bars")
    last_bar = bars.select("symbol", F.col("date").alias("_final"), "close")
    seed = marks.join(last_bar, ["symbol", "_final"]).select(
        "symbol", F.lit(0).cast("long").alias("row_pos"), "close",
        F.col("_ema_12").alias("ema_12"), F.col("_ema_26").alias("ema_26"), F.col("_obv").alias("obv"),
        _ema_9_of_signal().alias("ema_9"),
    )
    fresh = with_scans(
        bars.filter("_new"), EMA_SPANS, balance=("obv", "volume"), series=series, seed=seed
    ).drop(POSITION, TOTAL).withColumns(macd_columns())
    both = fresh.unionByName(bars.filter("NOT _new"), allowMissingColumns=True)
    return _feature_rows(staged(both, "continued"), horizon, "null", True, series, only=F.col("_new"))


def engineered_columns(periods=LAGS, windows=WINDOWS) -> list[str]:
    """Names of the engineered set, in order."""
    names = [*(f"return_{k}d" for k in RETURNS), "log_return_1d", "log_return_5d"]
    for k in periods:
        names += [f"close_lag_{k}", f"return_lag_{k}", f"volume_lag_{k}"]
    for n in windows:
        names += [
            f"sma_{n}", f"std_{n}", f"zscore_{n}", f"volume_sma_{n}", f"volume_ratio_{n}",
            f"rolling_min_{n}", f"rolling_max_{n}", f"range_position_{n}",
        ]
    names += [
        "rsi_14", "rsi_7", "macd", "macd_signal", "macd_histogram",
        "bb_upper", "bb_lower", "bb_width", "bb_position", "atr_14", "obv",
        "volatility_21d", "volatility_63d", "gk_volatility", "intraday_range",
        "day_of_week", "month", "quarter", "is_month_start", "is_month_end",
        "future_return", "target",
    ]
    return names


def engineered(
    bars: DataFrame, periods: Sequence[int] = LAGS, windows: Sequence[int] = WINDOWS,
    horizon: int = HORIZON, tail_label: str = "null", complete: bool = True,
    series: Series = DAILY,
) -> DataFrame:
    """Engineered set (77 columns by default); ``complete`` drops every row with a null."""

    def compute(f: Frames) -> None:
        returns(f)
        lags(f, ("close", "volume"), periods)
        return_lags(f, periods)
        sma(f, windows)
        rolling_stats(f, windows)
        volume_stats(f, windows)
        rsi(f)
        bollinger(f)
        atr(f)
        volatility(f)
        range_volatility(f)
        target(f, horizon, tail_label, names=("target", "future_return"))

    featured = in_blocks(
        with_averages(bars, series), compute, before=max(*windows, 63, max(periods) + 1),
        after=horizon, series=series,
    )
    names = engineered_columns(periods, windows)
    featured = with_calendar(featured).select(*bars.columns, *names)
    return featured.dropna("any") if complete else featured
