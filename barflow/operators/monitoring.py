"""Prediction outcomes, accuracy, staleness and performance per period."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barflow.functions.series import DAILY, Frames, Series, in_blocks, in_recent_days
from barflow.operators.modeling import classifier_scores, confusion, recent_outcomes

# Thresholds of the monitor.
HIGH_CONFIDENCE = 0.7
STALE_DAYS, WATCH_DAYS = 30, 14
LOW_ACCURACY = 0.5
RECENT = 20
LOOKBACK_DAYS = 30
TRADING_DAYS = 252


def outcome_bars(bars: DataFrame, horizon: int = 5, series: Series = DAILY) -> DataFrame:
    """Per bar: date, return and direction ``horizon`` bars later; bars without that future dropped."""

    def compute(f: Frames) -> None:
        change = F.try_divide(f.lead("close", horizon), F.col("close")) - 1
        f.out("outcome_date", f.lead("date", horizon))
        f.out("outcome_return", change)
        f.out("outcome_direction", (change > 0).cast("int"))

    found = in_blocks(bars.select("symbol", "date", "close"), compute, before=0, after=horizon, series=series)
    return found.filter(F.col("outcome_return").isNotNull()).drop("close")


def fill_outcomes(predictions: DataFrame, bars: DataFrame, as_of: str, horizon: int = 5) -> DataFrame:
    """Predictions whose outcome became known: direction, return, correctness and evaluation day.

    Only rows that are still open and whose outcome bar is not after ``as_of``.
    """
    day = F.lit(as_of).cast("date")
    outcomes = outcome_bars(bars, horizon).filter(F.col("outcome_date") <= day)
    open_rows = predictions.filter(F.col("actual_direction").isNull())
    values = [c for c in predictions.columns if c not in ("actual_direction", "actual_return", "is_correct")]
    return open_rows.join(
        outcomes.withColumnRenamed("date", "prediction_date"), ["symbol", "prediction_date"]
    ).select(
        *values,
        F.col("outcome_direction").alias("actual_direction"),
        F.col("outcome_return").alias("actual_return"),
        (F.col("predicted_direction") == F.col("outcome_direction")).alias("is_correct"),
        day.alias("evaluated_at"),
    )


def accuracy(predictions: DataFrame, bars: DataFrame) -> DataFrame:
    """Per symbol: hits of predictions that have a bar on their target day, and of the confident ones."""
    hit = F.col("predicted_direction") == F.col("actual_direction")
    confident = F.col("confidence") > HIGH_CONFIDENCE
    days = bars.select("symbol", F.col("date").alias("target_date"))
    matched = predictions.join(
        days.withColumn("_matched", F.lit(True)), ["symbol", "target_date"], "left"
    )
    known = F.col("_matched").isNotNull()
    counts = matched.groupBy("symbol").agg(
        F.count_if(known).alias("total_predictions"),
        F.count_if(known & hit).alias("_hits"),
        F.count_if(known & confident).alias("high_confidence_count"),
        F.count_if(known & confident & hit).alias("_confident_hits"),
        F.min(F.when(known, F.col("target_date"))).alias("period_start"),
        F.max(F.when(known, F.col("target_date"))).alias("period_end"),
    )

    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.round(F.try_divide(F.col(part), F.col(whole)), 4), F.lit(0.0))

    return counts.select(
        "symbol",
        F.when(F.col("total_predictions") > 0, "evaluated").otherwise("no_matching_dates").alias("status"),
        "total_predictions",
        share("_hits", "total_predictions").alias("accuracy"),
        share("_confident_hits", "high_confidence_count").alias("high_confidence_accuracy"),
        "high_confidence_count", "period_start", "period_end",
    )


def accuracy_of(predictions: DataFrame, bars: DataFrame, symbols: DataFrame) -> DataFrame:
    """``accuracy`` for every wanted symbol; one without predictions is ``insufficient_data``."""
    found = accuracy(predictions, bars)
    return symbols.select("symbol").join(found, "symbol", "left").withColumn(
        "status", F.coalesce(F.col("status"), F.lit("insufficient_data"))
    )


def staleness(trained: DataFrame, as_of: str, max_age_days: int = STALE_DAYS) -> DataFrame:
    """Model age in days from (symbol, trained_at) and whether it is too old."""
    age = F.datediff(F.lit(as_of).cast("date"), F.col("trained_at"))
    return trained.select(
        "symbol",
        age.cast("long").alias("model_age_days"),
        (age > max_age_days).alias("is_stale"),
        F.when(age > max_age_days, "RETRAIN").otherwise("OK").alias("recommendation"),
    )


def recent_accuracy(evaluated: DataFrame, n: int = RECENT) -> DataFrame:
    """Share of hits among the newest ``n`` evaluated predictions of each symbol."""
    hit = (F.col("predicted_direction") == F.col("actual_direction")).cast("int")
    return recent_outcomes(evaluated, n).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_recent"), F.round(F.avg(hit), 4).alias("recent_accuracy")
    )


def recommendation(age: Column, recent: Column) -> Column:
    return (
        F.when(age > STALE_DAYS, "RETRAIN_STALE_MODEL")
        .when(recent < LOW_ACCURACY, "RETRAIN_LOW_ACCURACY")
        .when(age > WATCH_DAYS, "MONITOR_CLOSELY")
        .otherwise("NO_ACTION_NEEDED")
    )


def monitor(
    trained: DataFrame, evaluated: DataFrame, drift: DataFrame, as_of: str
) -> DataFrame:
    """One row per symbol: age, recent accuracy, drift and the recommended action."""
    ages = staleness(trained, as_of).drop("recommendation")
    hits = recent_accuracy(evaluated)
    drifted = drift.select("symbol", "drifted_features", "total_features")
    return (
        ages.join(hits, "symbol", "left")
        .join(drifted, "symbol", "left")
        .select(
            "symbol", "model_age_days", "is_stale",
            (F.coalesce(F.col("drifted_features"), F.lit(0)) > 0).alias("drift_detected"),
            F.coalesce(F.col("drifted_features"), F.lit(0)).cast("long").alias("drifted_features"),
            F.coalesce(F.col("total_features"), F.lit(0)).cast("long").alias("total_features"),
            "recent_accuracy",
            recommendation(F.col("model_age_days"), F.col("recent_accuracy")).alias("recommendation"),
        )
    )


def rolling_accuracy(evaluated: DataFrame, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Hits over the last ``days`` calendar days at each evaluated prediction."""
    hit = (F.col("predicted_direction") == F.col("actual_direction")).cast("int")
    known = evaluated.filter(F.col("actual_direction").isNotNull()).select(
        "symbol", F.col("prediction_date").alias("date"), hit.alias("hit")
    )
    return in_recent_days(
        known, {"n_predictions": F.count("hit"), "rolling_accuracy": F.avg("hit")}, days
    ).drop("hit")


def performance_by_period(evaluated: DataFrame, horizon: int = 5) -> DataFrame:
    """Scores, Sharpe ratio and largest drawdown per symbol, model version and calendar quarter.

    The return of a prediction is the actual return, with its sign turned for a DOWN prediction.
    A quarter holds at most one prediction per day, so its running equity fits one task.
    """
    known = evaluated.filter(F.col("actual_direction").isNotNull())
    gain = F.when(F.col("predicted_direction") == 1, F.col("actual_return")).otherwise(-F.col("actual_return"))
    period = F.trunc("prediction_date", "quarter")
    rows = known.select(
        "symbol", "model_version", period.alias("period_start"), "prediction_date",
        F.col("predicted_direction").alias("prediction"), F.col("actual_direction").alias("label"),
        gain.alias("gain"),
    )
    upto = (
        Window.partitionBy("symbol", "model_version", "period_start").orderBy("prediction_date")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    # A loss of everything leaves no equity for the rest of the period.
    factor = F.greatest(1 + F.col("gain"), F.lit(0.0))
    equity = F.when(F.min(factor).over(upto) > 0, F.exp(F.sum(F.ln(factor)).over(upto))).otherwise(0.0)
    rows = rows.withColumn("equity", equity)
    rows = rows.withColumn("drawdown", F.col("equity") / F.greatest(F.max("equity").over(upto), F.lit(1.0)) - 1)
    counts = rows.groupBy("symbol", "model_version", "period_start").agg(
        F.count(F.lit(1)).alias("n_predictions"),
        *confusion(),
        F.avg("gain").alias("_mean"), F.stddev_samp("gain").alias("_std"),
        F.min("drawdown").alias("max_drawdown"),
    )
    sharpe = F.try_divide(F.col("_mean"), F.col("_std")) * math.sqrt(TRADING_DAYS / horizon)
    return counts.select(
        "symbol", "model_version", "period_start",
        F.date_sub(F.add_months("period_start", 3), 1).alias("period_end"),
        "n_predictions",
        *[c.alias(k) for k, c in classifier_scores().items()],
        sharpe.alias("sharpe_ratio"),
        F.least(F.col("max_drawdown"), F.lit(0.0)).alias("max_drawdown"),
    )
