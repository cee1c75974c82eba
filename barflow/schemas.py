"""Schemas of the stored tables; values are double inside the pipeline, decimals are a write option."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BARS = (
    "symbol string, date date, open double, high double, low double, close double, "
    "adj_close double, volume bigint"
)
BRONZE = (
    "symbol string, date date, open double, high double, low double, close double, "
    "adj_close double, volume bigint, source string, ingested_at timestamp_ntz, batch_id string"
)
SILVER = (
    "symbol string, date date, open double, high double, low double, close double, "
    "adj_close double, volume bigint, return_simple double, return_log double, "
    "is_imputed boolean, quality_score decimal(3,2), batch_id string"
)
FEATURES_LONG = ("symbol string, date date, feature_name string, feature_value double")
ASSETS = ("symbol string, name string, sector string, currency string")
PREDICTIONS = (
    "symbol string, prediction_date date, target_date date, model_version string, "
    "predicted_direction int, confidence double, actual_direction int, actual_return double, "
    "is_correct boolean"
)
MODEL_METRICS = (
    "model_version string, trained_at timestamp, symbol string, metric_name string, "
    "metric_value double, n_train bigint, n_test bigint, hyperparameters string"
)
QUALITY_CHECKS = (
    "symbol string, check_date date, check_name string, passed boolean, details string"
)
INGESTION_LOG = (
    "batch_id string, symbol string, start_date date, end_date date, rows_ingested bigint, "
    "status string, error_message string"
)

# Decimal types of the stored columns.
STORED_DECIMALS = {
    **dict.fromkeys(["open", "high", "low", "close", "adj_close"], "decimal(12,4)"),
    **dict.fromkeys(["return_simple", "return_log"], "decimal(10,8)"),
    **dict.fromkeys(["sma_5", "sma_10", "sma_21", "sma_63", "ema_12", "ema_26"], "decimal(12,4)"),
    **dict.fromkeys(["atr_14", "bb_upper", "bb_lower"], "decimal(12,4)"),
    **dict.fromkeys(["close_lag_1", "close_lag_5", "close_lag_21"], "decimal(12,4)"),
    **dict.fromkeys(["volatility_21d", "volatility_63d", "bb_width"], "decimal(10,6)"),
    **dict.fromkeys(["rsi_14", "rsi_7"], "decimal(6,2)"),
    **dict.fromkeys(["macd", "macd_signal", "macd_histogram"], "decimal(12,6)"),
    "bb_position": "decimal(6,4)",
    "volume_ratio_21": "decimal(8,4)",
    **dict.fromkeys(["volume_sma_21", "obv"], "decimal(18,2)"),
    **dict.fromkeys(["return_1d", "return_5d", "return_21d", "future_return_5d"], "decimal(10,8)"),
}


def to_stored_precision(df: DataFrame) -> DataFrame:
    """Columns in their stored decimal type; a value that does not fit becomes null."""
    return df.withColumns({
        c: F.col(c).try_cast(t) for c, t in STORED_DECIMALS.items() if c in df.columns
    })


def overflows(df: DataFrame) -> Column:
    """Aggregate: values that their stored decimal type cannot hold."""
    lost = F.lit(0)
    for c, t in STORED_DECIMALS.items():
        if c in df.columns:
            lost = lost + (F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).cast("int")
    return F.sum(lost)
