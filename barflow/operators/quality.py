"""Data quality checks as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RECENT_BUSINESS_DAYS = 5


def _business_days_between(start: Column, end: Column) -> Column:
    """Weekdays after ``start`` up to and including ``end``."""
    # Weekdays since Monday 1969-12-29, counting Monday to Friday.
    def index(day: Column) -> Column:
        days = F.unix_date(day) + 3
        return 5 * F.floor(days / 7) + F.least(days % 7 + 1, F.lit(5))

    return (index(end) - index(start)).cast("long")


def quality_checks(silver: DataFrame, check_date: str) -> DataFrame:
    """Four check rows per symbol from one pass over its bars."""
    return checks_of(silver.groupBy("symbol").agg(
        F.count_if(F.col("close").isNull()).alias("nulls"),
        F.count_if(F.col("high") < F.col("low")).alias("inverted"),
        F.count_if((F.col("close") < 0) | (F.col("open") < 0)).alias("negatives"),
        F.max("date").alias("newest"),
    ), check_date)


def checks_of(counts: DataFrame, check_date: str) -> DataFrame:
    """The check rows of counts per symbol, however these were made."""

    def check(name: str, passed: Column, key: str, value: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"),
            passed.alias("passed"),
            F.to_json(F.struct(value.alias(key))).alias("details"),
        )

    checks = F.array(
        check("completeness_no_null_close", F.col("nulls") == 0, "null_count", F.col("nulls")),
        check("consistency_ohlc_integrity", F.col("inverted") == 0, "invalid_rows", F.col("inverted")),
        check("validity_no_negative_prices", F.col("negatives") == 0, "negative_count", F.col("negatives")),
        check("freshness_has_recent_data", F.col("newest").isNotNull(), "max_date",
              F.col("newest").cast("string")),
    )
    return counts.select("symbol", F.explode(checks).alias("c")).select(
        "symbol", F.lit(check_date).cast("date").alias("check_date"), "c.*"
    )


def quality_totals(checks: DataFrame) -> DataFrame:
    return checks.agg(
        F.count(F.lit(1)).alias("total_checks"), F.count_if(~F.col("passed")).alias("failed")
    )


def extended_checks(silver: DataFrame, as_of: str, max_lag: int = RECENT_BUSINESS_DAYS) -> DataFrame:
    """Close inside its range, volume not negative, newest bar at most some business days old."""
    day = F.lit(as_of).cast("date")
    counts = silver.groupBy("symbol").agg(
        F.count_if(~F.col("close").between(F.col("low"), F.col("high"))).alias("close_outside_range"),
        F.count_if(F.col("volume") < 0).alias("negative_volume"),
        F.max("date").alias("newest"),
    )
    lag = _business_days_between(F.col("newest"), day)
    return counts.select(
        "symbol", "close_outside_range", "negative_volume",
        lag.alias("lag_business_days"), (lag <= max_lag).alias("is_recent"),
    )


def missing_symbols(expected: DataFrame, loaded: DataFrame) -> DataFrame:
    """Expected symbols without any loaded row."""
    return expected.select("symbol").distinct().join(
        loaded.select("symbol").distinct(), "symbol", "left_anti"
    )
