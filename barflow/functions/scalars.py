"""Scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient in double; null for a null or zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def log_ratio(numerator: Column, denominator: Column) -> Column:
    """Natural log of a quotient; null where the quotient is not positive."""
    return F.ln(ratio(numerator, denominator))


def coerce_double(column: Column) -> Column:
    """Number or null: text that is no number and NaN both become null."""
    value = column.try_cast("double")
    return F.when(~F.isnan(value), value)


def add_business_days(day: Column, n: int) -> Column:
    """``n`` weekdays after ``day`` (n >= 1); a weekend start counts from the Friday before it.

    Whole weeks are seven days each, and the remaining days skip one weekend when they cross it.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    weeks, rest = divmod(n, 5)
    weekday = F.weekday(day)
    past_friday = F.greatest(weekday - 4, F.lit(0))
    start = F.least(weekday, F.lit(4))
    skip = F.when(start + rest > 4, 2).otherwise(0)
    return F.date_add(day, (F.lit(7 * weeks + rest) + skip - past_friday).cast("int"))


def calendar_target(day: Column, horizon: int) -> Column:
    """Target date in calendar days: the horizon plus two days for a weekend."""
    return F.date_add(day, horizon + 2)


def direction_label(direction: Column) -> Column:
    return F.when(direction == 1, F.lit("UP")).otherwise(F.lit("DOWN"))


def chosen_confidence(direction: Column, probability_up: Column) -> Column:
    """Probability of the chosen class, four places."""
    return F.round(F.when(direction == 1, probability_up).otherwise(1 - probability_up), 4)


def split_symbols(text: Column) -> Column:
    """Comma-separated symbols as a trimmed array without empty entries."""
    trimmed = F.transform(F.split(text, ","), lambda s: F.trim(s))
    return F.filter(trimmed, lambda s: s != "")


def artifact_symbol(symbol: Column) -> Column:
    """Symbol as used in model names: upper case, dots become underscores."""
    return F.replace(F.upper(symbol), F.lit("."), F.lit("_"))


def model_version(prefix: str, day: Column) -> Column:
    return F.concat(F.lit(prefix), F.date_format(day, "yyyyMMdd"))
