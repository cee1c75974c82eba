"""Cleaning of raw bars: dedup, scoring, imputation, repair, outliers, and the silver transform."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.functions.scalars import coerce_double, log_ratio, ratio
from barflow.functions.series import DAILY, Series, spread_join, with_neighbours, with_previous

PRICES = ("open", "high", "low", "close")
OUTLIER_DEVIATIONS = 4.0


def dedup_last(
    raw: DataFrame, keys: Sequence[str] = ("symbol", "date"),
    newest: Sequence[str] = ("ingested_at", "source"),
) -> DataFrame:
    """Keep the newest row per key.

    A maximum over (newest, other columns) combines inside the map tasks, so one key with a great
    many copies sends one row per task; ties are settled by the remaining columns.
    """
    return _pick(raw, keys, newest, F.max)


def dedup_first(
    raw: DataFrame, keys: Sequence[str], newest: Sequence[str] = ("ingested_at", "source"),
) -> DataFrame:
    """Keep the oldest row per key."""
    return _pick(raw, keys, newest, F.min)


def _pick(raw: DataFrame, keys: Sequence[str], newest: Sequence[str], edge) -> DataFrame:
    order = [c for c in newest if c in raw.columns and c not in keys]
    rest = [c for c in raw.columns if c not in keys and c not in order]
    picked = raw.groupBy(*keys).agg(edge(F.struct(*order, *rest)).alias("_row"))
    return picked.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in raw.columns])


def coerce_numeric(df: DataFrame, prices: Sequence[str] = (*PRICES, "adj_close")) -> DataFrame:
    """Prices as double, volume as bigint; text that is no number becomes null."""
    present = [c for c in prices if c in df.columns]
    return df.withColumns({
        **{c: coerce_double(F.col(c)) for c in present},
        "volume": F.col("volume").try_cast("double").try_cast("long"),
    })


def drop_all_null_prices(df: DataFrame) -> DataFrame:
    return df.dropna(how="all", subset=list(PRICES))


def any_price_missing() -> Column:
    missing = F.lit(False)
    for c in PRICES:
        missing = missing | F.col(c).isNull()
    return missing


def quality_score(missing: Column, volume: Column, inverted: Column) -> Column:
    """1.00, less 0.30 for a missing price, 0.20 for zero volume, 0.20 for high below low.

    Counted in hundredths, so that no binary fraction shows; a null condition costs nothing.
    """
    points = (
        F.lit(100)
        - F.when(missing, 30).otherwise(0)
        - F.when(volume == 0, 20).otherwise(0)
        - F.when(inverted, 20).otherwise(0)
    )
    return (F.greatest(points, F.lit(0)) / 100).cast("decimal(3,2)")


def fill_forward(df: DataFrame, columns: Sequence[str] = PRICES, series: Series = DAILY) -> DataFrame:
    """Last known value of each column."""
    carried = with_previous(df, {f"_prev_{c}": F.col(c) for c in columns}, series)
    filled = {c: F.coalesce(F.col(c), F.col(f"_prev_{c}")) for c in columns}
    return carried.withColumns(filled).drop(*[f"_prev_{c}" for c in columns])


def fill_both(df: DataFrame, columns: Sequence[str] = PRICES, series: Series = DAILY) -> DataFrame:
    """Last known value of each column; before the first one, the next known value."""
    both = with_neighbours(
        df, {f"_prev_{c}": F.col(c) for c in columns}, {f"_next_{c}": F.col(c) for c in columns}, series
    )
    filled = {c: F.coalesce(F.col(c), F.col(f"_prev_{c}"), F.col(f"_next_{c}")) for c in columns}
    return both.withColumns(filled).drop(*[f"_{s}_{c}" for s in ("prev", "next") for c in columns])


def interpolate(df: DataFrame, columns: Sequence[str], series: Series = DAILY) -> DataFrame:
    """Linear in time between known values; the last value holds at the end, the first at the start."""
    if series.order != "date":
        raise ValueError("interpolation weighs by days and needs a daily series")

    def known(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.struct(F.col("date"), F.col(c).cast("double").alias("x")))

    both = with_neighbours(
        df, {f"_prev_{c}": known(c) for c in columns}, {f"_next_{c}": known(c) for c in columns}, series
    )
    filled = {}
    for c in columns:
        left, right = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
        weight = ratio(F.datediff("date", left["date"]), F.datediff(right["date"], left["date"]))
        between = left["x"] + (right["x"] - left["x"]) * weight
        filled[c] = F.coalesce(F.col(c).cast("double"), between, left["x"], right["x"])
    return both.withColumns(filled).drop(*[f"_{s}_{c}" for s in ("prev", "next") for c in columns])


def impute(df: DataFrame, strategy: str = "ffill", series: Series = DAILY) -> DataFrame:
    """Handle missing prices and volumes by ``ffill`` (then back), ``interpolate`` or ``drop``."""
    columns = [c for c in (*PRICES, "volume") if c in df.columns]
    if strategy == "ffill":
        return fill_both(df, columns, series)
    if strategy == "interpolate":
        return interpolate(df, columns, series)
    if strategy == "drop":
        return df.dropna("any", subset=columns)
    raise ValueError(f"unknown missing value strategy: {strategy}")


def null_count(columns: Sequence[str] = (*PRICES, "volume")) -> Column:
    """Nulls over several columns, as one aggregate."""
    cells = F.lit(0)
    for c in columns:
        cells = cells + F.col(c).isNull().cast("int")
    return F.sum(cells)


def null_audit(before: DataFrame, after: DataFrame) -> DataFrame:
    """Nulls per symbol before and after a cleaning step."""
    counts = before.groupBy("symbol").agg(null_count().alias("missing_before"))
    return counts.join(after.groupBy("symbol").agg(null_count().alias("missing_after")), "symbol")


def swap_inverted(df: DataFrame) -> DataFrame:
    """Exchange high and low where high is below low."""
    inverted = F.col("high") < F.col("low")
    return df.withColumns({
        "high": F.when(inverted, F.col("low")).otherwise(F.col("high")),
        "low": F.when(inverted, F.col("high")).otherwise(F.col("low")),
    })


def add_returns(df: DataFrame, series: Series = DAILY) -> DataFrame:
    """Simple and log return against the last known close."""
    close, prev = F.col("close"), F.col("_prev_close")
    return (
        with_previous(df, {"_prev_close": close}, series)
        .withColumns({"return_simple": ratio(close, prev) - 1, "return_log": log_ratio(close, prev)})
        .drop("_prev_close")
    )


def remove_outliers(df: DataFrame, deviations: float = OUTLIER_DEVIATIONS) -> DataFrame:
    """Drop returns outside mean +- ``deviations`` sample deviations of their symbol; nulls stay."""
    bounds = df.groupBy("symbol").agg(
        F.avg("return_simple").alias("_mean"), F.stddev_samp("return_simple").alias("_std")
    )
    value = F.col("return_simple")
    low = F.col("_mean") - deviations * F.col("_std")
    high = F.col("_mean") + deviations * F.col("_std")
    return (
        spread_join(df, bounds, ["symbol"])
        .filter(value.between(low, high) | value.isNull())
        .select(*df.columns)
    )


def preprocess(
    df: DataFrame, handle_missing: str = "ffill", outliers: bool = False, series: Series = DAILY
) -> DataFrame:
    """Impute, add returns and optionally drop outliers."""
    cleaned = add_returns(impute(df, handle_missing, series), series)
    return remove_outliers(cleaned) if outliers else cleaned


def _transformed(bronze: DataFrame, series: Series) -> DataFrame:
    """Raw bars scored, filled, repaired and with returns; rows without a close still inside."""
    rows = coerce_numeric(dedup_last(bronze))
    rows = with_previous(rows, {f"_prev_{c}": F.col(c) for c in PRICES}, series)
    filled = {c: F.coalesce(F.col(c), F.col(f"_prev_{c}")) for c in PRICES}
    close, prev = filled["close"], F.col("_prev_close")
    inverted = filled["high"] < filled["low"]
    columns = [c for c in rows.columns if not c.startswith("_prev_") and c not in (*PRICES, "volume")]
    return rows.select(
        *columns,
        filled["open"].alias("open"),
        F.when(inverted, filled["low"]).otherwise(filled["high"]).alias("high"),
        F.when(inverted, filled["high"]).otherwise(filled["low"]).alias("low"),
        close.alias("close"),
        F.coalesce(F.col("volume"), F.lit(0)).alias("volume"),
        (ratio(close, prev) - 1).alias("return_simple"),
        log_ratio(close, prev).alias("return_log"),
        any_price_missing().alias("is_imputed"),
        quality_score(any_price_missing(), F.col("volume"), inverted).alias("quality_score"),
    )


SILVER_COLUMNS = (
    "symbol", "date", *PRICES, "adj_close", "volume",
    "return_simple", "return_log", "is_imputed", "quality_score", "batch_id",
)


def silver(bronze: DataFrame, series: Series = DAILY) -> DataFrame:
    """Clean bars of all symbols: newest delivery, scored before the fill, swapped after it.

    Rows at the head of a series with a price that is still unknown are left to ``quarantine``.
    """
    rows = _transformed(bronze, series)
    return rows.dropna("any", subset=list(PRICES)).select(*SILVER_COLUMNS)


def quarantine(bronze: DataFrame, series: Series = DAILY) -> DataFrame:
    """Rows with a price unknown even after the fill: no clean bar can be made of them."""
    rows = _transformed(bronze, series)
    return rows.filter(any_price_missing()).select(*SILVER_COLUMNS)


def violations(df: DataFrame) -> DataFrame:
    """Per symbol: rows, null closes, closes not above zero, and days that occur more than once."""
    per_day = df.groupBy("symbol", "date").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("close").isNull()).alias("null_close"),
        F.count_if(F.col("close") <= 0).alias("non_positive_close"),
    )
    return per_day.groupBy("symbol").agg(
        F.sum("n").alias("rows"),
        F.sum("null_close").alias("null_close"),
        F.sum("non_positive_close").alias("non_positive_close"),
        F.sum(F.col("n") - 1).alias("repeated_days"),
    )


def assert_clean(df: DataFrame) -> None:
    """Raise when any bar breaks a rule of ``violations``."""
    names = ("null_close", "non_positive_close", "repeated_days")
    worst = violations(df).agg(*[F.sum(c).alias(c) for c in names]).first()
    broken = {c: worst[c] for c in names if worst[c]}
    if broken:
        raise ValueError(f"bars are not clean: {broken}")
