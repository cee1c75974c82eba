"""Latest-per-key views, dashboard and serving queries, ingest reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.functions.scalars import direction_label
from barflow.functions.series import DAILY, Series, in_blocks, last_rows, spread_join


def with_assets(facts: DataFrame, assets: DataFrame, columns: Sequence[str] = ("name", "sector")) -> DataFrame:
    """Facts of known symbols with columns of the asset dimension."""
    return spread_join(facts, assets.select("symbol", *columns), ["symbol"], by=_day(facts))


def of_known_assets(facts: DataFrame, assets: DataFrame) -> DataFrame:
    return spread_join(facts, assets.select("symbol"), ["symbol"], "left_semi", by=_day(facts))


def _day(facts: DataFrame) -> str:
    return next(c for c in ("date", "prediction_date", "check_date") if c in facts.columns)


def latest_rows(facts: DataFrame, order: str = "date") -> DataFrame:
    """Newest row per symbol, combined inside the map tasks."""
    rest = [c for c in facts.columns if c not in ("symbol", order)]
    newest = facts.groupBy("symbol").agg(F.max(F.struct(order, *rest)).alias("_row"))
    return newest.select("symbol", "_row.*").select(*facts.columns)


def latest_prices(silver: DataFrame, assets: DataFrame) -> DataFrame:
    newest = latest_rows(silver.select("symbol", "date", "close", "volume", "return_simple"))
    return newest.join(assets.select("symbol", "name"), "symbol").select(
        "symbol", "name", "date", "close", "volume", F.col("return_simple").alias("daily_return")
    )


def coverage(rows: DataFrame) -> DataFrame:
    return rows.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    counted = None
    for name, df in layers.items():
        one = df.agg(F.count(F.lit(1)).alias("value")).withColumn("metric", F.lit(name))
        counted = one if counted is None else counted.unionByName(one)
    return counted


def recent_months(gold: DataFrame, assets: DataFrame, column: str, as_of: str, months: int) -> DataFrame:
    """One feature of known symbols over the months before a day."""
    since = F.add_months(F.lit(as_of).cast("date"), -months)
    return of_known_assets(gold.select("symbol", "date", column).filter(F.col("date") > since), assets)


def latest_predictions(predictions: DataFrame, assets: DataFrame, n: int = 10) -> DataFrame:
    """Newest ``n`` predictions over all known symbols."""
    return (
        of_known_assets(predictions, assets)
        .select(
            "symbol", "prediction_date", "target_date",
            direction_label(F.col("predicted_direction")).alias("direction"),
            F.round("confidence", 4).alias("confidence"), "model_version",
        )
        .orderBy(F.desc("prediction_date"), "symbol")
        .limit(n)
    )


def prediction_history(predictions: DataFrame, n: int = 10) -> DataFrame:
    """Newest ``n`` predictions of each symbol."""
    return last_rows(predictions, n, Series(order="prediction_date")).select(
        "symbol", "prediction_date", "target_date", "model_version", "predicted_direction",
        "confidence", "actual_direction", "is_correct",
        direction_label(F.col("predicted_direction")).alias("direction_label"),
    )


def latest_accuracy(metrics: DataFrame, n: int = 3) -> DataFrame:
    return (
        metrics.filter(F.col("metric_name") == "accuracy")
        .orderBy(F.desc("trained_at"), "symbol")
        .limit(n)
        .select("symbol", "trained_at", F.col("metric_value").alias("accuracy"))
    )


def latest_metrics(metrics: DataFrame, names: Sequence[str]) -> DataFrame:
    """Newest value of every metric per symbol, one column each, with the newest training."""
    row = F.struct("trained_at", "metric_value")
    return metrics.groupBy("symbol").agg(
        F.max_by("model_version", "trained_at").alias("model_version"),
        *[F.max(F.when(F.col("metric_name") == c, row))["metric_value"].alias(c) for c in names],
        F.max_by("n_train", "trained_at").alias("n_train"),
        F.max("trained_at").alias("trained_at"),
    )


def latest_checks(checks: DataFrame, assets: DataFrame, n: int = 20) -> DataFrame:
    return (
        of_known_assets(checks, assets)
        .orderBy(F.desc("check_date"), "symbol", "check_name")
        .limit(n)
        .select("symbol", "check_name", "passed", "check_date", "details")
    )


def price_with_average(bars: DataFrame, n: int = 20, series: Series = DAILY) -> DataFrame:
    """Close and its moving average, for charts."""
    if n < 1:
        raise ValueError("the average needs at least one row")
    return in_blocks(
        bars.select("symbol", "date", "close"),
        lambda f: f.out("moving_average", f.mean("close", n)),
        before=n - 1, series=series,
    )


def period_change(bars: DataFrame) -> DataFrame:
    """First and last known close of each symbol and the change between them in percent."""
    known = bars.filter(F.col("close").isNotNull())
    edges = known.groupBy("symbol").agg(
        F.min_by("close", "date").alias("first_close"), F.max_by("close", "date").alias("last_close")
    )
    change = F.try_divide(F.col("last_close") - F.col("first_close"), F.col("first_close")) * 100
    return edges.withColumn("change_pct", change)


# ---------------------------------------------------------------- features as rows

def features_long(gold: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row per symbol, day and feature."""
    return gold.select("symbol", "date", *[F.col(c).cast("double").alias(c) for c in features]).unpivot(
        ["symbol", "date"], list(features), "feature_name", "feature_value"
    )


def features_pivot(long: DataFrame, features: Sequence[str]) -> DataFrame:
    """One column per feature; the mean where a feature occurs more than once."""
    return long.groupBy("symbol", "date").pivot("feature_name", list(features)).agg(F.avg("feature_value"))


# ---------------------------------------------------------------- ingest reports

def ingestion_log(bars: DataFrame, batch_id: str | None = None) -> DataFrame:
    """One success row per batch and symbol."""
    if batch_id is not None:
        bars = bars.withColumn("batch_id", F.lit(batch_id))
    return bars.groupBy("batch_id", "symbol").agg(
        F.min("date").alias("start_date"), F.max("date").alias("end_date"),
        F.count(F.lit(1)).alias("rows_ingested"),
    ).select(
        "batch_id", "symbol", "start_date", "end_date", "rows_ingested",
        F.lit("success").alias("status"), F.lit(None).cast("string").alias("error_message"),
    )


def failure_log(df: DataFrame, batch_id: str | Column, error: str) -> DataFrame:
    """Log rows for the symbols of a batch, or of each batch of a column, whose write failed."""
    batch = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    return df.select(batch.alias("batch_id"), "symbol").distinct().select(
        "batch_id", "symbol",
        F.lit(None).cast("date").alias("start_date"), F.lit(None).cast("date").alias("end_date"),
        F.lit(0).cast("long").alias("rows_ingested"),
        F.lit("failed").alias("status"), F.lit(error).alias("error_message"),
    )


def rows_per_symbol(expected: DataFrame, loaded: DataFrame) -> DataFrame:
    """Loaded rows of every expected symbol, 0 where none came."""
    counts = loaded.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    return expected.select("symbol").join(counts, "symbol", "left").select(
        "symbol", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("rows_ingested")
    )


def loaded_per_symbol(expected: DataFrame, log: DataFrame) -> DataFrame:
    """Rows that the ingestion log notes for every expected symbol; -1 where deliveries failed and none succeeded."""
    failed = F.count_if(F.col("status") == "failed") > 0
    counts = log.groupBy("symbol").agg(F.sum("rows_ingested").alias("n"), failed.alias("failed"))
    n = F.coalesce(F.col("n"), F.lit(0))
    return expected.select("symbol").join(counts, "symbol", "left").select(
        "symbol", F.when(F.col("failed") & (n == 0), -1).otherwise(n).cast("long").alias("rows_ingested"))


def ingest_status(per_symbol: DataFrame) -> DataFrame:
    """Counts of loaded, empty and failed (negative) symbols, and the rows of the loaded ones."""
    n = F.col("rows_ingested")
    return per_symbol.agg(
        F.count_if(n > 0).alias("succeeded"),
        F.count_if(n == 0).alias("empty"),
        F.count_if(n < 0).alias("failed"),
        F.coalesce(F.sum(F.when(n > 0, n)), F.lit(0)).alias("total_rows"),
    )


def last_batch(bronze: DataFrame) -> DataFrame:
    """Batch that delivered the newest bar of each symbol."""
    order = F.struct("date", "ingested_at", "batch_id")
    return bronze.groupBy("symbol").agg(F.max(order).alias("_o")).select(
        "symbol", F.col("_o.date").alias("date"), F.col("_o.batch_id").alias("source_batch_id")
    )
