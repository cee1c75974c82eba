"""Feature drift between a reference and a current period, per symbol and feature.

All features of all symbols are done in one job. Rows stay wide until a histogram bin or a distinct
value is known, so only counts are shuffled per feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.functions.ranking import cumulative_counts
from barflow.functions.series import spread_join

# Bins and thresholds.
BINS = 10
PSI_WARNING, PSI_CRITICAL = 0.1, 0.25
KS_ALPHA = 0.05
KS_MIN_ROWS = 10
KS_TERMS = 100
RATIO_NOW, RATIO_SOON, RATIO_WATCH, COUNT_SOON = 0.3, 0.15, 0.05, 5


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def common_features(reference: DataFrame, current: DataFrame) -> list[str]:
    shared = set(numeric_columns(current))
    return [c for c in numeric_columns(reference) if c in shared]


def both_sides(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    columns = ["symbol", "date", *[F.col(c).cast("double").alias(c) for c in features]]
    return reference.select(*columns, F.lit("ref").alias("side")).unionByName(
        current.select(*columns, F.lit("cur").alias("side"))
    )


def _side_counts() -> list[Column]:
    return [
        F.count_if(F.col("side") == "ref").alias("n_ref"),
        F.count_if(F.col("side") == "cur").alias("n_cur"),
    ]


def histogram(sides: DataFrame, features: Sequence[str], bins: int = BINS) -> DataFrame:
    """Counts per symbol, feature and equal-width bin over the joint range; empty bins left out.

    The last bin is closed, and constant data falls into it as a whole.
    """
    ranges = sides.groupBy("symbol").agg(
        *[F.min(c).alias(f"_lo_{c}") for c in features], *[F.max(c).alias(f"_hi_{c}") for c in features]
    )

    def bin_of(c: str) -> Column:
        low, high = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        place = F.floor((F.col(c) - low) / F.nullif(high - low, F.lit(0.0)) * bins)
        return F.when(F.col(c).isNotNull(), F.coalesce(F.least(place, F.lit(bins - 1)), F.lit(bins - 1)))

    entries = [F.struct(F.lit(c).alias("feature"), bin_of(c).alias("bin")) for c in features]
    return (
        spread_join(sides, ranges, ["symbol"])
        .select("symbol", "side", F.explode(F.array(*entries)).alias("e"))
        .select("symbol", "side", "e.feature", F.col("e.bin").cast("int").alias("bin"))
        .filter(F.col("bin").isNotNull())
        .groupBy("symbol", "feature", "bin")
        .agg(*_side_counts())
    )


def severity(psi: Column) -> Column:
    return (
        F.when(psi >= PSI_CRITICAL, "CRITICAL").when(psi >= PSI_WARNING, "WARNING").otherwise("OK")
    )


def psi(counts: DataFrame, bins: int = BINS) -> DataFrame:
    """Population stability index from histogram counts, each bin counted one up."""

    def in_bin(side: str, k: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("bin") == k, F.col(side))), F.lit(0))

    totals = counts.groupBy("symbol", "feature").agg(
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"),
        F.array(*[in_bin("n_ref", k) for k in range(bins)]).alias("ref_bins"),
        F.array(*[in_bin("n_cur", k) for k in range(bins)]).alias("cur_bins"),
    )
    index = F.lit(0.0)
    for k in range(bins):
        expected = (F.col("ref_bins")[k] + 1) / (F.col("n_ref") + bins)
        actual = (F.col("cur_bins")[k] + 1) / (F.col("n_cur") + bins)
        index = index + (actual - expected) * F.ln(actual / expected)
    empty = (F.col("n_ref") == 0) | (F.col("n_cur") == 0)
    scored = totals.select(
        "symbol", "feature", "n_ref", "n_cur", F.when(empty, 0.0).otherwise(index).alias("psi")
    )
    return scored.withColumn("severity", severity(F.col("psi")))


def kolmogorov_tail(x: Column, terms: int = KS_TERMS) -> Column:
    """Probability that Kolmogorov's limiting statistic exceeds ``x``."""
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda total, k: total + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * x * x),
    )
    # Below 0.2 the tail differs from 1 by less than 1e-12, and the series converges slowly.
    return F.when(x < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def ks(sides: DataFrame, features: Sequence[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic (exact) and limiting p-value per symbol and feature."""
    entries = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in features]
    long = (
        sides.select("symbol", "side", F.explode(F.array(*entries)).alias("e"))
        .select("symbol", "side", "e.feature", "e.value")
        .filter(F.col("value").isNotNull())
    )
    ref, cur = (F.count_if(F.col("side") == s) for s in ("ref", "cur"))
    ranked = cumulative_counts(long, ["symbol", "feature"], "value", {"ref": ref, "cur": cur})
    gap = F.abs(
        F.try_divide(F.col("ref_upto").cast("double"), F.col("ref_total"))
        - F.try_divide(F.col("cur_upto").cast("double"), F.col("cur_total"))
    )
    found = ranked.groupBy("symbol", "feature").agg(
        F.max(gap).alias("gap"), F.max("ref_total").alias("n_ref"), F.max("cur_total").alias("n_cur")
    )
    return ks_test(found)


def ks_test(found: DataFrame) -> DataFrame:
    """Statistic and p-value from the largest ``gap`` and the row counts; groups of few rows show no drift."""
    few = (F.col("n_ref") < KS_MIN_ROWS) | (F.col("n_cur") < KS_MIN_ROWS)
    scale = F.sqrt(F.col("n_ref") * F.col("n_cur") / (F.col("n_ref") + F.col("n_cur")))
    tested = found.select(
        "symbol", "feature", "n_ref", "n_cur",
        F.when(few, 0.0).otherwise(F.col("gap")).alias("ks_statistic"),
        F.when(few, 1.0).otherwise(kolmogorov_tail(scale * F.col("gap"))).alias("ks_p_value"),
    )
    return tested.withColumn("ks_drift", F.col("ks_p_value") < KS_ALPHA)


def drift_report(
    reference: DataFrame, current: DataFrame, features: Sequence[str] | None = None
) -> DataFrame:
    """PSI, KS and severity of every feature that is numeric in both frames."""
    features = list(features) if features is not None else common_features(reference, current)
    sides = both_sides(reference, current, features)
    stability = psi(histogram(sides, features)).select("symbol", "feature", "psi", "severity")
    tests = ks(sides, features).select("symbol", "feature", "ks_statistic", "ks_p_value")
    return stability.join(tests, ["symbol", "feature"]).select(
        "symbol", "feature",
        F.round("psi", 4).alias("psi"),
        F.round("ks_statistic", 4).alias("ks_statistic"),
        F.round("ks_p_value", 4).alias("ks_p_value"),
        "severity",
    )


def recommendation(ratio: Column, drifted: Column) -> Column:
    return (
        F.when(ratio >= RATIO_NOW, "RETRAIN_IMMEDIATELY")
        .when((ratio >= RATIO_SOON) | (drifted >= COUNT_SOON), "RETRAIN_RECOMMENDED")
        .when(ratio >= RATIO_WATCH, "MONITOR_CLOSELY")
        .otherwise("NO_ACTION_NEEDED")
    )


def drift_summary(report: DataFrame) -> DataFrame:
    """Per symbol: checked and drifted features, their names, the ratio and what to do."""
    drifted = F.col("severity") != "OK"
    totals = report.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("total_features"),
        F.count_if(drifted).alias("drifted_features"),
        # At most one entry per feature column.
        F.array_join(F.sort_array(F.collect_list(F.when(drifted, F.col("feature")))), ",").alias("drifted_names"),
    )
    share = F.col("drifted_features") / F.col("total_features")
    return totals.withColumns({
        "drift_ratio": F.round(share, 4),
        "recommendation": recommendation(share, F.col("drifted_features")),
    })
