"""The zone map of a layer: what it holds of each symbol in each period, written with every write.

A row has ``symbol, period, n, first_date, last_date`` and, where the layer has prices, counts of bars that fail a
quality check. Rows of one symbol and period add up, so an append only adds rows. Newest dates, row counts, quality
checks and the periods that an increment has to read come from here, without a look at the layer itself.

One writer at a time: the periods of a write are noted before it begins and struck out when its zones are
written, so the zones of a write that broke off are made again from these periods by the next reader.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barflow.session import staged
from barflow.sources.deltas import PERIOD, current, delete, readable

KEY = ("symbol", PERIOD)
SCHEMA = ("symbol string, n bigint, first_date date, last_date date, nulls bigint, inverted bigint, negatives bigint, "
          "period int")
_SUMS = ("n", "nulls", "inverted", "negatives")


def zones_path(layer: str) -> str:
    return f"{layer.rstrip('/')}.zones"


def _pending_path(layer: str) -> str:
    return f"{layer.rstrip('/')}.pending"


def zones_of(rows: DataFrame) -> DataFrame:
    """Zone rows of bars or features."""
    bad = {
        "nulls": F.col("close").isNull(), "inverted": F.col("high") < F.col("low"),
        "negatives": (F.col("close") < 0) | (F.col("open") < 0),
    } if {"open", "high", "low", "close"} <= set(rows.columns) else dict.fromkeys(_SUMS[1:], F.lit(False))
    return rows.groupBy("symbol", F.year("date").alias(PERIOD)).agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        *[F.count_if(c).alias(name) for name, c in bad.items()],
    ).select("symbol", "n", "first_date", "last_date", "nulls", "inverted", "negatives", PERIOD)


def begin(spark: SparkSession, layer: str, periods: Iterable[int]) -> None:
    """Note the periods that a write is about to touch, beside those of a write that broke off."""
    old = readable(spark, _pending_path(layer))
    known = {r[0] for r in old.collect()} if old is not None else set()
    spark.createDataFrame([(p,) for p in sorted({*known, *periods})], "period int").coalesce(1).write.mode("overwrite").parquet(
        _pending_path(layer))


def _rebuild(spark: SparkSession, layer: str, periods: Iterable[int]) -> None:
    """Zones of some periods, made from the layer; a period that is gone has none."""
    there, wanted = readable(spark, layer) is not None, sorted(periods)
    rows = zones_of(current(spark, layer).filter(F.col(PERIOD).isin(wanted))) if there else spark.createDataFrame([], SCHEMA)
    found = staged(rows, "zones")
    found.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD).parquet(zones_path(layer))
    for gone in set(wanted) - {r[0] for r in found.select(PERIOD).distinct().collect()}:
        delete(spark, f"{zones_path(layer)}/{PERIOD}={gone}")


def finish(spark: SparkSession, layer: str, periods: Iterable[int], appended: DataFrame | None = None) -> None:
    """Write the zones of a write that is done: of the rows it appended, or of the periods it rewrote."""
    noted = {r[0] for r in spark.read.parquet(_pending_path(layer)).collect()}
    if appended is None or noted - set(periods):
        _rebuild(spark, layer, noted | set(periods))
    else:
        zones_of(appended).coalesce(1).write.mode("append").partitionBy(PERIOD).parquet(zones_path(layer))
    delete(spark, _pending_path(layer))


def read(spark: SparkSession, layer: str) -> DataFrame:
    """One row for each symbol and period of a layer."""
    left = readable(spark, _pending_path(layer))
    if left is not None:
        _rebuild(spark, layer, [r[0] for r in left.collect()])
        delete(spark, _pending_path(layer))
    found = readable(spark, zones_path(layer))
    if found is None:  # a layer from before there were zones, or an empty one
        there = readable(spark, layer) is not None
        found = zones_of(current(spark, layer)) if there else spark.createDataFrame([], SCHEMA)
    return found.groupBy(*KEY).agg(
        *[F.sum(c).alias(c) for c in _SUMS], F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))


def newest(spark: SparkSession, layer: str) -> DataFrame:
    """``symbol, last_date``: the newest date of each symbol, from the zones."""
    return read(spark, layer).groupBy("symbol").agg(F.max("last_date").alias("last_date"))


def counts(spark: SparkSession, layer: str) -> DataFrame:
    """Per symbol the counts that quality checks are made of."""
    return read(spark, layer).groupBy("symbol").agg(
        *[F.sum(c).alias(c) for c in ("nulls", "inverted", "negatives")], F.max("last_date").alias("newest"))


# ---------------------------------------------------------------- sections: symbols in periods

def rows_in(spark: SparkSession, layer: str, sections: DataFrame) -> DataFrame:
    """The layer's rows of some (symbol, period): only the folders of these periods are read."""
    wanted = staged(sections.select(*KEY).distinct(), "sections")
    periods = sorted(r[0] for r in wanted.select(PERIOD).distinct().collect())
    rows = current(spark, layer)
    return rows.filter(F.col(PERIOD).isin(periods)).join(wanted, list(KEY), "left_semi").select(*rows.columns).drop(PERIOD)


def from_date(zones: DataFrame, starts: DataFrame) -> DataFrame:
    """Sections that hold dates from each symbol's ``start`` on."""
    return zones.join(starts, "symbol").filter(F.col("last_date") >= F.col("start"))


def newest_before(zones: DataFrame, starts: DataFrame) -> DataFrame:
    """The section of each symbol with the newest date before its ``start``."""
    earlier = zones.join(starts, "symbol").filter(F.col("first_date") < F.col("start"))
    return earlier.groupBy("symbol").agg(F.max(PERIOD).alias(PERIOD))


def last_before(zones: DataFrame, starts: DataFrame, n: int) -> DataFrame:
    """Sections that surely hold the ``n`` newest rows before each symbol's ``start``; all it has, if it has fewer.

    Of the period in which the start lies the rows before it are not known, so none are counted on.
    """
    earlier = zones.join(starts, "symbol").filter(F.col("first_date") < F.col("start"))
    sure = F.sum(F.when(F.col("last_date") < F.col("start"), F.col("n")).otherwise(0))
    later = Window.partitionBy("symbol").orderBy(F.desc(PERIOD)).rowsBetween(Window.unboundedPreceding, -1)
    return earlier.withColumn("_later", F.coalesce(sure.over(later), F.lit(0))).filter(F.col("_later") < n).drop("_later")


# ---------------------------------------------------------------- what an increment has seen

def changed(spark: SparkSession, source: DataFrame, progress: str) -> DataFrame:
    """Sections of the source's zones whose row count is not the one noted in ``progress``."""
    seen = readable(spark, progress)
    if seen is None:
        return source.select(*KEY, "n")
    return source.join(seen.select(*KEY, F.col("n").alias("_seen")), list(KEY), "left").filter(
        F.col("_seen").isNull() | (F.col("_seen") != F.col("n"))).select(*KEY, "n")


def note(spark: SparkSession, sections: DataFrame, progress: str, whole_symbols: bool = False) -> None:
    """Note the row counts of sections as seen; with ``whole_symbols`` they are all that these symbols have."""
    rows, seen = staged(sections.select(*KEY, "n"), "seen"), readable(spark, progress)
    if seen is not None:
        keys = ["symbol"] if whole_symbols else list(KEY)
        rows = staged(rows.unionByName(seen.join(rows.select(*keys).distinct(), keys, "left_anti").select(*KEY, "n")), "seen")
    rows.coalesce(1).write.mode("overwrite").parquet(progress)
