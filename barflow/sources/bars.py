"""Bars from ticks: the driver tables read as market-style price series.

Ticks are reduced by partial aggregation, so a symbol or day that holds most of the ticks is
combined inside every map task before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.functions.series import Frames, in_blocks, number_rows

PRICES = ("open", "high", "low", "close")
VALUES = ("open", "high", "low", "close", "adj_close", "volume")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main fixture: order totals per order priority and day."""
    price, tick = F.col("o_totalprice"), F.col("o_orderkey")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("symbol"), F.to_date("o_orderdate").alias("date"))
        .agg(
            F.min_by(price, tick).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, tick).alias("close"),
            F.count(F.lit(1)).alias("volume"),
        )
        .select("symbol", "date", *PRICES, F.col("close").alias("adj_close"), "volume")
    )


def bars_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide fixture: unit prices per brand and ship day, in one aggregation behind the join with the parts."""
    tick = F.struct(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.try_divide("l_extendedprice", "l_quantity").alias("price"),
    )
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("symbol"))
    return (
        table(spark, sf_dir, "lineitem").join(part, "l_partkey")
        .groupBy("symbol", F.to_date("l_shipdate").alias("date"))
        .agg(
            F.min(tick).alias("first"), F.max(tick).alias("last"),
            F.max(tick["price"]).alias("high"), F.min(tick["price"]).alias("low"),
            F.sum("l_quantity").cast("long").alias("volume"),
        )
        .select(
            "symbol", "date", F.col("first.price").alias("open"), "high", "low",
            F.col("last.price").alias("close"), F.col("last.price").alias("adj_close"), "volume",
        )
    )


def hourly_aggregates() -> list[Column]:
    """Open, high, low, close and tick count of ``value`` in event time order."""
    tick = F.struct("ts", "event_id", "value")
    return [
        F.min(tick)["value"].alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max(tick)["value"].alias("close"),
        F.count(F.lit(1)).alias("volume"),
    ]


def bars_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values per event type and hour."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("symbol"), F.date_trunc("hour", "ts").alias("bar_time"))
        .agg(*hourly_aggregates())
    )


# Fixed values of the dirty fixture: k is 7 * days since EPOCH + first digit of the symbol.
EPOCH = "1995-01-01"
FIRST_INGEST = "2002-01-01 00:00:00"
SECOND_INGEST = "2002-01-01 01:00:00"


def _dirt_key() -> Column:
    days = F.datediff(F.col("date"), F.lit(EPOCH).cast("date"))
    return 7 * days + F.substring("symbol", 1, 1).cast("int")


def bars_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw bars with nulls, swapped highs, zero volumes and second deliveries of the same key."""
    k = _dirt_key()
    all_null = k % 97 == 0
    swapped = k % 37 == 0

    def price(column: str, *null_when: Column) -> Column:
        value = F.col(column)
        for condition in (all_null, *null_when):
            value = F.when(~condition, value)
        return value

    dirty = bars_priority(spark, sf_dir).select(
        "symbol", "date",
        price("open", k % 41 == 0).alias("open"),
        F.when(~all_null, F.when(swapped, F.col("low")).otherwise(F.col("high"))).alias("high"),
        F.when(~all_null, F.when(swapped, F.col("high")).otherwise(F.col("low"))).alias("low"),
        price("close", k % 53 == 0).alias("close"),
        "adj_close",
        F.when(k % 61 != 0, F.when(k % 29 == 0, F.lit(0)).otherwise(F.col("volume")))
        .cast("long").alias("volume"),
        F.when(k % 47 == 0, 2).otherwise(1).alias("copies"),
    )
    second = F.col("copy") == 2
    return dirty.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        "symbol", "date", "open", "high", "low",
        F.when(second, F.col("close") * 1.001).otherwise(F.col("close")).alias("close"),
        "adj_close", "volume",
        F.lit("landing").alias("source"),
        F.when(second, F.lit(SECOND_INGEST)).otherwise(F.lit(FIRST_INGEST))
        .cast("timestamp_ntz").alias("ingested_at"),
        F.when(second, F.lit("batch-2")).otherwise(F.lit("batch-1")).alias("batch_id"),
    )


def bars_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean bars of which some closes are negative."""
    return bars_priority(spark, sf_dir).withColumn(
        "close", F.when(_dirt_key() % 89 == 0, -F.col("close")).otherwise(F.col("close"))
    )


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asset dimension: every order priority but the last, with a sector by its first digit."""
    digit = F.substring("symbol", 1, 1)
    return (
        table(spark, sf_dir, "orders")
        .select(F.col("o_orderpriority").alias("symbol"))
        .distinct()
        .filter(F.col("symbol") != "5-LOW")
        .select(
            "symbol",
            F.concat(F.lit("Asset "), digit).alias("name"),
            F.when(digit == "1", "energy").when(digit == "2", "mining").otherwise("banking")
            .alias("sector"),
            F.lit("BRL").alias("currency"),
        )
    )


def predictions(bars: DataFrame, evaluated: bool = True) -> DataFrame:
    """A rule-made prediction at every tenth bar: UP when the close is above the one five bars ago.

    ``evaluated`` fills the outcome where the fifth bar after it exists, otherwise it stays open.
    """

    def compute(f: Frames) -> None:
        f.out("close_lag_5", f.lag("close", 5))
        f.out("actual_return", F.try_divide(f.lead("close", 5), F.col("close")) - 1)

    numbered = number_rows(bars.select("symbol", "date", "close"))
    known = in_blocks(numbered, compute, before=5, after=5)
    number = F.col("row_pos") + 1
    predicted = (F.col("close") > F.col("close_lag_5")).cast("int")
    change = F.col("actual_return") if evaluated else F.lit(None).cast("double")
    actual = (change > 0).cast("int")
    return known.filter(number % 10 == 0).select(
        "symbol",
        F.col("date").alias("prediction_date"),
        F.date_add("date", 7).alias("target_date"),
        F.lit("momentum_v1").alias("model_version"),
        predicted.alias("predicted_direction"),
        (0.5 + (number % 50) / 100).alias("confidence"),
        actual.alias("actual_direction"),
        change.alias("actual_return"),
        (predicted == actual).alias("is_correct"),
    )
