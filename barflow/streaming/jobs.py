"""Structured Streaming jobs: landing files to bronze, bronze to silver and gold, ticks to bars.

All jobs drain what is there (``availableNow``) and keep their state in written tables, so a batch
that is repeated after a failure gives the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.functions.series import DAILY, Series, spread_join, with_scans
from barflow.operators import indicators
from barflow.operators.reports import latest_rows
from barflow.plans import layers
from barflow.plans.layers import BRONZE_KEY
from barflow.operators.upsert import last_dates, newer_than
from barflow.schemas import BARS, BRONZE
from barflow.session import staged
from barflow.sources import tables

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _drain(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest_bronze(
    spark: SparkSession, landing: str, bronze: str, checkpoint: str, files: int = 10_000, repeats_within: str = "7 days"
) -> None:
    """Landing files into bronze; the first delivery of a (symbol, day, source) stays.

    Records are kept as streaming state for ``repeats_within`` after their batch, so a record that is delivered again in
    that time never reaches the table. Later repeats, and other deliveries of the same bar, are settled by the
    keyed append. The watermark goes by the time of the batch, so no record is ever too late for it.
    """
    stream = (
        spark.readStream.schema(BRONZE).option("maxFilesPerTrigger", files).parquet(landing)
        .withColumn("_batch_at", F.current_timestamp())
        .withWatermark("_batch_at", repeats_within)
        .dropDuplicatesWithinWatermark([*BRONZE_KEY, "batch_id", "ingested_at"]).drop("_batch_at")
    )
    _drain(stream, lambda batch, _: tables.append_new(spark, bronze, batch, BRONZE_KEY), checkpoint)


def landing_to_gold(
    spark: SparkSession, landing: str, root: str, checkpoint: str, run_at: str | None = None, files: int = 10_000
) -> None:
    """Raw files into bronze, silver and gold: each batch is a layer run, whatever order its bars come in."""
    stream = spark.readStream.schema(BRONZE).option("maxFilesPerTrigger", files).parquet(landing)
    _drain(stream, lambda batch, _: layers.run(spark, batch, root, run_at), checkpoint)


def bars_from_ticks(
    spark: SparkSession, ticks: str, target: str, checkpoint: str, pattern: str = "*.parquet",
    width: str = "1 hour",
) -> DataFrame:
    """Bars of fixed width from ticks, however late a tick comes.

    Each batch writes what its ticks give to their bars. These parts combine, so the result has every tick
    and no state is held between batches.
    """
    stream = (
        spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", pattern).parquet(ticks)
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )
    tick = F.struct("ts", "event_id", "value")

    def each(batch: DataFrame, batch_id: int) -> None:
        parts = batch.groupBy(F.col("event_type").alias("symbol"), F.window("ts", width).alias("w")).agg(
            F.min(tick).alias("first"), F.max("value").alias("high"), F.min("value").alias("low"),
            F.max(tick).alias("last"), F.count(F.lit(1)).alias("volume"))
        parts.withColumn("bar_time", F.col("w.start")).drop("w").write.mode("overwrite").parquet(
            f"{target}/batch={batch_id}")

    _drain(stream, each, checkpoint)
    return spark.read.parquet(target).groupBy("symbol", "bar_time").agg(
        F.min("first")["value"].alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max("last")["value"].alias("close"), F.sum("volume").alias("volume"))


def _newest_version(written: DataFrame) -> DataFrame:
    """The row that the newest batch wrote for each symbol and day."""
    rest = [c for c in written.columns if c not in ("symbol", "date", "batch")]
    newest = written.groupBy("symbol", "date").agg(F.max_by(F.struct(*rest), "batch").alias("_row"))
    return newest.select("symbol", "date", "_row.*")


def running_averages(
    spark: SparkSession, landing: str, target: str, state: str, checkpoint: str, files: int = 10_000,
    series: Series = DAILY,
) -> DataFrame:
    """Exponential averages and on-balance volume kept up per batch.

    The state is the newest output row of each symbol. A batch continues from it with the same
    distributed scan as the full run. A symbol with bars that come late is computed again from the earliest
    of them on, and the newest version of each row is the result. The first delivery of a bar stays; a bar of
    a day that is already stored is written to ``repeated`` in the state folder.
    """
    spans, balance = indicators.EMA_SPANS, ("obv", "volume")

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = staged(batch, "bars-batch")
        seed = None
        rows, start = batch, None
        if batch_id > 0:
            seed = start = spark.read.parquet(f"{state}/batch={batch_id - 1}")
            rows = newer_than(batch, seed.select("symbol", "date"))
            late = staged(
                spread_join(batch, last_dates(seed), ["symbol"]).filter("date <= last_date").drop("last_date"), "late")
            if not late.isEmpty():
                before = spark.read.parquet(target).filter(F.col("batch") < batch_id)
                stored = staged(_newest_version(
                    spread_join(before, late.select("symbol").distinct(), ["symbol"], "left_semi")), "averages-stored")
                late.join(stored, ["symbol", "date"], "left_semi").write.mode("overwrite").parquet(
                    f"{state}/repeated/batch={batch_id}")
                missed = late.join(stored, ["symbol", "date"], "left_anti").select(*batch.columns)
                since = missed.groupBy("symbol").agg(F.min("date").alias("since"))
                again = spread_join(stored, since, ["symbol"])
                rows = rows.unionByName(missed).unionByName(again.filter("date >= since").select(*batch.columns))
                start = seed.join(since, "symbol", "left_anti").unionByName(
                    latest_rows(again.filter("date < since").select(*seed.columns)))
        fresh = staged(
            with_scans(rows, spans, balance=balance, series=series, seed=start), "averages"
        )
        fresh.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
        newest = latest_rows(fresh)
        if seed is not None:
            newest = newest.unionByName(seed.join(newest.select("symbol"), "symbol", "left_anti"))
        newest.write.mode("overwrite").parquet(f"{state}/batch={batch_id}")

    stream = spark.readStream.schema(BARS).option("maxFilesPerTrigger", files).parquet(landing)
    _drain(stream, each, checkpoint)
    return _newest_version(spark.read.parquet(target))
