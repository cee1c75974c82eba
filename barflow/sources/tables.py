"""Layer tables: Parquet partitioned by calendar year, written by append or by partition rewrite.

Spark's file sources have no MERGE, so an upsert or a reload writes its rows beside the layer (``deltas``), readers
merge them, and the changed years are rewritten once enough changes have come together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.operators.upsert import merge, new_rows
from barflow.session import staged
from barflow.sources import deltas, zones
from barflow.sources.zones import PERIOD


def write_layer(df: DataFrame, path: str, mode: str = "errorifexists", only_touched: bool = False) -> None:
    """Write rows by year, files of even size sorted by symbol and day, and the layer's zone map.

    A first write fails on a path in use. Rows to append or to overwrite with are read more than once: give
    them staged.
    """
    spark, first = df.sparkSession, not layer_exists(df.sparkSession, path)
    if first:
        _write(df, path, mode, only_touched)
        zones.begin(spark, path, periods := _years(spark.read.parquet(path)) if deltas.readable(spark, path) is not None else [])
    else:
        zones.begin(spark, path, periods := _years(df))
        _write(df, path, mode, only_touched)
    zones.finish(spark, path, periods, df if mode == "append" and not first else None)


def _write(df: DataFrame, path: str, mode: str, only_touched: bool) -> None:
    writer = (
        df.withColumn(PERIOD, F.year("date"))
        .hint("rebalance", F.col(PERIOD))
        .sortWithinPartitions(PERIOD, "symbol", "date")
        .write.mode(mode)
        .partitionBy(PERIOD)
    )
    if only_touched:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def read_layer(spark: SparkSession, path: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """Rows of a layer, between two dates if given (both inclusive): only the years they touch are read."""
    rows = deltas.current(spark, path)
    if since is not None:
        day = F.lit(since).cast("date")
        rows = rows.filter((F.col(PERIOD) >= F.year(day)) & (F.col("date") >= day))
    if until is not None:
        day = F.lit(until).cast("date")
        rows = rows.filter((F.col(PERIOD) <= F.year(day)) & (F.col("date") <= day))
    return rows.drop(PERIOD)


def layer_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table; a folder that cannot be read as one is an error, not an absent table."""
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def _years(rows: DataFrame) -> list[int]:
    return [r[0] for r in rows.select(F.year("date")).distinct().collect()]


def touched(spark: SparkSession, path: str, batch: DataFrame) -> DataFrame:
    """Rows of the table in the years of the batch; the list of years prunes the scan."""
    return deltas.current(spark, path).filter(F.col(PERIOD).isin(_years(batch))).drop(PERIOD)


def append_new(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert-ignore into a layer; returns the rows it inserted. Repeating a batch adds nothing."""
    batch = staged(batch, "append")
    there = layer_exists(spark, path)
    held = touched(spark, path, batch) if there else batch.limit(0)
    fresh = staged(new_rows(held, batch, keys), "append-new")
    if there and deltas.readable(spark, deltas.deltas_path(path)) is not None:
        _change(spark, path, fresh, keys)  # a key may have been deleted there
    else:
        write_layer(fresh, path, mode="append" if there else "errorifexists")
    return fresh


def _change(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], gone: DataFrame | None = None) -> None:
    """Write changes beside the layer, renew the zones of their years, and compact if it is due."""
    periods = set(_years(rows)) | (set(_years(gone)) if gone is not None else set())
    zones.begin(spark, path, periods)
    if periods:
        deltas.write(spark, path, rows, keys, gone)
    zones.finish(spark, path, periods)
    if deltas.due(spark, path, zones.read(spark, path)):
        deltas.compact(spark, path)


def upsert(
    spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
    keep: Sequence[str] = (), fill: Sequence[str] = (),
) -> None:
    """Merge a batch into a layer: only its own rows are written, and only the years it touches are read."""
    if not layer_exists(spark, path):
        write_layer(batch, path)
        return
    batch = staged(batch, "upsert")
    held = touched(spark, path, batch).join(batch.select(*keys), list(keys), "left_semi")
    _change(spark, path, staged(merge(held, batch, keys, keep, fill), "upsert-merged"), keys)


def reload(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str] = ("symbol", "date")) -> None:
    """Replace every symbol of the batch as a whole: its rows are written, and its other keys deleted.

    The zone map says which years have old rows of these symbols.
    """
    batch = staged(batch, "reload-batch")
    old = zones.rows_in(spark, path, zones.read(spark, path).join(batch.select("symbol").distinct(), "symbol", "left_semi"))
    gone = staged(old.select(*keys).join(batch.select(*keys), list(keys), "left_anti"), "reload-gone")
    _change(spark, path, batch.select(*old.columns), keys, gone)
