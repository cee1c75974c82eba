"""Keyed writes as DataFrame rules: merge, insert-ignore, high-water mark, reload."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.functions.series import spread_join
from barflow.operators.clean import dedup_first

BEGINNING = "1900-01-01"


def new_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert-ignore: the oldest batch row of every key that the target does not hold yet."""
    held = target.select(*keys)
    return dedup_first(batch, keys).join(held, list(keys), "left_anti").select(*batch.columns)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.unionByName(new_rows(target, batch, keys))


def merge(
    target: DataFrame, batch: DataFrame, keys: Sequence[str],
    keep: Sequence[str] = (), fill: Sequence[str] = (),
) -> DataFrame:
    """Target with the batch merged in by key; a batch holds at most one row per key.

    A column takes the batch value, except: ``keep`` columns stay as the target has them, and
    ``fill`` columns take the batch value only where it is not null. Keys found on one side only
    come through unchanged. The batch meets the target in left joins, for which a small batch is
    broadcast by its size at run time: the target is then neither shuffled nor sorted.
    """
    values = [c for c in target.columns if c not in keys]
    given = batch.select(*keys, *[F.col(c).alias(f"_batch_{c}") for c in values], F.lit(True).alias("_given"))

    def merged(c: str):
        if c in keep:
            return F.col(c)
        if c in fill:
            return F.coalesce(F.col(f"_batch_{c}"), F.col(c)).alias(c)
        return F.when(F.col("_given"), F.col(f"_batch_{c}")).otherwise(F.col(c)).alias(c)

    kept = target.join(given, list(keys), "left").select(
        *[F.col(c) if c in keys else merged(c) for c in target.columns])
    held = target.select(*keys).join(batch.select(*keys), list(keys), "left_semi")
    return kept.unionByName(batch.join(held, list(keys), "left_anti").select(*target.columns))


def touch(target: DataFrame, batch: DataFrame, keys: Sequence[str], stamp: str) -> DataFrame:
    """Merge that leaves the values of known keys alone and only renews their time stamp."""
    keep = [c for c in target.columns if c not in keys and c != stamp]
    return merge(target, batch, keys, keep=keep)


def last_dates(rows: DataFrame) -> DataFrame:
    return rows.groupBy("symbol").agg(F.max("date").alias("last_date"))


def newer_than(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows past the newest date the target holds for their symbol; all rows of a new symbol."""
    marks = last_dates(target)
    since = F.coalesce(F.col("last_date"), F.lit(BEGINNING).cast("date"))
    return (
        spread_join(source, marks, ["symbol"], "left")
        .filter(F.col("date") > since)
        .select(*source.columns)
    )


def reload_symbols(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Delete-and-reload: every symbol of the batch is replaced as a whole."""
    reloaded = batch.select("symbol").distinct()
    kept = spread_join(target, reloaded, ["symbol"], "left_anti")
    return kept.select(*target.columns).unionByName(batch.select(*target.columns))


def unknown_symbols(facts: DataFrame, assets: DataFrame) -> DataFrame:
    """Symbols of the facts that the dimension does not know."""
    return facts.select("symbol").distinct().join(assets.select("symbol"), "symbol", "left_anti")
