"""A stored rank table of a reference period, and exact Kolmogorov-Smirnov tests of later rows against it.

The reference is ranked once. Its table holds the distinct values with counts, dealt to cells of similar size per symbol and
feature, and the counts of the cells. A later period is counted by the same cells, which combines in the map tasks. The
gap between two distributions at the end of a cell follows from those counts alone, and what it can be inside a
cell is bounded by them; only cells whose bound exceeds the largest gap at an end are compared value by value.

Tables of two periods merge by adding the counts of equal values. Rows without a symbol and null values are not ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barflow.functions.ranking import MOST_CELLS, cell_of, cells_for, cut_points
from barflow.functions.series import spread_join
from barflow.operators.drift import ks_test
from barflow.session import staged

GROUP = ["symbol", "feature"]
CELL = [*GROUP, "cell"]
# The values that are compared singly are a share of all that falls with the root of the number of cells.
FEWEST_CELLS = 1024


def long_values(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row per known value: symbol, feature, value."""
    entries = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features]
    return (
        rows.filter("symbol IS NOT NULL").select("symbol", F.explode(F.array(*entries)).alias("e"))
        .select("symbol", "e.feature", "e.value").filter("value IS NOT NULL")
    )


def _write(distinct: DataFrame, path: str, cells: int | None) -> None:
    distinct = staged(distinct, "reference-values")
    splits = staged(cut_points(distinct, GROUP, "value", cells or max(FEWEST_CELLS, cells_for(distinct, GROUP))), "reference-splits")
    celled = spread_join(distinct, splits, GROUP, by="value").select(
        *GROUP, cell_of(F.col("_splits"), F.col("value"), MOST_CELLS).alias("cell"), "value", "n")
    # Sorted files let a scan of few cells skip the rest by the statistics of the row groups.
    celled.repartitionByRange(*CELL, "value").sortWithinPartitions(*CELL, "value").write.parquet(f"{path}/values")
    splits.write.parquet(f"{path}/splits")
    distinct.sparkSession.read.parquet(f"{path}/values").groupBy(*CELL).agg(F.sum("n").alias("n")).write.parquet(
        f"{path}/cells")


def write_ranks(reference: DataFrame, features: Sequence[str], path: str, cells: int | None = None) -> None:
    """Rank the reference into a new folder; one that exists is an error."""
    _write(long_values(reference, features).groupBy(*GROUP, "value").agg(F.count(F.lit(1)).alias("n")), path, cells)


def merge_ranks(spark: SparkSession, parts: Sequence[str], path: str, cells: int | None = None) -> None:
    """The rank table of all rows behind ``parts``, without reading those rows again."""
    values = spark.read.parquet(*[f"{p}/values" for p in parts])
    _write(values.groupBy(*GROUP, "value").agg(F.sum("n").alias("n")), path, cells)


def place(spark: SparkSession, path: str, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Values of the current rows with their cells; groups that the reference lacks have the one cell 0."""
    splits = spark.read.parquet(f"{path}/splits")
    return spread_join(long_values(current, features), splits, GROUP, "left", by="value").select(
        *GROUP, cell_of(F.col("_splits"), F.col("value"), MOST_CELLS).alias("cell"), "value")


def _share(count: Column, total: str) -> Column:
    return F.try_divide(count.cast("double"), F.col(total))


def cell_bounds(spark: SparkSession, path: str, placed: DataFrame) -> DataFrame:
    """Counts of both sides before and in each cell, the gap at its end, and whether a larger one may lie inside.

    Rounded division and subtraction are monotone, so the bound holds for the rounded gaps too.
    """
    sides = spark.read.parquet(f"{path}/cells").select(*CELL, F.col("n").alias("ref"), F.lit(0).cast("long").alias("cur"))
    counted = placed.groupBy(*CELL).agg(F.lit(0).cast("long").alias("ref"), F.count(F.lit(1)).alias("cur"))
    cells = sides.unionByName(counted).groupBy(*CELL).agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    # A group has at most MOST_CELLS rows here.
    whole = Window.partitionBy(*GROUP)
    upto = whole.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    counts = cells.select(
        *CELL, "ref", "cur",
        (F.sum("ref").over(upto) - F.col("ref")).alias("ref_before"),
        (F.sum("cur").over(upto) - F.col("cur")).alias("cur_before"),
        F.sum("ref").over(whole).alias("n_ref"), F.sum("cur").over(whole).alias("n_cur"),
    )
    ref_low, cur_low = _share(F.col("ref_before"), "n_ref"), _share(F.col("cur_before"), "n_cur")
    ref_high = _share(F.col("ref_before") + F.col("ref"), "n_ref")
    cur_high = _share(F.col("cur_before") + F.col("cur"), "n_cur")
    ends = counts.withColumn("gap", F.abs(ref_high - cur_high)).withColumn("_best", F.max("gap").over(whole))
    # Where one side has no value in the cell, the gap is largest at one of its ends.
    inside = (F.col("ref") > 0) & (F.col("cur") > 0) & (F.greatest(ref_high - cur_low, cur_high - ref_low) > F.col("_best"))
    return ends.withColumn("open", F.coalesce(inside, F.lit(False))).drop("_best")


def values_of_cells(spark: SparkSession, path: str, placed: DataFrame, cells: DataFrame) -> DataFrame:
    """Counts of both sides by value, of the given cells alone."""
    only = cells.select(*CELL)
    stored = spark.read.parquet(f"{path}/values").join(only, CELL, "left_semi").select(
        *CELL, "value", F.col("n").alias("ref"), F.lit(0).cast("long").alias("cur"))
    seen = placed.join(only, CELL, "left_semi").groupBy(*CELL, "value").agg(
        F.lit(0).cast("long").alias("ref"), F.count(F.lit(1)).alias("cur"))
    return stored.unionByName(seen).groupBy(*CELL, "value").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))


def ks_against(spark: SparkSession, path: str, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """The rows of ``drift.ks`` for the stored reference and the current rows."""
    placed = staged(place(spark, path, current, features), "current-placed")
    cells = staged(cell_bounds(spark, path, placed), "current-cells")
    opened = cells.filter("open")
    upto = Window.partitionBy(*CELL).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    known = opened.select(*CELL, "ref_before", "cur_before", "n_ref", "n_cur")
    inside = (
        values_of_cells(spark, path, placed, opened)
        .withColumns({"_ref": F.sum("ref").over(upto), "_cur": F.sum("cur").over(upto)})
        .join(known, CELL)
        .select(*GROUP, "n_ref", "n_cur", F.abs(
            _share(F.col("ref_before") + F.col("_ref"), "n_ref") - _share(F.col("cur_before") + F.col("_cur"), "n_cur")
        ).alias("gap"))
    )
    found = cells.select(*GROUP, "n_ref", "n_cur", "gap").unionByName(inside).groupBy(*GROUP).agg(
        F.max("gap").alias("gap"), F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur"))
    return ks_test(found)
