"""Exact order statistics of groups that may be too large for one task.

Values are first reduced to distinct values with counts. Approximate quantiles then cut each group
into cells of similar size; cumulative counts are built inside the cells and shifted by the totals of
the cells before. The cut points only balance the work: the counts are exact wherever they lie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barflow.functions.series import spread_join
from barflow.session import staged

CELLS, MOST_CELLS = 128, 4096
CELL_VALUES = 1 << 20


def cell_of(splits: Column, value: Column, cells: int) -> Column:
    """Number of split points not above the value, by halving."""
    steps = []
    step = 1
    while step < cells:
        steps.insert(0, step)
        step *= 2

    def advance(found: Column, width: Column) -> Column:
        probe = found + width
        fits = (probe <= F.size(splits)) & (F.get(splits, probe - 1) <= value)
        return F.when(fits, probe).otherwise(found)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)


def cells_for(distinct: DataFrame, group: Sequence[str]) -> int:
    """Cells a group needs, so that those of the largest group have about ``CELL_VALUES`` values each."""
    largest = distinct.groupBy(*group).count().agg(F.max("count")).first()[0] or 0
    cells = CELLS
    while cells < MOST_CELLS and cells * CELL_VALUES < largest:
        cells *= 2
    return cells


def cut_points(distinct: DataFrame, group: Sequence[str], value: str, cells: int) -> DataFrame:
    """Approximate quantiles of the distinct values per group, as the array ``_splits``."""
    # One call to the JVM, not one for each point.
    points = F.expr(f"array({', '.join(f'{i / cells!r}D' for i in range(1, cells))})")
    return distinct.groupBy(*group).agg(F.percentile_approx(value, points, F.lit(20 * cells)).alias("_splits"))


def cumulative_counts(
    values: DataFrame, group: Sequence[str], value: str, counted: dict[str, Column],
    cells: int | None = None,
) -> DataFrame:
    """Distinct values per group with, for each name, the count up to and including the value.

    ``counted`` maps a name to an aggregate; the output has ``<name>`` (at the value),
    ``<name>_upto`` and ``<name>_total`` (whole group).
    """
    # Three branches read the distinct values: cut points, cell totals and the counts themselves.
    distinct = staged(
        values.groupBy(*group, value).agg(*[c.alias(k) for k, c in counted.items()]), "distinct"
    )
    cells = cells or cells_for(distinct, group)
    splits = cut_points(distinct, group, value, cells)
    celled = spread_join(distinct, splits, list(group), by=value).select(
        *group, value, *counted, cell_of(F.col("_splits"), F.col(value), cells).alias("_cell")
    )
    totals = celled.groupBy(*group, "_cell").agg(*[F.sum(k).alias(f"_in_{k}") for k in counted])
    before = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    totals = totals.select(
        *group, "_cell",
        *[F.coalesce(F.sum(f"_in_{k}").over(before), F.lit(0)).alias(f"_before_{k}") for k in counted],
        *[F.sum(f"_in_{k}").over(whole).alias(f"{k}_total") for k in counted],
    )
    upto = (
        Window.partitionBy(*group, "_cell").orderBy(value)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    local = celled.withColumns({f"_upto_{k}": F.sum(k).over(upto) for k in counted})
    return local.join(totals.hint("merge"), [*group, "_cell"]).select(
        *group, value, *counted,
        *[(F.col(f"_before_{k}") + F.col(f"_upto_{k}")).alias(f"{k}_upto") for k in counted],
        *[f"{k}_total" for k in counted],
    )


def medians(values: DataFrame, group: Sequence[str], value: str, cells: int | None = None) -> DataFrame:
    """Exact median per group as ``median``; null values are skipped."""
    known = values.filter(F.col(value).isNotNull())
    ranked = cumulative_counts(known, group, value, {"n": F.count(F.lit(1))}, cells)
    # Ranks are 1-based; a value covers the ranks (n_upto - n, n_upto].
    low, high = F.floor((F.col("n_total") + 1) / 2), F.floor(F.col("n_total") / 2) + 1
    covers = [(F.col("n_upto") - F.col("n") < r) & (r <= F.col("n_upto")) for r in (low, high)]
    return ranked.groupBy(*group).agg(
        (
            (F.max(F.when(covers[0], F.col(value))) + F.max(F.when(covers[1], F.col(value)))) / 2
        ).alias("median")
    )
