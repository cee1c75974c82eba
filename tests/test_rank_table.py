"""Tests against a stored reference equal those that compare all values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from barflow.operators import drift, rank_table

FIELDS = "symbol string, date date, x double, y double"


def frame(spark, rows):
    return spark.createDataFrame([(s, None, x, y) for s, x, y in rows], FIELDS)


def drawn(seed, n, shift):
    rng = np.random.default_rng(seed)
    return [("hot" if i % 3 else "other", float(np.round(rng.normal(shift, 1), 2)), float(rng.exponential(1 + shift)))
            for i in range(n)]


def rows_of(df):
    return sorted(tuple(r) for r in df.select("symbol", "feature", "n_ref", "n_cur", "ks_statistic", "ks_p_value").collect())


@pytest.mark.parametrize("cells", [2, 16, None])
def test_equal_to_a_comparison_of_all_values(spark, tmp_path, cells):
    odd = [("hot", None, 1.0), ("few", 1.0, 2.0), ("constant", 5.0, 5.0), (None, 1.0, 1.0)]
    ref = frame(spark, drawn(1, 3000, 0.0) + odd + [("gone", 1.0, 1.0)] * 20 + [("constant", 5.0, 5.0)] * 30)
    cur = frame(spark, drawn(2, 900, 0.2) + odd + [("new", 1.0, None)] * 20 + [("constant", 5.0, 6.0)] * 30)
    path = str(tmp_path / "ranks")
    rank_table.write_ranks(ref, ["x", "y"], path, cells)
    want = rows_of(drift.ks(drift.both_sides(ref, cur, ["x", "y"]).filter("symbol IS NOT NULL"), ["x", "y"]))
    assert rows_of(rank_table.ks_against(spark, path, cur, ["x", "y"])) == want


def test_merged_tables_equal_one_of_all_rows(spark, tmp_path):
    first, second = frame(spark, drawn(3, 500, 0.0)), frame(spark, drawn(4, 700, 1.0))
    parts = [str(tmp_path / name) for name in ("first", "second")]
    for part, path in zip((first, second), parts):
        rank_table.write_ranks(part, ["x"], path)
    merged, whole = str(tmp_path / "merged"), str(tmp_path / "whole")
    rank_table.merge_ranks(spark, parts, merged)
    rank_table.write_ranks(first.unionByName(second), ["x"], whole)
    values = [sorted(tuple(r) for r in spark.read.parquet(f"{p}/values").collect()) for p in (merged, whole)]
    assert values[0] == values[1]


def test_few_values_are_compared(spark, tmp_path):
    """Rows compared value by value are a small part of both sides, and no reference row is read for the rest."""
    ref, cur = frame(spark, drawn(5, 9000, 0.0)), frame(spark, drawn(6, 6000, 0.3))
    path = str(tmp_path / "ranks")
    rank_table.write_ranks(ref, ["y"], path)
    placed = rank_table.place(spark, path, cur, ["y"])
    cells = rank_table.cell_bounds(spark, path, placed)
    moved = rank_table.values_of_cells(spark, path, placed, cells.filter("open")).agg(F.sum("ref") + F.sum("cur")).first()[0]
    assert 0 < moved < 15000 * 0.15


def test_empty_sides(spark, tmp_path):
    empty, some = frame(spark, []), frame(spark, drawn(7, 60, 0.0))
    for name, ref, cur in (("a", empty, some), ("b", some, empty), ("c", empty, empty)):
        path = str(tmp_path / name)
        rank_table.write_ranks(ref, ["x"], path)
        got = rank_table.ks_against(spark, path, cur, ["x"]).collect()
        assert [(r.ks_statistic, r.ks_p_value, r.ks_drift) for r in got] == [(0.0, 1.0, False)] * (0 if name == "c" else 2)
    with pytest.raises(Exception, match="already exists"):
        rank_table.write_ranks(some, ["x"], str(tmp_path / "a"))
