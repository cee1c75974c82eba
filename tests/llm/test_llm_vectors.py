"""Exact top-k search against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from barflow.llm import queries
from barflow.llm.vector_search import LEAST, MOST, top_k

VECTORS = "vec_id bigint, embedding array<double>, label int, query string, rank int, score double"


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "q", 2, 0.5) for i, v in rows], VECTORS).repartition(5)


def _brute(rows, is_query, k):
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, one) in enumerate(whole):
        if is_query(q):
            scores = sorted((-max(min(sum(map(int.__mul__, one, two)), MOST), LEAST), i)
                            for m, (i, two) in enumerate(whole) if m != n and len(one) == len(two))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def _found(spark, rows, k, **sizes):
    return sorted(map(tuple, top_k(_frame(spark, rows), F.col("vec_id") % 10 == 0, k, **sizes).collect()))


def _check(spark, rows, k=3, **sizes):
    assert _found(spark, rows, k, **sizes) == _brute(rows, lambda i: i % 10 == 0, k)


@pytest.mark.parametrize("k", [1, 7, 500])
def test_scores_and_ties_equal_brute_force(spark, k):
    rng = np.random.default_rng(k)
    rows = [(i, (rng.integers(-3, 4, 4) / 7).tolist()) for i in range(120)]
    _check(spark, rows, k)


def test_a_common_vector_and_groups_of_queries(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [0.5, 0.25, -1.0] if i % 3 else rng.normal(size=3).tolist()) for i in range(300)]
    _check(spark, rows, 5, group_bytes=100_000)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (10, None), (20, [1.0, None]), (30, [float("nan"), 1.0]), (40, [float("inf"), 1.0]), (50, []), (60, []),
            (70, [1.0]), (None, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (80, [3.0, -1.0]), (80, [3.0, -1.0]), (-10, [-1e-9, 0.0])]
    _check(spark, rows)
    assert _found(spark, [], 3) == []
    assert _found(spark, [(10, None), (20, [1.0])], 3) == []


def test_scores_beyond_doubles_and_longs_are_exact_or_saturated(spark):
    rows = [(i, [2.0 ** 20 + i, 2.0 ** 19 - i / 1024, float(i)]) for i in range(30)]
    rows += [(40, [1e200, -1e200, 0.0]), (41, [1e306, 1.0, 1.0]), (50, [1.7e308, 0.0, 1.0])]
    found = {(q, i): s for q, _, i, s in _found(spark, rows, 40)}
    want = {(q, i): s for q, _, i, s in _brute(rows[:30], lambda i: i % 10 == 0, 40)}
    assert {k: v for k, v in found.items() if max(k) < 40} == want
    assert found[40, 41] == MOST and found[40, 50] == MOST and found[50, 0] == MOST


def test_query_equals_brute_force(spark, tmp_path):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=16).astype("float32").astype(float).tolist()) for i in range(-200, 450)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    found = queries.QUERIES["op13_histogram_top_k"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == _brute(rows, lambda i: i % 100 == 0, 10)
