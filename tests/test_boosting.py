"""Boosted trees for many groups: against single-group runs and a recomputation from the node table."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barflow.operators import boosting, modeling
from barflow.operators.boosting import Boosting
from helpers import START

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    frames = []
    for symbol, n in (("HOT", 400), ("B", 120), ("FLAT", 60)):
        a, b, c = rng.normal(size=n), rng.integers(0, 4, n).astype(float), rng.normal(size=n)
        up = ((a > 0.2) ^ (b > 2)) if symbol != "FLAT" else np.ones(n, bool)
        b[rng.random(n) < 0.1] = np.nan
        frames.append(pd.DataFrame({"symbol": symbol, "date": [START + dt.timedelta(days=i) for i in range(n)],
                                    "a": a, "b": b, "c": c, "label": up.astype(int)}))
    return pd.concat(frames, ignore_index=True)


@pytest.fixture(scope="module")
def rows(spark, data):
    df = spark.createDataFrame(data)
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in FEATURES}).withColumn("label", F.col("label").cast("int")).repartition(3)


def _by_hand(nodes, x):
    """Margin of one row from the node table of its symbol."""
    total = 0.0
    for tree in sorted(nodes):
        node = 1
        while node in nodes[tree] and nodes[tree][node].feature is not None:
            split = nodes[tree][node]
            v = x[split.feature]
            node = 2 * node + (0 if v is None or math.isnan(v) or v < split.threshold else 1)
        leaf = [r for r in nodes[tree]["leaves"] if r.node == node]
        total += leaf[0].value
    return total


def test_groups_grow_together_as_each_would_alone(rows, data):
    settings = Boosting(trees=4, depth=3, rate=0.3, least_rows=5, bins=16, patience=0)
    together = boosting.train(rows, ["symbol"], FEATURES, settings)
    found = sorted((r.symbol, r.tree, r.node, r.feature or "", r.n_rows, r.threshold, r.value) for r in together.collect())
    for symbol in ("HOT", "B"):
        alone = boosting.train(rows.filter(F.col("symbol") == symbol), ["symbol"], FEATURES, settings).collect()
        mine = [r for r in found if r[0] == symbol]
        other = sorted((r.symbol, r.tree, r.node, r.feature or "", r.n_rows, r.threshold, r.value) for r in alone)
        assert [r[:6] for r in mine] == [r[:6] for r in other]
        assert all(x[6] == pytest.approx(y[6]) for x, y in zip(mine, other))
    assert all(r[3] == "" for r in found if r[0] == "FLAT")  # one label: nothing to split
    assert {r[1] for r in found if r[0] == "HOT"} == {0, 1, 2, 3, 4}
    # Scores by joins are those of a walk through the node table, and they learn the rule.
    nodes = {}
    for r in together.collect():
        trees = nodes.setdefault(r.symbol, {}).setdefault(r.tree, {"leaves": []})
        if r.feature is None:
            trees["leaves"].append(r)
        else:
            trees[r.node] = r
    scored = boosting.score(rows, together, ["symbol"], FEATURES).collect()
    assert len(scored) == len(data)
    for r in scored[::17]:
        assert r.probability_up == pytest.approx(1 / (1 + math.exp(-_by_hand(nodes[r.symbol], r))))
    hot = [r for r in scored if r.symbol == "HOT"]
    assert np.mean([r.prediction == r.label for r in hot]) > 0.85
    counts = {(r.symbol, r.feature): r.importance for r in boosting.importance(together, ["symbol"]).collect()}
    assert sum(counts.values()) == sum(1 for r in found if r[3]) and counts["HOT", "a"] >= 1


def test_early_stopping_is_by_group(spark, rows):
    settings = Boosting(trees=12, depth=2, rate=0.5, least_rows=5, bins=8, patience=3)
    marked = modeling.with_validation_tail(rows, 20)
    nodes = boosting.train(marked, ["symbol"], FEATURES, settings)
    trees = {r.symbol: r.n for r in nodes.groupBy("symbol").agg(F.max("tree").alias("n")).collect()}
    assert set(trees) == {"HOT", "B", "FLAT"} and trees["HOT"] >= 3
    # No group keeps trees behind its best one: the loss of its last tree is the least of all its prefixes.
    tail = marked.filter("is_validation AND symbol = 'HOT'")
    losses = []
    for t in range(trees["HOT"] + 1):
        part = boosting.score(tail, nodes.filter(F.col("tree") <= t), ["symbol"], FEATURES)
        losses.append(part.agg(F.avg(-F.log(F.when(F.col("label") == 1, F.col("probability_up")).otherwise(1 - F.col("probability_up"))))).first()[0])
    assert losses[-1] == min(losses)


def test_odd_groups(spark, rows):
    settings = Boosting(trees=1, depth=2, least_rows=5, bins=4, patience=0)
    few = rows.filter("symbol = 'B'").limit(3)
    nodes = boosting.train(few, ["symbol"], FEATURES, settings)
    assert {(r.tree, r.node) for r in nodes.collect()} == {(0, 1), (1, 1)}
    unknown = boosting.score(rows.filter("symbol = 'HOT'").limit(2), nodes, ["symbol"], FEATURES)
    assert [r.probability_up for r in unknown.collect()] == [None, None]
    assert boosting.train(rows.limit(0), ["symbol"], FEATURES, settings).count() == 0
    with pytest.raises(ValueError, match="missing"):
        boosting.score(rows.drop("a"), nodes, ["symbol"], FEATURES)
