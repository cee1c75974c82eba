"""Boosted trees for many groups at once: one model for each symbol, or each symbol and fold.

All groups grow together. A level of a tree is one aggregation of gradients by (group, node, feature, bin), from which
every open node of every group takes its best split; there is no loop over groups and no group is gathered in a
task. The model is a table of nodes, so scoring is a join for each level, and importances are counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barflow.functions.ranking import cumulative_counts
from barflow.functions.series import spread_join
from barflow.session import staged

#: Gains are compared to this many places; equal ones go to the first feature and its lowest bin.
PLACES = 9


@dataclass(frozen=True)
class Boosting:
    """Learner settings. ``patience`` trees without a better validation loss end a group; 0 watches none."""

    trees: int = 500
    depth: int = 6
    rate: float = 0.05
    least_rows: int = 20
    bins: int = 64
    l2: float = 1.0
    patience: int = 50


def _values(features: Sequence[str]) -> Column:
    """The features of a row in order; a null sorts below every value."""
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("-inf"))) for c in features])


def bin_edges(train: DataFrame, keys: Sequence[str], features: Sequence[str], bins: int) -> DataFrame:
    """``feature`` (its number), ``bin`` and ``low``, the least value of the bin, by group.

    A value's bin is the share of the group's training values below it, times ``bins``; equal values share one.
    """
    long = train.select(*keys, F.posexplode(_values(features)).alias("feature", "value"))
    ranked = cumulative_counts(long, [*keys, "feature"], "value", {"n": F.count(F.lit(1))})
    number = F.floor((F.col("n_upto") - F.col("n")) * bins / F.col("n_total")).cast("int")
    return ranked.groupBy(*keys, "feature", number.alias("bin")).agg(F.min("value").alias("low"))


def _binned(rows: DataFrame, edges: DataFrame, keys: Sequence[str], features: Sequence[str], spread: str) -> DataFrame:
    """Rows with ``_bins``: the bin of each feature, that of the greatest low edge not above the value."""
    lists = edges.groupBy(*keys, "feature").agg(F.array_sort(F.collect_list(F.struct("low", "bin"))).alias("edges"))
    cuts = lists.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("feature", "edges"))).alias("_cuts"))
    joined = spread_join(rows.withColumn("_values", _values(features)), cuts, list(keys), by=spread)

    def of(value: Column, cut: Column) -> Column:
        below = F.size(F.filter(cut["edges"], lambda e: e["low"] <= value))
        return F.get(cut["edges"], F.greatest(below, F.lit(1)) - 1)["bin"]

    return joined.withColumn("_bins", F.zip_with("_values", "_cuts", of)).drop("_values", "_cuts")


def _probability(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


def _best_splits(rows: DataFrame, keys: Sequence[str], level: int, settings: Boosting) -> DataFrame:
    """The best split of each open node: ``feature``, ``bin`` (values up to it go left) and ``n_rows``."""
    node = [*keys, "node"]
    p = _probability(F.col("margin"))
    sums = (
        rows.filter(F.col("node") >= 1 << level)
        .select(*node, (p - F.col("label")).alias("g"), (p * (1 - p)).alias("h"), F.posexplode("_bins").alias("feature", "bin"))
        .groupBy(*node, "feature", "bin")
        .agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("n"))
    )
    upto = Window.partitionBy(*node, "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*node, "feature")
    cut = sums.select(
        *node, "feature", "bin", *[F.sum(c).over(upto).alias(f"{c}_left") for c in "ghn"],
        *[F.sum(c).over(whole).alias(f"{c}_all") for c in "ghn"])
    score = lambda g, h: g * g / (h + settings.l2)
    left, every = [F.col("g_left"), F.col("h_left")], [F.col("g_all"), F.col("h_all")]
    gain = score(*left) + score(every[0] - left[0], every[1] - left[1]) - score(*every)
    fits = (F.col("n_left") >= settings.least_rows) & (F.col("n_all") - F.col("n_left") >= settings.least_rows)
    return (
        cut.filter(fits).withColumn("gain", F.round(gain, PLACES)).filter("gain > 0").groupBy(*node)
        .agg(F.max(F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "n_all")).alias("s"))
        .select(*node, (-F.col("s.f")).alias("feature"), (-F.col("s.b")).alias("bin"), F.col("s.n_all").alias("n_rows"), F.col("s.gain").alias("gain"))
    )


def _step(rows: DataFrame, splits: DataFrame, keys: Sequence[str], spread: str) -> DataFrame:
    """Rows moved to the child of their node, where it was split."""
    small = splits.select(*keys, "node", F.col("feature").alias("_feature"), F.col("bin").alias("_bin"))
    joined = spread_join(rows, small, [*keys, "node"], "left", by=spread)
    right = (F.get("_bins", F.col("_feature")) > F.col("_bin")).cast("int")
    return joined.withColumn("node", F.when(F.col("_feature").isNull(), F.col("node")).otherwise(2 * F.col("node") + right)).drop(
        "_feature", "_bin")


def _watched(rows: DataFrame, track: DataFrame | None, keys: Sequence[str], tree: int, patience: int) -> DataFrame:
    """Per group the best validation loss so far, its tree, and whether the group goes on."""
    loss = F.when(F.col("label") == 1, F.log1p(F.exp(-F.col("margin")))).otherwise(F.log1p(F.exp(F.col("margin"))))
    now = rows.groupBy(*keys).agg(F.avg(F.when(F.col("is_validation"), loss)).alias("loss"))
    if track is None:
        return now.select(*keys, "loss", F.lit(tree).alias("best_tree"), F.lit(True).alias("goes_on"))
    known = track.select(*keys, F.col("loss").alias("_loss"), F.col("best_tree").alias("_tree"), F.col("goes_on").alias("_on"))
    better = F.coalesce(F.col("loss") < F.col("_loss"), F.col("loss").isNull() & F.col("_on"))
    best = F.when(better, F.lit(tree)).otherwise(F.col("_tree"))
    return known.join(now, list(keys), "left").select(
        *keys, F.when(better, F.col("loss")).otherwise(F.col("_loss")).alias("loss"), best.alias("best_tree"),
        (F.col("_on") & (F.lit(tree) - best < patience)).alias("goes_on"))


def train(rows: DataFrame, keys: Sequence[str], features: Sequence[str], settings: Boosting = Boosting(), spread: str = "date") -> DataFrame:
    """The node table of one model for each group of ``keys``.

    ``rows`` has the features, a 0/1 ``label`` and, to stop early, ``is_validation``; validation rows choose the number
    of trees and do not train. ``spread`` is a column that parts the rows of a group. The table has, by group, ``tree``
    (0 holds the log odds to start from), ``node`` (1 is the root, 2n and 2n + 1 are the children of n), ``feature``
    and ``threshold`` (lower values go left, nulls too) of a split, ``n_rows``, and ``value`` of a leaf. Splits take the
    gain of the second-order loss. A group with validation rows ends after ``patience`` trees that were no better,
    and its trees behind the best are left out.

    Each tree reads and writes the rows once, with their margins; a level joins them with the splits of the level before
    and aggregates. Jobs are a few for each level, however many groups there are.
    """
    keys = list(keys)
    if "is_validation" not in rows.columns:
        rows = rows.withColumn("is_validation", F.lit(False))
    own = [c for c in dict.fromkeys([spread, *features]) if c not in keys]
    given = staged(rows.select(*keys, *own, "label", "is_validation"), "boost-rows")
    learning = given.filter("NOT is_validation")
    edges = staged(bin_edges(learning, keys, features, settings.bins), "bin-edges")
    start = staged(learning.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("label").alias("up")).select(
        *keys, "n_rows", F.log((F.col("up") + 1) / (F.col("n_rows") - F.col("up") + 1)).alias("value")), "boost-start")
    state = _binned(given, edges, keys, features, spread).select(*dict.fromkeys([*keys, spread]), "label", "is_validation", "_bins")
    state = spread_join(state, start.select(*keys, F.col("value").alias("margin")), keys, by=spread).withColumn("node", F.lit(1).cast("long"))
    state = staged(state, "boost-state")
    empty = {"feature": F.lit(None).cast("int"), "bin": F.lit(None).cast("int"), "gain": F.lit(None).cast("double")}
    names = [*keys, "tree", "node", "feature", "bin", "gain", "n_rows", "value"]
    made = [start.withColumns({"tree": F.lit(0), "node": F.lit(1).cast("long"), **empty}).select(*names)]
    track = staged(_watched(state, None, keys, 0, settings.patience), "boost-track") if settings.patience else None
    for tree in range(1, settings.trees + 1):
        for level in range(settings.depth):
            splits = staged(_best_splits(state.filter("NOT is_validation"), keys, level, settings), "boost-splits")
            made.append(splits.withColumns({"tree": F.lit(tree), "value": F.lit(None).cast("double")}).select(*names))
            state = _step(state, splits, keys, spread)
        p = _probability(F.col("margin"))
        leaves = staged(state.filter("NOT is_validation").groupBy(*keys, "node").agg(
            F.count(F.lit(1)).alias("n_rows"),
            (-settings.rate * F.sum(p - F.col("label")) / (F.sum(p * (1 - p)) + settings.l2)).alias("value")), "boost-leaves")
        made.append(leaves.withColumns({"tree": F.lit(tree), **empty}).select(*names))
        state = spread_join(state, leaves.select(*keys, "node", F.col("value").alias("_value")), [*keys, "node"], "left", by=spread).withColumn(
            "margin", F.col("margin") + F.coalesce("_value", F.lit(0.0))).withColumn("node", F.lit(1).cast("long")).drop("_value")
        if settings.patience:
            state = staged(state, "boost-state")
            track = staged(_watched(state, track, keys, tree, settings.patience), "boost-track")
            if track.filter("goes_on").isEmpty():
                break
            state = spread_join(state, track.filter("goes_on").select(*keys), keys, by=spread)
        else:
            state = staged(state, "boost-state")
        if tree % 16 == 0:  # one table instead of many small ones
            made = [staged(reduce(DataFrame.unionByName, made), "boost-nodes")]
    nodes = reduce(DataFrame.unionByName, made)
    if track is not None:
        nodes = nodes.join(track.select(*keys, "best_tree"), keys).filter("tree <= best_tree").drop("best_tree")
    # A split's threshold is the least value of the bins to its right.
    nodes = staged(nodes, "boost-nodes")
    cuts = nodes.filter("feature IS NOT NULL").select(*keys, "tree", "node", "feature", "bin").join(
        edges.withColumnRenamed("bin", "_bin"), [*keys, "feature"]).filter("_bin > bin").groupBy(*keys, "tree", "node").agg(
        F.min("low").alias("threshold"))
    return nodes.join(cuts, [*keys, "tree", "node"], "left").select(
        *keys, "tree", "node", F.get(F.array(*map(F.lit, features)), F.col("feature")).alias("feature"), "threshold",
        "gain", "n_rows", "value")


def score(rows: DataFrame, nodes: DataFrame, keys: Sequence[str], features: Sequence[str], ids: Sequence[str] = ("date",)) -> DataFrame:
    """``rows`` with ``probability_up`` and ``prediction``, by their group's trees; ``ids`` name a row within its group.

    Every row meets its group's trees and goes down one level with each join. A row of a group without a model has
    nulls. A feature that rows lack is an error.
    """
    absent = [c for c in features if c not in rows.columns]
    if absent:
        raise ValueError(f"features missing for scoring: {absent}")
    keys, ids = list(keys), [c for c in ids if c not in keys]
    known = nodes.withColumn("_feature", F.array_position(F.array(*map(F.lit, features)), F.col("feature")).cast("int") - 1)
    known = staged(known.select(*keys, "tree", "node", F.when(F.col("feature").isNotNull(), F.col("_feature")).alias("_feature"), "threshold", "value"), "model")
    deepest = known.agg(F.max("node")).first()[0] or 1
    by = (ids or keys)[0]
    at = spread_join(rows.select(*keys, *ids, _values(features).alias("_values")), known.select(*keys, "tree").distinct(), keys, by=by).withColumn(
        "node", F.lit(1).cast("long"))
    place = [*keys, "tree", "node"]
    for _ in range(deepest.bit_length() - 1):
        down = known.filter("_feature IS NOT NULL").select(*place, "_feature", "threshold")
        right = (F.get("_values", F.col("_feature")) >= F.col("threshold")).cast("int")
        at = spread_join(at, down, place, "left", by=by).withColumn(
            "node", F.when(F.col("_feature").isNull(), F.col("node")).otherwise(2 * F.col("node") + right)).drop("_feature", "threshold")
    total = spread_join(at, known.filter("value IS NOT NULL").select(*place, "value"), place, by=by).groupBy(*keys, *ids).agg(
        F.sum("value").alias("_margin"))
    return rows.join(total, [*keys, *ids], "left").withColumn("probability_up", _probability(F.col("_margin"))).withColumn(
        "prediction", (F.col("probability_up") > 0.5).cast("int")).drop("_margin")


def importance(nodes: DataFrame, by: Sequence[str] = (), top: int | None = None) -> DataFrame:
    """``feature, importance``: how many splits take each feature, the most first; ``top`` of each group of ``by``."""
    counts = nodes.filter("feature IS NOT NULL").groupBy(*by, "feature").agg(F.count(F.lit(1)).alias("importance"))
    if top is None:
        return counts
    order = Window.partitionBy(*by).orderBy(F.desc("importance"), "feature")
    return counts.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= top).drop("_rank")
