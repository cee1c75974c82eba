"""Order statistics, folds, scores, drift and monitoring against brute force."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barflow.functions.ranking import cumulative_counts, medians
from barflow.operators import drift, modeling, monitoring, reports
from barflow.operators.indicators import gold
from barflow.schemas import BARS
from helpers import START, collected


def sides(spark, ref, cur):
    rows = [("A", "ref", float(v)) for v in ref] + [("A", "cur", float(v)) for v in cur]
    made = [(s, START + dt.timedelta(days=i), side, v) for i, (s, side, v) in enumerate(rows)]
    return spark.createDataFrame(made, "symbol string, date date, side string, x double")


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [3.0, 1.0, 2.0], [5.0] * 40 + [1.0, 9.0]])
def test_median_of_small_groups(spark, values):
    df = spark.createDataFrame([("g", v) for v in values] + [("g", None)], "g string, v double")
    assert medians(df, ["g"], "v").first()["median"] == np.median(values)


def test_ranks_of_a_hot_group(spark):
    """A heavy value, a long tail and many cells give exact counts all the same."""
    rng = np.random.default_rng(3)
    values = np.concatenate([np.round(rng.pareto(0.5, 3000), 3), np.full(2000, 0.5), [1e12]])
    df = spark.createDataFrame(pd.DataFrame({"g": "hot", "v": values})).unionByName(
        spark.createDataFrame([("cold", 1.0)], "g string, v double"))
    for cells in (2, 16, 128):
        got = cumulative_counts(df, ["g"], "v", {"n": F.count(F.lit(1))}, cells).filter("g = 'hot'")
        got = collected(got, "v")
        assert (got.n_upto == got.n.cumsum()).all() and (got.n_total == len(values)).all()
        assert medians(df, ["g"], "v", cells).filter("g = 'hot'").first()["median"] == np.median(values)


def test_folds(spark):
    df = spark.createDataFrame(
        [("A", START + dt.timedelta(days=i)) for i in range(100)] + [("S", START)], "symbol string, date date")
    folds = collected(modeling.walk_forward(df, 3, 20, short="mark"), "fold", "date")
    short = folds[folds.role == modeling.TOO_SHORT]
    assert list(short.symbol) == ["S"] and set(short.fold) == {0}
    folds = folds[folds.fold > 0]
    assert set(folds.symbol) == {"A"}
    for i in (1, 2, 3):
        f = folds[folds.fold == i]
        test, train = f[f.role == "test"], f[f.role == "train"]
        assert len(test) == 20 and len(train) == 40 + 20 * (i - 1)
        assert train.date.max() < test.date.min()
    tested = folds[folds.role == "test"]
    assert tested.date.is_unique and tested.date.max() == START + dt.timedelta(days=99)
    with pytest.raises(Exception, match="3 folds of 20 rows need 80 rows"):
        modeling.walk_forward(df, 3, 20).collect()


def test_scores_without_positives(spark):
    rows = [("A", 1, 0, 1), ("A", 1, 0, 0)]
    got = modeling.fold_metrics(spark.createDataFrame(rows, "symbol string, fold int, prediction int, label int")).first()
    assert (got.accuracy, got.precision, got.recall, got.f1_score) == (0.5, 0, 0, 0)


def test_training_scores_and_registry(spark, random_bars, tmp_path):
    matrix = modeling.feature_matrix(gold(spark.createDataFrame(random_bars, BARS), warm=False))
    features = ["rsi_14", "return_5d", "volatility_21d"]
    matrix = matrix.select("symbol", "date", *features, "label")
    middle = modeling.feature_medians(matrix, features)
    filled = modeling.fill_with_medians(matrix, middle, features).cache()
    assert filled.dropna().count() == matrix.count()
    frame = matrix.toPandas()
    for r in middle.collect():
        assert r.rsi_14 == pytest.approx(frame[frame.symbol == r.symbol].rsi_14.median())
    settings = {**modeling.LEARNER, "maxIter": 2, "maxDepth": 2}
    model = modeling.fit(filled, features, settings)
    scored = modeling.score(model, filled)
    assert scored.filter("probability_up < 0 OR probability_up > 1 OR prediction NOT IN (0, 1)").count() == 0
    with pytest.raises(ValueError, match="rsi_14"):
        modeling.score(model, filled.drop("rsi_14"))
    ranked = modeling.feature_importance(model, features, top=2).collect()
    assert len(ranked) == 2 and ranked[0].importance >= ranked[1].importance
    root = str(tmp_path / "models")
    modeling.save_model(model, features, root, "v1", "2020-01-01")
    modeling.save_model(model, features, root, "v2", "2020-02-01")
    loaded, names, version = modeling.load_latest_model(spark, root)
    assert version == "v2" and names == features
    newest = modeling.latest_features(filled)
    predicted = modeling.predictions(modeling.score(loaded, newest), version).collect()
    assert len(predicted) == 3
    for p in predicted:
        assert p.target_date == p.prediction_date + dt.timedelta(days=7) and 0.5 <= p.confidence <= 1


def brute_psi(ref, cur):
    edges = np.linspace(min(ref.min(), cur.min()), max(ref.max(), cur.max()), 11)
    e = (np.histogram(ref, edges)[0] + 1) / (len(ref) + 10)
    a = (np.histogram(cur, edges)[0] + 1) / (len(cur) + 10)
    return float(np.sum((a - e) * np.log(a / e)))


def test_psi(spark):
    rng = np.random.default_rng(5)
    ref, cur = rng.normal(0, 1, 400), rng.normal(1, 1, 300)
    got = drift.psi(drift.histogram(sides(spark, ref, cur), ["x"])).first()
    assert got.psi == pytest.approx(brute_psi(ref, cur)) and got.severity == "CRITICAL"
    same = drift.psi(drift.histogram(sides(spark, ref, ref), ["x"])).first()
    assert same.psi == pytest.approx(0, abs=1e-12) and same.severity == "OK"
    const = drift.histogram(sides(spark, [2] * 30, [2] * 5), ["x"]).collect()
    assert [(r.bin, r.n_ref, r.n_cur) for r in const] == [(9, 30, 5)]
    empty = drift.psi(drift.histogram(sides(spark, [1, 2], []), ["x"])).first()
    assert empty.psi == 0


def test_ks(spark):
    rng = np.random.default_rng(6)
    ref, cur = np.round(rng.normal(0, 1, 300), 1), np.round(rng.normal(0.3, 1, 200), 1)
    points = np.unique(np.concatenate([ref, cur]))
    gap = max(abs((ref <= p).mean() - (cur <= p).mean()) for p in points)
    got = drift.ks(sides(spark, ref, cur), ["x"]).first()
    assert got.ks_statistic == pytest.approx(gap, abs=1e-15)
    lam = math.sqrt(300 * 200 / 500) * gap
    want = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
    assert got.ks_p_value == pytest.approx(want) and got.ks_drift == (want < 0.05)
    few = drift.ks(sides(spark, range(9), range(100, 109)), ["x"]).first()
    assert (few.ks_statistic, few.ks_p_value, few.ks_drift) == (0, 1, False)
    same = drift.ks(sides(spark, ref, ref), ["x"]).first()
    assert (same.ks_statistic, same.ks_p_value) == (0, 1)


def test_drift_summary_thresholds(spark):
    def summary(drifted, total):
        rows = [("A", f"f{i:02d}", "WARNING" if i < drifted else "OK") for i in range(total)]
        return drift.drift_summary(spark.createDataFrame(rows, "symbol string, feature string, severity string")).first()

    assert summary(3, 10).recommendation == "RETRAIN_IMMEDIATELY"
    assert summary(5, 100).recommendation == "RETRAIN_RECOMMENDED"
    assert summary(1, 10).recommendation == "MONITOR_CLOSELY"
    assert summary(0, 10).recommendation == "NO_ACTION_NEEDED"
    assert summary(3, 10).drifted_names == "f00,f01,f02"


def predicted(spark, rows):
    made = [("A", START + dt.timedelta(days=d), START + dt.timedelta(days=d + 7), p, a, g, c) for d, p, a, g, c in rows]
    return spark.createDataFrame(
        made, "symbol string, prediction_date date, target_date date, predicted_direction int, "
              "actual_direction int, actual_return double, confidence double")


def test_monitoring(spark, bars):
    evaluated = predicted(spark, [(0, 1, 1, 0.5, 0.9), (1, 0, 1, 0.25, 0.6), (2, 0, 0, -0.5, 0.8), (3, 1, None, None, 0.9)])
    got = monitoring.accuracy(evaluated, bars({"A": range(1, 10)})).first()
    assert (got.status, got.total_predictions, got.accuracy) == ("evaluated", 2, 0.5)
    assert (got.high_confidence_count, got.high_confidence_accuracy) == (1, 1.0)
    wanted = spark.createDataFrame([("A",), ("Z",)], "symbol string")
    statuses = {r.symbol: r.status for r in monitoring.accuracy_of(evaluated, bars({"A": [1]}), wanted).collect()}
    assert statuses == {"A": "no_matching_dates", "Z": "insufficient_data"}
    assert monitoring.recent_accuracy(evaluated, 2).first().recent_accuracy == 0.5
    trained = spark.createDataFrame([("A", START)], "symbol string, trained_at date")
    assert monitoring.staleness(trained, "2020-01-31").first().recommendation == "OK"
    assert monitoring.staleness(trained, "2020-02-01").first().is_stale
    report = spark.createDataFrame([("A", 2, 9)], "symbol string, drifted_features long, total_features long")
    row = monitoring.monitor(trained, evaluated, report, "2020-01-20").first()
    assert (row.recommendation, row.drift_detected, row.model_age_days) == ("MONITOR_CLOSELY", True, 19)


def test_period_performance_by_hand(spark):
    evaluated = predicted(spark, [(0, 1, 1, 0.5, 0.9), (1, 0, 1, 0.25, 0.6), (2, 0, 0, -0.5, 0.8), (3, 0, 1, 2.0, 0.8)]).withColumn(
        "model_version", F.lit("v1"))
    got = monitoring.performance_by_period(evaluated.filter("prediction_date < '2020-01-04'")).first()
    gains = np.array([0.5, -0.25, 0.5])
    assert got.sharpe_ratio == pytest.approx(gains.mean() / gains.std(ddof=1) * math.sqrt(252 / 5))
    assert got.max_drawdown == pytest.approx(-0.25) and got.period_end == dt.date(2020, 3, 31)
    # A loss above everything wipes the equity out.
    assert monitoring.performance_by_period(evaluated).first().max_drawdown == -1.0
    # Versions are measured apart.
    both = evaluated.unionByName(evaluated.filter("prediction_date < '2020-01-02'").withColumn("model_version", F.lit("v2")))
    counts = {r.model_version: r.n_predictions for r in monitoring.performance_by_period(both).collect()}
    assert counts == {"v1": 4, "v2": 1}


def test_outcomes_are_filled_once_known(bars):
    df = bars({"A": range(1, 11)})
    from barflow.sources.bars import predictions

    open_rows = predictions(bars({"A": list(range(1, 21))}), evaluated=False)
    found = monitoring.fill_outcomes(open_rows, bars({"A": list(range(1, 21))}), "2020-01-15")
    row = found.first()
    assert row.prediction_date == START + dt.timedelta(days=9) and row.actual_return == 0.5 and row.is_correct
    assert monitoring.fill_outcomes(open_rows, bars({"A": list(range(1, 21))}), "2020-01-14").count() == 0


def test_latest_metrics_take_the_newest_training(spark):
    rows = [("v1", START, "A", "accuracy", 0.4, 10), ("v2", START + dt.timedelta(days=9), "A", "accuracy", 0.6, 12),
            ("v1", START, "A", "recall", 0.1, 10)]
    df = spark.createDataFrame(
        rows, "model_version string, trained_at date, symbol string, metric_name string, metric_value double, n_train int")
    got = reports.latest_metrics(df, ["accuracy", "recall", "precision"]).first()
    assert (got.model_version, got.accuracy, got.recall, got.precision, got.n_train) == ("v2", 0.6, 0.1, None, 12)


def test_training_takes_more_symbols_than_tree_bins(spark):
    rows = spark.range(400).select(
        F.concat(F.lit("S"), (F.col("id") % 100).cast("string")).alias("symbol"),
        (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("label"))
    model = modeling.fit(rows, ["x"], {**modeling.LEARNER, "maxIter": 1, "maxDepth": 1})
    assert modeling.score(model, rows).count() == 400


def test_a_symbol_without_medians_is_scored(spark):
    rows = spark.createDataFrame([("A", START, 1.0, 5.0, 1), ("A", START, 3.0, None, 0)], "symbol string, date date, x double, y double, label int")
    features = ["x", "y"]
    middle = modeling.feature_medians(rows, features)
    pooled = modeling.pooled_medians(middle, features)
    assert pooled == {"x": 2.0, "y": 5.0}
    new = spark.createDataFrame([("NEW", START, None, 1.0)], "symbol string, date date, x double, y double")
    assert modeling.fill_with_medians(new, middle, features, pooled).first()["x"] == 2.0
    assert [tuple(r) for r in modeling.still_missing(modeling.fill_with_medians(new, middle, features), features).collect()] == [
        ("NEW", "x", 1)]


def test_the_newest_model_is_the_one_trained_last(spark, tmp_path):
    rows = spark.createDataFrame([("A", START, float(i % 2), i % 2) for i in range(60)], "symbol string, date date, x double, label int")
    model = modeling.fit(rows, ["x"], {**modeling.LEARNER, "maxIter": 1, "maxDepth": 1})
    for version, at in (("v9", "2020-01-01"), ("v10", "2020-02-01")):
        modeling.save_model(model, ["x"], str(tmp_path), version, at)
    assert modeling.load_latest_model(spark, str(tmp_path))[2] == "v10"
