"""The model run: folds, metrics, final model, predictions, outcomes and performance, each in its table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.operators import boosting, modeling, monitoring
from barflow.operators.upsert import new_rows
from barflow.session import staged
from barflow.sources import tables

PREDICTION_KEY = ("symbol", "prediction_date", "model_version")


def _add(spark: SparkSession, rows: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Insert-ignore into a table; repeating a run adds nothing."""
    there = tables.layer_exists(spark, path)
    fresh = staged(new_rows(spark.read.parquet(path), rows, keys) if there else rows, "model-rows")
    fresh.write.mode("append" if there else "errorifexists").parquet(path)


def train(
    spark: SparkSession, gold: DataFrame, root: str, version: str, trained_at: str, features: Sequence[str],
    settings: Mapping[str, object] = modeling.LEARNER, n_splits: int = modeling.N_SPLITS, test_size: int = modeling.TEST_SIZE,
) -> None:
    """Walk-forward training into ``model_metrics`` and ``predictions``, and the final model into ``registry``.

    The test rows of fold k are stored as predictions of the model ``<version>_fold_k``. The final model is
    trained on all rows; its medians are stored beside it. Symbols too short for folds have no metrics.
    """
    matrix = staged(modeling.feature_matrix(gold).select("symbol", "date", *features, "label"), "matrix")
    folds = staged(modeling.walk_forward(matrix, n_splits, test_size, short="mark"), "folds")
    scored = staged(modeling.train_walk_forward(folds, features, n_splits, test_size, settings), "fold-scores")
    sizes = folds.filter("role = 'train'").groupBy("symbol", "fold").count()
    trained = sizes.groupBy("symbol").agg(F.max("count").alias("n_train"))
    metrics = modeling.metrics_long(
        modeling.fold_summary(modeling.fold_metrics(scored)), version, trained_at, trained, test_size, settings)
    _add(spark, metrics, f"{root}/model_metrics", ("model_version", "symbol", "metric_name"))
    for k in range(1, n_splits + 1):
        made = modeling.predictions(scored.filter(F.col("fold") == k), f"{version}_fold_{k}")
        _add(spark, made, f"{root}/predictions", PREDICTION_KEY)
    middle = staged(modeling.feature_medians(matrix, features), "medians")
    filled = modeling.fill_with_medians(matrix, middle, features, modeling.pooled_medians(middle, features))
    model = modeling.fit_watched(filled, features, settings, test_size)
    middle.write.mode("overwrite").parquet(f"{root}/medians/{version}")
    modeling.save_model(model, features, f"{root}/registry", version, trained_at)


def train_each(
    spark: SparkSession, gold: DataFrame, root: str, version: str, trained_at: str, features: Sequence[str],
    settings: boosting.Boosting = boosting.Boosting(), n_splits: int = modeling.N_SPLITS, test_size: int = modeling.TEST_SIZE,
) -> None:
    """``train`` with a model for each symbol: the same tables, and all models of the version in one node table."""
    matrix = staged(modeling.feature_matrix(gold).select("symbol", "date", *features, "label"), "matrix")
    folds = staged(modeling.walk_forward(matrix, n_splits, test_size, short="mark"), "folds")
    scored, _ = modeling.train_each_symbol(folds, features, settings, test_size)
    scored = staged(scored, "fold-scores")
    sizes = folds.filter("role = 'train'").groupBy("symbol", "fold").count()
    trained = sizes.groupBy("symbol").agg(F.max("count").alias("n_train"))
    metrics = modeling.metrics_long(
        modeling.fold_summary(modeling.fold_metrics(scored)), version, trained_at, trained, test_size, vars(settings))
    _add(spark, metrics, f"{root}/model_metrics", ("model_version", "symbol", "metric_name"))
    for k in range(1, n_splits + 1):
        made = modeling.predictions(scored.filter(F.col("fold") == k), f"{version}_fold_{k}")
        _add(spark, made, f"{root}/predictions", PREDICTION_KEY)
    rows = modeling.with_validation_tail(matrix, test_size) if settings.patience else matrix
    boosting.train(rows, ["symbol"], features, settings).write.mode("overwrite").parquet(f"{root}/nodes/{version}")


def predict_each(spark: SparkSession, gold: DataFrame, root: str, version: str, features: Sequence[str]) -> None:
    """The newest feature row of every symbol that has a model, scored by its own model, into ``predictions``."""
    newest = modeling.latest_features(gold).select("symbol", "date", *features)
    scored = boosting.score(newest, spark.read.parquet(f"{root}/nodes/{version}"), ["symbol"], features)
    _add(spark, modeling.predictions(scored.filter("prediction IS NOT NULL"), version), f"{root}/predictions", PREDICTION_KEY)


def predict(spark: SparkSession, gold: DataFrame, root: str) -> None:
    """The newest feature row of every symbol, scored by the model trained last, into ``predictions``."""
    model, features, version = modeling.load_latest_model(spark, f"{root}/registry")
    middle = spark.read.parquet(f"{root}/medians/{version}")
    newest = modeling.latest_features(gold).select("symbol", "date", *features)
    filled = modeling.fill_with_medians(newest, middle, features, modeling.pooled_medians(middle, features))
    _add(spark, modeling.predictions(modeling.score(model, filled), version), f"{root}/predictions", PREDICTION_KEY)


def evaluated(spark: SparkSession, root: str) -> DataFrame:
    """Predictions with their outcomes where these are known."""
    rows = spark.read.parquet(f"{root}/predictions")
    if not tables.layer_exists(spark, f"{root}/outcomes"):
        return rows.withColumns({
            "actual_direction": F.lit(None).cast("int"), "actual_return": F.lit(None).cast("double"),
            "is_correct": F.lit(None).cast("boolean"), "evaluated_at": F.lit(None).cast("date")})
    return rows.join(spark.read.parquet(f"{root}/outcomes"), list(PREDICTION_KEY), "left")


def evaluate(spark: SparkSession, bars: DataFrame, root: str, as_of: str) -> None:
    """Outcomes that became known into ``outcomes``, and the performance of every version into ``model_performance``."""
    known = staged(monitoring.fill_outcomes(evaluated(spark, root).drop("evaluated_at"), bars, as_of), "outcomes")
    _add(spark, known.select(*PREDICTION_KEY, "actual_direction", "actual_return", "is_correct", "evaluated_at"),
         f"{root}/outcomes", PREDICTION_KEY)
    # Counts of a period grow until it ends, so each evaluation writes its own state.
    monitoring.performance_by_period(evaluated(spark, root)).write.mode("overwrite").parquet(
        f"{root}/model_performance/as_of={as_of}")
