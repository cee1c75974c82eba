"""Training data, walk-forward folds, classifier metrics, boosted trees and scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.functions.ranking import medians
from barflow.functions.scalars import calendar_target, chosen_confidence
from barflow.functions.series import (
    DAILY, POSITION, TOTAL, Series, last_rows, number_rows, spread_join,
)
from barflow.operators import boosting
from barflow.session import staged

LABEL = "target_direction_5d"
# Columns of a feature row that are no features: its key, its targets and its stamps.
NOT_FEATURES = ("symbol", "date", LABEL, "future_return_5d", "computed_at")
N_SPLITS = 5
TEST_SIZE = 63
TOO_SHORT = "too_short"

# Learner settings.
LEARNER = {"maxIter": 500, "stepSize": 0.05, "maxDepth": 6, "minInstancesPerNode": 20,
           "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "seed": 42}


def feature_names(gold: DataFrame) -> list[str]:
    return [c for c in gold.columns if c not in NOT_FEATURES]


def feature_matrix(gold: DataFrame, target: str = LABEL) -> DataFrame:
    """Features as double and the label as int, rows without a label dropped."""
    if target not in gold.columns:
        raise ValueError(f"target column {target!r} is not in the data")
    return gold.dropna(subset=[target]).select(
        "symbol", "date",
        *[F.col(c).cast("double").alias(c) for c in feature_names(gold)],
        F.col(target).cast("int").alias("label"),
    )


def feature_medians(matrix: DataFrame, features: Sequence[str]) -> DataFrame:
    """Exact median per symbol and feature, one column per feature."""
    long = matrix.select(
        "symbol",
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in features
        ])).alias("e"),
    ).select("symbol", "e.*")
    return (
        medians(long, ["symbol", "feature"], "value")
        .groupBy("symbol")
        .pivot("feature", list(features))
        .agg(F.first("median"))
    )


def fill_with_medians(
    matrix: DataFrame, middle: DataFrame, features: Sequence[str], pooled: Mapping[str, float] | None = None
) -> DataFrame:
    """Nulls of each feature become the median of its symbol, else the ``pooled`` value of the feature."""
    renamed = middle.select("symbol", *[F.col(c).alias(f"_median_{c}") for c in features])
    rest = pooled or {}
    return (
        spread_join(matrix, renamed, ["symbol"], "left")
        .withColumns({
            c: F.coalesce(F.col(c), F.col(f"_median_{c}"), F.lit(rest.get(c)).cast("double")) for c in features
        })
        .select(*matrix.columns)
    )


def pooled_medians(middle: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Per feature the median of the symbols' medians, 0 where no symbol has one: one row for the driver.

    For symbols without a median of their own: a new symbol, or one that lacks a feature throughout.
    """
    row = middle.agg(*[F.median(c).alias(c) for c in features]).first()
    return {c: row[c] if row[c] is not None else 0.0 for c in features}


def still_missing(matrix: DataFrame, features: Sequence[str]) -> DataFrame:
    """Per symbol and feature the rows without a value, for those that have any."""
    counts = matrix.groupBy("symbol").agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in features])
    return counts.unpivot("symbol", list(features), "feature", "n_missing").filter("n_missing > 0")


def walk_forward(
    df: DataFrame, n_splits: int = N_SPLITS, test_size: int = TEST_SIZE, short: str = "raise",
    series: Series = DAILY,
) -> DataFrame:
    """Rows with ``fold`` (1..n_splits) and ``role`` (train or test), expanding window.

    Of N rows the last n_splits * test_size are tested, fold by fold; each fold trains on all rows
    before its test rows. A series shorter than (n_splits + 1) * test_size fails the job, or with
    ``short="mark"`` its rows come once, as fold 0 with the role ``too_short``.
    """
    if short not in ("raise", "mark"):
        raise ValueError(f"short is 'raise' or 'mark', got {short!r}")
    needed = (n_splits + 1) * test_size
    numbered = number_rows(df, series)
    if short == "raise":
        message = F.concat(
            F.lit(f"{n_splits} folds of {test_size} rows need {needed} rows, got "),
            F.col(TOTAL).cast("string"),
        )
        numbered = numbered.withColumn(
            TOTAL, F.when(F.col(TOTAL) < needed, F.raise_error(message)).otherwise(F.col(TOTAL))
        )
    fold = F.col("fold")
    test_end = F.col(TOTAL) - (n_splits - fold) * test_size
    numbers = F.when(F.col(TOTAL) < needed, F.array(F.lit(0))).otherwise(F.sequence(F.lit(1), F.lit(n_splits)))
    return (
        numbered.withColumn("fold", F.explode(numbers))
        .filter((fold == 0) | (F.col(POSITION) < test_end))
        .withColumn("role", F.when(fold == 0, TOO_SHORT).when(
            F.col(POSITION) >= test_end - test_size, "test").otherwise("train"))
    )


def fold_sizes(folds: DataFrame) -> DataFrame:
    """Sizes and dates per symbol and fold; a series too short for folds is fold 0 with its rows."""
    return folds.groupBy("symbol", "fold").agg(
        F.when(F.col("fold") == 0, TOO_SHORT).otherwise("ok").alias("status"),
        F.count(F.lit(1)).alias("row_total"),
        F.count_if(F.col("role") == "train").alias("train_size"),
        F.count_if(F.col("role") == "test").alias("test_size"),
        F.max(F.when(F.col("role") == "train", F.col("date"))).alias("train_end"),
        F.min(F.when(F.col("role") == "test", F.col("date"))).alias("test_start"),
        F.max(F.when(F.col("role") == "test", F.col("date"))).alias("test_end"),
    )


def confusion() -> list[Column]:
    """Counts of a 0/1 ``prediction`` against a 0/1 ``label``, as aggregates."""
    predicted, actual = F.col("prediction") == 1, F.col("label") == 1
    return [
        F.count_if(predicted & actual).alias("tp"),
        F.count_if(predicted & ~actual).alias("fp"),
        F.count_if(~predicted & actual).alias("fn"),
        F.count_if(~predicted & ~actual).alias("tn"),
    ]


def classifier_scores() -> dict[str, Column]:
    """Scores from tp, fp, fn and tn; a score without a denominator is 0."""

    def score(numerator: Column, denominator: Column) -> Column:
        return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    accuracy = score(tp + tn, tp + fp + fn + tn)
    return {
        "accuracy": accuracy,
        "precision": score(tp, tp + fp),
        "recall": score(tp, tp + fn),
        "f1_score": score(2 * tp, 2 * tp + fp + fn),
        "directional_accuracy": accuracy,
    }


SCORES = ("accuracy", "precision", "recall", "f1_score", "directional_accuracy")


def fold_metrics(scored: DataFrame, by: Sequence[str] = ("symbol", "fold")) -> DataFrame:
    """Classifier scores per symbol and fold from rows with ``prediction`` and ``label``."""
    counts = scored.groupBy(*by).agg(*confusion())
    return counts.withColumns(classifier_scores())


def fold_summary(metrics: DataFrame) -> DataFrame:
    """Mean scores over the folds and the population deviation of the accuracy; nulls without folds."""
    real = lambda c: F.when(F.col("fold") > 0, F.col(c))
    return metrics.groupBy("symbol").agg(
        *[F.avg(real(c)).alias(c) for c in SCORES],
        F.stddev_pop(real("accuracy")).alias("accuracy_std"),
        F.count(real("accuracy")).alias("n_splits"),
    )


def metrics_long(
    summary: DataFrame, model_version: str, trained_at: str, n_train: DataFrame, n_test: int,
    hyperparameters: Mapping[str, object],
) -> DataFrame:
    """One metric row per symbol and score; ``n_train`` has (symbol, n_train)."""
    entries = [
        F.struct(F.lit(c).alias("metric_name"), F.col(c).cast("double").alias("metric_value"))
        for c in (*SCORES, "accuracy_std", "n_splits")
    ]
    settings = F.struct(*[F.lit(v).alias(k) for k, v in hyperparameters.items()])
    return (
        summary.join(n_train, "symbol")
        .withColumn("m", F.explode(F.array(*entries)))
        .select(
            F.lit(model_version).alias("model_version"),
            F.lit(trained_at).cast("timestamp").alias("trained_at"),
            "symbol", "m.metric_name", "m.metric_value",
            F.col("n_train").cast("long").alias("n_train"),
            F.lit(n_test).cast("long").alias("n_test"),
            F.to_json(settings).alias("hyperparameters"),
        )
    )


# ---------------------------------------------------------------- boosted trees

def with_validation_tail(train: DataFrame, test_size: int, series: Series = DAILY) -> DataFrame:
    """Mark the newest training rows of every symbol for early stopping, so the test rows stay unseen.

    A series of fewer than two tails trains on all its rows and is not watched.
    """
    numbered = number_rows(train.drop(POSITION, TOTAL), series)
    newest = F.col(TOTAL) - F.col(POSITION) <= test_size
    return numbered.withColumn("is_validation", newest & (F.col(TOTAL) >= 2 * test_size)).drop(
        POSITION, TOTAL
    )


def fit(
    matrix: DataFrame, features: Sequence[str], settings: Mapping[str, object] = LEARNER,
    validation: bool = False, validation_tol: float = 1e-4,
) -> PipelineModel:
    """One boosted-tree model over all symbols; what tells symbols apart are their features."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    learner = GBTClassifier(featuresCol="features", labelCol="label", validationTol=validation_tol, **settings)
    if validation:
        learner = learner.setValidationIndicatorCol("is_validation")
    return Pipeline(stages=[assembler, learner]).fit(matrix)


def fit_watched(
    matrix: DataFrame, features: Sequence[str], settings: Mapping[str, object] = LEARNER, test_size: int = TEST_SIZE,
    series: Series = DAILY,
) -> PipelineModel:
    """A model on all rows, of which the newest of each symbol say when to stop adding trees."""
    return fit(staged(with_validation_tail(matrix, test_size, series), "train"), features, settings, validation=True)


def score(model: PipelineModel, matrix: DataFrame) -> DataFrame:
    """Rows with ``prediction`` and ``probability_up``; a missing feature column is an error."""
    absent = [c for c in model.stages[0].getInputCols() if c not in matrix.columns]
    if absent:
        raise ValueError(f"features missing for scoring: {absent}")
    scored = model.transform(matrix)
    return scored.select(
        *matrix.columns,
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("probability_up"),
    )


def train_walk_forward(
    folds: DataFrame, features: Sequence[str], n_splits: int = N_SPLITS,
    test_size: int = TEST_SIZE, settings: Mapping[str, object] = LEARNER,
    series: Series = DAILY,
) -> DataFrame:
    """Test rows of all folds with their predictions; one fit per fold, all symbols together.

    ``folds`` is the output of ``walk_forward`` over a feature matrix. Medians come from the training
    rows of the fold, and early stopping watches the newest training rows.
    """
    results = []
    for i in range(1, n_splits + 1):
        rows = folds.filter(F.col("fold") == i)
        train = rows.filter(F.col("role") == "train")
        middle = staged(feature_medians(train, features), "medians")
        pooled = pooled_medians(middle, features)
        model = fit_watched(fill_with_medians(train, middle, features, pooled), features, settings, test_size, series)
        test = fill_with_medians(rows.filter(F.col("role") == "test"), middle, features, pooled)
        results.append(score(model, test))
    scored = results[0]
    for more in results[1:]:
        scored = scored.unionByName(more)
    return scored


def train_each_symbol(
    folds: DataFrame, features: Sequence[str], settings: boosting.Boosting = boosting.Boosting(), test_size: int = TEST_SIZE,
) -> tuple[DataFrame, DataFrame]:
    """A model of its own for each symbol and fold: the test rows with predictions, and the node table.

    ``folds`` is the output of ``walk_forward`` over a feature matrix. All symbols and folds grow in the same jobs.
    Early stopping watches the newest training rows of each; nulls need no filling, as they go left in every split.
    """
    by = ["symbol", "fold"]
    rows = folds.filter("role = 'train'")
    if settings.patience:
        rows = with_validation_tail(rows, test_size, Series(keys=tuple(by)))
    nodes = staged(boosting.train(rows, by, features, settings), "fold-nodes")
    return boosting.score(folds.filter("role = 'test'"), nodes, by, features), nodes


def feature_importance(model: PipelineModel, features: Sequence[str], top: int | None = 20) -> DataFrame:
    """Features by importance, the most important first."""
    spark = SparkSession.getActiveSession()
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(w)) for name, w in zip(features, weights)]
    ranked = spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )
    return ranked.limit(top) if top is not None else ranked


def latest_features(gold: DataFrame) -> DataFrame:
    """The newest feature row of every symbol, by one combining aggregation."""
    rest = [c for c in gold.columns if c not in ("symbol", "date")]
    newest = gold.groupBy("symbol").agg(F.max_by(F.struct("date", *rest), "date").alias("_row"))
    return newest.select("symbol", "_row.*").select(*gold.columns)


def predictions(scored: DataFrame, model_version: str, horizon: int = 5) -> DataFrame:
    """Scored newest rows as stored predictions: P(up) and the confidence of the chosen class."""
    return scored.select(
        "symbol",
        F.col("date").alias("prediction_date"),
        calendar_target(F.col("date"), horizon).alias("target_date"),
        F.lit(model_version).alias("model_version"),
        F.col("prediction").alias("predicted_direction"),
        F.round("probability_up", 4).alias("probability_up"),
        chosen_confidence(F.col("prediction"), F.col("probability_up")).alias("confidence"),
    )


# ---------------------------------------------------------------- model registry

def save_model(
    model: PipelineModel, features: Sequence[str], root: str, version: str, trained_at: str
) -> str:
    """Store the model under its version and add a row to the registry table beside it."""
    spark = SparkSession.getActiveSession()
    path = f"{root}/{version}"
    model.write().overwrite().save(path)
    row = spark.createDataFrame(
        [(version, path, trained_at, list(features))],
        "version string, path string, trained_at string, features array<string>",
    )
    row.coalesce(1).write.mode("append").parquet(f"{root}/_registry")
    return path


def load_latest_model(spark: SparkSession, root: str) -> tuple[PipelineModel, list[str], str]:
    """The model trained last (of one moment, the last version) with its feature list and version."""
    newest = (
        spark.read.parquet(f"{root}/_registry")
        .agg(F.max_by(F.struct("path", "features", "version"), F.struct("trained_at", "version")).alias("m"))
        .select("m.*").first()
    )
    if newest["path"] is None:
        raise FileNotFoundError(f"no model registered under {root}")
    return PipelineModel.load(newest["path"]), list(newest["features"]), newest["version"]


def recent_outcomes(evaluated: DataFrame, n: int = 20) -> DataFrame:
    """Newest ``n`` predictions per symbol whose outcome is known."""
    known = evaluated.filter(F.col("actual_direction").isNotNull())
    return last_rows(known, n, Series(order="target_date"))
