"""Fitting, searching, saving and applying churn models: Spark ML, and the boosted trees of ``boosting``."""

from __future__ import annotations

import dataclasses
import random
from collections.abc import Iterable, Sequence
from itertools import product

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from holdfast.functions import sigmoid
from holdfast.operators import boosting
from holdfast.operators.boosting import BoostedModel, Fit
from holdfast.operators.prep import SEED, scaling_stats, smote, with_folds
from holdfast.session import materialise
from holdfast.sources.schemas import CORE9, KEY

# The search space, by the names of the booster's parameters.
SEARCH_SPACE = {
    "n_estimators": (100, 200, 300),
    "max_depth": (3, 5, 7),
    "learning_rate": (0.01, 0.05, 0.1),
    "subsample": (0.7, 0.8, 1.0),
    "colsample_bytree": (0.7, 0.8, 1.0),
    "scale_pos_weight": (1, 5, 10),
}

# Rows of one partition in a fitting pass: the fewest, and the most once there are that many partitions.
ROWS_PER_TASK = 2_000
FULL_TASK_ROWS = 100_000
FITTING_TASKS = 64

# A fixed-weight logistic score. It needs no fitting, so every operator that
# consumes probabilities can be checked exactly in another engine.
LINEAR_BIAS = -0.6
LINEAR_WEIGHTS = {
    "recency_days": 0.004,
    "order_count": -0.25,
    "total_spend": -0.0000005,
    "avg_order_value": 0.000005,
    "avg_delivery_delay": 0.06,
    "pct_late_orders": 0.5,
    "avg_review_score": -0.1,
    "pct_bad_reviews": 0.4,
    "category_diversity": 0.05,
}


def linear_margin(weights: dict[str, float] = LINEAR_WEIGHTS, bias: float = LINEAR_BIAS) -> Column:
    margin = F.lit(float(bias))
    for feature, weight in weights.items():
        margin = margin + F.lit(float(weight)) * F.coalesce(F.col(feature).cast("double"), F.lit(0.0))
    return margin


def linear_score(
    features: DataFrame, weights: dict[str, float] = LINEAR_WEIGHTS, bias: float = LINEAR_BIAS
) -> DataFrame:
    """Add ``churn_probability`` from fixed weights, to six decimals."""
    return features.withColumn("churn_probability", F.round(sigmoid(linear_margin(weights, bias)), 6))


def fitting_tasks(rows: int) -> int:
    """Partitions of a fitting pass. Every task of a forest's pass hands on sums for all open nodes of all trees, however few
    its rows, so there are no more than FITTING_TASKS of them until each has FULL_TASK_ROWS."""
    return max(1, min(rows // ROWS_PER_TASK, FITTING_TASKS), rows // FULL_TASK_ROWS)


def _spread(train: DataFrame, rows: int | None = None) -> DataFrame:
    """Training rows in ``fitting_tasks`` partitions, placed and ordered by key.

    Bagging draws by partition, so the number of partitions follows from the row count alone:
    the same table gives the same model on any cluster, and a refit bags the same rows.
    """
    rows = train.count() if rows is None else rows
    return train.repartition(fitting_tasks(rows), KEY).sortWithinPartitions(KEY)


def _vector_stage(columns: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="error")


def _scaling_stage(stats: Row, columns: Sequence[str]) -> SQLTransformer:
    """Population standardisation as a stage, so that it is saved with the model."""
    scaled = ", ".join(
        f"(`{c}` - CAST('{stats[f'{c}_mean']!r}' AS DOUBLE)) / CAST('{stats[f'{c}_sd']!r}' AS DOUBLE) AS `scaled_{c}`"
        for c in columns
    )
    return SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")


def fit_logistic(
    train: DataFrame, columns: Sequence[str] = CORE9, max_iter: int = 1000, c: float = 1.0
) -> PipelineModel:
    """L2 logistic regression on standardised columns; ``c`` is the inverse penalty on summed loss."""
    stats = scaling_stats(train, columns).first()
    rows = stats["rows_seen"]
    regression = LogisticRegression(
        labelCol="label", maxIter=max_iter, regParam=1.0 / (c * rows), elasticNetParam=0.0, standardization=False
    )
    stages = [_scaling_stage(stats, columns), _vector_stage([f"scaled_{f}" for f in columns]), regression]
    return Pipeline(stages=stages).fit(_spread(train, rows))


def fit_forest(
    train: DataFrame, columns: Sequence[str] = CORE9, trees: int = 200, depth: int = 10, seed: int = SEED
) -> PipelineModel:
    forest = RandomForestClassifier(
        labelCol="label", numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", seed=seed
    )
    return Pipeline(stages=[_vector_stage(columns), forest]).fit(_spread(train))


def fit_boosted(
    train: DataFrame, columns: Sequence[str] = CORE9, params: dict[str, float] | None = None, seed: int = SEED
) -> BoostedModel:
    """Boosted trees, by the search space's parameter names."""
    return boosting.fit(train, columns, boosting.params_of(params or {}), seed)


def draw_candidates(space: dict[str, Sequence], n_iter: int, seed: int = SEED) -> list[dict]:
    """Distinct random points of the grid, the same for the same seed."""
    grid = [dict(zip(space, values)) for values in product(*space.values())]
    return random.Random(seed).sample(grid, min(n_iter, len(grid)))


def random_search(
    train: DataFrame,
    columns: Sequence[str] = CORE9,
    space: dict[str, Sequence] = SEARCH_SPACE,
    n_iter: int = 30,
    cv: int = 5,
    seed: int = SEED,
    balance_within_fold: bool = False,
    rows_at_once: int = boosting.ROWS_AT_ONCE,
) -> tuple[BoostedModel, DataFrame]:
    """Random search by cross-validated ROC AUC: the refitted best model and the table of draws.

    All draws and folds grow side by side. With ``balance_within_fold`` each training part is oversampled by itself and
    judged on untouched rows; without it ``train`` is taken as already balanced.
    """
    draws = draw_candidates(space, n_iter, seed)
    params = [boosting.params_of(d) for d in draws]
    folded = materialise(with_folds(train, cv, seed=seed).select(KEY, "label", "fold", *columns), "folds")
    areas = np.full((len(draws), cv), np.nan)
    if balance_within_fold:
        for fold in range(cv):
            inner = smote(folded.where(F.col("fold") != fold).drop("fold"), columns, seed=seed).drop("synthetic")
            untouched = folded.where(F.col("fold") == fold).withColumn(KEY, F.col(KEY).cast("string"))
            rows = materialise(inner.withColumn("fold", F.lit(-1)).unionByName(untouched), "fold-train")
            grown, _ = boosting.fit_many(rows, columns, [Fit(p, fold) for p in params], seed, rows_at_once, with_trees=False)
            areas[:, fold] = [g.area for g in grown]
    else:
        fits = [Fit(p, fold) for p in params for fold in range(cv)]
        grown, _ = boosting.fit_many(folded, columns, fits, seed, rows_at_once, with_trees=False)
        areas[:] = np.array([g.area for g in grown], dtype=float).reshape(areas.shape)
    # A fold without both classes has no area.
    scores = [float(np.nanmean(a)) if np.isfinite(a).any() else 0.0 for a in areas]
    order = sorted(range(len(draws)), key=lambda i: (-scores[i], i))
    best = fit_boosted(train, columns, draws[order[0]], seed)
    rows = [(i, *[float(draws[i][p]) for p in space], scores[i], order.index(i) + 1) for i in range(len(draws))]
    fields = ", ".join(f"{p} double" for p in space)
    results = train.sparkSession.createDataFrame(rows, f"draw int, {fields}, mean_auc double, place int")
    return best, results


def best_params(results: DataFrame) -> DataFrame:
    return results.where(F.col("place") == 1)


def predict(model: PipelineModel | BoostedModel, data: DataFrame, keep: Iterable[str] = (KEY, "label")) -> DataFrame:
    """Hard prediction and class-1 probability."""
    if isinstance(model, BoostedModel):
        scored = data.withColumn("probability", sigmoid(model.margin()))
        return scored.select(*keep, (F.col("probability") >= 0.5).cast("int").alias("prediction"), "probability")
    return model.transform(data).select(
        *keep,
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("probability"),
    )


def score_customers(
    model: PipelineModel | BoostedModel, features: DataFrame, columns: Sequence[str] = CORE9
) -> DataFrame:
    """Append ``churn_probability`` to the feature rows; missing features count as 0."""
    if isinstance(model, BoostedModel):
        return features.withColumn("churn_probability", sigmoid(model.margin()))
    original = {f"_given_{c}": F.col(c) for c in columns}
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
    scored = model.transform(features.withColumns(original).withColumns(filled)).withColumn(
        "churn_probability", vector_to_array("probability")[1]
    )
    return scored.withColumns({c: F.col(f"_given_{c}") for c in columns}).select(
        *features.columns, "churn_probability"
    )


# Below a boosted model's folder: one row of parameters and cuts, and one row per tree.
_HEAD, _TREES = "head", "trees"


def save_model(model: PipelineModel | BoostedModel, path: str) -> None:
    if not isinstance(model, BoostedModel):
        model.write().overwrite().save(path)
        return
    spark = SparkSession.getActiveSession()
    head = [(model.columns, dataclasses.asdict(model.params), [c.tolist() for c in model.cuts])]
    params = ", ".join(f"{f.name}: {'int' if f.type == 'int' else 'double'}" for f in dataclasses.fields(model.params))
    schema = f"columns array<string>, params struct<{params}>, cuts array<array<double>>"
    trees = [(i, t.tobytes()) for i, t in enumerate(model.trees)]
    # Sizes set by the parameters, not by the data.
    spark.createDataFrame(trees, "tree int, nodes binary").coalesce(1).write.mode("overwrite").parquet(f"{path}/{_TREES}")
    spark.createDataFrame(head, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/{_HEAD}")


def load_model(path: str) -> PipelineModel | BoostedModel:
    spark = SparkSession.getActiveSession()
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{_HEAD}")
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return PipelineModel.load(path)
    head = spark.read.parquet(f"{path}/{_HEAD}").first()
    trees = spark.read.parquet(f"{path}/{_TREES}").orderBy("tree").collect()
    return BoostedModel(
        list(head.columns),
        boosting.Params(**head.params.asDict()),
        [np.array(c, dtype=float) for c in head.cuts],
        [np.frombuffer(t.nodes, dtype=boosting.NODE) for t in trees],
    )
