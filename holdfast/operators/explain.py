"""Shapley values of linear and boosted-tree models, as long tables."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator, Sequence
from math import factorial

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators.boosting import BoostedModel
from holdfast.operators.ordering import quantiles
from holdfast.session import shared_root
from holdfast.sources.schemas import KEY

# The helpers below travel with the job, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

def linear_shap(data: DataFrame, weights: dict[str, float], background: DataFrame | None = None) -> DataFrame:
    """Shapley values of a linear margin: weight times the distance from the background mean."""
    columns = list(weights)
    filled = data.select(KEY, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    base = (background if background is not None else data).agg(
        *[F.avg(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(c) for c in columns]
    )
    means = base.select(F.struct("*")).scalar()
    entries = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(c).alias("value"),
            (F.lit(float(weights[c])) * (F.col(c) - F.col(f"_means.{c}"))).alias("shap"),
        )
        for c in columns
    ]
    return filled.withColumn("_means", means).select(KEY, F.inline(F.array(*entries)))


def logistic_weights(model: PipelineModel, columns: Sequence[str]) -> dict[str, float]:
    """Coefficients of a fitted logistic model, per column after standardisation."""
    return dict(zip(columns, model.stages[-1].coefficients.toArray().tolist()))


def shap_importance(shap: DataFrame, n: int | None = None) -> DataFrame:
    """Features by mean absolute Shapley value, largest first."""
    ranked = (
        shap.groupBy("feature")
        .agg(F.avg(F.abs("shap")).alias("mean_abs_shap"))
        .orderBy(F.desc("mean_abs_shap"), "feature")
    )
    return ranked if n is None else ranked.limit(n)


def shap_summary(shap: DataFrame) -> DataFrame:
    """Each value's impact with its colour: the value's place in its feature's range, 0 to 1.

    The range is the 5th to 95th percentile; if those are equal the 1st to 99th,
    and then the extremes.
    """
    ranges = quantiles(shap, "value", [0.05, 0.95, 0.01, 0.99, 0.0, 1.0], groups=["feature"])
    c = F.col
    spread, wide = c("q0") < c("q1"), c("q2") < c("q3")
    ranges = ranges.select(
        "feature",
        F.when(spread, c("q0")).when(wide, c("q2")).otherwise(c("q4")).alias("low"),
        F.when(spread, c("q1")).when(wide, c("q3")).otherwise(c("q5")).alias("high"),
    )
    place = F.coalesce(F.try_divide(c("value") - c("low"), c("high") - c("low")), F.lit(0.5))
    # One row per feature.
    return shap.join(F.broadcast(ranges), "feature", "inner").select(
        KEY,
        "feature",
        "value",
        "shap",
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), place)).alias("colour"),
    )


def tree_nodes(model: PipelineModel | BoostedModel) -> tuple[pd.DataFrame, list[float]]:
    """Node table and weights of a fitted tree ensemble, a forest's through its saved form.

    Its size is set by the number and depth of the trees, not by the data. A booster's cover is its sum of Hessians.
    """
    if isinstance(model, BoostedModel):
        return model.nodes(), [1.0] * len(model.trees)
    ensemble = model.stages[-1]
    spark = SparkSession.getActiveSession()
    path = f"{shared_root(spark)}/trees-{uuid.uuid4().hex}"
    ensemble.write().save(path)
    nodes = (
        spark.read.parquet(f"{path}/data")
        .select(
            F.col("treeID").alias("tree"),
            F.col("nodeData.id").alias("id"),
            F.col("nodeData.prediction").alias("prediction"),
            F.col("nodeData.rawCount").cast("double").alias("cover"),
            F.col("nodeData.leftChild").alias("left"),
            F.col("nodeData.rightChild").alias("right"),
            F.col("nodeData.split.featureIndex").alias("feature"),
            F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
            F.col("nodeData.impurityStats").alias("stats"),
            F.col("nodeData.gain").alias("gain"),
        )
        .toPandas()
    )
    return nodes, list(ensemble.treeWeights)


def leaf_paths(nodes: pd.DataFrame, weights: Sequence[float]) -> list[tuple]:
    """Every leaf as (weighted value, features, lower bounds, upper bounds, cover shares).

    A leaf is reached when each feature on its path lies in (lower, upper]; a cover
    share is the part of the training rows that stays on the path at that feature's
    splits, multiplied over repeated splits.
    """
    leaves = []
    for tree, table in nodes.groupby("tree"):
        rows = table.set_index("id").to_dict("index")
        pending = [(0, {})]
        while pending:
            node_id, path = pending.pop()
            node = rows[node_id]
            if node["left"] < 0:
                names = sorted(path)
                low, high, share = (np.array([path[f][i] for f in names], float) for i in range(3))
                leaves.append((weights[int(tree)] * node["prediction"], names, low, high, share))
                continue
            feature, threshold = int(node["feature"]), node["threshold"]
            low, high, share = path.get(feature, (-np.inf, np.inf, 1.0))
            for child, bounds in (
                (node["left"], (low, min(high, threshold))),
                (node["right"], (max(low, threshold), high)),
            ):
                kept = rows[child]["cover"] / node["cover"]
                pending.append((child, {**path, feature: (*bounds, share * kept)}))
    return leaves


def _subset_weights(size: int) -> np.ndarray:
    """Shapley weight of a coalition of each size among ``size`` players, seen from one of them."""
    return np.array([factorial(s) * factorial(size - 1 - s) / factorial(size) for s in range(size)])


def leaf_shap(x: np.ndarray, leaves: Sequence[tuple]) -> np.ndarray:
    """Path-dependent Shapley values of all rows (Lundberg et al. 2018), leaf by leaf.

    With a leaf's features in a coalition the leaf contributes 1 or 0 for each, and
    outside it the cover share. The sum over coalitions of each size is a coefficient of the
    product of all factors ``share + inside * z``, multiplied out once per leaf; one feature's own
    share needs it without that feature's factor, which is divided out again.
    """
    out = np.zeros(x.shape)
    for value, names, low, high, share in leaves:
        size = len(names)
        if size == 0:
            continue
        columns = x[:, names]
        inside = ((columns > low) & (columns <= high)).astype(float)
        weights = _subset_weights(size)
        whole = np.zeros((len(x), size + 1))
        whole[:, 0] = 1.0
        for j in range(size):
            whole[:, 1:] = whole[:, 1:] * share[j] + whole[:, :-1] * inside[:, j, None]
            whole[:, 0] *= share[j]
        for i in range(size):
            # A factor that is a number is divided out directly, the other by long division from the top.
            total, carried = np.zeros(len(x)), np.zeros(len(x))
            holds = inside[:, i] > 0
            for k in range(size - 1, -1, -1):
                carried = np.where(holds, whole[:, k + 1] - share[i] * carried, whole[:, k] / share[i])
                total += carried * weights[k]
            out[:, names[i]] += value * (inside[:, i] - share[i]) * total
    return out


def expected_margin(leaves: Sequence[tuple]) -> float:
    """Base value: every leaf weighted by the cover shares along its path."""
    return float(sum(value * np.prod(share) for value, _, _, _, share in leaves))


def tree_shap(model: BoostedModel, data: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Shapley values of a boosted model's log-odds: (key, feature, value, shap, base).

    The leaf list is broadcast, as its size depends on the model alone; rows are
    explained where they lie, in Arrow batches and without a shuffle.
    """
    names = list(columns)
    nodes, weights = tree_nodes(model)
    leaves = leaf_paths(nodes, weights)
    shared = data.sparkSession.sparkContext.broadcast(leaves)
    base = expected_margin(leaves)
    wide = data.select(KEY, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names])
    key_type = wide.schema[KEY].dataType.simpleString()

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = pdf[names].to_numpy(float)
            values = pd.DataFrame(leaf_shap(x, shared.value), columns=[f"shap_{c}" for c in names], index=pdf.index)
            yield pd.concat([pdf, values], axis=1)

    fields = ", ".join([f"{KEY} {key_type}", *[f"{c} double" for c in names], *[f"shap_{c} double" for c in names]])
    entries = [
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("value"), F.col(f"shap_{c}").alias("shap")) for c in names
    ]
    return wide.mapInPandas(explain, fields).select(KEY, F.inline(F.array(*entries)), F.lit(base).alias("base"))


def replayed(model: PipelineModel | BoostedModel, data: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(key, probability) of class 1, by walking the saved node table instead of asking the model.

    Boosted trees add up leaf values to the log-odds; a forest averages the class shares of its leaves. The
    node table is broadcast, as its size depends on the model alone.
    """
    names = list(columns)
    nodes, weights = tree_nodes(model)
    forest = not isinstance(model, BoostedModel)
    trees = []
    for tree, table in nodes.sort_values("id").groupby("tree"):
        value = table["prediction"].to_numpy(float)
        if forest:
            value = np.array([s[1] / sum(s) for s in table["stats"]])
        at = {i: row for row, i in enumerate(table["id"])}
        left, right = (np.array([at.get(i, 0) for i in table[c]]) for c in ("left", "right"))
        is_leaf, feature = (table["left"] < 0).to_numpy(), table["feature"].fillna(0).to_numpy(int)
        trees.append((weights[int(tree)], is_leaf, feature, table["threshold"].to_numpy(float), left, right, value))
    shared = data.sparkSession.sparkContext.broadcast(trees)
    wide = data.select(KEY, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names])
    key_type = wide.schema[KEY].dataType.simpleString()

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x, total = pdf[names].to_numpy(float), np.zeros(len(pdf))
            rows = np.arange(len(x))
            for weight, is_leaf, feature, threshold, left, right, value in shared.value:
                node = np.zeros(len(x), dtype=int)
                while (inner := ~is_leaf[node]).any():
                    goes_left = x[rows, feature[node]] <= threshold[node]
                    node = np.where(inner, np.where(goes_left, left[node], right[node]), node)
                total += weight * value[node]
            probability = total / sum(t[0] for t in shared.value) if forest else 1 / (1 + np.exp(-total))
            yield pd.DataFrame({KEY: pdf[KEY], "probability": probability})

    return wide.mapInPandas(walk, f"`{KEY}` {key_type}, probability double")


def tree_margin(model: BoostedModel, data: DataFrame) -> DataFrame:
    """The log-odds that the base and the Shapley values of a row add up to, from the model itself."""
    return data.select(KEY, model.margin().alias("margin"))
