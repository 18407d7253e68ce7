"""Facts about fitted models that hold whatever the fit, and that another engine can state from the tables.

A fitted model's numbers differ between engines; that it sits at its optimum, that its
predictions follow from its own node table, that its explanations add up and that a saved
model scores like the one in memory doesn't.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators import boosting, evaluate, explain, hazards, models
from holdfast.operators.boosting import BoostedModel
from holdfast.operators.hazards import HazardModel
from holdfast.operators.prep import SEED
from holdfast.operators.retention import with_defaults
from holdfast.operators.segments import risk_tier
from holdfast.plans.churn import serve
from holdfast.sources.schemas import CORE9, KEY


def _nothing(value: Column, digits: int) -> Column:
    """Rounded, so that what is left of floating-point noise is 0 (and never -0)."""
    return F.round(F.abs(value), digits)


def logistic_optimum(model: PipelineModel, train: DataFrame, columns: Sequence[str] = CORE9, c: float = 1.0) -> DataFrame:
    """Per column the slope of the penalised loss at the fitted coefficients, and the training rows by class."""
    fitted = model.stages[-1]
    scored = models.predict(model, train, keep=("label", *[f"scaled_{x}" for x in columns]))
    error = F.col("probability") - F.col("label")
    sums = scored.agg(
        F.count_if(F.col("label") == 0).alias("rows_0"),
        F.count_if(F.col("label") == 1).alias("rows_1"),
        *[F.sum(error * F.col(f"scaled_{x}")).alias(x) for x in columns],
    )
    slopes = F.array(
        *[
            F.struct(
                F.lit(x).alias("feature"),
                _nothing((F.col(x) + F.lit(float(w) / c)) / (F.col("rows_0") + F.col("rows_1")), 3).alias("slope"),
            )
            for x, w in zip(columns, fitted.coefficients.toArray())
        ]
    )
    return sums.select("rows_0", "rows_1", F.inline(slopes))


def hazard_optimum(model: HazardModel, lives: DataFrame) -> DataFrame:
    """Per covariate the mean slope of the partial likelihood at the fitted weights, with the rows and deaths used."""
    p = len(model.columns)
    rows, _, _ = hazards.prepared(lives, model.columns)
    _, slope, _ = hazards.likelihood(hazards.day_sums(rows, p, model.weights), p)
    gained = model.reached >= model.start
    used = rows.agg(F.count("*").alias("lives"), F.sum(F.col("event").cast("long")).alias("deaths"))
    facts = F.array(
        *[
            F.struct(F.lit(name).alias("feature"), _nothing(F.lit(float(g)) / F.col("lives"), 6).alias("slope"))
            for name, g in zip(model.columns, slope)
        ]
    )
    return used.select(
        "lives", "deaths", F.lit(bool(gained)).alias("gained"), F.lit(bool(model.converged)).alias("converged"), F.inline(facts)
    )


def tree_predictions(model: PipelineModel | BoostedModel, data: DataFrame, columns: Sequence[str] = CORE9) -> DataFrame:
    """Per row whether the probability is one and agrees with the prediction, and its distance from the node table's."""
    found = models.predict(model, data)
    own = explain.replayed(model, data, columns).withColumnRenamed("probability", "replayed")
    p = F.col("probability")
    return found.join(own, KEY).select(
        KEY,
        "label",
        p.between(0, 1).alias("is_probability"),
        # At exactly one half a tie may go either way.
        ((F.col("prediction") == evaluate.hard_prediction(p)) | (p == 0.5)).alias("agrees"),
        _nothing(p - F.col("replayed"), 6).alias("difference"),
    )


def _deepest(nodes: pd.DataFrame) -> int:
    """Splits on the longest path of any tree."""
    depth = {}
    for n in nodes.sort_values(["tree", "id"]).itertuples():
        own = depth.setdefault((n.tree, n.id), 0)
        if n.left >= 0:
            depth[n.tree, n.left] = depth[n.tree, n.right] = own + 1
    return max(depth.values(), default=0)


def booster_facts(model: BoostedModel, train: DataFrame, seed: int = SEED) -> DataFrame:
    """One row: numbers of trees and levels, and how far leaves and gains are from what the rows that reach them say.

    Rows walk every tree by its thresholds; gradients are taken at the margins of the trees before it and added up by
    node. A leaf must be the penalised Newton step of its sums, a split's gain follow from those of its children, and the
    loss over all rows fall with every round that all rows and columns took part in, and in the end.
    """
    nodes, p = model.nodes(), model.params
    names = list(model.columns)
    # A node's place is its id.
    tables = [
        (
            t["left"].to_numpy(int),
            t["right"].to_numpy(int),
            t["feature"].fillna(0).to_numpy(int),
            t["threshold"].to_numpy(float),
            t["prediction"].to_numpy(float),
        )
        for _, t in nodes.sort_values("id").groupby("tree")
    ]
    spread = train.select(
        F.xxhash64(KEY).alias("hash"), F.col("label").cast("double").alias("label"), *[F.col(c).cast("double").alias(c) for c in names]
    )

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, losses, seen = [np.zeros((2, len(t[0]))) for t in tables], np.zeros(len(tables) + 1), False
        for pdf in batches:
            if pdf.empty:
                continue
            seen = True
            x, y, rows = pdf[names].to_numpy(float), pdf["label"].to_numpy(), np.arange(len(pdf))
            weight = np.where(y == 1, p.scale_pos_weight, 1.0)
            margin = np.zeros(len(pdf))
            for tree, (left, right, feature, threshold, value) in enumerate(tables):
                rate = 1 / (1 + np.exp(-margin))
                taken = boosting.sampled(pdf["hash"].to_numpy(), p.subsample, seed, tree)
                g, h = weight * (rate - y), weight * rate * (1 - rate)
                losses[tree] += (weight * (np.logaddexp(0, margin) - y * margin)).sum()
                at = np.zeros(len(pdf), dtype=int)
                while (inner := left[at] >= 0).any():
                    lower = np.where(x[rows, feature[at]] <= threshold[at], left[at], right[at])
                    at = np.where(inner, lower, at)
                for total, values in zip(sums[tree], (g, h)):
                    total += np.bincount(at[taken], values[taken], minlength=len(left))
                margin = margin + value[at]
            losses[-1] += (weight * (np.logaddexp(0, margin) - y * margin)).sum()
        if not seen:
            return
        for tree, (left, right, *_) in enumerate(tables):
            # Only leaves have sums so far; children come after their parent.
            for node in np.nonzero(left >= 0)[0][::-1]:
                sums[tree][:, node] = sums[tree][:, left[node]] + sums[tree][:, right[node]]
            loss = np.where(np.arange(len(left)) == 0, losses[tree], 0.0)
            yield pd.DataFrame({"tree": tree, "id": np.arange(len(left)), "g": sums[tree][0], "h": sums[tree][1], "loss": loss})
        yield pd.DataFrame([(len(tables), 0, 0.0, 0.0, losses[-1])], columns=["tree", "id", "g", "h", "loss"])

    # As many rows as the model has nodes, once per task.
    sums = spread.mapInPandas(walk, "tree int, id int, g double, h double, loss double").groupBy("tree", "id")
    sums = sums.agg(*[F.sum(c).alias(c) for c in ("g", "h", "loss")]).toPandas()
    both = nodes.merge(sums, on=["tree", "id"], how="left")
    both["score"] = both["g"] ** 2 / (both["h"] + p.reg_lambda)
    leaf = -p.learning_rate * both["g"] / (both["h"] + p.reg_lambda)
    score = both.set_index(["tree", "id"])["score"]
    inner = both[both["left"] >= 0]
    children = [score.loc[list(zip(inner["tree"], inner[side]))].to_numpy() for side in ("left", "right")]
    gain = 0.5 * (children[0] + children[1] - inner["score"].to_numpy())
    losses = sums[sums["id"] == 0].sort_values("tree")["loss"].to_numpy()
    falls = losses[-1] < losses[0] and (p.subsample < 1 or bool((np.diff(losses) <= 1e-9).all()))
    apart = [np.abs(both["prediction"] - leaf).max(), np.abs(inner["gain"].to_numpy() - gain).max() if len(inner) else 0.0]
    row = (nodes["tree"].nunique(), _deepest(nodes), round(float(apart[0]), 4) + 0.0, round(float(apart[1]), 3) + 0.0, bool(falls))
    fields = "trees long, levels int, leaf_difference double, gain_difference double, loss_falls boolean"
    return train.sparkSession.createDataFrame([row], fields)


def first_split(model: BoostedModel) -> DataFrame:
    """The first tree's root: column, threshold, gain and the two leaf values; no row if nothing was to gain."""
    rows = []
    for n in model.nodes()[lambda t: (t["tree"] == 0) & (t["id"] == 0) & (t["left"] >= 0)].itertuples():
        values = model.nodes().set_index(["tree", "id"])["prediction"]
        numbers = (n.threshold, n.gain, values[0, n.left], values[0, n.right])
        rows.append((model.columns[int(n.feature)], *(round(float(v), 6) for v in numbers)))
    fields = "feature string, threshold double, gain double, left_value double, right_value double"
    return SparkSession.getActiveSession().createDataFrame(rows, fields)


def forest_facts(model: PipelineModel, train: DataFrame) -> DataFrame:
    """One row: numbers of trees and levels, how far recorded gains are from those of the class counts in the nodes, and
    whether the forest orders its own training rows far better than chance."""
    nodes, weights = explain.tree_nodes(model)
    stats = nodes.set_index(["tree", "id"])["stats"].map(lambda s: np.array(s, dtype=float))

    def impurity(counts: pd.Series) -> np.ndarray:
        return np.array([1 - ((c / c.sum()) ** 2).sum() for c in counts])

    inner = nodes[nodes["left"] >= 0]
    own = stats.loc[list(zip(inner["tree"], inner["id"]))]
    sides = [stats.loc[list(zip(inner["tree"], inner[side]))] for side in ("left", "right")]
    shares = [np.array([s.sum() for s in side]) / np.array([s.sum() for s in own]) for side in sides]
    gain = impurity(own) - shares[0] * impurity(sides[0]) - shares[1] * impurity(sides[1])
    apart = float(np.abs(inner["gain"].to_numpy() - gain).max()) if len(inner) else 0.0
    area = models.predict(model, train).select(F.lit("forest").alias("model"), "label", "probability")
    row = (len(weights), _deepest(nodes), round(apart, 6) + 0.0)
    fields = "trees long, levels int, gain_difference double"
    judged = evaluate.model_comparison(area).select((F.col("roc_auc") > 0.8).alias("orders_rows"))
    facts = train.sparkSession.createDataFrame([row], fields)
    return facts.withColumn("orders_rows", judged.scalar())


def shapley_sums(model: BoostedModel, data: DataFrame, columns: Sequence[str] = CORE9) -> DataFrame:
    """Per row the number of values and the distance of base and values from the model's own log-odds."""
    values = explain.tree_shap(model, data, columns)
    sums = values.groupBy(KEY).agg(F.count("*").alias("features"), (F.sum("shap") + F.first("base")).alias("total"))
    return sums.join(explain.tree_margin(model, data), KEY).select(
        KEY, "features", _nothing(F.col("total") - F.col("margin"), 6).alias("difference")
    )


def search_draws(results: DataFrame, space: dict[str, Sequence]) -> DataFrame:
    """One row: how many draws there are, are distinct and lie in the grid, and whether places and best draw are right."""
    names = list(space)
    grid = results.sparkSession.createDataFrame(
        [tuple(map(float, values)) for values in product(*space.values())], ", ".join(f"{p} double" for p in names)
    )
    best = models.best_params(results).agg(F.max("mean_auc").alias("best_auc"), F.count("*").alias("best_rows"))
    return (
        results.agg(
            F.count("*").alias("draws"),
            F.countDistinct(*names).alias("distinct_draws"),
            F.sort_array(F.collect_list("place")).alias("places"),
            F.max("mean_auc").alias("top_auc"),
            F.bool_and(F.col("mean_auc").between(0, 1)).alias("areas_valid"),
        )
        .join(results.join(grid, names, "left_semi").agg(F.count("*").alias("inside_grid")))
        .join(best)
        .select(
            "draws",
            "distinct_draws",
            "inside_grid",
            "areas_valid",
            (F.col("places") == F.sequence(F.lit(1), F.col("draws").cast("int"))).alias("places_complete"),
            ((F.col("best_rows") == 1) & (F.col("best_auc") == F.col("top_auc"))).alias("best_is_first"),
        )
    )


def areas(scored: DataFrame) -> DataFrame:
    """Per model the distance of the exact area under the curve from Spark's evaluator."""
    judge = BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="probability", metricName="areaUnderROC", numBins=0
    )
    comparison = evaluate.model_comparison(scored)
    names = [r.model for r in comparison.select("model").collect()]  # one row per model
    known = [(name, float(judge.evaluate(scored.where(F.col("model") == name)))) for name in names]
    judged = scored.sparkSession.createDataFrame(known, "model string, judged double")
    return comparison.join(judged, "model").select("model", _nothing(F.col("roc_auc") - F.col("judged"), 6).alias("difference"))


def stored_scores(stored: DataFrame, model: PipelineModel | BoostedModel, features: DataFrame) -> DataFrame:
    """Per person whether the stored tier is that of the stored probability, and its distance from the score in memory."""
    here = models.score_customers(model, features).select(KEY, F.col("churn_probability").alias("here"))
    return stored.join(here, KEY, "full").select(
        KEY,
        F.col("risk_tier").eqNullSafe(risk_tier(F.col("churn_probability"))).alias("tier_agrees"),
        _nothing(F.col("churn_probability") - F.col("here"), 6).alias("difference"),
    )


def served_scores(records: DataFrame, model: BoostedModel) -> DataFrame:
    """Per input record its fields out of range, whether tier and action are those of its probability, and that one's
    distance from the node table's for the completed record."""
    served = serve(records, lambda df: models.score_customers(model, df))
    own = explain.replayed(model, with_defaults(records), model.columns)
    p = F.col("churn_probability")
    tier = risk_tier(p, "left")
    return served.join(own, KEY).select(
        KEY,
        "fields_out_of_range",
        (F.col("risk_tier") == tier).alias("tier_agrees"),
        F.col("recommended_action").isNotNull().alias("has_action"),
        _nothing(p - F.col("probability"), 6).alias("difference"),
    )
