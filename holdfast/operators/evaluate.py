"""Classifier evaluation over (model, label, probability) tables.

Scores are counted by distinct value first; curves then need one running total
over those counts, computed without a one-task window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions import safe_ratio
from holdfast.operators.ordering import row_numbers, running_totals

RECALL_THRESHOLD = 0.30


def hard_prediction(probability: Column, threshold: float = 0.5) -> Column:
    return (probability >= threshold).cast("int")


def confusion_counts(scored: DataFrame, threshold: float | None = None) -> DataFrame:
    """One row per model with the four cells; predicts from the probability when a threshold is given."""
    predicted = hard_prediction(F.col("probability"), threshold) if threshold is not None else F.col("prediction")
    label = F.col("label")
    cells = {"tp": (1, 1), "fp": (0, 1), "fn": (1, 0), "tn": (0, 0)}
    return scored.withColumn("_predicted", predicted.cast("int")).groupBy("model").agg(
        *[F.count_if((label == y) & (F.col("_predicted") == p)).alias(cell) for cell, (y, p) in cells.items()]
    )


def classification_report(scored: DataFrame, threshold: float | None = 0.5) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted averages.

    A ratio with a zero denominator is reported as 0.
    """

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(safe_ratio(top, bottom), F.lit(0.0))

    c = F.col
    counts = confusion_counts(scored, threshold)
    measured = (
        counts.withColumns(
            {
                "p0": ratio(c("tn"), c("tn") + c("fn")),
                "r0": ratio(c("tn"), c("tn") + c("fp")),
                "p1": ratio(c("tp"), c("tp") + c("fp")),
                "r1": ratio(c("tp"), c("tp") + c("fn")),
                "s0": c("tn") + c("fp"),
                "s1": c("tp") + c("fn"),
            }
        )
        .withColumns(
            {
                "f0": ratio(2 * c("p0") * c("r0"), c("p0") + c("r0")),
                "f1": ratio(2 * c("p1") * c("r1"), c("p1") + c("r1")),
                "total": c("s0") + c("s1"),
                "accuracy": ratio(c("tp") + c("tn"), c("s0") + c("s1")),
            }
        )
    )

    def line(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class_name"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1_score"),
            support.alias("support"),
        )

    def weighted(a: str, b: str) -> Column:
        return ratio(c(a) * c("s0") + c(b) * c("s1"), c("total"))

    lines = F.array(
        line("0", c("p0"), c("r0"), c("f0"), c("s0")),
        line("1", c("p1"), c("r1"), c("f1"), c("s1")),
        line("accuracy", c("accuracy"), c("accuracy"), c("accuracy"), c("total")),
        line("macro avg", (c("p0") + c("p1")) / 2, (c("r0") + c("r1")) / 2, (c("f0") + c("f1")) / 2, c("total")),
        line("weighted avg", weighted("p0", "p1"), weighted("r0", "r1"), weighted("f0", "f1"), c("total")),
    )
    return measured.select("model", F.inline(lines))


def score_counts(scored: DataFrame) -> DataFrame:
    """Positives and negatives at each distinct score."""
    return scored.where(F.col("probability").isNotNull()).groupBy("model", "probability").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )


def _descending(scored: DataFrame) -> DataFrame:
    """Per distinct score: positives and negatives scored at or above it, and class totals."""
    return running_totals(
        score_counts(scored),
        [F.desc("probability")],
        {"tp": "pos", "fp": "neg"},
        groups=["model"],
        with_totals=True,
    ).withColumnsRenamed({"tp_total": "all_pos", "fp_total": "all_neg"})


def roc_auc(scored: DataFrame) -> DataFrame:
    """Exact area under the ROC curve; tied scores count half. Null with a single class."""
    above = F.col("tp") - F.col("pos")
    wins = F.col("neg").cast("double") * (above.cast("double") + F.col("pos").cast("double") / 2)
    return (
        _descending(scored)
        .groupBy("model")
        .agg(
            F.sum(wins).alias("wins"),
            F.max("all_pos").alias("positives"),
            F.max("all_neg").alias("negatives"),
        )
        .select(
            "model",
            "positives",
            "negatives",
            F.try_divide(F.col("wins"), F.col("positives").cast("double") * F.col("negatives").cast("double")).alias(
                "roc_auc"
            ),
        )
    )


def roc_curve(scored: DataFrame, drop_intermediate: bool = False) -> DataFrame:
    """False and true positive rate at each distinct score, from the (0, 0) point down.

    ``drop_intermediate`` leaves out points whose steps on both sides are equal.
    """
    points = _descending(scored).select(
        "model",
        F.col("probability").alias("threshold"),
        "tp",
        "fp",
        "all_pos",
        "all_neg",
    )
    if drop_intermediate:
        points = _drop_collinear(points)
    rated = points.select(
        "model",
        "threshold",
        safe_ratio(F.col("fp"), F.col("all_neg")).alias("fpr"),
        safe_ratio(F.col("tp"), F.col("all_pos")).alias("tpr"),
    )
    starts = points.groupBy("model").agg(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return starts.unionByName(rated)


def _drop_collinear(points: DataFrame) -> DataFrame:
    """Keep first, last and corner points of each model's curve.

    A point is a corner when the counts gained on either side of it differ, so
    every point has to meet both neighbours: number the points, join on the number.
    """
    numbered = row_numbers(points, [F.desc("threshold")], "point", groups=["model"])
    step = numbered.select("model", "point", F.col("tp").alias("tp_at"), F.col("fp").alias("fp_at"))
    earlier = step.select(
        "model", (F.col("point") + 1).alias("point"), F.col("tp_at").alias("tp_prev"), F.col("fp_at").alias("fp_prev")
    )
    later = step.select(
        "model", (F.col("point") - 1).alias("point"), F.col("tp_at").alias("tp_next"), F.col("fp_at").alias("fp_next")
    )
    joined = numbered.join(earlier, ["model", "point"], "left").join(later, ["model", "point"], "left")
    turns = (F.col("tp") - F.col("tp_prev") != F.col("tp_next") - F.col("tp")) | (
        F.col("fp") - F.col("fp_prev") != F.col("fp_next") - F.col("fp")
    )
    ends = F.col("tp_prev").isNull() | F.col("tp_next").isNull()
    return joined.where(ends | turns).select(*points.columns)


def chance_line() -> list[tuple[str, float, float]]:
    """The two end points of the random-guess diagonal."""
    return [("random guess", 0.0, 0.0), ("random guess", 1.0, 1.0)]


def roc_with_chance(scored: DataFrame) -> DataFrame:
    """ROC points of every model plus the random-guess diagonal."""
    curve = roc_curve(scored)
    ends = F.array(
        *[
            F.struct(
                F.lit(model).alias("model"),
                F.lit(None).cast("double").alias("threshold"),
                F.lit(fpr).alias("fpr"),
                F.lit(tpr).alias("tpr"),
            )
            for model, fpr, tpr in chance_line()
        ]
    )
    diagonal = scored.sparkSession.range(1).select(F.inline(ends))
    return curve.unionByName(diagonal)


def precision_recall_curve(scored: DataFrame, closing_point: bool = True) -> DataFrame:
    """Precision and recall when predicting at or above each distinct score.

    ``closing_point`` adds the (precision 1, recall 0) point that has no threshold.
    """
    points = _descending(scored).select(
        "model",
        F.col("probability").alias("threshold"),
        F.coalesce(safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0)).alias("precision"),
        F.coalesce(safe_ratio(F.col("tp"), F.col("all_pos")), F.lit(1.0)).alias("recall"),
    )
    if not closing_point:
        return points
    closing = points.groupBy("model").agg(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(closing)


def threshold_report(scored: DataFrame, threshold: float = RECALL_THRESHOLD) -> DataFrame:
    """The classification report after predicting at a recall-oriented threshold."""
    return classification_report(scored, threshold)


def compare_models(scored_by_model: dict[str, DataFrame]) -> DataFrame:
    """Scored rows of several models stacked under their names."""
    named = [df.withColumn("model", F.lit(name)) for name, df in scored_by_model.items()]
    return reduce(DataFrame.unionByName, named)


def model_comparison(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Area under the curve with class-1 precision, recall and F1, best model first."""
    report = classification_report(scored, threshold).where(F.col("class_name") == "1")
    areas = roc_auc(scored).select("model", "roc_auc")
    return (
        areas.join(report.select("model", "precision", "recall", "f1_score"), "model", "inner")
        .withColumn("position", F.row_number().over(Window.orderBy(F.desc("roc_auc"), "model")))
        .orderBy("position")
    )
