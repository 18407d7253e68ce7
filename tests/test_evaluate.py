import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from holdfast.operators import evaluate as E


def frame(spark, rows, model="m"):
    return spark.createDataFrame([(model, int(y), float(p)) for y, p in rows], "model string, label int, probability double")


def pairwise_auc(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


def test_auc_counts_ties_half(spark):
    rows = [(1, 0.9), (0, 0.5), (1, 0.5), (0, 0.5), (0, 0.1), (1, 0.1)]
    assert E.roc_auc(frame(spark, rows)).first().roc_auc == pytest.approx(pairwise_auc(rows))


def test_auc_properties(spark):
    @settings(max_examples=4, deadline=None)
    @given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 8)), min_size=4, max_size=60))
    def check(draws):
        rows = [(y, p / 8) for y, p in [(0, 1), (1, 2), *draws]]
        straight = frame(spark, rows)
        scored = E.compare_models(
            {
                "p": straight,
                "flipped": straight.withColumn("probability", 1 - F.col("probability")),
                "squared": straight.withColumn("probability", F.col("probability") ** 2),
            }
        )
        auc = {r.model: r.roc_auc for r in E.roc_auc(scored).collect()}
        assert auc["p"] == pytest.approx(pairwise_auc(rows), abs=1e-6)
        assert auc["flipped"] == pytest.approx(1 - auc["p"], abs=2e-6)
        assert auc["squared"] == auc["p"]

    check()


def test_auc_equals_spark_evaluator(spark):
    df = spark.range(3000).select(
        F.lit("m").alias("model"),
        (F.pmod(F.hash("id"), F.lit(3)) == 0).cast("int").alias("label"),
        (F.pmod(F.hash(F.col("id") + 7), F.lit(97)) / 97.0).alias("probability"),
    )
    judged = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="probability", numBins=0).evaluate(
        df.withColumn("label", F.col("label").cast("double"))
    )
    assert E.roc_auc(df).first().roc_auc == pytest.approx(judged, abs=1e-6)


def test_single_class_has_no_area(spark):
    scored = frame(spark, [(1, 0.2), (1, 0.7)])
    assert E.roc_auc(scored).first().roc_auc is None
    report = {r.class_name: r for r in E.classification_report(scored, 0.5).collect()}
    assert (report["0"].precision, report["0"].recall, report["0"].support) == (0.0, 0.0, 0)
    assert (report["1"].precision, report["1"].recall) == (1.0, 0.5)


def test_curve_drops_only_points_on_straight_lines(spark):
    rng = np.random.default_rng(3)
    rows = [(int(rng.random() < 0.4 + 0.3 * p), p) for p in np.round(rng.random(400), 2)]
    full = E.roc_curve(frame(spark, rows)).toPandas()
    short = E.roc_curve(frame(spark, rows), drop_intermediate=True).toPandas()

    scores = sorted({p for _, p in rows}, reverse=True)
    tps = np.array([sum(y for y, p in rows if p >= s) for s in scores])
    fps = np.array([sum(1 - y for y, p in rows if p >= s) for s in scores])
    keep = np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True]
    assert len(full) == len(scores) + 1
    assert sorted(short.threshold.dropna()) == sorted(np.array(scores)[keep])
    ordered = full.sort_values(["fpr", "tpr"])
    assert (ordered.tpr.diff().dropna() >= 0).all()


def test_precision_recall_points(spark):
    points = E.precision_recall_curve(frame(spark, [(1, 0.8), (0, 0.4), (1, 0.4), (0, 0.1)])).toPandas()
    got = {(t if t == t else None): (p, r) for t, p, r in zip(points.threshold, points.precision, points.recall)}
    assert got == {0.8: (1.0, 0.5), 0.4: (2 / 3, 1.0), 0.1: (0.5, 1.0), None: (1.0, 0.0)}
    assert E.precision_recall_curve(frame(spark, [(1, 0.8)]), closing_point=False).count() == 1


def test_report_from_predictions_matches_threshold_form(spark):
    scored = frame(spark, [(1, 0.8), (0, 0.4), (1, 0.35), (0, 0.1)])
    hard = scored.withColumn("prediction", E.hard_prediction(F.col("probability"), 0.3))
    assert E.classification_report(hard, None).collect() == E.threshold_report(scored).collect()
