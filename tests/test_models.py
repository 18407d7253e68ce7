import uuid
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.operators import boosting as B
from holdfast.operators import explain as X
from holdfast.operators import models as M
from holdfast.operators.segments import with_tier
from holdfast.plans import checks
from holdfast.plans.churn import scoring_job
from holdfast.session import materialise, shared_root
from holdfast.sources.schemas import KEY

COLS = ["a", "b", "c"]
SMALL = {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.3}


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3)) * [1, 5, 100]
    margin = 1.5 * x[:, 0] - 0.2 * x[:, 1] + np.where(x[:, 2] > 50, 1.0, -0.5)
    y = (rng.random(300) < 1 / (1 + np.exp(-margin))).astype(int)
    rows = [(f"k{i}", int(y[i]), *map(float, x[i])) for i in range(300)]
    return materialise(spark.createDataFrame(rows, f"{KEY} string, label int, a double, b double, c double"), "train")


@pytest.fixture(scope="module")
def boosted(train):
    return M.fit_boosted(train, COLS, SMALL)


def test_logistic_regression_reaches_the_penalised_optimum(train):
    model = M.fit_logistic(train, COLS)
    got = model.stages[-1]
    pdf = train.toPandas()
    x = pdf[COLS].to_numpy()
    z = np.c_[(x - x.mean(0)) / x.std(0), np.ones(len(x))]
    y, w = pdf.label.to_numpy(), np.zeros(4)
    penalty = np.diag([1.0, 1.0, 1.0, 0.0])  # inverse strength 1 on the summed loss
    for _ in range(30):
        p = 1 / (1 + np.exp(-z @ w))
        w -= np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + penalty, z.T @ (p - y) + penalty @ w)
    assert np.allclose([*got.coefficients.toArray(), got.intercept], w, atol=1e-3)


def test_fits_do_not_depend_on_how_the_rows_lie(spark, train, monkeypatch):
    monkeypatch.setattr(M, "ROWS_PER_TASK", 60)
    for fit in (lambda t: M.fit_forest(t, COLS, trees=5, depth=3), lambda t: M.fit_boosted(t, COLS, {**SMALL, "subsample": 0.7})):
        one, other = (M.predict(fit(train.repartition(n)), train) for n in (2, 7))
        assert one.exceptAll(other).count() == 0
    assert M._spread(train.repartition(7)).rdd.getNumPartitions() == 5


def test_replayed_probabilities_are_the_models_own(train, boosted):
    for model in (boosted, M.fit_forest(train, COLS, trees=7, depth=4)):
        own = X.replayed(model, train, COLS).withColumnRenamed("probability", "replayed")
        joined = M.predict(model, train).join(own, KEY)
        assert joined.count() == 300
        assert joined.where("abs(probability - replayed) > 1e-9").count() == 0


def test_predictions_have_the_contract_columns(train):
    out = M.predict(M.fit_forest(train, COLS, trees=5, depth=3), train)
    assert out.columns == [KEY, "label", "prediction", "probability"]
    assert out.where(~F.col("probability").between(0, 1)).count() == 0


def test_saved_models_predict_the_same(spark, train, boosted):
    for model in (boosted, M.fit_logistic(train, COLS)):
        path = f"{shared_root(spark)}/saved-{uuid.uuid4().hex}"
        M.save_model(model, path)
        before, after = M.predict(model, train), M.predict(M.load_model(path), train)
        assert before.exceptAll(after).count() == 0


def test_scoring_keeps_the_given_columns(spark, train, boosted):
    given = train.withColumn("a", F.when(F.col(KEY) != "k0", F.col("a")))
    scored = M.score_customers(boosted, given, COLS)
    assert scored.columns == [*given.columns, "churn_probability"]
    assert scored.where(f"{KEY} = 'k0'").first().a is None
    one = M.score_customers(boosted, given.where(f"{KEY} = 'k1'"), COLS)
    assert one.first().churn_probability == scored.where(f"{KEY} = 'k1'").first().churn_probability


def test_scoring_job_writes_tiers(spark, train, boosted):
    path = f"{shared_root(spark)}/job-{uuid.uuid4().hex}"
    out = scoring_job(spark, boosted, train, path, COLS)
    assert out.count() == 300
    again = with_tier(out.drop("risk_tier")).select(KEY, "risk_tier")
    assert again.exceptAll(out.select(KEY, "risk_tier")).count() == 0


def test_candidates_are_distinct_and_repeatable():
    draws = M.draw_candidates(M.SEARCH_SPACE, 30)
    assert len(draws) == 30 == len({tuple(d.values()) for d in draws})
    assert draws == M.draw_candidates(M.SEARCH_SPACE, 30) != M.draw_candidates(M.SEARCH_SPACE, 30, seed=1)


@pytest.mark.parametrize("within", [False, True])
def test_random_search_returns_best_draw(train, within):
    space = {"n_estimators": (2,), "max_depth": (1, 2), "learning_rate": (0.3,), "subsample": (1.0,),
             "colsample_bytree": (0.7,), "scale_pos_weight": (1, 5)}
    model, results = M.random_search(train, COLS, space, n_iter=2, cv=2, balance_within_fold=within)
    rows = results.toPandas()
    assert sorted(rows.place) == [1, 2] and rows.mean_auc.between(0.5, 1).all()
    best = M.best_params(results).first()
    assert best.mean_auc == rows.mean_auc.max()
    assert model.params.max_depth == best.max_depth


def exact_shapley(nodes, weights, x, size):
    """Brute force over coalitions with the cover-weighted tree expectation."""

    def value(known):
        total = 0.0
        for tree, table in nodes.groupby("tree"):
            rows = table.set_index("id").to_dict("index")

            def walk(i):
                n = rows[i]
                if n["left"] < 0:
                    return n["prediction"]
                if int(n["feature"]) in known:
                    return walk(n["left"] if x[int(n["feature"])] <= n["threshold"] else n["right"])
                share = rows[n["left"]]["cover"] / n["cover"]
                return share * walk(n["left"]) + (1 - share) * walk(n["right"])

            total += weights[int(tree)] * walk(0)
        return total

    out = []
    for i in range(size):
        others = [j for j in range(size) if j != i]
        out.append(
            sum(
                factorial(len(s)) * factorial(size - 1 - len(s)) / factorial(size) * (value({*s, i}) - value(set(s)))
                for r in range(size)
                for s in combinations(others, r)
            )
        )
    return out


def test_tree_shap_equals_brute_force_and_adds_up(train, boosted):
    shap = X.tree_shap(boosted, train, COLS)
    wide = shap.groupBy(KEY).pivot("feature", COLS).agg(F.first("shap")).toPandas().set_index(KEY)
    nodes, weights = X.tree_nodes(boosted)
    data = train.toPandas().set_index(KEY)
    for key in ["k0", "k7", "k42"]:
        want = exact_shapley(nodes, weights, data.loc[key, COLS].to_numpy(float), 3)
        assert np.allclose(wide.loc[key, COLS].to_numpy(float), want, atol=1e-9)
    total = shap.groupBy(KEY).agg((F.sum("shap") + F.max("base")).alias("total"))
    apart = total.join(X.tree_margin(boosted, train), KEY).agg(F.max(F.abs(F.col("total") - F.col("margin"))))
    assert apart.first()[0] < 1e-9


def test_linear_shap_adds_up_to_the_margin(train):
    weights = {"a": 0.5, "b": -1.0, "c": 0.01}
    shap = X.linear_shap(train, weights).groupBy(KEY).agg(F.sum("shap").alias("s"))
    means = train.agg(*[F.avg(c).alias(c) for c in COLS]).first()
    base = sum(weights[c] * means[c] for c in COLS)
    margin = sum(F.col(c) * w for c, w in weights.items())
    apart = shap.join(train, KEY).agg(F.max(F.abs(F.col("s") + base - margin)))
    assert apart.first()[0] < 1e-9


def test_importance_and_summary(spark):
    rows = [("x", "a", 1.0, -2.0), ("y", "a", 3.0, 1.0), ("x", "b", 5.0, 0.5), ("y", "b", 5.0, 0.5)]
    shap = spark.createDataFrame(rows, f"{KEY} string, feature string, value double, shap double")
    assert [tuple(r) for r in X.shap_importance(shap).collect()] == [("a", 1.5), ("b", 0.5)]
    assert X.shap_importance(shap, 1).count() == 1
    colours = {(r[KEY], r.feature): r.colour for r in X.shap_summary(shap).collect()}
    assert colours == {("x", "a"): 0.0, ("y", "a"): 1.0, ("x", "b"): 0.5, ("y", "b"): 0.5}


def test_facts_tell_right_boosters_from_wrong_ones(train):
    chosen = {**SMALL, "subsample": 0.8, "colsample_bytree": 0.7, "scale_pos_weight": 2}
    model = M.fit_boosted(train, COLS, chosen)
    right = checks.booster_facts(model, train).first()
    assert tuple(right) == (4, 3, 0.0, 0.0, True)
    flipped = train.withColumn("label", 1 - F.col("label"))
    assert checks.booster_facts(model, flipped).first().leaf_difference > 0.05
    assert not checks.booster_facts(M.fit_boosted(flipped, COLS, chosen), train).first().loss_falls
    rng = np.random.default_rng(2)
    mixed = []
    for tree in model.trees:
        tree, leaves = tree.copy(), tree["feature"] < 0
        tree["grad"][leaves] = rng.permutation(tree["grad"][leaves])
        mixed.append(tree)
    shuffled = B.BoostedModel(model.columns, model.params, model.cuts, mixed)
    assert checks.booster_facts(shuffled, train).first().leaf_difference > 0.05
    half = B.BoostedModel(model.columns, model.params, model.cuts, model.trees[:2])
    assert checks.booster_facts(half, train).first().trees == 2


def test_booster_facts_hand_on_one_row_per_node_and_task(spark, train, monkeypatch):
    """However many batches of rows a task has."""
    model, made = M.fit_boosted(train, COLS, SMALL), []
    whole = type(train).mapInPandas

    def watched(self, *args, **kwargs):
        made.append(whole(self, *args, **kwargs))
        return made[-1]

    monkeypatch.setattr(type(train), "mapInPandas", watched)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        assert tuple(checks.booster_facts(model, train.coalesce(1)).first()) == (4, 3, 0.0, 0.0, True)
        assert made[0].count() == len(model.nodes()) + 1
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_facts_tell_right_forests_from_wrong_ones(train):
    right = checks.forest_facts(M.fit_forest(train, COLS, trees=20, depth=5), train).first()
    assert tuple(right) == (20, 5, 0.0, True)
    flipped = train.withColumn("label", 1 - F.col("label"))
    wrong = checks.forest_facts(M.fit_forest(flipped, COLS, trees=1, depth=1), train).first()
    assert (wrong.trees, wrong.levels, wrong.orders_rows) == (1, 1, False)


def test_first_split_is_the_best_of_all_cuts(train):
    model = M.fit_boosted(train, COLS, {"n_estimators": 1, "max_depth": 1, "scale_pos_weight": 5})
    got = checks.first_split(model).first()
    pdf = train.toPandas()
    w = np.where(pdf.label == 1, 5.0, 1.0)
    g, h = w * (0.5 - pdf.label.to_numpy()), w * 0.25
    at = {(c, cut): pdf[c].to_numpy() <= cut for c, cuts in zip(COLS, model.cuts) for cut in cuts}
    gains = {k: 0.5 * (g[l].sum() ** 2 / (h[l].sum() + 1) + g[~l].sum() ** 2 / (h[~l].sum() + 1) - g.sum() ** 2 / (h.sum() + 1))
             for k, l in at.items() if min(h[l].sum(), h[~l].sum()) >= 1}
    best = max(gains, key=gains.get)
    assert (got.feature, round(best[1], 6)) == (best[0], got.threshold) and abs(got.gain - gains[best]) < 1e-4
    left = at[best]
    assert abs(got.left_value + 0.3 * g[left].sum() / (h[left].sum() + 1)) < 1e-5


def test_fitting_tasks_follow_from_the_rows_and_stay_few():
    counts = {1: 1, 1_716: 1, 17_160: 8, 103_000: 51, 1_030_000: 64, 6_200_000: 64, 62_000_000: 620}
    assert {rows: M.fitting_tasks(rows) for rows in counts} == counts
