"""Named queries over the test tables.

Each takes (spark, sf_dir), runs over whole tables and returns a DataFrame whose
floating-point columns are rounded, so that other engines can be compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions import class_name, currency_text, percent_text
from holdfast.operators import evaluate, explain, explore, extensions, features, hazards, labels, models, prep
from holdfast.operators import profile, retention, segments, suggestions
from holdfast.plans import checks
from holdfast.plans.churn import Study, TrainingSet, scoring_job, serve, training_set
from holdfast.session import materialise, shared_root
from holdfast.sources import order_tables, read_scored, read_table, write_scored
from holdfast.sources.schemas import CORE9, FULL13, KEY
from holdfast.streaming.live_scores import latest_scores, start_scoring

Query = Callable[[SparkSession, str], DataFrame]

# Decimals shown, where they aren't six; queries that choose their own are left alone.
DIGITS = {
    "total_spend": 2,
    "total_freight": 4,
    "avg_spend": 4,
    "revenue_at_risk": 2,
    "top_spend": 2,
    "all_spend": 2,
    "density": 12,
}
OWN_DIGITS = ("smote_balanced", "scaled_features", "linear_shap", "shap_summary", "range_violations")
FLOATS = [c for c in FULL13 if c not in ("recency_days", "order_count", "category_diversity")]

# Fixed-weight scores that stand in for three models in comparisons.
RIVAL_SCORES = {
    "all features": models.LINEAR_WEIGHTS,
    "recency": {"recency_days": 0.004, "order_count": -0.25},
    "service": {"avg_delivery_delay": 0.2, "avg_review_score": -0.3, "pct_bad_reviews": 0.8},
}


def study(spark: SparkSession, sf_dir: str) -> Study:
    return Study(order_tables(spark, sf_dir))


def rounded(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Feature columns to their own digits, or the given columns to six."""
    if columns is not None:
        return df.withColumns({c: F.round(c, 6) for c in columns})
    return df.withColumns({c: F.round(c, DIGITS.get(c, 6)) for c in FLOATS if c in df.columns})


def _study_query(build: Callable[[Study], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(study(spark, sf_dir))


def _on_orders(operator) -> Query:
    return _study_query(lambda s: operator(s.table("orders")))


def _on_features(operator) -> Query:
    return _study_query(lambda s: operator(s.features()))


def _on_scored(operator) -> Query:
    return _study_query(lambda s: operator(s.scored()))


def _on_tiered(operator) -> Query:
    return _study_query(lambda s: operator(s.tiered()))


# Tables, labels and features


SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}


def _sql_types(profiled: DataFrame) -> DataFrame:
    """Column types by their SQL names."""
    return profiled.replace(SQL_TYPES, subset=["data_type"])


def _table_profile(s: Study) -> DataFrame:
    named = {name: s.table(name) for name in ("orders", "order_items", "order_reviews")}
    return _sql_types(profile.profile_tables(named))


def _orders_at(s: Study, pick) -> DataFrame:
    chosen = pick(s.table("orders"), s.cutoff)
    return labels.with_person(chosen.select("order_id", "customer_id", labels.PLACED), s.table("customers")).select(
        "order_id", KEY, labels.PLACED
    )


def _cutoff(s: Study) -> DataFrame:
    frame = labels.cutoff_frame(s.table("orders"))
    return frame.select(
        "max_date",
        "cutoff_date",
        F.to_date("max_date").cast("string").alias("data_until"),
        F.to_date("cutoff_date").cast("string").alias("cutoff_day"),
    )


def _people_split(s: Study) -> DataFrame:
    active, churned = labels.split_people(s.table("orders"), s.table("customers"), s.cutoff)
    return active.withColumn("group_name", F.lit("active")).unionByName(
        churned.withColumn("group_name", F.lit("churned"))
    )


def _churn_rate(s: Study) -> DataFrame:
    return labels.churn_rate(s.labels()).withColumn("churn_rate_text", percent_text(F.col("churn_rate")))


def _order_delays(s: Study) -> DataFrame:
    measured = features.delivery_measures(labels.delivered_orders(s.table("orders")))
    return measured.select("order_id", "delivery_delay_days", "actual_delivery_days")


def _rfm(s: Study) -> DataFrame:
    return rounded(features.rfm_features(s.table("orders"), s.table("customers"), s.table("order_items"), s.cutoff))


def _delivery(s: Study) -> DataFrame:
    return rounded(
        features.delivery_features(s.table("orders"), s.table("customers"), s.cutoff),
        ["avg_delivery_delay", "avg_delivery_days", "pct_late_orders"],
    )


def _delivery_strict(s: Study) -> DataFrame:
    return rounded(
        features.delivery_features(s.table("orders"), s.table("customers"), s.cutoff, strict_asof=True),
        ["avg_delivery_delay", "avg_delivery_days", "pct_late_orders"],
    )


def _reviews(s: Study) -> DataFrame:
    return rounded(
        features.review_features(s.table("orders"), s.table("customers"), s.table("order_reviews"), s.cutoff),
        ["avg_review_score", "pct_bad_reviews"],
    )


def _diversity(s: Study) -> DataFrame:
    return features.category_diversity(
        s.table("orders"), s.table("customers"), s.table("order_items"), s.table("products"), s.cutoff
    )


def _feature_profile(s: Study) -> DataFrame:
    wide = s.features().select(*FULL13, "churned")
    return _sql_types(profile.table_profile(wide, "features"))


def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, items and reviews written as CSV and read back with their declared types, then counted."""
    s = study(spark, sf_dir)

    def back(name: str) -> DataFrame:
        path = f"{shared_root(spark)}/{name}-csv-{uuid.uuid4().hex}"
        s.table(name).write.option("header", True).csv(path)
        return read_table(spark, name, path, columns=s.table(name).columns)

    parts = (
        ("orders", F.col("order_status"), "order_delivered_customer_date", F.max(labels.PLACED)),
        ("order_items", F.lit("all"), "price", F.lit(None).cast("timestamp_ntz")),
        ("order_reviews", F.col("review_score").cast("string"), "review_creation_date", F.max("review_creation_date")),
    )
    counted = [
        back(name).groupBy(group.alias("part")).agg(
            F.lit(name).alias("table_name"), F.count("*").alias("rows"), F.count(filled).alias("filled"), last.alias("last_moment")
        )
        for name, group, filled, last in parts
    ]
    return reduce(DataFrame.unionByName, counted)


# Training data and fixed-weight scores


def _written_matrix(s: Study) -> DataFrame:
    return materialise(prep.matrix(s.features()), "matrix")


def _split(s: Study) -> DataFrame:
    return prep.stratified_split(_written_matrix(s)).select(KEY, "label", "split")


def _scaled(s: Study) -> DataFrame:
    split = materialise(prep.stratified_split(_written_matrix(s)), "split")
    stats = prep.scaling_stats(split.where(F.col("split") == "train"), CORE9)
    return rounded(prep.scale(split.where(F.col("split") == "test"), stats, CORE9).select(KEY, *CORE9), list(CORE9))


def _folds(s: Study) -> DataFrame:
    return prep.with_folds(_written_matrix(s), 5).select(KEY, "label", "fold")


def _linear_scores(s: Study) -> DataFrame:
    return s.scored().select(KEY, "churned", "churn_probability")


def _held_out(s: Study, rivals: dict[str, dict[str, float]]) -> DataFrame:
    """Test rows of the split with the probability of each fixed-weight score, by model."""
    test = prep.stratified_split(_written_matrix(s)).where(F.col("split") == "test")
    by_model = {
        name: models.linear_score(test, weights).select(
            KEY, "label", F.col("churn_probability").alias("probability")
        )
        for name, weights in rivals.items()
    }
    return evaluate.compare_models(by_model)


def _one(s: Study) -> DataFrame:
    return _held_out(s, {"all features": models.LINEAR_WEIGHTS})


def _on_held_out(operator) -> Query:
    return _study_query(lambda s: operator(_one(s)))


def _threshold_predictions(s: Study) -> DataFrame:
    predicted = evaluate.hard_prediction(F.col("probability"), evaluate.RECALL_THRESHOLD)
    return _one(s).select(KEY, "label", predicted.alias("prediction"))


def _linear_shap(s: Study) -> DataFrame:
    table = _written_matrix(s)
    return explain.linear_shap(table, models.LINEAR_WEIGHTS)


def _rounded_shap(s: Study) -> DataFrame:
    return rounded(_linear_shap(s), ["value", "shap"])


def _shap_summary(s: Study) -> DataFrame:
    shap = materialise(_linear_shap(s), "shap")
    return rounded(explain.shap_summary(shap), ["value", "shap", "colour"])


# Scored customers


def _scored_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored customers written by tier, read back and counted."""
    path = f"{shared_root(spark)}/scored-{uuid.uuid4().hex}"
    write_scored(study(spark, sf_dir).tiered(), path)
    return segments.tier_kpis(read_scored(spark, path))


def _tiers(tiered: DataFrame) -> DataFrame:
    left = segments.risk_tier(F.col("churn_probability"), "left")
    return tiered.select(KEY, "churn_probability", "risk_tier", left.alias("rule_tier"))


def _actions(scored: DataFrame) -> DataFrame:
    return segments.with_action(scored).select(KEY, "risk_tier", "recommended_action")


def _top_display(tiered: DataFrame) -> DataFrame:
    predicted = evaluate.hard_prediction(F.col("churn_probability"))
    return segments.top_at_risk(tiered).select(
        KEY,
        class_name(predicted).alias("predicted_class"),
        currency_text(F.round("total_spend", 2)).alias("spend_text"),
    )


def _violations(features_df: DataFrame) -> DataFrame:
    return rounded(retention.range_violations(features_df), ["value"])


def _campaign(features_df: DataFrame) -> DataFrame:
    rows = retention.campaign_schedule(retention.reactivation_target(features_df))
    return rows.withColumns({c: F.col(c).cast("string") for c in ("send_date", "offer_ends")})


def _bad_review_trigger(s: Study) -> DataFrame:
    return retention.bad_review_trigger(s.table("orders"), s.table("customers"), s.table("order_reviews"))


def _suggestions(s: Study) -> DataFrame:
    return suggestions.product_suggestions(
        s.observed_orders, s.table("customers"), s.table("order_items"), s.table("products")
    )


# Survival, geography, sellers, experiments


def _survival(s: Study) -> DataFrame:
    lives = extensions.customer_lifetimes(s.table("orders"), s.table("customers"), s.labels(), s.cutoff)
    # The outer edges are open, so that nobody's lifetime is left out.
    edges = [float("-inf"), *segments.DELAY_EDGES[1:-1], float("inf")]
    segment = segments.cut(F.col("avg_delivery_delay"), edges, segments.DELAY_LABELS)
    grouped = lives.join(s.features().select(KEY, segment.alias("segment")), KEY, "inner")
    return extensions.kaplan_meier(grouped, "segment")


# Covariates of the hazard model.
HAZARD_COLUMNS = ("avg_order_value", "avg_review_score", "pct_late_orders", "category_diversity")


def _lives(s: Study) -> DataFrame:
    lives = extensions.customer_lifetimes(s.table("orders"), s.table("customers"), s.labels(), s.cutoff)
    return lives.join(s.features().select(KEY, *HAZARD_COLUMNS), KEY, "inner")


def _hazards(s: Study) -> DataFrame:
    lives = materialise(_lives(s), "hazard-lives")
    return checks.hazard_optimum(hazards.fit_hazards(lives, HAZARD_COLUMNS), lives)


def _null_scores(s: Study) -> DataFrame:
    return rounded(hazards.null_scores(_lives(s), HAZARD_COLUMNS), ["slope", "variance", "z_statistic"])


def _state_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Study(order_tables(spark, sf_dir, with_states=True))
    return extensions.state_churn(s.features(), s.table("orders"), s.table("customers"), s.cutoff)


def _experiment(s: Study) -> DataFrame:
    target = s.tiered().where(F.col("risk_tier") == segments.TIER_LABELS[-1])
    return extensions.assign_arms(target).withColumn("retained", 1 - F.col("churned"))


# Fitted models


def _training(s: Study) -> TrainingSet:
    return training_set(s.features())


def _balance(s: Study) -> DataFrame:
    sets = _training(s)
    return explore.balance_report({"before": sets.train, "after": sets.balanced}, "label")


def _logistic(s: Study) -> DataFrame:
    sets = _training(s)
    return checks.logistic_optimum(models.fit_logistic(sets.balanced), sets.balanced)


def _fitted_trees(fit) -> Query:
    def run(s: Study) -> DataFrame:
        sets = _training(s)
        return checks.tree_predictions(fit(sets.balanced), sets.test)

    return _study_query(run)


# A point of the search space.
BOOSTER = {
    "n_estimators": 100,
    "max_depth": 5,
    "learning_rate": 0.1,
    "subsample": 0.8,
    "colsample_bytree": 0.8,
    "scale_pos_weight": 5,
}


def _search(s: Study) -> DataFrame:
    _, results = models.random_search(_training(s).balanced, n_iter=30, cv=5)
    return checks.search_draws(results, models.SEARCH_SPACE)


def _booster_facts(s: Study) -> DataFrame:
    sets = _training(s)
    return checks.booster_facts(models.fit_boosted(sets.balanced, params=BOOSTER), sets.balanced)


def _forest_facts(s: Study) -> DataFrame:
    sets = _training(s)
    return checks.forest_facts(models.fit_forest(sets.balanced), sets.balanced)


def _first_split(s: Study) -> DataFrame:
    """One tree of one split, on the training part as it is."""
    stump = {"n_estimators": 1, "max_depth": 1}
    return checks.first_split(models.fit_boosted(_training(s).train, params=stump))


def _fitted_comparison(s: Study) -> DataFrame:
    sets = _training(s)
    fitted = {
        "Logistic Regression": models.fit_logistic(sets.balanced),
        "Random Forest": models.fit_forest(sets.balanced),
        "Boosted Trees": models.fit_boosted(sets.balanced, params=BOOSTER),
    }
    scored = materialise(
        evaluate.compare_models({name: models.predict(model, sets.test) for name, model in fitted.items()}), "rivals"
    )
    return checks.areas(scored)


def _tree_shap(s: Study) -> DataFrame:
    sets = _training(s)
    return checks.shapley_sums(models.fit_boosted(sets.balanced, params=BOOSTER), sets.test)


def _batch_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, save, load, score everyone and read the scored table."""
    s = study(spark, sf_dir)
    everyone = materialise(s.features(), "features")
    model_path = f"{shared_root(spark)}/model-{uuid.uuid4().hex}"
    model = models.fit_boosted(training_set(everyone).balanced, params=BOOSTER)
    models.save_model(model, model_path)
    loaded = models.load_model(model_path)
    scored = scoring_job(spark, loaded, everyone, f"{shared_root(spark)}/scored-{uuid.uuid4().hex}")
    return checks.stored_scores(scored, model, everyone)


def _saved_booster(sets) -> models.BoostedModel:
    """A booster fitted, saved and loaded again."""
    path = f"{shared_root(sets.balanced.sparkSession)}/model-{uuid.uuid4().hex}"
    models.save_model(models.fit_boosted(sets.balanced, params=BOOSTER), path)
    return models.load_model(path)


def _partial_records(everyone: DataFrame) -> DataFrame:
    """Every person's features as a partial input record: two fields are never given, one only by some."""
    return everyone.drop("total_freight", "max_delivery_delay", "churned")


def _served_by_model(s: Study) -> DataFrame:
    """Partial input records scored by a model that was saved and loaded again."""
    everyone = materialise(s.features(), "features")
    loaded = _saved_booster(training_set(everyone))
    return checks.served_scores(_partial_records(everyone), loaded)


def _served(s: Study) -> DataFrame:
    """Partial input records under the fixed weights."""
    return serve(_partial_records(s.features()), models.linear_score).select(
        KEY, "fields_out_of_range", "churn_probability", "risk_tier", "recommended_action"
    )


def _live_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of order files, each with its items and reviews, scored as they arrive."""
    tables = order_tables(spark, sf_dir)
    root = f"{shared_root(spark)}/live-{uuid.uuid4().hex}"
    paths = {name: f"{root}/{name}" for name in tables}
    tables["customers"].write.parquet(paths["customers"])
    tables["products"].write.parquet(paths["products"])
    for later in (False, True):
        for name in ("orders", "order_items", "order_reviews"):
            part = tables[name].where((F.col("order_id") % 4 == 0) == F.lit(later))
            part.write.mode("append").parquet(paths[name])
        query = start_scoring(spark, paths, models.linear_score, f"{root}/log", f"{root}/progress", available_now=True)
        query.awaitTermination()
    return latest_scores(spark, f"{root}/log").select(KEY, "order_count", "churn_probability")


QUERIES: dict[str, Query] = {
    # tables, labels and features
    "table_profile": _study_query(_table_profile),
    "csv_round_trip": _csv_round_trip,
    "delivered_ratio": _on_orders(labels.delivered_ratio),
    "cutoff_date": _study_query(_cutoff),
    "pre_cutoff_orders": _study_query(lambda s: _orders_at(s, labels.pre_cutoff)),
    "post_cutoff_orders": _study_query(lambda s: _orders_at(s, labels.post_cutoff)),
    "churn_labels": _study_query(lambda s: s.labels()),
    "churn_labels_per_customer": _study_query(lambda s: s.labels("per_customer")),
    "active_and_churned": _study_query(_people_split),
    "churn_rate": _study_query(_churn_rate),
    "order_delays": _study_query(_order_delays),
    "rfm_features": _study_query(_rfm),
    "delivery_features": _study_query(_delivery),
    "delivery_features_asof": _study_query(_delivery_strict),
    "review_features": _study_query(_reviews),
    "category_diversity": _study_query(_diversity),
    "feature_table": _on_features(rounded),
    "feature_table_repaired": _study_query(lambda s: rounded(s.features("repaired"))),
    "feature_table_asof": _study_query(lambda s: rounded(s.features(strict_asof=True))),
    "feature_profile": _study_query(_feature_profile),
    # exploration
    "class_balance": _on_features(explore.class_balance),
    "feature_means_by_class": _on_features(explore.feature_means_by_class),
    "correlation_matrix": _on_features(explore.correlation_matrix),
    "feature_histogram": _on_features(explore.feature_histogram),
    # split, scaling and evaluation of fixed-weight scores
    "stratified_split": _study_query(_split),
    "cross_validation_folds": _study_query(_folds),
    "scaled_features": _study_query(_scaled),
    "linear_score": _study_query(_linear_scores),
    "classification_report": _on_held_out(evaluate.classification_report),
    "roc_auc": _on_held_out(evaluate.roc_auc),
    "roc_curve": _on_held_out(evaluate.roc_with_chance),
    "roc_curve_corners": _on_held_out(lambda scored: evaluate.roc_curve(scored, drop_intermediate=True)),
    "pr_curve": _on_held_out(evaluate.precision_recall_curve),
    "threshold_predictions": _study_query(_threshold_predictions),
    "threshold_report": _on_held_out(evaluate.threshold_report),
    "model_comparison": _study_query(lambda s: evaluate.model_comparison(_held_out(s, RIVAL_SCORES))),
    "linear_shap": _study_query(_rounded_shap),
    "shap_importance": _study_query(lambda s: explain.shap_importance(_linear_shap(s))),
    "shap_summary": _study_query(_shap_summary),
    # segments and dashboard
    "delay_segment_churn": _on_features(segments.delay_segment_churn),
    "review_segment_churn": _on_features(segments.review_segment_churn),
    "segment_dashboard": _on_features(segments.segment_dashboard),
    "risk_tiers": _on_tiered(_tiers),
    "rule_tier_actions": _on_scored(_actions),
    "tier_counts": _on_tiered(segments.tier_counts),
    "tier_spend": _on_tiered(segments.tier_spend),
    "tier_kpis": _on_tiered(segments.tier_kpis),
    "scored_round_trip": _scored_round_trip,
    "top10_high_risk": _on_tiered(lambda t: rounded(segments.top_at_risk(t))),
    "top10_display": _on_tiered(_top_display),
    "top10_text": _on_tiered(segments.top_at_risk_text),
    "probability_histogram": _on_scored(segments.probability_histogram),
    "monthly_churn_trend": _on_scored(
        lambda scored: segments.monthly_churn_trend(scored).withColumn("month", F.col("month").cast("string"))
    ),
    "range_violations": _on_features(_violations),
    "revenue_at_risk": _on_tiered(segments.revenue_at_risk),
    # retention
    "trigger_delivery_recovery": _study_query(
        lambda s: retention.delivery_recovery_trigger(s.table("orders"), s.table("customers"))
    ),
    "trigger_bad_review": _study_query(_bad_review_trigger),
    "target_delivery_recovery": _on_tiered(lambda t: rounded(retention.delivery_recovery_target(t))),
    "target_delivery_recovery_mean": _on_tiered(
        lambda t: rounded(retention.delivery_recovery_target(t, "avg_delivery_delay", 3))
    ),
    "target_bad_review": _on_scored(retention.bad_review_target),
    "target_reactivation": _on_features(lambda f: rounded(retention.reactivation_target(f))),
    "campaign_schedule": _on_features(_campaign),
    "target_vip": _on_scored(lambda scored: rounded(retention.vip_target(materialise(scored, "scored")))),
    "worst_sellers": _study_query(
        lambda s: retention.worst_sellers(s.table("orders"), s.table("order_items"), s.table("order_reviews"))
    ),
    "product_suggestions": _study_query(_suggestions),
    "insight_recency_ratio": _on_features(retention.recency_ratio),
    "insight_delay_ratio": _on_features(retention.delay_ratio),
    "insight_review_slope": _on_features(retention.review_slope),
    "insight_review_jump": _on_features(retention.review_jump),
    "insight_spend": _on_features(retention.spend_insight),
    "insight_category": _on_features(retention.category_insight),
    "recency_band_churn": _on_features(retention.recency_band_churn),
    "spend_concentration": _on_features(retention.spend_concentration),
    "one_time_buyers": _study_query(lambda s: labels.one_time_buyers(s.table("orders"), s.table("customers"))),
    # survival, geography, sellers, experiments
    "km_survival": _study_query(_survival),
    "cox_null_scores": _study_query(_null_scores),
    "cox_hazards": _study_query(_hazards),
    "state_churn": _state_churn,
    "seller_churn": _study_query(
        lambda s: extensions.seller_churn(
            s.labels(), s.table("orders"), s.table("customers"), s.table("order_items"), s.cutoff
        )
    ),
    "experiment_arms": _study_query(lambda s: _experiment(s).select(KEY, "arm")),
    "ab_lift": _study_query(lambda s: extensions.lift_readout(_experiment(s))),
    # fitted models
    "smote_balance": _study_query(_balance),
    "smote_balanced": _study_query(lambda s: rounded(_training(s).balanced, list(CORE9))),
    "lr_scores": _study_query(_logistic),
    "rf_scores": _fitted_trees(models.fit_forest),
    "gbt_scores": _fitted_trees(lambda train: models.fit_boosted(train, params=BOOSTER)),
    "booster_facts": _study_query(_booster_facts),
    "booster_first_split": _study_query(_first_split),
    "forest_facts": _study_query(_forest_facts),
    "random_search_results": _study_query(_search),
    "fitted_model_comparison": _study_query(_fitted_comparison),
    "tree_shap": _study_query(_tree_shap),
    "batch_scores": _batch_scores,
    # serving
    "served_records": _study_query(_served),
    "served_by_model": _study_query(_served_by_model),
    "live_scores": _live_scores,
}


def _shown(query: Query) -> Query:
    """The query with its floating-point columns rounded; operators themselves don't round."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = query(spark, sf_dir)
        doubles = [c for c, kind in found.dtypes if kind == "double"]
        return found.withColumns({c: F.round(c, DIGITS.get(c, 6)) for c in doubles}) if doubles else found

    return run


QUERIES = {name: query if name in OWN_DIGITS else _shown(query) for name, query in QUERIES.items()}
