"""The whole study as one job: read tables, write features, reports, model and scores."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators import evaluate, explain, explore, labels, models, profile, retention, segments, suggestions
from holdfast.plans.churn import Study, scoring_job, training_set
from holdfast.session import clear_scratch, materialise
from holdfast.sources.schemas import FEATURE_SETS


def run_study(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    out: str,
    feature_set: str = "core9",
    fill: str = "literal",
    search_space: dict[str, Sequence] = models.SEARCH_SPACE,
    n_iter: int = 30,
    cv: int = 5,
    forest_trees: int = 200,
    forest_depth: int = 10,
) -> dict[str, str]:
    """Write every table of the study below ``out`` and return their paths by name.

    Tables that several steps read are written before they are used. The boosted
    model found by the search is the one that explains, scores and is saved. All results lie below
    ``out``; the application's scratch tables are deleted at the end.
    """
    if spark.conf.get("spark.sql.adaptive.enabled") != "true":
        warnings.warn("adaptive execution is off: joins on best-selling products won't be split", stacklevel=2)
    columns = FEATURE_SETS[feature_set]
    study = Study(tables)
    paths: dict[str, str] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        paths[name] = f"{out}/{name}"
        df.write.mode("overwrite").parquet(paths[name])
        return spark.read.schema(df.schema).parquet(paths[name])

    customers, orders, items = study.table("customers"), study.table("orders"), study.table("order_items")
    keep("table_profile", profile.profile_tables(tables))
    keep("cutoff", labels.cutoff_frame(orders))
    keep("churn_rate", labels.churn_rate(study.labels()))
    features = keep("features", study.features(fill))
    keep("feature_profile", profile.table_profile(features, "features"))

    keep("class_balance", explore.class_balance(features))
    keep("feature_means", explore.feature_means_by_class(features))
    keep("feature_histogram", explore.feature_histogram(features))
    keep("correlation_matrix", explore.correlation_matrix(features))

    sets = training_set(features, columns)
    keep("training_balance", explore.balance_report({"before": sets.train, "after": sets.balanced}, "label"))
    logistic = models.fit_logistic(sets.balanced, columns)
    forest = models.fit_forest(sets.balanced, columns, forest_trees, forest_depth)
    boosted, draws = models.random_search(sets.balanced, columns, search_space, n_iter, cv)
    keep("search_results", draws)
    fitted = {"Logistic Regression": logistic, "Random Forest": forest, "Boosted Trees": boosted}
    held_out = keep(
        "held_out_scores",
        evaluate.compare_models({name: models.predict(model, sets.test) for name, model in fitted.items()}),
    )
    keep("model_comparison", evaluate.model_comparison(held_out))
    keep("classification_report", evaluate.classification_report(held_out, threshold=None))
    keep("roc_curve", evaluate.roc_with_chance(held_out))
    winner = held_out.where(F.col("model") == "Boosted Trees")
    keep("precision_recall", evaluate.precision_recall_curve(winner))
    keep("recall_report", evaluate.threshold_report(winner))
    shap = keep("shap", explain.tree_shap(boosted, sets.test, columns))
    keep("shap_importance", explain.shap_importance(shap))
    keep("shap_summary", explain.shap_summary(shap))

    paths["model"] = f"{out}/model"
    models.save_model(boosted, paths["model"])
    paths["scored"] = f"{out}/scored"
    scored = scoring_job(spark, boosted, features, paths["scored"], columns)
    keep("segments", segments.segment_dashboard(features))
    keep("tier_counts", segments.tier_counts(scored))
    keep("tier_spend", segments.tier_spend(scored))
    keep("revenue_at_risk", segments.revenue_at_risk(scored))
    keep("top_at_risk", segments.top_at_risk(scored))
    keep("probability_histogram", segments.probability_histogram(scored))
    keep("monthly_churn_trend", segments.monthly_churn_trend(scored))

    keep("delivery_recovery", retention.delivery_recovery_target(scored))
    keep("bad_review", retention.bad_review_target(scored))
    keep("vip", retention.vip_target(scored))
    reactivation = keep("reactivation", retention.reactivation_target(features))
    keep("campaign_schedule", retention.campaign_schedule(reactivation))
    keep("worst_sellers", retention.worst_sellers(orders, items, study.table("order_reviews")))
    observed = materialise(study.observed_orders.select("order_id", "customer_id"), "observed")
    keep("product_suggestions", suggestions.product_suggestions(observed, customers, items, study.table("products")))
    clear_scratch(spark)
    return paths
