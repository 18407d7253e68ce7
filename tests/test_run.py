from pyspark.sql import functions as F

from holdfast.operators.models import load_model, score_customers
from holdfast.plans.run import run_study
from holdfast.sources import order_tables
from holdfast.sources.schemas import FULL13, KEY

SPACE = {"n_estimators": (2,), "max_depth": (2,), "learning_rate": (0.3,), "scale_pos_weight": (1,)}


def test_whole_study(spark, sf_dir, tmp_path):
    out = str(tmp_path / "out")
    paths = run_study(spark, order_tables(spark, sf_dir), out, "full13", search_space=SPACE, n_iter=1, cv=2,
                      forest_trees=3, forest_depth=3)
    read = {name: spark.read.parquet(path) for name, path in paths.items() if name != "model"}
    assert read["features"].count() == read["scored"].count() == 143
    assert {r.model for r in read["model_comparison"].collect()} == {
        "Logistic Regression", "Random Forest", "Boosted Trees"
    }
    assert {r.feature for r in read["shap_importance"].collect()} == set(FULL13)
    balance = {(r.stage, r.label): r.rows for r in read["training_balance"].collect()}
    assert balance[("after", 0)] == balance[("after", 1)] == balance[("before", 1)]
    # The saved model is the one that scored.
    again = score_customers(load_model(paths["model"]), read["features"], FULL13)
    same = again.join(read["scored"].select(KEY, F.col("churn_probability").alias("stored")), KEY)
    assert same.count() == 143 and same.where("abs(stored - churn_probability) > 1e-12").count() == 0
