from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from holdfast.operators import features as FT
from holdfast.operators import labels as L
from holdfast.plans.churn import Study
from holdfast.sources import order_tables
from holdfast.sources.schemas import FULL13, KEY

ORDERS = """order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz,
 order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"""
CUT = datetime(2018, 1, 31)


def day(n, month=1, hour=0):
    return datetime(2018, month, n, hour)


@pytest.fixture(scope="module")
def small(spark):
    orders = [
        # ann: two order-level ids, one order on each side of the cutoff
        ("o1", "c1", "delivered", day(1), day(10, hour=2), day(10)),
        ("o2", "c2", "delivered", day(5, 7), day(9, 7), day(10, 7)),
        # bob: exactly at the cutoff, never delivered
        ("o3", "c3", "delivered", CUT, None, day(10, 2)),
        # cid: no items
        ("o4", "c4", "delivered", day(2), day(3), day(4)),
        # dot: late by 8 days, reviewed twice, one unknown category
        ("o5", "c5", "delivered", day(3), day(28), day(20)),
        # eve: one microsecond after the cutoff
        ("o6", "c6", "delivered", datetime(2018, 1, 31, 0, 0, 0, 1), day(9, 2), day(10, 2)),
        # not delivered: ignored
        ("o7", "c1", "shipped", day(7), None, day(9)),
        ("o8", "c8", "delivered", datetime(2018, 7, 31), day(2, 8), day(9, 8)),
    ]
    customers = [
        ("c1", "ann", "A"), ("c2", "ann", "B"), ("c3", "bob", "A"), ("c4", "cid", "A"),
        ("c5", "dot", "A"), ("c6", "eve", "A"), ("c8", "fay", "A"), ("c9", None, "A"),
    ]
    items = [
        ("o1", "p1", "s1", 10.0, 1.0), ("o1", "p2", "s1", 20.0, 2.0), ("o1", "p1", "s2", 30.0, 3.0),
        ("o3", "p9", "s1", 5.0, 0.5), ("o5", "p3", "s1", 7.25, 0.25), ("o2", "p1", "s1", 99.0, 9.0),
    ]
    reviews = [("o1", 5, day(11)), ("o5", 1, day(29)), ("o5", 4, day(3, 2)), ("o5", None, day(3, 2))]
    products = [("p1", "toys"), ("p2", "books"), ("p3", None)]
    return {
        "orders": spark.createDataFrame(orders, ORDERS),
        "customers": spark.createDataFrame(customers, "customer_id string, customer_unique_id string, customer_state string"),
        "order_items": spark.createDataFrame(
            items, "order_id string, product_id string, seller_id string, price double, freight_value double"
        ),
        "order_reviews": spark.createDataFrame(
            reviews, "order_id string, review_score int, review_creation_date timestamp_ntz"
        ),
        "products": spark.createDataFrame(products, "product_id string, product_category_name string"),
    }


def test_cutoff_is_six_months_before_the_last_delivered_order(small):
    assert L.cutoff_frame(small["orders"]).first().cutoff_date == CUT


def test_labels(small):
    cutoff = L.cutoff_column(small["orders"])
    labels = {r[KEY]: r.churned for r in L.churn_labels(small["orders"], small["customers"], cutoff).collect()}
    assert labels == {"ann": 0, "bob": 1, "cid": 1, "dot": 1}
    strict = L.churn_labels(small["orders"], small["customers"], cutoff, "per_customer")
    # ann came back after six months and four days
    assert {r[KEY]: r.churned for r in strict.collect()}["ann"] == 1
    active, churned = L.split_people(small["orders"], small["customers"], cutoff)
    assert {r[0] for r in active.collect()} == {"ann"}
    assert {r[0] for r in churned.collect()} == {"bob", "cid", "dot"}
    with pytest.raises(ValueError):
        L.churn_labels(small["orders"], small["customers"], cutoff, "other")


def test_feature_values(small):
    rows = {r[KEY]: r for r in Study(small).features().collect()}
    assert set(rows) == {"ann", "bob", "dot"}  # cid has no items
    ann, bob, dot = rows["ann"], rows["bob"], rows["dot"]
    assert (ann.order_count, ann.total_spend, ann.avg_order_value, ann.total_freight) == (1, 60.0, 20.0, 6.0)
    assert (ann.recency_days, ann.category_diversity, ann.churned) == (30, 2, 0)
    assert (ann.avg_delivery_delay, ann.avg_delivery_days, ann.pct_late_orders) == (0.0, 9.0, 0.0)
    # never delivered: filled, and no item matches a product
    assert (bob.avg_delivery_delay, bob.max_delivery_delay, bob.avg_delivery_days) == (0.0, 0.0, 3.0)
    assert (bob.avg_review_score, bob.min_review_score, bob.pct_bad_reviews) == (None, 3.0, 0.0)
    assert (bob.category_diversity, bob.recency_days, bob.pct_late_orders) == (1, 0, 0.0)
    # both reviews count, the one without a score only in the denominator of the bad share
    assert (dot.avg_review_score, dot.min_review_score) == (2.5, 1.0)
    assert dot.pct_bad_reviews == pytest.approx(1 / 3)
    assert (dot.category_diversity, dot.max_delivery_delay, dot.pct_late_orders) == (0, 8.0, 1.0)


def test_repaired_fill_and_strict_asof(small):
    repaired = {r[KEY]: r for r in Study(small).features("repaired").collect()}
    assert repaired["bob"].avg_review_score == 3.0
    strict = {r[KEY]: r for r in Study(small).features(strict_asof=True).collect()}
    assert strict["dot"].avg_review_score == 1.0


def test_given_cutoff_overrides_the_computed_one(small):
    rows = Study(small, fixed_cutoff=day(2, 1)).labels().collect()
    assert {r[KEY] for r in rows} == {"ann", "cid"}


def test_one_pass_table_equals_joined_aggregates(spark, sf_dir):
    t = order_tables(spark, sf_dir)
    s = Study(t)
    joined = FT.fill_features(
        FT.assemble(
            FT.rfm_features(t["orders"], t["customers"], t["order_items"], s.cutoff),
            FT.delivery_features(t["orders"], t["customers"], s.cutoff),
            FT.review_features(t["orders"], t["customers"], t["order_reviews"], s.cutoff),
            FT.category_diversity(t["orders"], t["customers"], t["order_items"], t["products"], s.cutoff),
            s.labels(),
        )
    )
    one_pass = s.features()
    assert one_pass.columns == joined.columns
    assert one_pass.exceptAll(joined).count() == 0 and joined.exceptAll(one_pass).count() == 0


def test_feature_invariants(spark, sf_dir):
    s = Study(order_tables(spark, sf_dir))
    f = s.features()
    broken = f.where(
        ~F.col("churned").isin(0, 1)
        | ~F.col("pct_late_orders").between(0, 1)
        | ~F.col("pct_bad_reviews").between(0, 1)
        | (F.col("max_delivery_delay") < F.col("avg_delivery_delay"))
        | (F.col("min_review_score") > F.col("avg_review_score"))
    )
    assert broken.count() == 0
    assert f.join(s.labels(), KEY, "left_anti").count() == 0
    assert f.count() == 143 and f.columns[1:14] == list(FULL13)


def test_feature_table_is_the_same_beyond_the_limit_on_categories(spark, sf_dir, monkeypatch):
    """Bits of words and rows by category count alike."""
    study = Study(order_tables(spark, sf_dir))
    want = study.features().toPandas().sort_values(KEY, ignore_index=True)
    monkeypatch.setattr(FT, "category_names", lambda products: None)
    got = study.features().toPandas().sort_values(KEY, ignore_index=True)
    pd.testing.assert_frame_equal(got, want)


def test_more_categories_than_a_word_has_bits(spark):
    """150 categories, those of unknown products and later orders left out."""
    rows = [(i, i % 3, i % 150) for i in range(900)]
    per_order = spark.createDataFrame(rows, "order_id int, person int, product_id int")
    products = spark.createDataFrame([(i, None if i % 7 == 0 else f"kind {i:03}") for i in range(140)], "product_id int, product_category_name string")
    items = per_order.select("order_id", "product_id", F.lit(1.0).alias("price"), F.lit(1.0).alias("freight_value"))
    names = FT.category_names(products)
    assert len(names) == 120 and FT.category_names(products, 119) is None
    got = FT.items_with_words(items, products, names).join(per_order, "order_id").groupBy("person").agg(
        sum(F.bit_count(F.coalesce(F.bit_or(w), F.lit(0).cast("long"))) for w in ("word0", "word1")).alias("kinds")
    )
    want = {p: len({c for _, q, c in rows if q == p and c < 140 and c % 7}) for p in range(3)}
    assert {r.person: r.kinds for r in got.collect()} == want
