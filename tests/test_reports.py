import random
from collections import Counter, defaultdict
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.operators import explore, extensions, profile, retention, segments, suggestions
from holdfast.sources.schemas import KEY


def test_profile_counts_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    rows = {r.column_name: (r.data_type, r.row_count, r.column_count, r.null_count) for r in profile.table_profile(df, "t").collect()}
    assert rows == {"a": ("int", 2, 2, 0), "b": ("string", 2, 2, 1)}


def test_correlation_skips_nulls_pairwise_and_survives_constants(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 7.0, 5.0), (4.0, 6.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.feature_a, r.feature_b): r.correlation for r in explore.correlation_matrix(df, ["a", "b", "c"]).collect()}
    want = np.corrcoef([1, 3, 4], [2, 7, 6])[0, 1]
    assert got[("a", "b")] == got[("b", "a")] == pytest.approx(want, abs=1e-6)
    assert got[("a", "c")] is None and got[("c", "c")] is None and got[("a", "a")] == 1.0


def test_histogram_matches_numpy(spark):
    values = np.random.default_rng(0).normal(size=500)
    df = spark.createDataFrame([("x", float(v)) for v in values] + [("flat", 2.0)] * 3 + [("x", None)], "g string, v double")
    got = explore.histogram(df, ["g"], "v", 40).toPandas().sort_values("bin")
    rows, edges = np.histogram(values, 40)
    density, _ = np.histogram(values, 40, density=True)
    part = got[got.g == "x"]
    assert part["rows"].tolist() == rows.tolist()
    assert np.allclose(part.density, density, atol=1e-8) and np.allclose(part.bin_start, edges[:-1], atol=1e-6)
    flat = got[got.g == "flat"]
    assert flat["rows"].tolist() == np.histogram([2.0] * 3, 40)[0].tolist()
    alone = explore.histogram(df.where("g = 'x'"), [], "v", 40).toPandas().sort_values("bin")
    assert alone["rows"].tolist() == rows.tolist()


def test_empty_segments_and_tiers_are_reported(spark):
    df = spark.createDataFrame([(1.0, 1, None), (1.0, 0, 150.0)], "avg_delivery_delay double, churned int, total_spend double")
    rows = [(r.segment, r.customers, r.churn_rate) for r in segments.delay_segment_churn(df).collect()]
    one = segments.DELAY_LABELS[1]
    assert rows[1] == (one, 2, 0.5) and [r[1:] for r in rows if r[0] != one] == [(0, None)] * 3
    tiered = spark.createDataFrame([("Low risk", 3.0)], "risk_tier string, total_spend double")
    assert {(r.risk_tier, r.customers) for r in segments.tier_counts(tiered).collect()} == {
        ("Low risk", 1), ("Medium risk", 0), ("High risk", 0)
    }


def test_top_k_breaks_ties_by_key_and_puts_nulls_last(spark):
    rows = [("b", 5.0), ("a", 5.0), ("c", None), ("d", 9.0)]
    df = spark.createDataFrame(rows, f"{KEY} string, total_spend double").selectExpr(
        "*", "1 AS recency_days", "0.9 AS churn_probability", "'High risk' AS risk_tier"
    )
    assert [r[KEY] for r in segments.top_at_risk(df, 3).collect()] == ["d", "a", "b"]
    assert [r[KEY] for r in segments.top_at_risk(df).collect()] == ["d", "a", "b", "c"]
    text = segments.top_at_risk_text(df, 1).first()
    assert (text.total_spend, text.churn_probability) == ("BRL 9", "90.0%")


def test_input_rules_and_defaults(spark):
    partial = spark.createDataFrame([("x", 400, None)], f"{KEY} string, recency_days int, pct_late_orders double")
    full = retention.with_defaults(partial).withColumn(KEY, F.lit("x"))
    row = full.first()
    assert (row.recency_days, row.pct_late_orders, row.avg_delivery_days) == (400.0, 0.2, 12.0)
    assert [(r.feature, r.value) for r in retention.range_violations(full).collect()] == [("recency_days", 400.0)]
    missing = full.withColumn("order_count", F.lit(None).cast("double"))
    assert {r.feature for r in retention.range_violations(missing).collect()} == {"recency_days", "order_count"}


def test_two_histories_of_suggestions(spark, monkeypatch):
    monkeypatch.setattr(suggestions, "BLOCK", 4)
    rng = random.Random(4)
    products = [(p, None if p % 9 == 0 else f"cat{p % 3}") for p in range(60)]
    lines, owner = [], {}
    for o in range(400):
        # one person places a third of the orders and owns most of the catalogue
        owner[o] = 0 if o % 3 == 0 else rng.randrange(1, 40)
        for _ in range(rng.randrange(1, 4)):
            lines.append((o, int(60 * rng.random() ** 2), float(rng.randrange(1, 50))))
    orders = spark.createDataFrame([(o, o) for o in owner], "order_id int, customer_id int")
    customers = spark.createDataFrame(list(owner.items()), f"customer_id int, {KEY} int")
    got = suggestions.product_suggestions(
        orders,
        customers,
        spark.createDataFrame(lines, "order_id int, product_id int, price double"),
        spark.createDataFrame(products, "product_id int, product_category_name string"),
        per_person=4,
    )
    category, sold = dict(products), Counter()
    spend, owned = defaultdict(Counter), defaultdict(set)
    for o, p, price in lines:
        if category[p]:
            sold[p] += 1
            spend[owner[o]][category[p]] += price
            owned[owner[o]].add(p)
    want = set()
    for person, by_category in spend.items():
        best = min(by_category, key=lambda c: (-by_category[c], c))
        ranked = sorted((p for p in sold if category[p] == best), key=lambda p: (-sold[p], p))
        for i, p in enumerate([p for p in ranked if p not in owned[person]][:4], start=1):
            want.add((person, best, i, p, sold[p]))
    assert {tuple(r) for r in got.collect()} == want


def test_worst_sellers_count_an_order_once(spark):
    when = datetime(2018, 1, 1)
    orders = spark.createDataFrame(
        [(i, "delivered", when, datetime(2018, 1, 10 + i), datetime(2018, 1, 10)) for i in range(10)],
        """order_id int, order_status string, order_purchase_timestamp timestamp_ntz,
        order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz""",
    )
    items = spark.createDataFrame([(i, f"s{i}") for i in range(10)] * 2, "order_id int, seller_id string")
    reviews = spark.createDataFrame([(i, 1 if i == 4 else 5) for i in range(10)], "order_id int, review_score int")
    rows = {r.seller_id: (r.orders, r.delay_tile, r.review_tile) for r in retention.worst_sellers(orders, items, reviews).collect()}
    assert rows == {"s9": (1, 1, 10), "s4": (1, 6, 1)}
    # Without its review the latest seller is still there, and nobody else's place depends on it.
    fewer = retention.worst_sellers(orders, items, reviews.where("order_id <> 9")).collect()
    assert {r.seller_id: (r.delay_tile, r.review_tile) for r in fewer} == {"s9": (1, None), "s4": (6, 1)}


def test_people_without_a_known_category_are_a_group(spark):
    rows = spark.createDataFrame([(0, 1), (1, 0), (1, 1), (3, 0)], "category_diversity long, churned int")
    got = {r.categories: (r.customers, r.churn_rate) for r in retention.category_insight(rows).collect()}
    assert got == {"no known category": (1, 1.0), "one category": (2, 0.5), "several categories": (1, 0.0)}


def test_survival_reaches_zero_and_respects_censoring(spark):
    lives = spark.createDataFrame([("g", 1, 1), ("g", 2, 0), ("g", 3, 1), ("g", 3, 1)], "seg string, duration int, event int")
    got = [(r.duration, r.at_risk, r.events, r.survival) for r in extensions.kaplan_meier(lives, "seg").orderBy("duration").collect()]
    assert got == [(1, 4, 1, 0.75), (2, 3, 0, 0.75), (3, 2, 2, 0.0)]


def test_lift(spark):
    rows = [("treatment", 1)] * 30 + [("treatment", 0)] * 70 + [("control", 1)] * 20 + [("control", 0)] * 80
    r = extensions.lift_readout(spark.createDataFrame(rows, "arm string, retained int")).first()
    assert (r.treated_rate, r.control_rate, r.lift) == pytest.approx((0.3, 0.2, 0.1))
    assert r.z_statistic == pytest.approx(0.1 / (0.25 * 0.75 * 0.02) ** 0.5, abs=1e-6)
