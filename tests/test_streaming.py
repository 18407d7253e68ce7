import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from holdfast.operators.features import feature_table
from holdfast.operators.models import linear_score
from holdfast.plans.churn import Study
from holdfast.sources import order_tables
from holdfast.sources.schemas import KEY
from holdfast.streaming.live_scores import latest_scores, rescore, start_scoring
from holdfast.streaming.score_log import ScoreLog


def run(spark, paths, tmp_path):
    query = start_scoring(
        spark, paths, linear_score, str(tmp_path / "log"), str(tmp_path / "progress"), available_now=True
    )
    query.awaitTermination()
    assert query.exception() is None


def deliver(tables, paths, keep):
    """Orders of a delivery, then their items and reviews."""
    for name in ("orders", "order_items", "order_reviews"):
        tables[name].where(keep).coalesce(1).write.mode("append").parquet(paths[name])


def test_people_are_rescored_when_they_order(spark, sf_dir, tmp_path):
    tables = order_tables(spark, sf_dir)
    paths = {name: str(tmp_path / name) for name in tables}
    for name in ("customers", "products"):
        tables[name].write.parquet(paths[name])
    deliver(tables, paths, "order_id % 4 <> 0")
    run(spark, paths, tmp_path)
    # Items and reviews of the later orders come with them, not before.
    deliver(tables, paths, "order_id % 4 = 0")
    run(spark, paths, tmp_path)

    got = latest_scores(spark, str(tmp_path / "log"))
    whole = Study(tables, months=0)
    want = linear_score(whole.features())
    # Everyone in the second batch is scored on their complete history.
    later = tables["orders"].where("order_id % 4 = 0")
    touched = later.join(tables["customers"], "customer_id").select(KEY).distinct()
    joined = want.join(touched, KEY, "left_semi").join(
        got.select(KEY, F.col("churn_probability").alias("logged"), F.col("order_count").alias("n")), KEY, "left"
    )
    assert joined.count() > 0
    assert joined.where("logged IS NULL OR logged <> churn_probability OR n <> order_count").count() == 0
    assert got.select(KEY).distinct().count() == got.count()
    # A restart with nothing new logs nothing.
    before = ScoreLog(spark, str(tmp_path / "log")).entries().count()
    run(spark, paths, tmp_path)
    assert ScoreLog(spark, str(tmp_path / "log")).entries().count() == before
    # One moment per epoch is kept, and never an earlier one.
    state = spark.read.parquet(str(tmp_path / "progress-moments")).orderBy("epoch").collect()
    assert len(state) == 2 and state[0].latest <= state[1].latest and state[0].until < state[1].until


def test_prices_do_not_travel_to_the_products(spark, sf_dir):
    tables = order_tables(spark, sf_dir)
    people = tables["customers"].select(KEY).distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scored = rescore(people, tables, linear_score, datetime(1998, 1, 1))
        plan = scored._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # What is scanned below each shuffle by product, and how often single items are shuffled with their money.
    below = [part.split("FileScan parquet ")[1].split("]")[0] for part in plan.split("Exchange hashpartitioning(product_id")[1:]]
    assert below and not any("price" in columns for columns in below)
    shuffled = re.findall(r"Exchange hashpartitioning\(order_id.*\n(.*)\n", plan)
    assert shuffled and not any("price" in line and "HashAggregate" not in line for line in shuffled)


@pytest.mark.parametrize("copies", [1, 2])
def test_items_of_wanted_orders_count_as_those_of_all(spark, copies):
    """Also where a product comes twice, is unknown or has no category, and where keys are null."""
    day = datetime(2020, 1, 1)
    orders = [(i, i, "delivered", day, day, day) for i in range(6)]
    items = [(0, 1, 10.0, 1.0), (0, 1, 5.0, 1.0), (1, 2, 7.0, None), (2, 9, 3.0, 1.0), (3, None, 2.0, 1.0), (None, 1, 4.0, 1.0), (4, 3, None, 1.0)]
    order_fields = ("order_id long, customer_id long, order_status string, order_purchase_timestamp timestamp_ntz, "
                    "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz")
    tables = {
        "orders": spark.createDataFrame(orders, order_fields),
        "customers": spark.createDataFrame([(i, i % 4) for i in range(6)], f"customer_id long, {KEY} long"),
        "order_items": spark.createDataFrame(items, "order_id long, product_id long, price double, freight_value double"),
        "order_reviews": spark.createDataFrame([(0, 4, day)], "order_id long, review_score int, review_creation_date timestamp_ntz"),
        "products": spark.createDataFrame(
            [(1, "a"), (2, None), (3, "b"), (None, "c")] + [(1, "a")] * (copies - 1), "product_id long, product_category_name string"
        ),
    }
    moment = F.lit(datetime(2020, 2, 1)).cast("timestamp_ntz")
    whole = feature_table(tables, moment)
    some = feature_table(tables, moment, near=tables["orders"].select("order_id"))
    got = sorted(map(tuple, some.collect()))
    assert got == sorted(map(tuple, whole.collect())) and len(got) == 4
    assert some.where(F.col(KEY) == 0).first().total_spend == 15.0 * copies


def batches(n, people=25, seed=6):
    rng = random.Random(seed)
    return [[(f"p{i}", float(epoch), None if epoch % 5 else "x") for i in rng.sample(range(people), 10)] for epoch in range(n)]


def logged(log):
    return {r[KEY]: (r.churn_probability, r.risk_tier) for r in log.latest().collect()}


def frame(spark, rows):
    return spark.createDataFrame(rows, f"{KEY} string, churn_probability double, risk_tier string").coalesce(1)


def test_log_reads_stay_bounded_by_the_live_rows(spark, tmp_path):
    log, newest = ScoreLog(spark, str(tmp_path), fan=3), {}
    for epoch, rows in enumerate(batches(30)):
        log.append(frame(spark, rows), epoch)
        newest |= {k: (p, t) for k, p, t in rows}
    assert logged(log) == newest
    levels = [r.level for r in log.runs()]
    assert max(levels) >= 3 and all(levels.count(i) < 3 for i in set(levels))
    # 300 rows were logged; a level holds at most two runs of 25 live rows.
    assert log.entries().count() <= 2 * 10 + 2 * 25 * max(levels)
    log.forget()
    assert logged(ScoreLog(spark, str(tmp_path))) == newest


def test_log_survives_a_crash_between_write_and_switch(spark, tmp_path, monkeypatch):
    log, newest = ScoreLog(spark, str(tmp_path), fan=3), {}
    switch = ScoreLog._switch
    for epoch, rows in enumerate(batches(9)):
        before = dict(newest)
        newest |= {k: (p, t) for k, p, t in rows}
        for fails_at in (1, 2):  # before the batch counts, then before a merged run does, if there is one
            calls = []

            def crash(self, runs):
                calls.append(runs)
                if len(calls) == fails_at:
                    raise OSError("the driver is gone")
                switch(self, runs)

            monkeypatch.setattr(ScoreLog, "_switch", crash)
            try:
                log.append(frame(spark, rows), epoch)
            except OSError:
                if log.runs():
                    assert logged(log) == (before if fails_at == 1 else newest)
        monkeypatch.setattr(ScoreLog, "_switch", switch)
        # Tried again, an epoch that counts is left alone.
        log.append(frame(spark, rows), epoch)
        log.append(frame(spark, [("p0", -1.0, "wrong")]), epoch)
        assert logged(log) == newest


def test_empty_log_says_so(spark, tmp_path):
    log = ScoreLog(spark, str(tmp_path / "none"))
    assert log.runs() == [] and log.entries() is None
    with pytest.raises(FileNotFoundError):
        log.latest()
