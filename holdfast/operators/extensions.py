"""Survival curves, geographic and seller churn, and experiment readouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions import floor_days, hash_unit, safe_ratio
from holdfast.operators.labels import PLACED, pre_cutoff, with_person
from holdfast.sources.schemas import KEY


def customer_lifetimes(orders: DataFrame, customers: DataFrame, labels: DataFrame, cutoff) -> DataFrame:
    """Days from the first to the last observed purchase; churning ends a life, returning censors it."""
    spans = (
        with_person(pre_cutoff(orders, cutoff).select("customer_id", PLACED), customers)
        .groupBy(KEY)
        .agg(F.min(PLACED).alias("first"), F.max(PLACED).alias("last"))
    )
    return spans.join(labels, KEY, "inner").select(
        KEY, floor_days(F.col("last"), F.col("first")).alias("duration"), F.col("churned").alias("event")
    )


def kaplan_meier(lives: DataFrame, group: str) -> DataFrame:
    """Survival by group and day, from (group, duration, event) rows.

    Rows are counted per day first, so a window holds one row per day of the
    calendar and not one per person.
    """
    days = lives.groupBy(group, "duration").agg(
        F.sum(F.col("event").cast("long")).alias("events"), F.count("*").alias("leaving")
    )
    later = Window.partitionBy(group).orderBy("duration").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    sofar = Window.partitionBy(group).orderBy("duration").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stays = 1 - F.col("events") / F.col("at_risk")
    return (
        days.withColumn("at_risk", F.sum("leaving").over(later))
        .withColumn("log_stay", F.when(stays > 0, F.log(stays)).otherwise(0.0))
        .withColumn("died_out", F.max(F.when(stays > 0, 0).otherwise(1)).over(sofar))
        .withColumn("survival", F.when(F.col("died_out") == 1, 0.0).otherwise(F.exp(F.sum("log_stay").over(sofar))))
        .select(group, "duration", "at_risk", "events", "survival")
    )


def state_churn(features: DataFrame, orders: DataFrame, customers: DataFrame, cutoff) -> DataFrame:
    """Churn rate and mean delay by state; a person counts in every state they ordered from."""
    states = (
        pre_cutoff(orders, cutoff)
        .select("customer_id")
        .join(customers.select("customer_id", KEY, "customer_state"), "customer_id", "inner")
        .select(KEY, "customer_state")
        .distinct()
    )
    return (
        states.join(features.select(KEY, "churned", "avg_delivery_delay"), KEY, "inner")
        .groupBy("customer_state")
        .agg(
            F.count("*").alias("customers"),
            F.avg("churned").alias("churn_rate"),
            F.avg("avg_delivery_delay").alias("avg_delay"),
        )
    )


def seller_churn(labels: DataFrame, orders: DataFrame, customers: DataFrame, items: DataFrame, cutoff) -> DataFrame:
    """Churn rate among each seller's buyers, highest first."""
    placed = with_person(pre_cutoff(orders, cutoff).select("order_id", "customer_id"), customers)
    buyers = (
        items.select("order_id", "seller_id")
        .distinct()
        .join(placed, "order_id", "inner")
        .select("seller_id", KEY)
        .distinct()
    )
    return (
        buyers.join(labels, KEY, "inner")
        .groupBy("seller_id")
        .agg(
            F.count("*").alias("buyers"),
            F.sum("churned").alias("churned_buyers"),
            F.avg("churned").alias("churn_rate"),
        )
        .orderBy(F.desc("churn_rate"), "seller_id")
    )


def assign_arms(targets: DataFrame, seed: int = 42, treated_share: float = 0.5) -> DataFrame:
    """Experiment arm from the key alone, the same on every run."""
    share = hash_unit(seed, F.col(KEY))
    return targets.withColumn("arm", F.when(share < treated_share, "treatment").otherwise("control"))


def lift_readout(assigned: DataFrame, outcome: str = "retained") -> DataFrame:
    """Rates of both arms, the lift and the two-proportion z statistic."""
    value = F.col(outcome).cast("double")
    treated, control = F.col("arm") == "treatment", F.col("arm") == "control"
    c = F.col
    sums = assigned.agg(
        F.count_if(treated).alias("n_t"),
        F.count_if(control).alias("n_c"),
        F.sum(F.when(treated, value)).alias("x_t"),
        F.sum(F.when(control, value)).alias("x_c"),
    )
    pooled = (c("x_t") + c("x_c")) / (c("n_t") + c("n_c"))
    error = F.sqrt(pooled * (1 - pooled) * (1 / c("n_t") + 1 / c("n_c")))
    p_t, p_c = safe_ratio(c("x_t"), c("n_t")), safe_ratio(c("x_c"), c("n_c"))
    return sums.where((c("n_t") > 0) & (c("n_c") > 0)).select(
        c("n_t").alias("treated"),
        c("n_c").alias("controls"),
        p_t.alias("treated_rate"),
        p_c.alias("control_rate"),
        (p_t - p_c).alias("lift"),
        F.try_divide(p_t - p_c, error).alias("z_statistic"),
    )
