"""Observation window and churn labels."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions import fraction, months_before
from holdfast.sources.schemas import KEY

PLACED = "order_purchase_timestamp"


def delivered_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_status") == "delivered")


def delivered_ratio(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.count_if(F.col("order_status") == "delivered").alias("delivered_orders"),
        F.count("*").alias("total_orders"),
        fraction(F.col("order_status") == "delivered").alias("delivered_share"),
    )


def cutoff_frame(orders: DataFrame, months: int = 6) -> DataFrame:
    """Last purchase among delivered orders and the cutoff ``months`` before it."""
    last = delivered_orders(orders).agg(F.max(PLACED).alias("max_date"))
    return last.select("max_date", months_before(F.col("max_date"), months).alias("cutoff_date"))


def cutoff_column(orders: DataFrame, months: int = 6, cutoff: datetime | None = None) -> Column:
    """The cutoff as a column: the given moment, or a scalar subquery over the orders.

    Either form reaches the scan as a pushed filter.
    """
    if cutoff is not None:
        return F.lit(cutoff).cast("timestamp_ntz")
    return cutoff_frame(orders, months).select("cutoff_date").scalar()


def pre_cutoff(orders: DataFrame, cutoff: Column) -> DataFrame:
    return delivered_orders(orders).where(F.col(PLACED) <= cutoff)


def post_cutoff(orders: DataFrame, cutoff: Column) -> DataFrame:
    return delivered_orders(orders).where(F.col(PLACED) > cutoff)


def with_person(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Attach the person to each order."""
    return orders.join(customers.select("customer_id", KEY), "customer_id", "inner").where(
        F.col(KEY).isNotNull()
    )


def churn_labels(
    orders: DataFrame,
    customers: DataFrame,
    cutoff: Column,
    definition: str = "none_after_cutoff",
    months: int = 6,
) -> DataFrame:
    """One row per person with a delivered order at or before the cutoff.

    ``none_after_cutoff``: churned when no delivered order follows the cutoff.
    ``per_customer``: churned when none falls within ``months`` after the person's
    own last order before the cutoff. Both need one aggregation over the orders
    instead of two key sets, so a person with very many orders is reduced map-side.
    """
    placed = F.col(PLACED)
    seen = with_person(delivered_orders(orders).select("customer_id", PLACED), customers)
    before = F.max(F.when(placed <= cutoff, placed))
    after = F.min(F.when(placed > cutoff, placed))
    people = seen.groupBy(KEY).agg(before.alias("last_before"), after.alias("next_after")).where(
        F.col("last_before").isNotNull()
    )
    returned = F.col("next_after").isNotNull()
    if definition == "per_customer":
        window_end = F.col("last_before") + F.make_ym_interval(F.lit(0), F.lit(months))
        returned = returned & (F.col("next_after") <= window_end)
    elif definition != "none_after_cutoff":
        raise ValueError(f"unknown churn definition {definition!r}")
    return people.select(KEY, F.when(returned, 0).otherwise(1).alias("churned"))


def split_people(orders: DataFrame, customers: DataFrame, cutoff: Column) -> tuple[DataFrame, DataFrame]:
    """Active people (bought before and after the cutoff) and churned people, as key sets."""
    before = with_person(pre_cutoff(orders, cutoff), customers).select(KEY).distinct()
    after = with_person(post_cutoff(orders, cutoff), customers).select(KEY).distinct()
    return before.join(after, KEY, "left_semi"), before.join(after, KEY, "left_anti")


def churn_rate(labels: DataFrame) -> DataFrame:
    return labels.agg(
        F.count("*").alias("customers"),
        F.sum("churned").alias("churned_customers"),
        F.avg("churned").alias("churn_rate"),
    )


def one_time_buyers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Share of people with exactly one delivered order."""
    per_person = with_person(delivered_orders(orders).select("customer_id"), customers).groupBy(KEY).count()
    return per_person.agg(
        F.count("*").alias("customers"),
        F.count_if(F.col("count") == 1).alias("one_time_customers"),
        fraction(F.col("count") == 1).alias("one_time_share"),
    )
