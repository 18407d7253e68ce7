"""Risk tiers, segment tables and dashboard queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions import currency_text, cut, cut_ordinal, from_units, money_units, percent_text
from holdfast.operators.explore import histogram
from holdfast.sources.schemas import KEY

# Bin edges and labels of the segments and tiers, and the action for each tier.
DELAY_EDGES = (-99, 0, 3, 7, 99)
DELAY_LABELS = ("On time", "1-3 days late", "4-7 days late", "7+ days late")
REVIEW_EDGES = (0, 2, 3, 4, 5.01)
REVIEW_LABELS = ("1-2 stars", "3 stars", "4 stars", "5 stars")
TIER_EDGES = (0, 0.3, 0.6, 1.0)
TIER_LABELS = ("Low risk", "Medium risk", "High risk")
ACTIONS = {
    "High risk": "immediate retention action recommended",
    "Medium risk": "include in next reactivation campaign",
    "Low risk": "no immediate action needed",
}


def risk_tier(probability: Column, boundary: str = "right") -> Column:
    """Tier of a probability.

    ``right``: bins closed on the right, so 0.3 is low, 0.6 medium and exactly 0 has
    no tier. ``left``: rules ``>= 0.6`` and ``>= 0.3``, so 0.3 is medium and 0.6 high.
    """
    if boundary == "right":
        return cut(probability, TIER_EDGES, TIER_LABELS)
    if boundary != "left":
        raise ValueError("boundary is 'right' or 'left'")
    low, medium, high = TIER_LABELS
    return (
        F.when(probability >= TIER_EDGES[2], high)
        .when(probability >= TIER_EDGES[1], medium)
        .when(probability.isNotNull(), low)
    )


def with_tier(scored: DataFrame, boundary: str = "right") -> DataFrame:
    return scored.withColumn("risk_tier", risk_tier(F.col("churn_probability"), boundary))


def with_action(scored: DataFrame) -> DataFrame:
    """Rule tier, recommended action and display text for each scored row."""
    tier = risk_tier(F.col("churn_probability"), "left")
    action = F.element_at(F.create_map(*[F.lit(x) for pair in ACTIONS.items() for x in pair]), tier)
    return scored.withColumns(
        {
            "risk_tier": tier,
            "recommended_action": action,
            "probability_text": percent_text(F.col("churn_probability")),
        }
    )


def _labelled_frame(df: DataFrame, labels: Sequence[str], name: str) -> DataFrame:
    """The full list of labels with their order, so that empty bins stay in a report."""
    rows = F.array(
        *[F.struct(F.lit(i).alias("ordinal"), F.lit(label).alias(name)) for i, label in enumerate(labels)]
    )
    return df.sparkSession.range(1).select(F.inline(rows))


def churn_by_bin(
    features: DataFrame,
    value: str,
    edges: Sequence[float],
    labels: Sequence[str],
    name: str = "segment",
    include_lowest: bool = False,
) -> DataFrame:
    """Churn rate and size per bin of ``value``; empty bins have a null rate.

    Values beyond the outer edges, and nulls, are in no bin and count nowhere.
    """
    ordinal = cut_ordinal(F.col(value), edges, include_lowest=include_lowest)
    rates = (
        features.groupBy(ordinal.alias("ordinal"))
        .agg(F.count("*").alias("customers"), F.avg("churned").alias("churn_rate"))
        .where(F.col("ordinal").isNotNull())
    )
    return (
        _labelled_frame(features, labels, name)
        .join(rates, "ordinal", "left")
        .select("ordinal", name, F.coalesce("customers", F.lit(0)).alias("customers"), "churn_rate")
        .orderBy("ordinal")
    )


def delay_segment_churn(
    features: DataFrame, edges: Sequence[float] = DELAY_EDGES, labels: Sequence[str] = DELAY_LABELS
) -> DataFrame:
    return churn_by_bin(features, "avg_delivery_delay", edges, labels)


def review_segment_churn(
    features: DataFrame, edges: Sequence[float] = REVIEW_EDGES, labels: Sequence[str] = REVIEW_LABELS
) -> DataFrame:
    return churn_by_bin(features, "avg_review_score", edges, labels)


def segment_dashboard(features: DataFrame) -> DataFrame:
    """Delay and review segment tables under one another."""
    return (
        delay_segment_churn(features)
        .withColumn("segment_kind", F.lit("delivery delay"))
        .unionByName(review_segment_churn(features).withColumn("segment_kind", F.lit("review score")))
    )


def _by_tier(tiered: DataFrame, *measures: Column) -> DataFrame:
    """Measures per tier, with every tier present."""
    counted = tiered.where(F.col("risk_tier").isNotNull()).groupBy("risk_tier").agg(*measures)
    return _labelled_frame(tiered, TIER_LABELS, "risk_tier").join(counted, "risk_tier", "left").drop("ordinal")


def tier_counts(tiered: DataFrame) -> DataFrame:
    return (
        _by_tier(tiered, F.count("*").alias("customers"))
        .withColumn("customers", F.coalesce("customers", F.lit(0)))
        .orderBy(F.desc("customers"), "risk_tier")
    )


def tier_spend(tiered: DataFrame) -> DataFrame:
    return _by_tier(tiered, F.try_divide(from_units(F.sum(money_units(F.col("total_spend")))), F.count("total_spend")).alias("avg_spend"))


def tier_kpis(tiered: DataFrame) -> DataFrame:
    """Sizes of the three tiers in one row."""
    return tiered.agg(
        *[
            F.count_if(F.col("risk_tier") == label).alias(label.lower().replace(" risk", "_risk_customers"))
            for label in reversed(TIER_LABELS)
        ]
    )


def revenue_at_risk(tiered: DataFrame) -> DataFrame:
    """Spend weighted by churn probability, per tier."""
    spend = F.col("total_spend")
    return _by_tier(
        tiered,
        F.count("*").alias("customers"),
        from_units(F.sum(money_units(spend))).alias("total_spend"),
        from_units(F.sum(money_units(F.col("churn_probability") * spend))).alias("revenue_at_risk"),
    )


def top_at_risk(tiered: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` highest spenders in the high-risk tier; equal spends are ordered by key."""
    return (
        tiered.where(F.col("risk_tier") == TIER_LABELS[-1])
        .orderBy(F.desc_nulls_last("total_spend"), KEY)
        .select(KEY, "total_spend", "recency_days", "churn_probability")
        .limit(n)
    )


def top_at_risk_text(tiered: DataFrame, n: int = 10) -> DataFrame:
    """The same list formatted for display."""
    return top_at_risk(tiered, n).withColumns(
        {
            "churn_probability": percent_text(F.col("churn_probability")),
            "total_spend": currency_text(F.col("total_spend")),
        }
    )


def probability_histogram(scored: DataFrame, bins: int = 40) -> DataFrame:
    return histogram(scored, [], "churn_probability", bins)


def monthly_churn_trend(scored: DataFrame) -> DataFrame:
    """Mean predicted churn by month of the last purchase."""
    return (
        scored.groupBy(F.date_trunc("month", "last_purchase").cast("date").alias("month"))
        .agg(
            F.count("*").alias("customers"),
            F.avg("churn_probability").alias("predicted_churn_rate"),
        )
        .orderBy("month")
    )
