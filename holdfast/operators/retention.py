"""Retention targets, campaign rows and insight tables over scored features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions import from_units, money_units, safe_ratio
from holdfast.operators.features import BAD_SCORE, delivery_measures, reviews_by_order
from holdfast.operators.labels import delivered_orders, with_person
from holdfast.operators.ordering import row_numbers, tile_of
from holdfast.operators.selection import at_ranks, quantile_values
from holdfast.operators.segments import TIER_LABELS, churn_by_bin
from holdfast.session import materialise
from holdfast.sources.schemas import KEY

HIGH_PROBABILITY = 0.6

# Accepted range and default of each input field (None: no upper limit).
INPUT_RULES = {
    "recency_days": (0, 365, 90),
    "order_count": (1, None, 2),
    "total_spend": (0.0, None, 150.0),
    "avg_order_value": (0.0, None, 75.0),
    "total_freight": (0.0, None, 20.0),
    "avg_delivery_delay": (-10, 30, 0),
    "max_delivery_delay": (-10, 60, 0),
    "avg_delivery_days": (1, 60, 12),
    "pct_late_orders": (0.0, 1.0, 0.2),
    "avg_review_score": (1.0, 5.0, 4.0),
    "min_review_score": (1, 5, 3),
    "pct_bad_reviews": (0.0, 1.0, 0.0),
    "category_diversity": (1, 10, 2),
}
# Recency days on which the reactivation messages go out, and their discount in percent.
CAMPAIGN_DAYS = {60: 0, 75: 15, 89: 15}
# Days the campaign's discount holds, discount after a late delivery, least and most for the best customers.
CAMPAIGN_OFFER_DAYS = 7
RECOVERY_DISCOUNT = 10
VIP_DISCOUNT = (20, 25)
RECENCY_EDGES = (0, 60, 90, 120, float("inf"))
RECENCY_LABELS = ("0-60 days", "60-90 days", "90-120 days", "120+ days")


def _outside(feature: str, low: float, high: float | None) -> Column:
    value = F.col(feature).cast("double")
    inside = (value >= low) if high is None else value.between(low, high)
    return ~F.coalesce(inside, F.lit(False))


def count_out_of_range(rules: dict[str, tuple] = INPUT_RULES) -> Column:
    """How many values of a record lie outside their accepted range."""
    return sum((_outside(f, low, high).cast("int") for f, (low, high, _) in rules.items()), F.lit(0))


def range_violations(records: DataFrame, rules: dict[str, tuple] = INPUT_RULES) -> DataFrame:
    """One row per value outside its accepted range; a missing value is a violation too."""
    checks = []
    for feature, (low, high, _) in rules.items():
        value = F.col(feature).cast("double")
        checks.append(
            F.when(
                _outside(feature, low, high),
                F.struct(
                    F.lit(feature).alias("feature"),
                    value.alias("value"),
                    F.lit(float(low)).alias("min_allowed"),
                    F.lit(None if high is None else float(high)).cast("double").alias("max_allowed"),
                ),
            )
        )
    return records.select(KEY, F.inline(F.array_compact(F.array(*checks))))


def with_defaults(records: DataFrame, rules: dict[str, tuple] = INPUT_RULES) -> DataFrame:
    """Complete partial input records with the default of each missing field."""
    present = set(records.columns)
    return records.withColumns(
        {
            f: F.coalesce(F.col(f).cast("double"), F.lit(float(default))) if f in present else F.lit(float(default))
            for f, (_, _, default) in rules.items()
        }
    )


# Triggers and targets


def delivery_recovery_trigger(orders: DataFrame, customers: DataFrame, days: int = 3) -> DataFrame:
    """Delivered orders later than ``days``, with outreach and offer deadlines."""
    arrived = F.col("order_delivered_customer_date")
    late = delivery_measures(delivered_orders(orders)).where(F.col("delivery_delay_days") > days)
    return with_person(late, customers).select(
        "order_id",
        KEY,
        "delivery_delay_days",
        (arrived + F.make_dt_interval(hours=F.lit(24))).alias("outreach_due"),
        F.lit(RECOVERY_DISCOUNT).alias("discount_pct"),
        (arrived + F.make_dt_interval(F.lit(30))).alias("offer_expires"),
    )


def delivery_recovery_target(
    tiered: DataFrame, measure: str = "max_delivery_delay", days: float = 7
) -> DataFrame:
    """High-risk people whose worst (or, with ``avg_delivery_delay`` and 3, mean) delay is long."""
    return tiered.where((F.col("risk_tier") == TIER_LABELS[-1]) & (F.col(measure) > days)).select(
        KEY, measure, "total_spend", "churn_probability"
    )


def bad_review_trigger(
    orders: DataFrame, customers: DataFrame, reviews: DataFrame, max_score: int = BAD_SCORE
) -> DataFrame:
    """Low reviews with the moment by which someone should call."""
    low = reviews.where(F.col("review_score") <= max_score)
    return (
        low.join(with_person(orders.select("order_id", "customer_id"), customers), "order_id", "inner")
        .select(
            "order_id",
            KEY,
            "review_score",
            (F.col("review_creation_date") + F.make_dt_interval(hours=F.lit(48))).alias("contact_due"),
        )
    )


def bad_review_target(scored: DataFrame, max_score: int = BAD_SCORE, probability: float = HIGH_PROBABILITY) -> DataFrame:
    return scored.where(
        (F.col("min_review_score") <= max_score) & (F.col("churn_probability") >= probability)
    ).select(KEY, "min_review_score", "churn_probability")


def reactivation_target(
    features: DataFrame, low: int = 60, high: int = 90, min_spend: float = 100.0
) -> DataFrame:
    return features.where(F.col("recency_days").between(low, high) & (F.col("total_spend") > min_spend)).select(
        KEY, "recency_days", "total_spend", "last_purchase"
    )


def campaign_schedule(targets: DataFrame, days: dict[int, int] = CAMPAIGN_DAYS) -> DataFrame:
    """One row per message: its day since the last purchase, send date, discount, what it offers and until when.

    The first message has suggestions instead of a discount. The discount starts with the first message that has
    one and ends some days later; later messages remind of it and may go out after its end.
    """
    first_offer = next((day for day, off in days.items() if off), None)
    messages = F.array(
        *[
            F.struct(
                F.lit(step).alias("message"),
                F.lit(day).alias("recency_day"),
                F.lit(off).alias("discount_pct"),
                F.lit("discount" if off else "product suggestions").alias("offer"),
                F.lit(first_offer + CAMPAIGN_OFFER_DAYS if off else None).cast("int").alias("end_day"),
            )
            for step, (day, off) in enumerate(days.items(), start=1)
        ]
    )
    return targets.select(KEY, "last_purchase", F.inline(messages)).select(
        KEY,
        "message",
        "recency_day",
        "discount_pct",
        "offer",
        F.date_add(F.to_date("last_purchase"), F.col("recency_day")).alias("send_date"),
        F.date_add(F.to_date("last_purchase"), F.col("end_day")).alias("offer_ends"),
    )


def vip_target(scored: DataFrame, top_share: float = 0.2, probability: float = HIGH_PROBABILITY) -> DataFrame:
    """Likely churners whose spend lies in the top share, highest spend first."""
    spend = materialise(scored.select(KEY, "total_spend", "churn_probability"), "spend")
    [threshold] = quantile_values(spend, "total_spend", [1 - top_share])
    return (
        spend.where((F.col("churn_probability") >= probability) & (F.col("total_spend") >= F.lit(threshold).cast("double")))
        .select(
            KEY,
            "total_spend",
            "churn_probability",
            F.lit(VIP_DISCOUNT[0]).alias("min_discount_pct"),
            F.lit(VIP_DISCOUNT[1]).alias("max_discount_pct"),
        )
        .orderBy(F.desc("total_spend"), KEY)
    )


def worst_sellers(orders: DataFrame, items: DataFrame, reviews: DataFrame, tiles: int = 10) -> DataFrame:
    """Sellers in the worst tile by mean delay or by mean review; an order counts once per seller.

    Each list ranks the sellers that have its measure: one without reviews can still be among the
    latest, with a null review tile, and the other way round.
    """
    per_order = delivery_measures(delivered_orders(orders)).select("order_id", "delivery_delay_days")
    pairs = items.select("seller_id", "order_id").distinct()
    sellers = (
        pairs.join(per_order, "order_id", "inner")
        .join(reviews_by_order(reviews).select("order_id", "score_sum", "scores"), "order_id", "left")
        .groupBy("seller_id")
        .agg(
            F.count("*").alias("orders"),
            F.avg("delivery_delay_days").alias("avg_delay"),
            F.try_divide(F.sum("score_sum").cast("double"), F.sum("scores").cast("double")).alias("avg_review"),
        )
    )
    sellers = materialise(sellers, "sellers")

    def tiled(measure: str, order: Column, name: str) -> DataFrame:
        known = sellers.where(F.col(measure).isNotNull()).select("seller_id", measure)
        ranked = row_numbers(known, [order, F.col("seller_id")], "place", with_totals=True)
        return ranked.select("seller_id", tile_of(F.col("place"), F.col("place_total"), tiles).alias(name))

    return (
        sellers.join(tiled("avg_delay", F.desc("avg_delay"), "delay_tile"), "seller_id", "left")
        .join(tiled("avg_review", F.col("avg_review"), "review_tile"), "seller_id", "left")
        .where((F.col("delay_tile") == 1) | (F.col("review_tile") == 1))
        .select("seller_id", "orders", "avg_delay", "avg_review", "delay_tile", "review_tile")
    )


# Insight tables


def _two_rates(features: DataFrame, exposed: Column, baseline: Column) -> DataFrame:
    """Churn rate of two groups of people and their ratio."""
    churned = F.col("churned").cast("double")
    rates = features.agg(
        F.count_if(exposed).alias("exposed_customers"),
        F.count_if(baseline).alias("baseline_customers"),
        F.avg(F.when(exposed, churned)).alias("exposed_rate"),
        F.avg(F.when(baseline, churned)).alias("baseline_rate"),
    )
    return rates.select(
        "exposed_customers",
        "baseline_customers",
        "exposed_rate",
        "baseline_rate",
        safe_ratio(F.col("exposed_rate"), F.col("baseline_rate")).alias("churn_ratio"),
    )


def recency_ratio(features: DataFrame) -> DataFrame:
    """Churn of long-absent people against recent buyers, by two definitions."""
    recency = F.col("recency_days")
    wide = _two_rates(features, recency > 120, recency < 30).withColumn("comparison", F.lit("over 120 vs under 30"))
    rest = _two_rates(features, recency > 90, recency <= 90).withColumn("comparison", F.lit("over 90 vs rest"))
    return wide.unionByName(rest)


def delay_ratio(features: DataFrame, days: float = 7) -> DataFrame:
    worst = F.col("max_delivery_delay")
    return _two_rates(features, worst > days, worst <= 0)


def review_slope(features: DataFrame) -> DataFrame:
    """Change of churn per review point, by least squares."""
    return features.agg(
        F.regr_count("churned", "avg_review_score").alias("customers"),
        F.try_divide(
            F.regr_sxy(F.col("churned").cast("double"), F.col("avg_review_score")),
            F.regr_sxx(F.col("churned").cast("double"), F.col("avg_review_score")),
        ).alias("churn_per_review_point"),
    )


def review_jump(features: DataFrame) -> DataFrame:
    """Churn rate per whole review band and the change from the band below."""
    band = F.floor("avg_review_score").cast("int")
    rates = (
        features.where(F.col("avg_review_score").isNotNull())
        .groupBy(band.alias("review_band"))
        .agg(F.count("*").alias("customers"), F.avg("churned").alias("rate"))
    )
    # One row per band: five at most.
    step = F.col("rate") - F.lag("rate").over(Window.orderBy("review_band"))
    return rates.select(
        "review_band", "customers", F.col("rate").alias("churn_rate"), step.alias("jump")
    )


def spend_insight(features: DataFrame, threshold: float = 300.0) -> DataFrame:
    """Churn above and below a spend, and the correlation of spend with churn."""
    spend, churned = F.col("total_spend"), F.col("churned").cast("double")
    return features.agg(
        F.count_if(spend > threshold).alias("high_spenders"),
        F.avg(F.when(spend > threshold, churned)).alias("high_spend_rate"),
        F.avg(F.when(spend <= threshold, churned)).alias("low_spend_rate"),
        F.try_divide(
            F.regr_sxy(churned, spend), F.sqrt(F.regr_sxx(churned, spend) * F.regr_syy(churned, spend))
        ).alias("spend_churn_correlation"),
    )


def category_insight(features: DataFrame) -> DataFrame:
    """Churn by the number of known categories; people none of whose items has one are a group of their own."""
    kinds = F.col("category_diversity")
    return features.groupBy(
        F.when(kinds > 1, "several categories")
        .when(kinds == 1, "one category")
        .otherwise("no known category")
        .alias("categories")
    ).agg(F.count("*").alias("customers"), F.avg("churned").alias("churn_rate"))


def recency_band_churn(
    features: DataFrame, edges: Sequence[float] = RECENCY_EDGES, labels: Sequence[str] = RECENCY_LABELS
) -> DataFrame:
    """Churn rate along recency; a purchase on the cutoff day belongs to the first band."""
    return churn_by_bin(features, "recency_days", edges, labels, "recency_band", include_lowest=True)


def spend_concentration(features: DataFrame, tiles: int = 5) -> DataFrame:
    """Share of spend held by the top tile of people.

    The least spend in the tile is found by selection; people who spent just as much fill the places left.
    """
    spend = materialise(features.select("total_spend"), "spend")
    people = spend.agg(F.count("*").alias("n"), F.count("total_spend").alias("known")).first()
    top = -(-people.n // tiles)
    [least] = at_ranks(spend, "total_spend", [max(people.known - top, 0)])
    edge, units = F.lit(least).cast("double"), money_units(F.col("total_spend"))
    above = F.col("total_spend") > edge
    sums = spend.agg(
        F.count_if(above).alias("above"),
        F.coalesce(F.sum(F.when(above, units)), F.lit(0)).alias("units_above"),
        from_units(F.sum(units)).alias("all_spend"),
    )
    filled = (F.lit(min(top, people.known)) - F.col("above")) * money_units(edge)
    return sums.select(
        F.lit(top).cast("long").alias("top_customers"),
        from_units(F.col("units_above") + filled).alias("top_spend"),
        "all_spend",
    ).withColumn("top_share", safe_ratio(F.col("top_spend"), F.col("all_spend")))
