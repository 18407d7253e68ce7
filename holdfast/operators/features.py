"""Per-person features.

Items and reviews are both one-to-many to orders, so each is reduced to one row
per order before it meets the orders. That keeps the fan-outs apart, and a hot
order is already one row per map task when it is shuffled. The feature table then
needs a single aggregation by person, in which a bounded set of categories is a few
words of bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions import floor_days, fraction, from_units, money_units
from holdfast.operators.labels import PLACED, delivered_orders, pre_cutoff, with_person
from holdfast.sources.schemas import FULL13, KEY

# Fills for people without deliveries or reviews.
LITERAL_FILLS = {
    "avg_delivery_delay": 0.0,
    "max_delivery_delay": 0.0,
    "avg_delivery_days": 3.0,
    "min_review_score": 3.0,
    "pct_bad_reviews": 0.0,
    "category_diversity": 1,
}
REPAIRED_FILLS = {**LITERAL_FILLS, "avg_review_score": 3.0, "pct_late_orders": 0.0}

BAD_SCORE = 2

# Up to this many categories a person's set of them is kept as bits; beyond it the rows are spread by category.
MOST_CATEGORIES = 1_024
WORD_BITS = 64


def items_by_order(items: DataFrame) -> DataFrame:
    """Item totals per order; money in whole units."""
    return items.groupBy("order_id").agg(
        F.sum(money_units(F.col("price"))).alias("spend"),
        F.count("price").alias("priced_items"),
        F.sum(money_units(F.col("freight_value"))).alias("freight"),
    )


def _each_once(products: DataFrame) -> bool:
    """Whether no product comes twice."""
    return products.where(F.col("product_id").isNotNull()).groupBy("product_id").count().where("count > 1").isEmpty()


def _items_of_orders(items: DataFrame, products: DataFrame, known: DataFrame, near: DataFrame | None, *more: Column) -> DataFrame:
    """Item totals per order and ``more``, and whether any item is of a known product. A product that comes twice counts its
    items twice.

    With ``near``, the ids of the orders wanted, money is added up where the items lie, and only order and product go to
    the products, if each of those comes once.
    """

    def wanted(per_order: DataFrame) -> DataFrame:
        # Above the sums: few orders still reach the scan, and for many no single items are moved.
        return per_order if near is None else per_order.join(near, "order_id", "left_semi")

    known = known.withColumn("is_product", F.lit(True))
    has_product = F.bool_or(F.coalesce("is_product", F.lit(False))).alias("has_product")
    if near is not None and _each_once(products):
        met = items.select("order_id", "product_id").join(known, "product_id", "inner")
        kinds = wanted(met.groupBy("order_id").agg(has_product, *more))
        both = wanted(items_by_order(items)).join(kinds, "order_id", "left")
        return both.withColumn("has_product", F.coalesce("has_product", F.lit(False)))
    return wanted(
        items.select("order_id", "product_id", "price", "freight_value")
        .join(known, "product_id", "left")
        .groupBy("order_id")
        .agg(
            F.sum(money_units(F.col("price"))).alias("spend"),
            F.count("price").alias("priced_items"),
            F.sum(money_units(F.col("freight_value"))).alias("freight"),
            has_product,
            *more,
        )
    )


def items_with_categories(items: DataFrame, products: DataFrame, near: DataFrame | None = None) -> DataFrame:
    """Item totals per order with the set of known categories."""
    known = products.select("product_id", "product_category_name")
    return _items_of_orders(items, products, known, near, F.collect_set("product_category_name").alias("categories"))


def category_names(products: DataFrame, most: int = MOST_CATEGORIES) -> list[str] | None:
    """All categories in order of name; None if there are more than ``most``."""
    kinds = products.select("product_category_name").where(F.col("product_category_name").isNotNull()).distinct()
    found = sorted(row[0] for row in kinds.limit(most + 1).collect())
    return found if len(found) <= most else None


def _words(names: list[str]) -> list[str]:
    return [f"word{i}" for i in range(-(-len(names) // WORD_BITS))]


def items_with_words(items: DataFrame, products: DataFrame, names: list[str], near: DataFrame | None = None) -> DataFrame:
    """Item totals per order with the set of known categories as bits: the s-th is bit s % 64 of ``word<s // 64>``."""
    slots = products.sparkSession.createDataFrame(
        [(name, slot) for slot, name in enumerate(names)], "product_category_name string, slot int"
    )
    known = (
        products.select("product_id", "product_category_name")
        .join(F.broadcast(slots), "product_category_name", "left")
        .select("product_id", "slot")
    )
    bit = F.expr(f"shiftleft(1L, slot % {WORD_BITS})")
    own = [F.bit_or(F.when(F.floor(F.col("slot") / WORD_BITS) == i, bit)).alias(w) for i, w in enumerate(_words(names))]
    return _items_of_orders(items, products, known, near, *own)


def _total(units: Column) -> Column:
    return from_units(F.coalesce(F.sum(units), F.lit(0)))


def _mean(units: Column, count: Column) -> Column:
    return F.try_divide(from_units(F.sum(units)), F.sum(count).cast("double"))


def reviews_by_order(reviews: DataFrame) -> DataFrame:
    score = F.col("review_score")
    return reviews.groupBy("order_id").agg(
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("scores"),
        F.min("review_score").alias("score_min"),
        F.count_if(score <= BAD_SCORE).alias("bad_reviews"),
        F.count("*").alias("reviews"),
    )


def delivery_measures(orders: DataFrame, strict_asof: Column | None = None) -> DataFrame:
    """Delay against the promise and days in transit, per order.

    ``strict_asof`` hides deliveries later than that moment.
    """
    arrived = F.col("order_delivered_customer_date")
    if strict_asof is not None:
        arrived = F.when(arrived <= strict_asof, arrived)
    return orders.withColumns(
        {
            "delivery_delay_days": floor_days(arrived, F.col("order_estimated_delivery_date")),
            "actual_delivery_days": floor_days(arrived, F.col(PLACED)),
        }
    )


def reviews_asof(reviews: DataFrame, moment: Column) -> DataFrame:
    """Reviews written at or before ``moment``."""
    return reviews.where(F.col("review_creation_date") <= moment)


def rfm_features(orders: DataFrame, customers: DataFrame, items: DataFrame, cutoff: Column) -> DataFrame:
    """Recency, frequency and spend over orders that have items."""
    placed = with_person(pre_cutoff(orders, cutoff).select("order_id", "customer_id", PLACED), customers)
    per_order = placed.join(items_by_order(items), "order_id", "inner")
    return (
        per_order.groupBy(KEY)
        .agg(
            F.max(PLACED).alias("last_purchase"),
            F.count("*").alias("order_count"),
            _total(F.col("spend")).alias("total_spend"),
            _mean(F.col("spend"), F.col("priced_items")).alias("avg_order_value"),
            _total(F.col("freight")).alias("total_freight"),
        )
        .withColumn("recency_days", floor_days(cutoff, F.col("last_purchase")))
    )


def delivery_features(
    orders: DataFrame, customers: DataFrame, cutoff: Column, strict_asof: bool = False
) -> DataFrame:
    measured = delivery_measures(pre_cutoff(orders, cutoff), cutoff if strict_asof else None)
    delay = F.col("delivery_delay_days")
    return (
        with_person(measured.select("customer_id", "delivery_delay_days", "actual_delivery_days"), customers)
        .groupBy(KEY)
        .agg(
            F.avg(delay).alias("avg_delivery_delay"),
            F.max(delay).alias("max_delivery_delay"),
            F.avg("actual_delivery_days").alias("avg_delivery_days"),
            fraction(delay > 0).alias("pct_late_orders"),
        )
    )


def review_features(orders: DataFrame, customers: DataFrame, reviews: DataFrame, cutoff: Column) -> DataFrame:
    """Every review row counts, so an order reviewed twice weighs twice."""
    placed = with_person(pre_cutoff(orders, cutoff).select("order_id", "customer_id"), customers)
    return (
        placed.join(reviews_by_order(reviews), "order_id", "inner")
        .groupBy(KEY)
        .agg(
            F.try_divide(F.sum("score_sum").cast("double"), F.sum("scores").cast("double")).alias(
                "avg_review_score"
            ),
            F.min("score_min").alias("min_review_score"),
            (F.sum("bad_reviews").cast("double") / F.sum("reviews").cast("double")).alias("pct_bad_reviews"),
        )
    )


def category_diversity(
    orders: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame, cutoff: Column
) -> DataFrame:
    """Distinct known categories; 0 when all are unknown, no row when no item matches a product.

    Orders hold few repeated categories, so item rows go to their order in one
    shuffle of two narrow columns instead of being made distinct there first. Both
    joins meet a unique key, so a hot product or order is split by the adaptive
    skew join, and a hot person is made distinct before the next shuffle.
    """
    placed = with_person(pre_cutoff(orders, cutoff).select("order_id", "customer_id"), customers)
    item_categories = (
        items.select("order_id", "product_id")
        .join(products.select("product_id", "product_category_name"), "product_id", "inner")
        .select("order_id", "product_category_name")
    )
    return (
        placed.join(item_categories, "order_id", "inner")
        .select(KEY, "product_category_name")
        .distinct()
        .groupBy(KEY)
        .agg(F.count("product_category_name").alias("category_diversity"))
    )


def fill_features(features: DataFrame, fill: str = "literal") -> DataFrame:
    """Fill nulls; ``literal`` leaves the average score null, ``repaired`` fills it too."""
    fills = {"literal": LITERAL_FILLS, "repaired": REPAIRED_FILLS}[fill]
    return features.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})


def assemble(
    rfm: DataFrame, delivery: DataFrame, reviews: DataFrame, diversity: DataFrame, labels: DataFrame
) -> DataFrame:
    """Join the four aggregates and the labels on the person, unfilled."""
    return (
        rfm.join(delivery, KEY, "left")
        .join(reviews, KEY, "left")
        .join(labels, KEY, "inner")
        .join(diversity, KEY, "left")
        .withColumns(
            {c: F.col(c).cast("double") for c in ("max_delivery_delay", "min_review_score")}
        )
        .select(KEY, *FULL13, "last_purchase", "churned")
    )


def feature_table(
    tables: dict[str, DataFrame],
    cutoff: Column,
    fill: str = "literal",
    strict_asof: bool = False,
    near: DataFrame | None = None,
) -> DataFrame:
    """The labelled feature table from one pass over each table.

    Items meet their products and are reduced to their order, measures and set of categories together; where ``near``
    gives the ids of the orders in ``tables``, that is money by itself in a second pass. One
    aggregation by person then adds up the measures and joins the sets, whose categories are bits of a few
    words, so that a person with very many orders reaches the shuffle as one row per task. Should there be
    more than ``MOST_CATEGORIES``, orders are spread by category instead.
    """
    reviews = reviews_asof(tables["order_reviews"], cutoff) if strict_asof else tables["order_reviews"]
    measured = delivery_measures(delivered_orders(tables["orders"]), cutoff if strict_asof else None)
    names = category_names(tables["products"])
    items = (
        items_with_categories(tables["order_items"], tables["products"], near)
        if names is None
        else items_with_words(tables["order_items"], tables["products"], names, near)
    )
    per_order = (
        with_person(
            measured.select("order_id", "customer_id", PLACED, "delivery_delay_days", "actual_delivery_days"),
            tables["customers"],
        )
        .join(items, "order_id", "left")
        .join(reviews_by_order(reviews), "order_id", "left")
        .withColumn("observed", F.col(PLACED) <= cutoff)
    )
    sums = _sums_by_category(per_order) if names is None else _sums_by_person(per_order, _words(names))
    return fill_features(_finished(sums, cutoff), fill)


def _measures(counted: Column) -> tuple[dict[str, Column], dict[str, Column]]:
    """Sums, and extremes and flags, over the rows that ``counted`` says are an order up to the cutoff."""
    bought = counted & F.col("priced_items").isNotNull()

    def own(column: str) -> Column:
        return F.when(counted, F.col(column))

    added = {
        "order_count": F.count_if(bought),
        "orders_seen": F.count_if(counted),
        **{c: F.sum(own(c)) for c in ("spend", "priced_items", "freight", "score_sum", "scores", "bad_reviews", "reviews")},
        "delay_sum": F.sum(own("delivery_delay_days")),
        "delays": F.count(own("delivery_delay_days")),
        "days_sum": F.sum(own("actual_delivery_days")),
        "transits": F.count(own("actual_delivery_days")),
        "late": F.count_if(counted & (F.col("delivery_delay_days") > 0)),
    }
    extremes = {
        "last_purchase": F.max(F.when(bought, F.col(PLACED))),
        "max_delivery_delay": F.max(own("delivery_delay_days")),
        "min_review_score": F.min(own("score_min")),
    }
    return added, extremes


def _sums_by_person(per_order: DataFrame, words: list[str]) -> DataFrame:
    """One aggregation by person, from one row per order with its categories as bits."""
    observed = F.col("observed")
    added, extremes = _measures(observed)
    sums = per_order.groupBy(KEY).agg(
        *[column.alias(name) for name, column in {**added, **extremes}.items()],
        F.bool_or(~observed).alias("came_back"),
        F.bool_or(observed & F.coalesce("has_product", F.lit(False))).alias("has_product"),
        *[F.bit_or(F.when(observed, F.col(w))).alias(w) for w in words],
    )
    kinds = sum((F.bit_count(F.coalesce(w, F.lit(0).cast("long"))) for w in words), F.lit(0)).cast("long")
    # Null when none of the items is of a known product.
    return sums.withColumn("category_diversity", F.when(F.col("has_product"), kinds))


def _sums_by_category(per_order: DataFrame) -> DataFrame:
    """The same from a row per order and category, by person and category and then by person."""
    observed = F.col("observed")
    nothing = F.array(F.lit(None).cast("string"))
    spread = per_order.withColumn(
        "category", F.explode(F.concat(nothing, F.coalesce("categories", F.array().cast("array<string>"))))
    )
    # The row without a category speaks for the order.
    is_order = F.col("category").isNull()
    added, extremes = _measures(is_order & observed)
    by_category = spread.groupBy(KEY, "category").agg(
        *[column.alias(name) for name, column in {**added, **extremes}.items()],
        F.bool_or(is_order & ~observed).alias("came_back"),
        F.bool_or(observed & F.coalesce("has_product", F.lit(False))).alias("has_product"),
        F.bool_or(observed).alias("seen"),
    )
    return by_category.groupBy(KEY).agg(
        F.max("last_purchase").alias("last_purchase"),
        F.max("max_delivery_delay").alias("max_delivery_delay"),
        F.min("min_review_score").alias("min_review_score"),
        F.bool_or("came_back").alias("came_back"),
        F.when(F.bool_or("has_product"), F.count_if(F.col("category").isNotNull() & F.col("seen"))).alias(
            "category_diversity"
        ),
        *[F.sum(name).alias(name) for name in added],
    )


def _finished(sums: DataFrame, cutoff: Column) -> DataFrame:
    """Features and label from the sums of the people who bought something, unfilled."""

    def ratio(top: str, bottom: str) -> Column:
        return F.try_divide(F.col(top).cast("double"), F.col(bottom).cast("double"))

    people = sums.where(F.col("order_count") > 0).withColumns(
        {
            "recency_days": floor_days(cutoff, F.col("last_purchase")),
            "total_spend": from_units(F.coalesce("spend", F.lit(0))),
            "avg_order_value": F.try_divide(from_units(F.col("spend")), F.col("priced_items").cast("double")),
            "total_freight": from_units(F.coalesce("freight", F.lit(0))),
            "max_delivery_delay": F.col("max_delivery_delay").cast("double"),
            "min_review_score": F.col("min_review_score").cast("double"),
            "avg_delivery_delay": ratio("delay_sum", "delays"),
            "avg_delivery_days": ratio("days_sum", "transits"),
            "pct_late_orders": ratio("late", "orders_seen"),
            "avg_review_score": ratio("score_sum", "scores"),
            "pct_bad_reviews": ratio("bad_reviews", "reviews"),
            "churned": F.when(F.col("came_back"), 0).otherwise(1),
        }
    )
    return people.select(KEY, *FULL13, "last_purchase", "churned")
