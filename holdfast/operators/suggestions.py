"""Product suggestions from purchase history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions import money_units
from holdfast.operators.labels import with_person
from holdfast.operators.ordering import row_numbers
from holdfast.session import materialise
from holdfast.sources.schemas import KEY

BLOCK = 1024


def purchases(orders: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Items and spend per person, category and product, reduced at the order grain first."""
    per_order = items.groupBy("order_id", "product_id").agg(
        F.count("*").alias("units"), F.sum(money_units(F.col("price"))).alias("spend")
    )
    known = products.where(F.col("product_category_name").isNotNull()).select("product_id", "product_category_name")
    return (
        per_order.join(known, "product_id", "inner")
        .join(with_person(orders.select("order_id", "customer_id"), customers), "order_id", "inner")
        .groupBy(KEY, F.col("product_category_name").alias("category"), "product_id")
        .agg(F.sum("units").alias("units"), F.sum("spend").alias("spend"))
    )


def top_category(bought: DataFrame) -> DataFrame:
    """The category each person spends most in; equal spends go to the first name."""
    spend = bought.groupBy(KEY, "category").agg(F.sum("spend").alias("spend"))
    best = F.min(F.struct((-F.col("spend")).alias("minus_spend"), F.col("category"))).alias("best")
    return spend.groupBy(KEY).agg(best).select(KEY, F.col("best.category").alias("category"))


def _place_in_own_list(owned: DataFrame) -> DataFrame:
    """Number each person's owned products by sales rank.

    Blocks of ranks keep a person who owns a large part of the catalogue from
    becoming one window group: counts per block are summed, then rows numbered
    inside each block.
    """
    keys = [KEY, "block"]
    blocked = owned.withColumn("block", F.floor((F.col("sales_rank") - 1) / BLOCK))
    before = Window.partitionBy(KEY).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocked.groupBy(*keys).count().select(*keys, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("earlier"))
    )
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy("sales_rank"))
    return blocked.withColumn("inside", inside).join(offsets, keys, "inner").withColumn(
        "place", F.col("inside") + F.col("earlier")
    )


def product_suggestions(
    orders: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame, per_person: int = 3
) -> DataFrame:
    """The best-selling products of each person's top category that the person has not bought.

    People are never paired with whole categories. If the products a person owns
    sit at sales ranks r1 < r2 < ..., the i-th one not owned has rank i plus the
    number of owned ones with r_j - j < i, so exactly ``per_person`` ranks are
    looked up for each person.
    """
    bought = materialise(purchases(orders, customers, items, products), "purchases")
    sales = bought.groupBy("category", "product_id").agg(F.sum("units").alias("sold"))
    ranked = materialise(
        row_numbers(sales, [F.desc("sold"), F.col("product_id")], "sales_rank", groups=["category"]), "sales"
    )
    favourite = top_category(bought)
    owned = (
        bought.select(KEY, "category", "product_id")
        .join(favourite, [KEY, "category"], "left_semi")
        .join(ranked.select("category", "product_id", "sales_rank"), ["category", "product_id"], "inner")
    )

    def shifts(gap: Column) -> Column:
        return F.array(*[F.count_if(gap < i) for i in range(1, per_person + 1)])

    wanted = (
        _place_in_own_list(owned)
        .groupBy(KEY, "category")
        .agg(shifts(F.col("sales_rank") - F.col("place")).alias("shifts"))
        .select(KEY, "category", F.posexplode("shifts").alias("at", "shift"))
        .select(
            KEY,
            "category",
            (F.col("at") + 1).alias("suggestion"),
            (F.col("at") + 1 + F.col("shift")).alias("sales_rank"),
        )
    )
    return wanted.join(ranked, ["category", "sales_rank"], "inner").select(
        KEY, "category", "suggestion", "product_id", "sold"
    )
