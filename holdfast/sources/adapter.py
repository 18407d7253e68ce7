"""Order tables derived from the TPC-H-like test tables.

Delivery dates and review scores come from integer arithmetic on keys, which
every engine evaluates alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Columns of the test tables that the order tables are derived from.
SOURCE_SCHEMAS = {
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz",
    "customer": "c_custkey long, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_extendedprice double, l_tax double",
    "part": "p_partkey long, p_type string",
}


def order_tables(spark: SparkSession, sf_dir: str, with_states: bool = False) -> dict[str, DataFrame]:
    """The order tables; people's states cost two joins, so they are added on request."""

    def read(name: str) -> DataFrame:
        return spark.read.schema(SOURCE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")

    source = read("orders")
    key = F.col("o_orderkey")
    placed = F.col("o_orderdate")
    status = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .otherwise("processing")
    )
    transit = F.make_dt_interval((5 + (key * 13) % 23).cast("int"), (key % 24).cast("int"))
    delivered = F.when(key % 97 != 0, placed + transit)
    promised = placed + F.make_dt_interval((10 + (key * 7) % 11).cast("int"))

    orders = source.select(
        key.alias("order_id"),
        key.alias("customer_id"),
        status.alias("order_status"),
        placed.alias("order_purchase_timestamp"),
        delivered.alias("order_delivered_customer_date"),
        promised.alias("order_estimated_delivery_date"),
    )

    customers = source.select(key.alias("customer_id"), F.col("o_custkey").alias("customer_unique_id"))
    if with_states:
        people = read("customer").join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        states = people.select(
            F.col("c_custkey").alias("customer_unique_id"), F.col("n_name").alias("customer_state")
        )
        customers = customers.join(states, "customer_unique_id", "left")

    items = read("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
    )

    # Some orders have no review and some have two, as scores for one order repeat.
    scores = F.concat(
        F.when(key % 11 != 0, F.array((1 + (key * 31) % 5).cast("int"))).otherwise(F.array().cast("array<int>")),
        F.when(key % 13 == 0, F.array((1 + (key * 17 + 3) % 5).cast("int"))).otherwise(
            F.array().cast("array<int>")
        ),
    )
    reviews = source.select(
        key.alias("order_id"),
        F.explode(scores).alias("review_score"),
        (delivered + F.make_dt_interval(F.lit(1))).alias("review_creation_date"),
    )

    products = read("part").select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 50 != 0, F.col("p_type")).alias("product_category_name"),
    )
    return {
        "orders": orders,
        "customers": customers,
        "order_items": items,
        "order_reviews": reviews,
        "products": products,
    }
