import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from holdfast.operators.ordering import hash_order, quantiles, row_numbers, running_totals, tile_of


def skewed(spark, n=5000):
    """A third of the rows in one group and a third with one value."""
    return spark.range(n).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).cast("int").alias("g"),
        F.when(F.col("id") % 3 == 1, 5.0).otherwise((F.col("id") * 7919 % 1009).cast("double")).alias("v"),
    )


def test_running_totals_match_a_window(spark):
    df = skewed(spark)
    got = running_totals(df, [F.desc("v"), F.col("id")], {"s": "v"}, ["g"], with_totals=True)
    w = Window.partitionBy("g").orderBy(F.desc("v"), "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("want", F.sum("v").over(w)).withColumn("all", F.sum("v").over(Window.partitionBy("g")))
    joined = got.join(want.select("id", "want", "all"), "id")
    assert joined.count() == 5000
    assert joined.where((F.col("s") != F.col("want")) | (F.col("s_total") != F.col("all"))).count() == 0


def test_row_numbers_over_many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = skewed(spark)
        got = row_numbers(df, [F.col("v"), F.col("id")])
        want = df.withColumn("want", F.row_number().over(Window.orderBy("v", "id")))
        assert got.join(want.select("id", "want"), "id").where("rank <> want").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_tiles_match_ntile(spark):
    for n, k in ((10, 3), (11, 4), (3, 5), (143, 10)):
        df = spark.range(1, n + 1).withColumn("want", F.ntile(k).over(Window.orderBy("id")))
        assert df.where(tile_of(F.col("id"), F.lit(n), k) != F.col("want")).count() == 0


def test_quantiles_match_numpy(spark):
    df = skewed(spark)
    pdf = df.toPandas()
    points = [0.05, 0.5, 0.8, 1.0]
    row = quantiles(df, "v", points).first()
    assert np.allclose([row[f"q{i}"] for i in range(4)], np.quantile(pdf.v, points))
    for row in quantiles(df, "v", points, ["g"]).collect():
        assert np.allclose([row[f"q{i}"] for i in range(4)], np.quantile(pdf.v[pdf.g == row.g], points))


def test_hash_order_is_dense_within_groups(spark):
    ranked = hash_order(skewed(spark), "id", 3, group="g").toPandas()
    for _, part in ranked.groupby("g"):
        assert sorted(part["rank"]) == list(range(1, len(part) + 1))
    again = hash_order(skewed(spark).repartition(3), "id", 3, group="g").toPandas()
    pd.testing.assert_series_equal(ranked.set_index("id")["rank"].sort_index(), again.set_index("id")["rank"].sort_index())
