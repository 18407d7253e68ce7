"""Class balance, per-class means, correlations and histograms."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions import class_name, safe_ratio
from holdfast.sources.schemas import COMPARED8


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count and share of each non-null value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    return counts.withColumn("share", F.col("rows") / total).orderBy(F.desc("rows"), column)


def class_balance(features: DataFrame) -> DataFrame:
    return value_counts(features, "churned").select(
        "churned", class_name(F.col("churned")).alias("class_label"), "rows", "share"
    )


def long_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per feature: (keep..., feature, value)."""
    wide = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in features])
    return wide.unpivot(list(keep), list(features), "feature", "value")


def feature_means_by_class(features: DataFrame, columns: Sequence[str] = COMPARED8) -> DataFrame:
    """Mean of each feature for retained and churned people, features as rows.

    Means are taken while the table is wide, so only one row per class is unpivoted.
    """
    means = features.groupBy("churned").agg(*[F.avg(c).alias(c) for c in columns])
    value = F.round("value", 2)
    return (
        long_features(means, columns, ["churned"])
        .groupBy("feature")
        .agg(
            F.max(F.when(F.col("churned") == 0, value)).alias("retained_mean"),
            F.max(F.when(F.col("churned") == 1, value)).alias("churned_mean"),
        )
    )


def correlation_matrix(features: DataFrame, columns: Sequence[str] = (*COMPARED8, "churned")) -> DataFrame:
    """Pearson correlation of every ordered pair of columns; null against a constant.

    One pass with one set of pairwise sums; rows with either side null are left
    out of that pair, and the diagonal is 1 unless the column is constant.
    """
    typed = features.select(*[F.col(c).cast("double").alias(c) for c in columns])

    def correlation(a: str, b: str):
        # The sums of one pair leave out rows with either side null.
        return F.expr(f"try_divide(regr_sxy({a}, {b}), sqrt(regr_sxx({a}, {b}) * regr_syy({a}, {b})))")

    row = typed.agg(
        *[correlation(a, b).alias(f"{a}|{b}") for a, b in combinations(columns, 2)],
        *[F.expr(f"CASE WHEN stddev_pop({a}) > 0 THEN 1.0D END").alias(f"{a}|{a}") for a in columns],
    )
    names = F.split("pair", "[|]")
    sides = row.unpivot([], row.columns, "pair", "correlation").select(
        F.get(names, F.lit(0)).alias("a"), F.get(names, F.lit(1)).alias("b"), F.col("correlation").alias("value")
    )

    def cell(first: str, second: str):
        return F.struct(
            F.col(first).alias("feature_a"), F.col(second).alias("feature_b"), F.col("value").alias("correlation")
        )

    cells = F.when(F.col("a") == F.col("b"), F.array(cell("a", "b"))).otherwise(
        F.array(cell("a", "b"), cell("b", "a"))
    )
    return sides.select(F.inline(cells))


def histogram(df: DataFrame, groups: Sequence[str], value: str, bins: int = 40) -> DataFrame:
    """Density histogram with equal-width bins between each group's own extremes.

    The last bin is closed on the right; a group with one distinct value gets a
    unit-wide range around it. Every bin is reported, empty ones with density 0.
    ``groups`` must name a bounded set of groups, which is what gets broadcast.
    """
    known = df.where(F.col(value).isNotNull())
    ranges = (
        known.groupBy(*groups)
        .agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count("*").alias("total"))
        .withColumn("flat", F.col("lo") == F.col("hi"))
        .withColumn("lo", F.when(F.col("flat"), F.col("lo") - 0.5).otherwise(F.col("lo")))
        .withColumn("hi", F.when(F.col("flat"), F.col("hi") + 0.5).otherwise(F.col("hi")))
        .drop("flat")
    )
    width = (F.col("hi") - F.col("lo")) / bins
    number = F.least(F.floor((F.col(value) - F.col("lo")) / width), F.lit(bins - 1)).cast("int")
    if groups:
        placed = known.join(F.broadcast(ranges.select(*groups, "lo", "hi")), list(groups), "inner")
    else:
        edges = ranges.select(F.struct("lo", "hi")).scalar()
        placed = known.withColumn("_edges", edges).select(
            value, F.col("_edges.lo").alias("lo"), F.col("_edges.hi").alias("hi")
        )
    counts = placed.groupBy(*groups, number.alias("bin")).agg(F.count("*").alias("rows"))
    frame = ranges.withColumn("bin", F.explode(F.array(*[F.lit(i) for i in range(bins)])))
    return frame.join(counts, [*groups, "bin"], "left").select(
        *groups,
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_start"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
        safe_ratio(F.coalesce("rows", F.lit(0)), F.col("total") * width).alias("density"),
    )


def feature_histogram(features: DataFrame, columns: Sequence[str] = COMPARED8, bins: int = 40) -> DataFrame:
    return histogram(long_features(features, columns, ["churned"]), ["feature", "churned"], "value", bins)


def balance_report(stages: dict[str, DataFrame], label: str = "churned") -> DataFrame:
    """Class counts of several stages, such as before and after oversampling."""
    parts = [
        df.groupBy(label).agg(F.count("*").alias("rows")).select(F.lit(name).alias("stage"), label, "rows")
        for name, df in stages.items()
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def proportions_by(df: DataFrame, groups: Sequence[str], column: str) -> DataFrame:
    """Share of each value within its group; the window runs over already counted rows."""
    counts = df.where(F.col(column).isNotNull()).groupBy(*groups, column).agg(F.count("*").alias("rows"))
    return counts.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy(*groups)))
