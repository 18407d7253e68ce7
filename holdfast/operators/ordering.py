"""Global order without one-task windows: running totals, ranks, exact quantiles.

A window without a partition, or over one hot group, runs in a single task. Here
rows are range-partitioned on the whole sort key instead, windows run inside each
range, and each range is shifted by the totals of the ranges before it. The
ranges are written out once, because range bounds are sampled and may differ if
the exchange is computed again. What remains on one task is one row per range and
group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions import key_hash
from holdfast.session import materialise

RANGE = "_range"


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    sums: dict[str, str],
    groups: Sequence[str] = (),
    with_totals: bool = False,
) -> DataFrame:
    """Add inclusive running sums: ``sums`` maps a new column to the column it adds up.

    ``order`` must be total within each group. Group columns must not be null.
    ``with_totals`` also adds each sum's group total, as ``<name>_total``.
    """
    keys = [*groups, RANGE]
    ranged = materialise(
        df.repartitionByRange(*[F.col(g) for g in groups], *order).withColumn(RANGE, F.spark_partition_id()),
        "ranged",
    )
    whole = Window.partitionBy(*groups)
    before = whole.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*keys).agg(*[F.sum(source).alias(f"_all_{name}") for name, source in sums.items()])
    offsets = totals.select(
        *keys,
        *[F.coalesce(F.sum(f"_all_{name}").over(before), F.lit(0)).alias(f"_before_{name}") for name in sums],
        *[F.sum(f"_all_{name}").over(whole).alias(f"{name}_total") for name in sums if with_totals],
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = ranged.select("*", *[F.sum(source).over(inside).alias(name) for name, source in sums.items()])
    return (
        running.join(offsets, keys, "inner")
        .withColumns({name: F.col(name) + F.col(f"_before_{name}") for name in sums})
        .drop(RANGE, *[f"_before_{name}" for name in sums])
    )


def row_numbers(
    df: DataFrame,
    order: Sequence[Column],
    name: str = "rank",
    groups: Sequence[str] = (),
    with_totals: bool = False,
) -> DataFrame:
    """``row_number`` over ``groups``; ``order`` must be total within each group.

    ``with_totals`` also adds the group's row count, as ``<name>_total``.
    """
    one = f"_one_{name}"
    return running_totals(df.withColumn(one, F.lit(1)), order, {name: one}, groups, with_totals).drop(one)


def tile_of(rank: Column, rows: Column, tiles: int) -> Column:
    """The ``ntile`` number of a row from its rank: earlier tiles take the remainder."""
    small = F.floor(rows / tiles)
    extra = rows - small * tiles
    in_large = F.ceil(rank / (small + 1))
    in_small = extra + F.ceil(F.try_divide(rank - extra * (small + 1), small))
    return F.when(rank <= extra * (small + 1), in_large).otherwise(in_small).cast("int")


def quantiles(df: DataFrame, value: str, points: Sequence[float], groups: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group, columns ``q0``, ``q1``, ...

    Equal values are counted together first, so repeated values cost nothing.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*groups, F.col(value).cast("double").alias("_value"))
        .agg(F.count("*").alias("_n"))
    )
    sized = running_totals(counts, [F.col("_value")], {"_upto": "_n"}, groups, with_totals=True)

    def at(position: Column) -> Column:
        return F.min(F.when(F.col("_upto") > position, F.col("_value")))

    def interpolated(point: float) -> Column:
        place = (F.col("_upto_total") - 1) * F.lit(point)
        low, high = at(F.floor(place)), at(F.ceil(place))
        part = F.max(place - F.floor(place))
        return low + (high - low) * part

    return sized.groupBy(*groups).agg(*[interpolated(p).alias(f"q{i}") for i, p in enumerate(points)])


def hash_order(df: DataFrame, key: str, seed: int, name: str = "rank", group: str | None = None) -> DataFrame:
    """Dense pseudo-random rank of each row from 1, within ``group`` when given.

    Rows are spread over 4,096 buckets by the first digits of their digest. The
    buckets are uniform whatever the keys or groups look like, so each window
    holds about 1/4,096 of a group, and the bucket offsets are a bounded table.
    """
    groups = [group] if group else []
    keys = [*groups, "_bucket"]
    hashed = df.withColumn("_digest", key_hash(seed, F.col(key))).withColumn(
        "_bucket", F.substring("_digest", 1, 3)
    )
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy(*keys)
        .count()
        .select(*keys, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(*keys).orderBy("_digest", key)
    return (
        hashed.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, keys, "inner")
        .withColumn(name, F.col("_inside") + F.col("_before"))
        .drop("_digest", "_bucket", "_inside", "_before")
    )
