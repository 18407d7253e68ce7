"""Feature matrix, stratified split, folds, scaling and oversampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions import hash_unit, key_hash
from holdfast.operators.neighbours import nearest_neighbours
from holdfast.operators.ordering import hash_order
from holdfast.session import materialise
from holdfast.sources.schemas import CORE9, KEY

SEED = 42


def matrix(features: DataFrame, columns: Sequence[str] = CORE9, label: str = "churned") -> DataFrame:
    """Key, label and the model's columns as doubles with nulls set to 0."""
    label_column = [F.col(label).cast("int").alias("label")] if label in features.columns else []
    return features.select(
        KEY, *label_column, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns]
    )


def assemble_vector(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error").transform(df)


def split_sizes(df: DataFrame, label: str = "label", test_size: float = 0.2) -> DataFrame:
    """Test rows per class: the rounded-up total shared out by largest remainder."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    # One row per class from here on.
    everything = Window.partitionBy()
    shared = counts.withColumn("total", F.sum("n").over(everything)).withColumn(
        "quota", F.ceil(F.col("total") * F.lit(test_size)) * F.col("n") / F.col("total")
    )
    remainder = F.col("quota") - F.floor("quota")
    left = F.ceil(F.col("total") * F.lit(test_size)) - F.sum(F.floor("quota")).over(everything)
    place = F.row_number().over(Window.orderBy(remainder.desc(), label))
    return shared.withColumn("left", left).withColumn("place", place).select(
        label,
        "n",
        (F.floor("quota") + F.when(F.col("place") <= F.col("left"), 1).otherwise(0)).cast("long").alias("n_test"),
    )


def stratified_split(
    df: DataFrame, label: str = "label", key: str = KEY, test_size: float = 0.2, seed: int = SEED
) -> DataFrame:
    """Add ``split``: in each class the rows with the lowest key digests are the test rows.

    Sizes are exact and the result is the same on every run. Only digest-bucket
    counts and one bucket per class are ordered; the table itself gets the split
    by comparing each digest with its class's last test digest, without a shuffle.
    ``df`` is read three times, so pass a written table.
    """
    digest = key_hash(seed, F.col(key))
    hashed = df.select(label, F.col(key).alias("_key"), digest.alias("_digest")).withColumn(
        "_bucket", F.substring("_digest", 1, 3)
    )
    upto = Window.partitionBy(label).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets = hashed.groupBy(label, "_bucket").count().withColumn("_upto", F.sum("count").over(upto))
    last_bucket = (
        buckets.join(F.broadcast(split_sizes(df, label, test_size)), label)
        .where((F.col("_upto") >= F.col("n_test")) & (F.col("_upto") - F.col("count") < F.col("n_test")))
        .select(label, "_bucket", (F.col("n_test") - F.col("_upto") + F.col("count")).alias("_need"))
    )
    order = Window.partitionBy(label).orderBy("_digest", "_key")
    last_row = (
        hashed.join(F.broadcast(last_bucket), [label, "_bucket"])
        .withColumn("_place", F.row_number().over(order))
        .where(F.col("_place") == F.col("_need"))
        .select(label, F.col("_digest").alias("_last_digest"), F.col("_key").alias("_last_key"))
    )
    in_test = (digest < F.col("_last_digest")) | ((digest == F.col("_last_digest")) & (F.col(key) <= F.col("_last_key")))
    # One row per class.
    return (
        df.join(F.broadcast(last_row), label, "left")
        .withColumn("split", F.when(in_test, "test").otherwise("train"))
        .drop("_last_digest", "_last_key")
    )


def with_folds(df: DataFrame, folds: int, label: str = "label", key: str = KEY, seed: int = SEED) -> DataFrame:
    """Add ``fold``: classes are dealt round the folds, so fold sizes differ by at most one row per class."""
    dealt = hash_order(df, key, seed + 1, "_deal", group=label)
    return dealt.withColumn("fold", F.pmod(F.col("_deal") - 1, F.lit(folds)).cast("int")).drop("_deal")


def scaling_stats(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation per column, and the row count, in one row; a constant column divides by 1."""
    spread = [
        F.when(F.stddev_pop(c) > 0, F.stddev_pop(c)).otherwise(F.lit(1.0)).alias(f"{c}_sd") for c in columns
    ]
    return train.agg(F.count("*").alias("rows_seen"), *[F.avg(c).alias(f"{c}_mean") for c in columns], *spread)


def scale(df: DataFrame, stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Standardise with statistics fitted elsewhere, which arrive as a one-row subquery."""
    one_row = stats.select(F.struct("*")).scalar()
    scaled = {c: (F.col(c) - F.col(f"_stats.{c}_mean")) / F.col(f"_stats.{c}_sd") for c in columns}
    return df.withColumn("_stats", one_row).withColumns(scaled).drop("_stats")


def vector_id(columns: Sequence[str]) -> Column:
    """Digest of a row's values; copies share it."""
    return F.md5(F.concat_ws("|", *[(F.col(c) + F.lit(0.0)).cast("string") for c in columns]))


def neighbour_pools(minority: DataFrame, columns: Sequence[str], k: int, tile_rows: int = 2048) -> DataFrame:
    """For each distinct vector, up to ``k`` neighbour vectors counted with multiplicity.

    Copies of a vector are its own nearest neighbours. They are counted instead of
    being compared, so a vector held by a third of the rows costs one point.
    """
    distinct = materialise(
        minority.groupBy(vector_id(columns).alias("vector_id")).agg(
            F.count("*").alias("copies"), *[F.first(c).alias(c) for c in columns]
        ),
        "vectors",
    )
    near = nearest_neighbours(distinct, "vector_id", columns, k, tile_rows)
    weights = distinct.select(F.col("vector_id").alias("neighbour"), F.least("copies", F.lit(k)).alias("times"))
    others = (
        near.join(weights, "neighbour", "inner")
        .groupBy("vector_id")
        .agg(F.sort_array(F.collect_list(F.struct("position", "times", "vector"))).alias("near"))
    )
    own = F.array_repeat(
        F.array(*[F.col(c) for c in columns]), F.least(F.col("copies") - 1, F.lit(k)).cast("int")
    )
    listed = F.flatten(F.transform("near", lambda n: F.array_repeat(n["vector"], n["times"].cast("int"))))
    return distinct.join(others, "vector_id", "left").select(
        "vector_id",
        F.slice(F.concat(own, F.coalesce(listed, F.array().cast("array<array<double>>"))), 1, k).alias("pool"),
    )


def smote(
    train: DataFrame,
    columns: Sequence[str],
    label: str = "label",
    key: str = KEY,
    k: int = 5,
    seed: int = SEED,
    tile_rows: int = 2048,
) -> DataFrame:
    """Oversample the smaller class to the size of the larger one (Chawla et al. 2002).

    Each synthetic row lies between a drawn row of the smaller class and one of its
    k nearest neighbours in that class. Draws depend only on the seed and the row's
    number, so a retried task makes the same rows. Synthetic keys start with
    ``synthetic-`` and the key column becomes text. Pass a written table.
    """
    counts = {row[label]: row["count"] for row in train.groupBy(label).count().collect()}
    small = min(counts, key=lambda value: (counts[value], value))
    missing = max(counts.values()) - counts[small]
    original = train.select(F.col(key).cast("string").alias(key), label, *columns, F.lit(False).alias("synthetic"))
    if missing == 0:
        return original

    minority = train.where(F.col(label) == small)
    seeds = hash_order(minority.select(key, *columns), key, seed, "_seat").withColumn(
        "vector_id", vector_id(columns)
    )
    seats = seeds.join(neighbour_pools(minority, columns, k, tile_rows), "vector_id", "inner")
    number = F.col("id")
    draws = train.sparkSession.range(missing).select(
        "id",
        (F.floor(hash_unit(seed + 1, number) * counts[small]) + 1).alias("_seat"),
        hash_unit(seed + 2, number).alias("_pick"),
        hash_unit(seed + 3, number).alias("_along"),
    )
    at = F.floor(F.col("_pick") * F.size("pool")).cast("int")
    neighbour = F.when(F.size("pool") > 0, F.get("pool", at)).otherwise(F.array(*[F.col(c) for c in columns]))
    made = draws.join(seats, "_seat", "inner").withColumn("_other", neighbour)
    synthetic = made.select(
        F.concat(F.lit("synthetic-"), number.cast("string")).alias(key),
        F.lit(small).cast(train.schema[label].dataType).alias(label),
        *[
            (F.col(c) + F.col("_along") * (F.get("_other", F.lit(i)) - F.col(c))).alias(c)
            for i, c in enumerate(columns)
        ],
        F.lit(True).alias("synthetic"),
    )
    return original.unionByName(synthetic)
