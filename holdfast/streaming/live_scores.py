"""Scoring people as their orders arrive.

Each micro-batch is one run of a ``ScoreLog``, written over when it is retried until it counts, so a
restart neither loses nor repeats rows. Readers take each person's newest row.

A batch sees all tables as they stood when it was first tried: the moment is written down before
anything is scored, and files that came later are left out, also when the batch is retried. Files are
taken as they are; they aren't changed once written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from holdfast.operators.features import feature_table
from holdfast.operators.labels import PLACED, delivered_orders, with_person
from holdfast.operators.segments import with_tier
from holdfast.sources.schemas import KEY
from holdfast.streaming.score_log import ScoreLog

Scorer = Callable[[DataFrame], DataFrame]


def orders_of(people: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """All orders of the given people, under any of their order-level ids."""
    aliases = customers.join(people, KEY, "left_semi").select("customer_id")
    return orders.join(aliases, "customer_id", "left_semi")


def rescore(people: DataFrame, tables: dict[str, DataFrame], scorer: Scorer, moment) -> DataFrame:
    """Current features and score of the given people at ``moment``.

    Their orders, and only the items and reviews of those, enter the aggregation.
    """
    own = orders_of(people, tables["orders"], tables["customers"])
    theirs = own.select("order_id")
    reviews = tables["order_reviews"].join(theirs, "order_id", "left_semi")
    tables = {**tables, "orders": own, "order_reviews": reviews}
    return with_tier(scorer(feature_table(tables, F.lit(moment).cast("timestamp_ntz"), near=theirs).drop("churned")))


def start_scoring(
    spark: SparkSession,
    paths: dict[str, str],
    scorer: Scorer,
    log_path: str,
    progress_path: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Watch a folder of order files and log a new score for everyone who ordered.

    ``paths`` are the Parquet folders of all order tables. Each batch opens them anew, so
    that items and reviews which arrive with the orders are seen.
    """
    schemas: dict[str, StructType] = {name: spark.read.parquet(path).schema for name, path in paths.items()}
    orders = spark.readStream.schema(schemas["orders"]).parquet(paths["orders"])

    def seen(session: SparkSession, name: str, until) -> DataFrame:
        files = session.read.schema(schemas[name]).parquet(paths[name])
        return files.where(F.col("_metadata.file_modification_time") <= F.lit(until)).select(*schemas[name].names)

    def on_batch(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        moments = f"{progress_path}-moments"
        state = _state(session, moments)
        mine = state.where(F.col("epoch") == epoch).first() if state is not None else None
        if mine is None:
            # The last delivered purchase so far is carried from epoch to epoch; orders aren't read again for it.
            before = state.agg(F.max("latest")).first()[0] if state is not None else None
            latest = delivered_orders(batch).agg(F.max(PLACED).alias("latest"))
            row = latest.select(
                F.lit(epoch).cast("long").alias("epoch"),
                F.greatest("latest", F.lit(before).cast("timestamp_ntz")).alias("latest"),
                F.current_timestamp().alias("until"),
            )
            row.write.mode("overwrite").parquet(f"{moments}/at={epoch}")
            mine = session.read.parquet(f"{moments}/at={epoch}").first()
        tables = {name: seen(session, name, mine.until) for name in paths}
        people = with_person(batch.select("customer_id"), tables["customers"]).select(KEY).distinct()
        scores = rescore(people, tables, scorer, mine.latest)
        ScoreLog(session, log_path).append(scores, epoch)

    writer = orders.writeStream.foreachBatch(on_batch).option("checkpointLocation", progress_path)
    return writer.trigger(availableNow=True).start() if available_now else writer.start()


def _state(spark: SparkSession, path: str) -> DataFrame | None:
    """One row per epoch so far; None before the first."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    return spark.read.parquet(path).drop("at") if there else None


def latest_scores(spark: SparkSession, log_path: str) -> DataFrame:
    """Each person's newest logged row."""
    return ScoreLog(spark, log_path).latest()
