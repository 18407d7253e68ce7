"""The churn study end to end: tables to features, features to models, models to scores."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators import features as feature_ops
from holdfast.operators import labels as label_ops
from holdfast.operators.boosting import BoostedModel
from holdfast.operators.models import linear_score, score_customers
from holdfast.operators.prep import SEED, matrix, smote, stratified_split
from holdfast.operators.retention import INPUT_RULES, count_out_of_range, with_defaults
from holdfast.operators.segments import with_action, with_tier
from holdfast.session import materialise
from holdfast.sources import read_scored, write_scored
from holdfast.sources.schemas import CORE9


@dataclass(frozen=True)
class Study:
    """Order tables and a cutoff, with the tables derived from them. Everything is lazy."""

    tables: dict[str, DataFrame]
    months: int = 6
    fixed_cutoff: datetime | None = None

    def table(self, name: str) -> DataFrame:
        return self.tables[name]

    @cached_property
    def cutoff(self) -> Column:
        return label_ops.cutoff_column(self.table("orders"), self.months, self.fixed_cutoff)

    @cached_property
    def observed_orders(self) -> DataFrame:
        return label_ops.pre_cutoff(self.table("orders"), self.cutoff)

    def labels(self, definition: str = "none_after_cutoff") -> DataFrame:
        return label_ops.churn_labels(
            self.table("orders"), self.table("customers"), self.cutoff, definition, self.months
        )

    def features(self, fill: str = "literal", strict_asof: bool = False) -> DataFrame:
        return feature_ops.feature_table(self.tables, self.cutoff, fill, strict_asof)

    def scored(self) -> DataFrame:
        """Features with the fixed-weight score."""
        return linear_score(self.features())

    def tiered(self) -> DataFrame:
        return with_tier(self.scored())


@dataclass(frozen=True)
class TrainingSet:
    train: DataFrame
    test: DataFrame
    balanced: DataFrame


def training_set(
    features: DataFrame, columns: Sequence[str] = CORE9, test_size: float = 0.2, k: int = 5, seed: int = SEED
) -> TrainingSet:
    """Matrix, stratified split, and oversampling of the training part only."""
    table = materialise(matrix(features, columns), "matrix")
    split = materialise(stratified_split(table, test_size=test_size, seed=seed), "split")
    train = split.where(F.col("split") == "train").drop("split")
    test = split.where(F.col("split") == "test").drop("split")
    balanced = materialise(smote(train, columns, k=k, seed=seed), "balanced").drop("synthetic")
    return TrainingSet(train, test, balanced)


def serve(
    records: DataFrame, scorer: Callable[[DataFrame], DataFrame], rules: dict[str, tuple] = INPUT_RULES
) -> DataFrame:
    """Score input records of up to thirteen fields, one or many: defaults, checks, probability, tier and action.

    Missing fields and nulls take their defaults. ``fields_out_of_range`` counts values outside their accepted range; they are
    scored as given.
    """
    filled = with_defaults(records, rules).withColumn("fields_out_of_range", count_out_of_range(rules))
    return with_action(scorer(filled))


def scoring_job(
    spark: SparkSession,
    model: PipelineModel | BoostedModel,
    features: DataFrame,
    path: str,
    columns: Sequence[str] = CORE9,
    boundary: str = "right",
) -> DataFrame:
    """Score every person, assign tiers, write the scored table and read it back."""
    write_scored(with_tier(score_customers(model, features, columns), boundary), path)
    return read_scored(spark, path)
