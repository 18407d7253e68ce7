"""Table profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_profile(df: DataFrame, name: str) -> DataFrame:
    """One row per column: type, row count, column count and nulls, from one pass over the data."""
    types = dict(df.dtypes)
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    described = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(types[c]).alias("data_type"),
                F.col(c).alias("null_count"),
            )
            for c in df.columns
        ]
    )
    return counts.select(
        F.lit(name).alias("table_name"),
        F.col("_rows").alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.inline(described),
    )


def profile_tables(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [table_profile(df, name) for name, df in tables.items()])
