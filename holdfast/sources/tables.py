"""Loading the order tables, and reading and writing scored customers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.sources import multiline
from holdfast.sources.schemas import MULTILINE_TABLES, TABLES


def read_table(
    spark: SparkSession,
    name: str,
    path: str,
    file_format: str = "csv",
    lenient: bool = False,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """One table with its declared types, matched by column name.

    CSV is read as text and cast, so no type inference pass is run over the data.
    Malformed values raise, or become null when ``lenient``. ``columns`` narrows
    the table to the declared columns an input really has. The files of one folder must
    have one header: each file's is checked when it is read, and another order of columns raises.
    """
    declared = TABLES[name]
    if file_format == "csv" and name in MULTILINE_TABLES:
        raw = multiline.read_csv(spark, path)
    elif file_format == "csv":
        raw = spark.read.option("header", True).option("enforceSchema", False).option("escape", '"').csv(path)
    else:
        raw = spark.read.format(file_format).load(path)
    if not declared:
        return raw
    wanted = list(columns) if columns is not None else list(declared)
    missing = [c for c in wanted if c not in raw.columns]
    if missing:
        raise ValueError(f"table {name} at {path} lacks columns: {', '.join(missing)}")

    def typed(column: str):
        value = F.col(column)
        return (value.try_cast(declared[column]) if lenient else value.cast(declared[column])).alias(column)

    return raw.select(*[typed(c) for c in wanted])


def load(
    spark: SparkSession,
    directory: str,
    file_format: str = "csv",
    pattern: str | None = None,
    names: Iterable[str] = tuple(TABLES),
    lenient: bool = False,
) -> dict[str, DataFrame]:
    """All tables of a directory; ``pattern`` maps a table name to a file name or glob."""
    pattern = pattern or ("{table}.csv" if file_format == "csv" else "{table}.parquet")
    return {
        name: read_table(spark, name, f"{directory}/{pattern.format(table=name)}", file_format, lenient)
        for name in names
    }


def parse_timestamps(df: DataFrame, columns: Iterable[str], lenient: bool = False) -> DataFrame:
    """Turn text columns into timestamps without zone; malformed text raises unless lenient."""

    def parsed(column: str):
        value = F.col(column)
        return value.try_cast("timestamp_ntz") if lenient else value.cast("timestamp_ntz")

    return df.withColumns({c: parsed(c) for c in columns})


def write_scored(scored: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Persist scored customers, laid out by tier so that tier reports read one folder.

    Rows are brought together by tier first, large tiers in several parts, so that not every task writes to every folder.
    """
    scored.hint("rebalance", "risk_tier").write.mode(mode).partitionBy("risk_tier").parquet(path)


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
