"""CSV whose values hold line breaks, read by many tasks.

A line break ends a record only outside quotes, and whether a line begins inside quotes depends on all quotes before
it. Each split of a file so counts its own quotes; sums over the splits before it, one row each, say how it
begins, and running sums inside the split say the rest. Records on one line are taken as they are; only lines of records
that go over several are brought together. Quotes inside values are doubled, so they come in pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, number, record): the records of the files at ``path``, numbered from 1 in each file, without their line ends."""
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            # Only the order inside a split counts.
            F.monotonically_increasing_id().alias("place"),
            "value",
            (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
        )
    )
    # One row per split.
    splits = lines.groupBy("file", "split").agg(F.sum("quotes").alias("quotes"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    begins = splits.select("file", "split", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("before"))
    here = Window.partitionBy("file", "split").orderBy("place")
    marked = lines.join(begins, ["file", "split"]).withColumn(
        "before", F.col("before") + F.coalesce(F.sum("quotes").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    marked = marked.withColumn("first", F.col("before") % 2 == 0)
    # A line that begins inside quotes has the number of the record that was begun before, maybe some splits ago.
    counts = marked.groupBy("file", "split").agg(F.count_if("first").alias("firsts"))
    offsets = counts.select("file", "split", F.coalesce(F.sum("firsts").over(earlier), F.lit(0)).alias("offset"))
    number = F.col("offset") + F.count_if("first").over(here.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = marked.join(offsets, ["file", "split"]).withColumn("number", number)
    alone = F.col("first") & (F.col("quotes") % 2 == 0)
    whole = numbered.where(alone).select("file", "number", "value")
    parts = (
        numbered.where(~alone)
        .groupBy("file", "number")
        .agg(F.sort_array(F.collect_list(F.struct("split", "place", "value"))).alias("lines"))
        .select("file", "number", F.array_join("lines.value", "\n").alias("value"))
    )
    return whole.union(parts).select("file", "number", F.regexp_replace("value", "\r$", "").alias("record"))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """The files at ``path`` as text columns by the names of their header, which must be the same in all; blank lines are left out."""
    names = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path).columns
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    values = F.from_csv("record", F.lit(schema), {"escape": '"'})
    found = records(spark, path).where(F.col("record") != "").select("file", "number", values.alias("v"))
    return found.where(_is_row(names)).select(*[F.col(f"v.c{i}").alias(n) for i, n in enumerate(names)])


def _is_row(names: list[str]) -> Column:
    """Not a header; one with other names raises."""
    header = F.array(*[F.lower(f"v.c{i}") for i in range(len(names))]) == F.array(*[F.lit(n.lower()) for n in names])
    other = F.raise_error(F.concat(F.lit("the header differs from those of the other files: "), F.col("file")))
    return F.when(F.col("number") > 1, True).when(header, False).otherwise(other.cast("boolean"))
