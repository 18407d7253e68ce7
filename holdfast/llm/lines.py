"""Lines that several documents share, kept only where they come first.

The hashes of lines seen so far lie in sorted runs in the shared folder. Documents
come in batches, in the order of their keys: a batch's own line hashes are reduced to one
row each, joined to all runs by a merge join, those not found become a new run of the
first level, and ``fan`` runs of one level are compacted into one of the next. So a
batch reads few runs however many batches came before, and a run is written once a level.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.common import fresh, two_hashes
from holdfast.session import materialise, shared_root

BLANKS = " \t\n\x0b\x0c\r"
MIN_CHARS = 10
BATCHES = 4
FAN = 3
HASHES = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without blanks at either end, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def lines_of(text: Column) -> Column:
    """The text cut at line feeds; a null text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class SortedRuns:
    """First owners of line hashes, as levelled sorted runs below one folder."""

    def __init__(self, spark: SparkSession, owner_type: str, fan: int = FAN):
        self._spark, self._fan = spark, fan
        self._schema = f"h1 bigint, h2 bigint, owner {owner_type}"
        self._root = f"{shared_root(spark)}/line-runs-{uuid.uuid4().hex}"
        self._levels: list[list[str]] = []
        self._written = 0

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self._spark.createDataFrame([], self._schema)
        return self._spark.read.schema(self._schema).parquet(*paths)

    def _path(self, name: str) -> str:
        self._written += 1
        return f"{self._root}/{name}-{self._written}"

    def _delete(self, paths: list[str]) -> None:
        jvm = self._spark.sparkContext._jvm
        for path in paths:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)

    def add(self, lines: DataFrame) -> DataFrame:
        """Take in a batch (h1, h2, owner), whose owners are above those of all batches before.

        Returns (h1, h2, owner) of the batch's hashes that have a row above their first owner.
        """
        own = lines.groupBy(*HASHES).agg(F.min("owner").alias("first"), F.max("owner").alias("last"))
        known = self._read([p for level in self._levels for p in level]).withColumnRenamed("owner", "before")
        joined = own.join(known.hint("merge"), HASHES, "left")
        path = self._path("batch")
        (
            joined.where("before IS NULL OR before < last")
            .select(
                *HASHES,
                F.coalesce("before", "first").alias("owner"),
                "last",
                F.col("before").isNull().alias("is_new"),
            )
            .sortWithinPartitions("is_new", *HASHES)
            .write.partitionBy("is_new")
            .parquet(path)
        )
        self._push(f"{path}/is_new=true", 0)
        batch = self._spark.read.schema(f"{self._schema}, last {self._schema.rsplit(' ', 1)[1]}").parquet(path)
        return batch.where("last > owner").select(*HASHES, "owner")

    def _push(self, path: str, level: int) -> None:
        if not self._exists(path):
            return
        while len(self._levels) <= level:
            self._levels.append([])
        runs = self._levels[level]
        runs.append(path)
        if len(runs) >= self._fan:
            merged = self._path(f"level{level + 1}")
            self._read(runs).repartitionByRange(*HASHES).sortWithinPartitions(*HASHES).write.parquet(merged)
            # The runs of a batch are also read for its own repeats, so only runs of higher levels are cleared here.
            self._delete(runs if level else [])
            self._levels[level] = []
            self._push(merged, level + 1)

    def _exists(self, path: str) -> bool:
        place = self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def repeated_lines(
    df: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, batches: int = BATCHES
) -> DataFrame:
    """(key, hashes): for each document the first hashes of its lines that an earlier document holds."""
    kind = dict(df.dtypes)[key]
    keys = F.filter(F.transform(lines_of(F.col(text)), line_key), lambda k: F.length(k) >= min_chars)
    lines = materialise(
        df.where(F.col(key).isNotNull())
        .select(F.col(key).alias("owner"), F.explode(keys).alias("line"))
        .select("owner", *[h.alias(n) for h, n in zip(two_hashes(F.col("line")), HASHES)]),
        "line-keys",
    )
    points = [i / batches for i in range(1, batches)]
    cuts = sorted(set(lines.approxQuantile("owner", points, 0.01))) if points else []
    runs = SortedRuns(df.sparkSession, kind)
    dropped = None
    for low, high in zip([None, *cuts], [*cuts, None]):
        batch = lines
        if low is not None:
            batch = batch.where(F.col("owner") > low)
        if high is not None:
            batch = batch.where(F.col("owner") <= high)
        repeats = runs.add(batch).withColumnRenamed("owner", "first")
        found = batch.join(repeats, HASHES).where("owner > first").select("owner", "h1")
        dropped = found if dropped is None else dropped.union(found)
    return dropped.groupBy("owner").agg(F.collect_set("h1").alias("hashes")).toDF(key, "hashes")


def drop_repeated_lines(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    batches: int = BATCHES,
    n_lines: str = "n_lines",
    n_dropped: str = "n_dropped",
) -> DataFrame:
    """All rows and columns, ``text`` without the lines that an earlier document holds, and two counts.

    A line is known by its key (``line_key``). A key of at least ``min_chars`` code points that
    several documents hold stays, with all its lines, in the one of smallest ``key`` only; other
    lines stay. Rows of one key are one document. Rows without a key neither lose lines nor count as
    documents. A null text is one empty line and stays null; repeated rows stay; an
    empty table stays empty; a very long text is split whole. Column names for the
    counts that ``df`` already has are an error.
    """
    if clash := {n_lines, n_dropped} & set(df.columns):
        raise ValueError(f"columns exist already: {sorted(clash)}")
    owner, hashes, kept = (fresh(df, c) for c in ("_owner", "_hashes", "_lines"))
    found = repeated_lines(df, key, text, min_chars, batches).toDF(owner, hashes)
    lines = lines_of(F.col(text))

    def stays(line: Column) -> Column:
        of_line = line_key(line)
        return (F.length(of_line) < min_chars) | ~F.array_contains(F.col(hashes), two_hashes(of_line)[0])

    joined = df.join(found, df[key] == found[owner], "left")
    after = joined.withColumn(kept, F.when(F.col(hashes).isNotNull(), F.filter(lines, stays)))
    return after.select(
        *[
            F.coalesce(F.array_join(kept, "\n"), F.col(text)).alias(text) if c == text else F.col(c)
            for c in df.columns
        ],
        F.size(lines).cast("long").alias(n_lines),
        F.coalesce(F.size(lines) - F.size(F.col(kept)), F.lit(0)).cast("long").alias(n_dropped),
    )
