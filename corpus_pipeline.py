"""From raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a table that is written and read again as the
next one's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm import lines, minhash, packing, quality, secrets
from holdfast.llm.catalog import documents
from holdfast.session import materialise


def _counted(docs: DataFrame) -> DataFrame:
    """The same columns, ``n_chars`` brought up to date where there is one."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document holds; a text may end up empty."""
    n_lines, n_dropped = (f"_{x}_{len(docs.columns)}" for x in ("lines", "dropped"))
    cut = lines.drop_repeated_lines(docs, n_lines=n_lines, n_dropped=n_dropped)
    return _counted(cut.select(*docs.columns))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near duplicates."""
    return minhash.first_of_each(docs)


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret replaced by a mark."""
    return _counted(secrets.redact(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens, with their ids."""
    return packing.pack_texts(docs)


STAGES = [
    ("quality classifier", good_texts),
    ("line dedup", own_lines),
    ("MinHash near-dedup", one_of_each),
    ("secret scans", no_secrets),
    ("packing", packed),
]

# The classifier, the signatures and the packing can't be put in SQL: tests/llm holds each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result written to the shared folder before the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
