"""Helpers the operators share: fresh column names, folds, links to components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.session import materialise

# More rounds than any graph needs: each one at least halves the longest chain of links.
MAX_ROUNDS = 60


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``."""
    return F.crc32(key.cast("string").cast("binary")) % folds


def two_hashes(*columns: Column) -> list[Column]:
    """Two 64-bit hashes with different seeds: 128 bits together, so that chance collisions don't count."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)]


def keep_rows(df: DataFrame, ids: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose key is (``left_semi``) or isn't (``left_anti``) in the one-column table ``ids``."""
    name = fresh(df, "_kept_key")
    renamed = ids.toDF(name)
    return df.join(renamed, df[key] == renamed[name], how)


# Words of 64 bits in a sieve: at most so many rows of two numbers, 4 MB, are broadcast whatever the data.
SIEVE_WORDS = 1 << 18


def _sifted(df: DataFrame, key: str, ids: DataFrame, maybe: bool) -> DataFrame:
    word, bit, mask, bits = (fresh(df, c) for c in ("_word", "_bit", "_mask", "_bits"))

    def marked(table: DataFrame, column: str) -> DataFrame:
        hashed = F.xxhash64(column)
        placed = table.withColumns(
            {word: F.pmod(hashed, F.lit(SIEVE_WORDS)), bit: F.pmod(F.shiftright(hashed, 20), F.lit(64)).cast("int")}
        )
        return placed.withColumn(mask, F.expr(f"shiftleft(1L, `{bit}`)")).drop(bit)

    there = marked(ids, ids.columns[0]).groupBy(word).agg(F.bit_or(mask).alias(bits))
    joined = marked(df, key).join(F.broadcast(there), word, "inner" if maybe else "left")
    hit = F.col(bits).bitwiseAND(F.col(mask)) != 0
    return joined.where(hit if maybe else ~F.coalesce(hit, F.lit(False))).select(*df.columns)


def sieve(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key may be in the one-column table ``ids``, without moving ``df``.

    Keys are hashed to one of 16 million bits. All rows whose key is there pass, others
    only by chance, so a join after it shuffles little as long as ``ids`` are few, and loses nothing if they aren't.
    """
    return _sifted(df, key, ids, True)


def without(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key isn't in the one-column table ``ids``; only those that pass the sieve are joined.

    An outer join, because the optimizer would move an anti join below the sieve and shuffle every row.
    """
    name = fresh(df, "_other_key")
    others, maybe = ids.toDF(name).distinct(), sieve(df, key, ids)
    rest = maybe.join(others, maybe[key] == others[name], "left").where(F.col(name).isNull()).select(*df.columns)
    return _sifted(df, key, ids, False).union(rest)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for undirected ``links`` (a, b): the smallest node each node can reach.

    Alternates large-star and small-star steps: every node passes its smallest
    neighbour on to its larger, then to its smaller neighbours, until only stars
    are left. A node with very many links costs a partial minimum and a join that
    adaptive execution can split, never a list of its neighbours. Each round is
    written to the shared folder. Links that are null or lead to their own node
    say nothing; nodes without links don't appear.
    """
    a, b = F.col("a"), F.col("b")
    edges = materialise(
        links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "links"
    )
    state = None
    for _ in range(MAX_ROUNDS):
        both = edges.union(edges.select("b", "a"))
        small = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(small, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lowest, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(moved.union(lowest.select("a", F.col("m").alias("b"))).distinct(), "stars")
        now = edges.agg(
            F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == state or not now[0]:
            break
        state = now
    else:
        raise RuntimeError("the links did not settle into stars")
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select(F.col("b").alias("node"), F.col("b").alias("component"))
    )
