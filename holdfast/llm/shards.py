"""Shards cut from a Hilbert curve over metadata. Built-in functions only.

Each dimension is cut at its quantiles into 2^b steps, and the steps together give a
place on a Hilbert curve. Rows sorted by it keep neighbours in every dimension together, so a run of them
covers a narrow range of each, and a reader that knows the ranges skips most files. The sorted rows are
cut into runs of equal row counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import fresh, two_hashes
from holdfast.operators.ordering import row_numbers, running_totals, tile_of

BITS = 5
SHARDS = 24
# Relative error of the quantiles; the steps only need to be about equally filled.
ACCURACY = 10_000


def _string_cuts(df: DataFrame, column: str, shares: list[float]) -> list[str]:
    """The strings at these shares of the rows in order. Rows are counted by string first, so a hot string is one row a task."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    placed = running_totals(counts, [F.col(column)], {"_upto": "_n"}, with_totals=True)
    ends = [F.min(F.when(F.col("_upto") >= F.lit(p) * F.col("_upto_total"), F.col(column))) for p in shares]
    return [cut for cut in placed.agg(*[end.alias(f"c{i}") for i, end in enumerate(ends)]).first() if cut is not None]


def with_steps(df: DataFrame, columns: list[str], bits: int, name: str) -> DataFrame:
    """Add ``name``: for each column a step from 0 to 2^bits - 1, cut at quantiles over all rows; null is step 0.

    Numbers are cut at approximate quantiles, strings at exact ones in the order of their UTF-8 bytes, whatever their common beginnings.
    """
    shares = [i / 2**bits for i in range(1, 2**bits)]
    kinds = dict(df.dtypes)
    numbers = [c for c in columns if kinds[c] != "string"]
    cuts = {c: _string_cuts(df, c, shares) for c in columns if kinds[c] == "string"}
    if numbers:
        found = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, ACCURACY).alias(c) for c in numbers]).first()
        cuts |= {c: found[c] or [] for c in numbers}

    def step(column: str) -> Column:
        # Equal quantiles are one cut: a frequent value has a step of its own.
        kind = "string" if kinds[column] == "string" else "double"
        own = F.array(*[F.lit(cut).cast(kind) for cut in sorted(set(cuts[column]), key=_in_order)]).cast(f"array<{kind}>")
        return F.when(F.col(column).isNull(), F.lit(0)).otherwise(F.size(F.filter(own, lambda cut: F.col(column).cast(kind) >= cut))).cast("long")

    return df.withColumn(name, F.array(*map(step, columns)))


def _in_order(cut):
    return cut.encode() if isinstance(cut, str) else cut


def hilbert_index(df: DataFrame, axes: str, bits: int, name: str) -> DataFrame:
    """Add the place on the Hilbert curve of the point whose coordinates the array ``axes`` has (Skilling's transform)."""
    turned, gray, turn = fresh(df, "_turned"), fresh(df, "_gray"), fresh(df, "_turn")
    powers = F.array(*[F.lit(1 << level).cast("long") for level in range(bits - 1, -1, -1)])
    higher = F.filter(powers, lambda q: q > 1)
    places = F.sequence(F.lit(0), F.size(axes) - 1)

    def visit(q: Column):
        def step(x: Column, i: Column) -> Column:
            first, own = F.get(x, F.lit(0)), F.get(x, i)
            is_set = own.bitwiseAND(q) != 0
            flip = first.bitwiseXOR(own).bitwiseAND(q - 1)
            return F.transform(
                x,
                lambda v, j: F.when(j == 0, v.bitwiseXOR(F.when(is_set, q - 1).otherwise(flip)))
                .when((j == i) & ~is_set, v.bitwiseXOR(flip))
                .otherwise(v),
            )

        return step

    zero = F.lit(0).cast("long")
    undone = F.aggregate(higher, F.col(axes), lambda x, q: F.aggregate(places, x, visit(q)))
    coded = F.transform(
        F.col(turned),
        lambda v, j: F.aggregate(F.slice(F.col(turned), F.lit(1), j + 1), zero, lambda acc, u: acc.bitwiseXOR(u)),
    )
    last = F.element_at(gray, -1)
    turn_of = F.aggregate(
        higher, zero, lambda t, q: F.when(last.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t)
    )
    index = F.aggregate(
        powers,
        zero,
        lambda acc, q: F.aggregate(
            F.col(gray),
            acc,
            lambda a, v: a * 2 + F.when(v.bitwiseXOR(F.col(turn)).bitwiseAND(q) != 0, 1).otherwise(0),
        ),
    )
    staged = df.withColumn(turned, undone).withColumn(gray, coded).withColumn(turn, turn_of)
    return staged.withColumn(name, index).drop(turned, gray, turn)


def assign(
    df: DataFrame,
    dimensions: list[str],
    shards: int = SHARDS,
    bits: int = BITS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, size, text_crc32, curve, rows_before, shard, slot): every row in one of ``shards`` runs.

    Row counts of shards differ by one at most; ``slot`` counts from 0 in each. Rows at one place of
    the curve are ordered by text and key, so equal texts there stay together and a
    place that holds a third of all rows is cut like any other. ``size`` is the text's UTF-8 bytes plus 8 (null: 8),
    its checksum that of the empty text. Null dimensions count as the
    lowest step, repeated rows take a slot each, fewer rows than shards leave the last shards empty,
    an empty table gives no rows, and a very long text counts with all its bytes.
    Only the columns named here are carried.
    """
    names = [f"d{i}" for i in range(len(dimensions))]
    chosen = df.select(
        F.col(key).alias("key"),
        F.col(text).cast("string").alias("text"),
        *[F.col(c).alias(name) for c, name in zip(dimensions, names)],
    )
    body = F.coalesce("text", F.lit(""))
    placed = hilbert_index(with_steps(chosen, names, bits, "steps"), "steps", bits, "curve").select(
        "key",
        (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        "curve",
        two_hashes(body)[0].alias("text_hash"),
    )
    order = [F.col(c) for c in ("curve", "text_hash", "key")]
    ranked = row_numbers(placed, order, "rank", with_totals=True)
    rank, total = F.col("rank"), F.col("rank_total")
    small = F.floor(total / shards)
    large = (total - small * shards) * (small + 1)  # rows in the shards that hold one more
    slot = F.when(rank <= large, F.pmod(rank - 1, small + 1)).otherwise(
        F.try_mod(rank - 1 - large, small)
    )
    return ranked.select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        "curve",
        (tile_of(rank, total, shards) - 1).cast("int").alias("shard"),
        slot.cast("long").alias("slot"),
    )


def write_shards(df: DataFrame, assigned: DataFrame, path: str, key: str = "doc_id") -> None:
    """Write the rows of ``df``, whose keys must be unique, as one folder per shard, in slot order."""
    shard, slot = fresh(df, "shard"), fresh(df, "slot")
    placed = assigned.select(F.col(key).alias("_key"), F.col("shard").alias(shard), F.col("slot").alias(slot))
    joined = df.join(placed, df[key].eqNullSafe(placed["_key"])).drop("_key")
    joined.repartitionByRange(shard, slot).sortWithinPartitions(shard, slot).drop(slot).write.partitionBy(shard).parquet(path)
