"""Vectors linked by cosine, found through spherical-cap filters.

A vector is split into three blocks, each block has a code of random directions, and a filter
is one direction from each code: their scores add up, so all filters a vector exceeds the
limit of are decoded from three short lists without looking at the others. Vectors close in angle exceed many of
the same filters, others hardly any. Vectors are joined on filters and every pair that meets
is checked by its cosine. The code grows with the number of vectors, so that a filter holds about as many at any size.
There are three independent sets of filters: what one misses the others find.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.chunks import tidy
from holdfast.llm.common import components, two_hashes
from holdfast.session import materialise

COSINE = 0.9
SEED = 17
BLOCKS = 3
# Filters a vector exceeds on average, and at least (then its best ones).
FILTERS, LEAST = 40, 24
# Independent sets of filters. For any pair they are missed independently, so the chance of a miss is that of one to this power.
CODES = 3
# Vectors a filter holds on average; so many are compared at once in a filter that holds more.
PER_FILTER, TILE = 16, 1024


class CapFilters:
    """One set of filters for vectors of one dimension: ``size`` directions in each of three codes."""

    def __init__(self, dimension: int, size: int, number: int = 0):
        rng = np.random.default_rng([SEED, dimension, size, number])
        self.size = size
        self._turn = np.linalg.qr(rng.standard_normal((dimension, dimension)))[0]
        self._ends = np.linspace(0, dimension, BLOCKS + 1).astype(int)
        self._codes = []
        for a, b in zip(self._ends[:-1], self._ends[1:]):
            code = rng.standard_normal((size, b - a))
            self._codes.append(code / np.maximum(np.linalg.norm(code, axis=1, keepdims=True), 1e-12))
        chance = min(0.5, FILTERS / size**BLOCKS)
        self._limit = math.sqrt(BLOCKS) * NormalDist().inv_cdf(1 - chance) / math.sqrt(dimension)

    def decode(self, units: np.ndarray) -> list[np.ndarray]:
        """For each unit vector (row) the sorted numbers of its filters."""
        turned = units @ self._turn
        scores = [turned[:, a:b] @ c.T for a, b, c in zip(self._ends[:-1], self._ends[1:], self._codes)]
        return [self._one([s[i] for s in scores]) for i in range(len(units))]

    def _one(self, scores: list[np.ndarray]) -> np.ndarray:
        """Best first in each block: a prefix of a block's order can only be useful while the best of the others lift it."""
        orders = [np.argsort(-s, kind="stable") for s in scores]
        best = [s[o] for s, o in zip(scores, orders)]
        limit = self._limit
        while True:
            first = best[0][best[0] >= limit - best[1][0] - best[2][0]]
            pairs = first[:, None] + best[1][None, : np.searchsorted(-best[1], best[0][0] + best[2][0] - limit, "right")]
            i, j = np.nonzero(pairs >= limit - best[2][0])
            ends = np.searchsorted(-best[2], pairs[i, j] - limit, side="right")
            if ends.sum() >= min(LEAST, self.size**BLOCKS):
                break
            limit -= 0.1 * max(abs(limit), 0.01)
        k = np.arange(ends.sum()) - np.repeat(np.cumsum(ends) - ends, ends)
        i, j = np.repeat(i, ends), np.repeat(j, ends)
        return np.sort((orders[0][i] * self.size + orders[1][j]) * self.size + orders[2][k])


class ManyFilters:
    """CODES sets of filters, numbered one after the other."""

    def __init__(self, dimension: int, size: int):
        self._sets = [CapFilters(dimension, size, number) for number in range(CODES)]
        self._step = size**BLOCKS

    def decode(self, units: np.ndarray) -> list[np.ndarray]:
        """For each unit vector (row) the sorted numbers of its filters in all sets."""
        found = [own.decode(units) for own in self._sets]
        return [np.concatenate([own + at * self._step for at, own in enumerate(of_row)]) for of_row in zip(*found)]


@lru_cache(maxsize=4)
def _filters(dimension: int, size: int) -> ManyFilters:
    return ManyFilters(dimension, size)


def code_size(vectors: int) -> int:
    """Directions per block, so that a filter holds PER_FILTER vectors on average."""
    return max(6, math.ceil((vectors * FILTERS / PER_FILTER) ** (1 / BLOCKS)))


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite numbers, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _dealt(vectors: DataFrame, size: int) -> DataFrame:
    """(node, dim, filter) of all filters of (node, vector)."""
    schema = T.StructType([*vectors.select("node", "dim").schema.fields, T.StructField("filters", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                found = _filters(dim, size).decode(_units(_matrix(own.column(2), dim)))
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(1), pa.array(found, type=pa.list_(pa.int64()))], ["node", "dim", "filters"]
                )

    return vectors.select("node", "dim", "vector").mapInArrow(tidy(run), schema).select("node", "dim", F.explode("filters").alias("filter"))


def _smallest_common(lists: list[np.ndarray], filter_id: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether ``filter_id`` is the smallest filter that both of each pair have, given that both have it.

    Smaller filters are numbered and each vector's set of them becomes bits; a pair that shares a bit met before.
    """
    small = [own[: np.searchsorted(own, filter_id)] for own in lists]
    numbers, seen = np.unique(np.concatenate(small), return_counts=True) if small else (np.array([]), np.array([]))
    shared = numbers[seen > 1]
    met = np.zeros(len(i), dtype=bool)
    for first in range(0, len(shared), 63):
        part = shared[first : first + 63]
        bits = np.zeros(len(lists), dtype=np.int64)
        for row, own in enumerate(small):
            places = np.searchsorted(part, own)
            places = places[(places < len(part)) & (part[np.minimum(places, len(part) - 1)] == own)]
            bits[row] = (np.int64(1) << places).sum()
        met |= (bits[i] & bits[j]) != 0
    return ~met


def _compare(x: np.ndarray, filter_id: int, left: np.ndarray, right: np.ndarray, least: float, size: int):
    """Linked pairs (i, j, is new) between the rows ``left`` and ``right`` of x, or among ``left`` if both are the same."""
    units = _units(x)
    close = units[left] @ units[right].T >= least
    i, j = np.nonzero(close)
    i, j = left[i], right[j]
    once = i < j if left is right else np.ones(len(i), dtype=bool)
    i, j = i[once], j[once]
    if not len(i):
        return i, j, np.zeros(0, dtype=bool)
    involved, places = np.unique(np.concatenate([i, j]), return_inverse=True)
    lists = _filters(x.shape[1], size).decode(units[involved])
    return i, j, _smallest_common(lists, filter_id, places[: len(i)], places[len(i) :])


def _roots(n: int, i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each of n rows the smallest id reachable over the pairs."""
    roots = ids.copy()
    while True:
        low = np.minimum(roots[i], roots[j])
        after = roots.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        if (after == roots).all():
            return roots
        roots = after


def _linked(dealt: DataFrame, least: float, size: int) -> DataFrame:
    """(node, links, root) of (dim, filter, a, b, tile, node, copies, vector), rows of one (dim, filter, a, b) together."""
    schema = "node long, links long, root long"

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Rows of each group, which has at most two tiles; a group may go on in the next batch."""
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            keys = np.stack([table.column(c).to_numpy() for c in ("dim", "filter", "a", "b")])
            starts = [0, *(np.nonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))[0] + 1).tolist()]
            for start, end in zip(starts[:-1], starts[1:]):
                if end - start > 1:
                    yield table.slice(start, end - start)
            rest = table.slice(starts[-1]) if table.num_rows else None
        if rest is not None and rest.num_rows > 1:
            yield rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[np.ndarray] = []

        def taken() -> pa.RecordBatch:
            columns = np.concatenate(made, axis=1)
            made.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "links", "root"])

        for group in groups(batches):
            dim, filter_id, a, b = (group.column(c)[0].as_py() for c in ("dim", "filter", "a", "b"))
            ids, copies, tile = (group.column(c).to_numpy() for c in ("node", "copies", "tile"))
            x = _matrix(group.column("vector").combine_chunks(), dim)
            left = np.nonzero(tile == a)[0]
            right = left if a == b else np.nonzero(tile == b)[0]
            i, j, new = _compare(x, filter_id, left, right, least, size)
            if len(i):
                links = np.bincount(i[new], copies[j[new]], len(ids)) + np.bincount(j[new], copies[i[new]], len(ids))
                hit = np.unique(np.concatenate([i, j]))
                made.append(np.stack([ids[hit], links[hit].astype(np.int64), _roots(len(ids), i, j, ids)[hit]]))
                if sum(m.shape[1] for m in made) > 10_000:
                    yield taken()
        if made:
            yield taken()

    return dealt.mapInArrow(tidy(run), schema)


def near_vectors(df: DataFrame, vector: str = "embedding", key: str = "vec_id", cosine: float = COSINE) -> DataFrame:
    """(key, n_links, component_id, kept) for every row.

    Pairs at ``cosine`` or more, in double precision, are linked if they share a filter, others never. At 0.9 and dimension
    64 each of the three sets of filters missed 0 to 1 of 3,000 random pairs with the code for 2,000 vectors, 3 to 6 for 20,000,
    6 to 16 for 200,000, 20 to 30 for 5 million and 41 to 43 for 50 million; all three together missed none, and as they
    are independent some 3 in a million are to be expected at 50 million. Closer pairs are found more surely. Equal vectors count as one with copies: they are linked with
    one another without being compared. ``n_links`` counts other keys linked directly, ``component_id`` is the smallest key
    reachable, ``kept`` says whether that is the row's own. Vectors that are null, empty, zero or hold null
    or non-finite components link with nothing, nor do vectors of different lengths with each other. Repeated rows of a key count once
    and are all returned (with different vectors, that of lowest hash counts); a row without a key has no links and no component. Many different vectors within one cap are compared
    with each other, tile by tile over many tasks: their links can't be counted otherwise.
    An empty table gives an empty one; other columns are left out.
    """
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"))
    valid = rows.where(usable(F.col("vector")) & F.col("id").isNotNull())
    one, two = two_hashes(F.col("vector"))
    hashed = valid.withColumn("h", F.struct(one.alias("h1"), two.alias("h2")))
    by_id = hashed.groupBy("id").agg(F.min("h").alias("h"), F.min_by("vector", "h").alias("vector"))
    values = by_id.groupBy("h").agg(
        F.min("id").alias("node"), F.count("*").alias("copies"), F.first("vector").alias("vector")
    )
    values = materialise(values.withColumn("dim", F.size("vector").cast("long")), "vectors")
    size = code_size(values.count())
    dealt = materialise(_dealt(values, size), "filters")
    large = dealt.groupBy("dim", "filter").count().where(F.col("count") > TILE)
    tiles = F.coalesce(F.ceil(F.col("count") / TILE), F.lit(1)).cast("long")
    placed = (
        dealt.join(large, ["dim", "filter"], "left")
        .withColumn("tiles", tiles)
        .withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        .select("node", "dim", "filter", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "tile")
    )
    with_vectors = placed.join(values.select("node", "dim", "copies", "vector"), ["node", "dim"])
    grouped = with_vectors.select("dim", "filter", "a", "b", "tile", "node", "copies", "vector")
    grouped = grouped.repartition("dim", "filter", "a", "b").sortWithinPartitions("dim", "filter", "a", "b")
    found = materialise(_linked(grouped, cosine, size), "vector-links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    of_value = (
        values.select("h", "node", "copies")
        .join(counts, "node", "left")
        .join(classes, "node", "left")
        .select(
            "h",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    of_id = hashed.groupBy("id").agg(F.min("h").alias("h")).join(of_value, "h").drop("h")
    component = F.coalesce("component_id", "id")
    return (
        rows.select("id")
        .join(of_id, "id", "left")
        .select(
            F.col("id").alias(key),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            (F.col("id") == component).alias("kept"),
        )
    )
