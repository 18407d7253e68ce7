"""Exact top-k by inner product through a pivot-distance index.

Vectors get one more component, so that all are equally long; the nearest in Euclidean
distance then have the largest inner products. Each vector is kept under its nearest pivot, sorted by
its distance to it. By the triangle inequality a vector nearer to the query than r lies, under each pivot, in an
annulus: its distance to the pivot differs from the query's by r at most. A query first searches the
rings around its own place, which gives a bound on its k-th best score, then every ring of
every pivot that the bound's annulus meets, and in a ring only the rows inside it. All
other rings are proven not to matter.

Pivots are fitted on a bounded sample and only decide how much is skipped; all vectors are indexed.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.chunks import tidy
from holdfast.llm.common import two_hashes
from holdfast.session import materialise

PIVOTS, SAMPLE, ROUNDS = 64, 4_096, 4
# Rings per pivot at most, rows a ring should have, and rows a task gets of a ring that has more.
RINGS, RING_ROWS, BLOCK_ROWS = 64, 512, 4_096
QUERY_ROWS = 4_096
# Relative errors allowed for in squared distances and, where these are nearly 0, distances in double precision.
SLACK, NEAR_SLACK = 1e-9, 1e-7
# Below these squared lengths inner products are exact in double precision, and in 64-bit whole numbers.
DOUBLE_EXACT, LONG_EXACT = 2.0**52, 2.0**62
MOST_DIGITS = 10**38 - 1


def finite(vector: Column) -> Column:
    """Not null, and all components finite numbers."""
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def quantised(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def _whole(column: pa.Array, dimension: int, kind: type = np.float64) -> np.ndarray:
    """Vectors from lists of integers, shorter ones filled with zeros; ``kind``: double, int64 or object (Python integers)."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    if kind is object:
        values = np.array(values.tolist(), dtype=object)
    if (sizes == dimension).all():
        return values.reshape(-1, dimension).astype(kind)
    out = np.zeros((len(sizes), dimension), dtype=kind)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """The vectors with the component that makes the square of their length ``longest``."""
    return np.hstack([x, np.sqrt(np.maximum(longest - (x**2).sum(axis=1), 0))[:, None]])


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (x**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def fit_pivots(sample: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Centres of the sample by a few rounds of k-means from spread starting points."""
    rng = np.random.default_rng(5)
    chosen = sample[rng.choice(len(sample), min(pivots, len(sample)), replace=False)]
    for _ in range(ROUNDS):
        nearest = _distances(sample, chosen).argmin(axis=1)
        chosen = np.array([sample[nearest == i].mean(axis=0) if (nearest == i).any() else c for i, c in enumerate(chosen)])
    return chosen


class Search:
    """An index over (id, vector) and the searches in it; vectors are arrays of integers."""

    def __init__(self, vectors: DataFrame, k: int):
        self.k = k
        self._vectors = vectors
        ends = vectors.agg(
            F.max(F.size("vector")).alias("dim"),
            F.max(F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x)).alias("longest"),
        ).first()
        self.empty = ends.dim is None
        self._dim, self._longest = ends.dim or 0, ends.longest or 0.0
        # No score exceeds the largest squared length, which says in what numbers it is exact.
        self._kind = np.float64 if self._longest < DOUBLE_EXACT else np.int64 if self._longest < LONG_EXACT else object
        sample = [] if self.empty else vectors.orderBy(F.xxhash64("id"), "id").select("vector").limit(SAMPLE).collect()
        if not self.empty:
            self._pivots = fit_pivots(_lifted(_whole(pa.array([r.vector for r in sample], pa.list_(pa.int64())), self._dim), self._longest))
            self._build()

    def _build(self) -> None:
        """Write (pivot, ring, block, id, vector, distance); a ring's rows are spread over blocks of bounded size."""
        placed = materialise(self._placed(self._vectors), "placed")
        points = [i / RINGS for i in range(1, RINGS)]
        counts = placed.groupBy("pivot").agg(F.count("*").alias("n"), F.percentile_approx("distance", points, 1000).alias("cuts"))
        # At most PIVOTS rows of RINGS numbers.
        cuts = {}
        for row in counts.collect():
            rings = max(1, min(RINGS, row.n // RING_ROWS))
            cuts[row.pivot] = [row.cuts[round(i * RINGS / rings) - 1] for i in range(1, rings)]
        every = F.array(*[F.array(*map(F.lit, cuts.get(p, []))).cast("array<double>") for p in range(len(self._pivots))])
        inside = F.get(every, F.col("pivot").cast("int"))
        ringed = placed.withColumn("ring", F.size(F.filter(inside, lambda cut: F.col("distance") >= cut)).cast("long"))
        stats = ringed.groupBy("pivot", "ring").agg(
            F.count("*").alias("n"), F.min("distance").alias("low"), F.max("distance").alias("high")
        )
        # At most PIVOTS * RINGS rows.
        self._rings = stats.orderBy("pivot", "ring").toPandas()
        self._rings["blocks"] = -(-self._rings["n"] // BLOCK_ROWS)
        spread = self._vectors.sparkSession.createDataFrame(self._rings[["pivot", "ring", "blocks"]])
        self._index = ringed.join(F.broadcast(spread), ["pivot", "ring"]).withColumn(
            "block", F.pmod(F.xxhash64("id"), F.col("blocks"))
        )

    def _placed(self, vectors: DataFrame) -> DataFrame:
        pivots, dim, longest = self._pivots, self._dim, self._longest

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                far = _distances(_lifted(_whole(batch.column(1), dim), longest), pivots)
                nearest = far.argmin(axis=1)
                own = far[np.arange(len(far)), nearest]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(nearest.astype(np.int64)), pa.array(own)],
                    ["id", "vector", "pivot", "distance"],
                )

        schema = "id long, vector array<bigint>, pivot long, distance double"
        return vectors.select("id", "vector").mapInArrow(tidy(run), schema)

    def _plan(self, queries: DataFrame, near: bool) -> DataFrame:
        """(pivot, ring, id, vector, bound, chunk): the rings each query searches. ``near``: those around its own
        place, until k others must be among their rows; else all the others that its bound doesn't exclude.
        """
        pivots, dim, longest, rings, k = self._pivots, self._dim, self._longest, self._rings, self.k
        ring_pivot, low, high, n = (rings[c].to_numpy() for c in ("pivot", "low", "high", "n"))
        ring = rings["ring"].to_numpy()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _whole(batch.column(1), dim)
                bounds = batch.column(2).to_numpy(zero_copy_only=False)
                # A query's own added component is 0: distances then order inner products with it.
                to_pivot = _distances(np.hstack([x, np.zeros((len(x), 1))]), pivots)[:, ring_pivot]
                squares = (x**2).sum(axis=1)[:, None]
                gap = np.maximum(np.maximum(low - to_pivot, to_pivot - high) - NEAR_SLACK * np.sqrt(squares + longest), 0)
                # Rings that hold the query's own place first, those of the nearest pivot before others.
                order = np.argsort(gap + 1e-9 * to_pivot, axis=1, kind="stable")
                counted = np.cumsum(n[order], axis=1)
                first = np.zeros_like(gap, dtype=bool)
                np.put_along_axis(first, order, counted - n[order] < k + 1, axis=1)
                if near:
                    chosen = first
                else:
                    most = (squares + longest - gap**2) / 2
                    chosen = ~first & (most + SLACK * (squares + longest) + 1 >= bounds[:, None])
                i, j = np.nonzero(chosen)
                taken = batch.take(pa.array(i))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(ring_pivot[j]), pa.array(ring[j])],
                    ["id", "vector", "bound", "chunk", "pivot", "ring"],
                )

        schema = "id long, vector array<bigint>, bound double, chunk long, pivot long, ring long"
        return queries.select("id", "vector", "bound", "chunk").mapInArrow(tidy(run), schema)

    def _scored(self, plan: DataFrame) -> DataFrame:
        """(query_id, vec_id, score): of each block a query searches, its best k rows."""
        dim, longest, k, pivots, kind = self._dim, self._longest, self.k, self._pivots, self._kind
        number = pa.decimal128(38, 0) if kind is object else pa.int64()

        def numbers(scores: np.ndarray) -> pa.Array:
            if kind is not object:
                return pa.array(scores.astype(np.int64))
            return pa.array([Decimal(max(-MOST_DIGITS, min(MOST_DIGITS, int(v)))) for v in scores], number)

        def score(asked: pa.Table, rows: pa.Table) -> pa.Table:
            found: list[pa.Table] = []
            names = ["query_id", "vec_id", "score"]
            if len(asked) and len(rows):
                rows = rows.take(pc.sort_indices(rows, [("distance", "ascending"), ("id", "ascending")]))
                asked, rows = asked.combine_chunks(), rows.combine_chunks()
                ids, distance = rows["id"].to_numpy(), rows["distance"].to_numpy()
                vectors, queries = rows["vector"].combine_chunks(), asked["vector"].combine_chunks()
                q = _whole(queries, dim)
                pivot = pivots[rows["pivot"][0].as_py()]
                squares = (q**2).sum(axis=1)
                to_pivot = _distances(np.hstack([q, np.zeros((len(q), 1))]), pivot[None, :])[:, 0]
                bound = asked["bound"].to_numpy()
                reach = np.sqrt(np.maximum(squares + longest - 2 * bound, 0) + SLACK * (squares + longest) + 1)
                reach = np.where(np.isfinite(bound), reach + NEAR_SLACK * np.sqrt(squares + longest), np.inf)
                starts = np.searchsorted(distance, to_pivot - reach, side="left")
                ends = np.searchsorted(distance, to_pivot + reach, side="right")
                x, q = _whole(vectors, dim, kind), _whole(queries, dim, kind)
                for i, query in enumerate(asked["id"].to_numpy()):
                    a, b = starts[i], ends[i]
                    scores = x[a:b] @ q[i]
                    other = ids[a:b] != query
                    scores, near = scores[other], ids[a:b][other]
                    if len(scores) > k:
                        kept = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                        scores, near = scores[kept], near[kept]
                    # By score descending, then id; two stable sorts, as Python integers can't be negated into a key array of longs.
                    best = np.argsort(near, kind="stable")
                    best = best[np.argsort(-scores[best], kind="stable")][:k]
                    found.append(pa.table([pa.array(np.full(len(best), query)), pa.array(near[best]), numbers(scores[best])], names))
            empty = pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], number)], names)
            return pa.concat_tables([empty, *found])

        keys = ["pivot", "ring", "block"]
        spread = self._vectors.sparkSession.createDataFrame(self._rings[["pivot", "ring", "blocks"]])
        asked = plan.join(F.broadcast(spread), ["pivot", "ring"]).withColumn(
            "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
        )
        # An index row is copied for the chunks of queries that ask for its block, and for no others.
        wanted = asked.select(*[F.col(c).alias(f"asked_{c}") for c in (*keys, "chunk")]).distinct()
        index = self._index.select(*keys, "id", "vector", "distance")
        rows = index.join(wanted, [F.col(c) == F.col(f"asked_{c}") for c in keys]).withColumn("chunk", F.col("asked_chunk") + F.lit(0).cast("long"))
        asked = asked.select(*keys, "chunk", "id", "vector", "bound")
        kind_name = "decimal(38,0)" if kind is object else "long"
        return (
            asked.groupBy(*keys, "chunk")
            .cogroup(rows.select(*keys, "chunk", "id", "vector", "distance").groupBy(*keys, "chunk"))
            .applyInArrow(score, f"query_id long, vec_id long, score {kind_name}")
        )

    def best(self, found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= self.k)

    def run(self, queries: DataFrame) -> DataFrame:
        """(query_id, rank, vec_id, score) for (id, vector) of the queries."""
        if self.empty:
            return queries.selectExpr("id AS query_id", "1 AS rank", "id AS vec_id", "id AS score").limit(0)
        chunks = max(1, -(-queries.count() // QUERY_ROWS))
        asked = queries.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks).cast("long")))
        unbound = asked.withColumn("bound", F.lit(float("-inf")))
        near = materialise(self.best(self._scored(self._plan(unbound, True))), "near")
        bounds = near.where(F.col("rank") == self.k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("bound"))
        bounded = asked.join(bounds, "id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
        rest = self._scored(self._plan(bounded, False))
        found = self.best(near.select("query_id", "vec_id", "score").union(rest))
        if self._kind is object:
            ends = [F.lit(v).cast("decimal(38,0)") for v in ("-9223372036854775808", "9223372036854775807")]
            found = found.withColumn("score", F.greatest(ends[0], F.least(ends[1], "score")).cast("long"))
        return found.select("query_id", "rank", "vec_id", "score")


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    vector: str = "embedding",
    key: str = "vec_id",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``is_query``, the k others with the largest scores.

    Components become floor(scale * x), scores are integer inner products, compared
    exactly (up to 38 digits); one beyond the range of a long is shown as the end of that range. Components beyond it count as its end. Ties go to the smaller key; fewer than k others are all given, none gives no row. Rows whose key or vector is
    null, or whose vector holds null or non-finite components, take no part; of vectors of different lengths the shorter ends in
    zeros. Rows with the query's own key aren't its candidates; repeated rows of a key count once, of different vectors under one
    key the one of lowest hash. An empty table gives an empty result; texts and other columns play no part.
    """
    rows = df.where(F.col(key).isNotNull() & finite(F.col(vector))).select(
        F.col(key).cast("long").alias("id"), quantised(F.col(vector), scale).alias("vector"), is_query.alias("asks")
    )
    one = F.struct(*two_hashes(F.col("vector")))
    rows = rows.groupBy("id").agg(F.min_by("vector", one).alias("vector"), F.max("asks").alias("asks"))
    rows = materialise(rows, "quantised")
    return Search(rows.select("id", "vector"), k).run(rows.where("asks").select("id", "vector"))
