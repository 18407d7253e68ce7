"""Exact k nearest neighbours among distinct points.

Points are cut into tiles, a tile that is too large along its own widest dimension, until none is: distinct
points always differ somewhere, so ties on one column only move the cut to another. Neighbours inside a piece of a
point's own tile give an upper bound on its k-th distance; only tiles whose bounding box comes within that
bound are searched. Boxes are kept in levels, each grouped under the boxes of the next, until few are left: a point is
routed from those down by joins, so no task or driver holds the list of all tiles. Nothing is approximate: tile
borders are estimated, but they decide where work is done and not what is found.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.session import materialise

# The helpers below travel with the job, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The boxes that every task may hold, the boxes under one of the next level, and the parts of one cut.
TOP_BOXES = 1_024
FAN = 256
PARTS = 16
ROW_BLOCK = 64


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of two row blocks, added up dimension by dimension."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        out += (a[:, j, None] - b[None, :, j]) ** 2
    return out


def _small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of so many rows, broadcast if they are few."""
    return F.broadcast(df) if rows <= TOP_BOXES else df


def _tile(points: DataFrame, features: Sequence[str], tile_rows: int) -> tuple[DataFrame, DataFrame]:
    """``points`` with a ``tile`` of at most twice ``tile_rows`` points, and the tiles' counts and boxes.

    Only points that are alike in every feature stay together beyond that.
    """
    tiled = points.withColumn("tile", F.lit(0).cast("long"))
    while True:
        boxes = materialise(
            tiled.groupBy("tile").agg(
                F.count("*").alias("n"),
                *[F.min(f).alias(f"lo_{f}") for f in features],
                *[F.max(f).alias(f"hi_{f}") for f in features],
            ),
            "boxes",
        )
        spreads = [
            F.struct((F.col(f"hi_{f}") - F.col(f"lo_{f}")).alias("spread"), F.lit(i).alias("dim"), f"lo_{f}", f"hi_{f}")
            for i, f in enumerate(features)
        ]
        named = [s.cast("struct<spread:double,dim:int,lo:double,hi:double>") for s in spreads]
        large = boxes.where(F.col("n") > 2 * tile_rows).select(
            "tile", F.least(F.lit(PARTS), F.ceil(F.col("n") / tile_rows)).alias("parts"), F.array_max(F.array(*named)).alias("cut")
        )
        large = materialise(large.where("cut.spread > 0"), "large-tiles")
        rows = large.count()
        if not rows:
            return tiled, boxes
        value = F.get(F.array(*[F.col(f) for f in features]), F.col("cut.dim"))
        asked = tiled.join(_small(large, rows), "tile", "left").withColumn("_value", value)
        shares = [i / PARTS for i in range(1, PARTS)]
        borders = (
            asked.where("cut IS NOT NULL")
            .groupBy("tile")
            .agg(
                F.percentile_approx("_value", shares, 1_000).alias("borders"),
                F.first("parts").alias("_parts"),
                F.first("cut").alias("_cut"),
            )
        )
        # So many of the borders as there shall be parts; the largest value lies beyond all of them.
        borders = borders.select(
            "tile",
            "_cut",
            F.filter(
                F.filter("borders", lambda b, i: F.floor((i + 1) * F.col("_parts") / PARTS) > F.floor(i * F.col("_parts") / PARTS)),
                lambda b: b < F.col("_cut.hi"),
            ).alias("borders"),
        ).select("tile", F.when(F.size("borders") > 0, F.col("borders")).otherwise(F.array("_cut.lo")).alias("borders"))
        part = F.size(F.filter("borders", lambda b: b < F.col("_value")))
        tiled = materialise(
            asked.join(_small(borders, rows), "tile", "left")
            .withColumn("tile", F.when(F.col("cut").isNull(), F.col("tile")).otherwise(F.xxhash64("tile", part)))
            .drop("parts", "cut", "_value", "borders"),
            "tiles",
        )


def _levels(boxes: DataFrame, features: Sequence[str]) -> list[DataFrame]:
    """(box, parent, n, lo_*, hi_*) level by level, from the top, which is small, down to the tiles."""
    ends = [f"{side}_{f}" for f in features for side in ("lo", "hi")]
    levels, current = [], boxes.select(F.col("tile").alias("box"), "n", *ends)
    left = current.count()
    while left > TOP_BOXES:
        middles = current.select("box", *[((F.col(f"lo_{f}") + F.col(f"hi_{f}")) / 2).alias(f) for f in features])
        grouped, _ = _tile(middles, features, FAN)
        placed = materialise(current.join(grouped.select("box", F.col("tile").alias("parent")), "box"), "levels")
        levels.insert(0, placed)
        current = placed.groupBy(F.col("parent").alias("box")).agg(
            F.sum("n").alias("n"), *[(F.min if e.startswith("lo_") else F.max)(e).alias(e) for e in ends]
        )
        above = current.count()
        if above >= left:
            break
        left = above
    return [current, *levels]


def _within(part: pd.DataFrame, boxes: pd.DataFrame, names: Sequence[str], k: int) -> pd.DataFrame:
    """Points beside each of the boxes that come within their reach.

    A box of more than k points bounds the reach by its farthest corner, which helps points whose own tile has too few.
    """
    low, high = (boxes[[f"{side}_{f}" for f in names]].to_numpy(float) for side in ("lo", "hi"))
    numbers, enough, found = boxes["box"].to_numpy(), boxes["n"].to_numpy() > k, []
    for start in range(0, len(part), ROW_BLOCK):
        some = part.iloc[start : start + ROW_BLOCK]
        values = some[list(names)].to_numpy(float)
        gap, far = (np.zeros((len(values), len(numbers))) for _ in range(2))
        for j in range(len(names)):
            x = values[:, j, None]
            gap += np.maximum(np.maximum(low[None, :, j] - x, x - high[None, :, j]), 0.0) ** 2
            far += np.maximum(np.abs(x - low[None, :, j]), np.abs(x - high[None, :, j])) ** 2
        reach = np.minimum(some["reach"].to_numpy(), far[:, enough].min(axis=1, initial=np.inf))
        rows, hit = np.nonzero(gap <= reach[:, None])
        found.append(some.assign(reach=reach).iloc[rows].assign(box=numbers[hit]))
    return pd.concat(found) if found else part.iloc[:0].assign(box=np.zeros(0, dtype=np.int64))


def _route(bounded: DataFrame, boxes: DataFrame, key: str, names: Sequence[str], k: int, block_rows: int) -> DataFrame:
    """(key, features, reach, tile): every point with each tile within its reach."""
    top, *lower = _levels(boxes, names)
    # At most TOP_BOXES rows.
    few = top.toPandas()
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in bounded.schema] + ["box long"])
    carried = bounded.columns

    def from_top(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield _within(pdf, few, names, k)

    def downwards(asked: pd.DataFrame, below: pd.DataFrame) -> pd.DataFrame:
        return _within(asked[carried], below, names, k)

    routed = materialise(bounded.mapInPandas(from_top, fields), "routed")
    for level in lower:
        # Points that come to a box are dealt into parts, each with the boxes below it.
        parts = routed.groupBy("box").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("parts"))
        asked = routed.join(parts, "box").withColumn("part", F.pmod(F.xxhash64(key, "box"), F.col("parts")).cast("int"))
        below = level.withColumn("above", F.col("parent")).join(parts.withColumnRenamed("box", "above"), "above")
        below = below.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        found = (
            asked.select(F.col("box").alias("above"), "part", *carried)
            .groupBy("above", "part")
            .cogroup(below.drop("parts", "parent").groupBy("above", "part"))
            .applyInPandas(downwards, fields)
        )
        routed = materialise(found, "routed")
    return routed.withColumnRenamed("box", "tile")


def nearest_neighbours(
    points: DataFrame,
    key: str,
    features: Sequence[str],
    k: int,
    tile_rows: int = 2048,
    block_rows: int = 32_768,
) -> DataFrame:
    """The ``k`` nearest other points of every point: (key, position, neighbour, distance, vector).

    ``points`` has unique keys, distinct vectors and no nulls. Equal distances are
    ordered by the neighbour's key. A tile is searched in blocks of about
    ``block_rows`` asking and stored points, so a dense or popular tile becomes more
    tasks, not a larger one.
    """
    names = list(features)
    key_type = points.schema[key].dataType.simpleString()
    columns = ", ".join(f"`{f}` double" for f in names)
    typed = points.select(key, *[F.col(f).cast("double").alias(f) for f in names])
    tiled, boxes = _tile(typed, names, tile_rows)
    tiles = boxes.count()
    sizes = boxes.select("tile", F.ceil(F.col("n") / block_rows).cast("int").alias("chunks"))
    members = tiled.join(_small(sizes, tiles), "tile").withColumn(
        "chunk", F.pmod(F.xxhash64(key), F.col("chunks")).cast("int")
    )

    def bound(pdf: pd.DataFrame) -> pd.DataFrame:
        values = pdf[names].to_numpy(float)
        reach = np.full(len(values), np.inf)
        if len(values) > k:
            for start in range(0, len(values), ROW_BLOCK):
                block = squared_distances(values[start : start + ROW_BLOCK], values)
                # The point itself is among the k + 1 smallest.
                reach[start : start + ROW_BLOCK] = np.partition(block, k, axis=1)[:, k]
        return pdf[[key, *names]].assign(reach=reach)

    bounded = members.groupBy("tile", "chunk").applyInPandas(
        bound, f"`{key}` {key_type}, {columns}, reach double"
    )

    routed = _route(bounded, boxes, key, names, k, block_rows)
    visits = routed.groupBy("tile").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("parts"))
    queries = (
        routed.join(_small(sizes, tiles), "tile")
        .join(_small(visits, tiles), "tile")
        .withColumn("part", F.pmod(F.xxhash64(key, F.lit("part")), F.col("parts")).cast("int"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    )
    targets = members.join(_small(visits, tiles), "tile").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    )

    def search(asked: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        stored = stored.sort_values(key, kind="stable")
        vectors, stored_keys = stored[names].to_numpy(float), stored[key].to_numpy()
        found = []
        for start in range(0, len(asked), ROW_BLOCK) if len(stored) else ():
            part = asked.iloc[start : start + ROW_BLOCK]
            gaps = squared_distances(part[names].to_numpy(float), vectors)
            own = part[key].to_numpy()
            gaps[own[:, None] == stored_keys[None, :]] = np.inf
            limit = part["reach"].to_numpy()
            if gaps.shape[1] > k:
                limit = np.minimum(limit, np.partition(gaps, k - 1, axis=1)[:, k - 1])
            row, col = np.nonzero((gaps <= limit[:, None]) & np.isfinite(gaps))
            hits = pd.DataFrame(
                {key: own[row], "neighbour": stored_keys[col], "distance": gaps[row, col], "vector": list(vectors[col])}
            )
            hits = hits.sort_values([key, "distance", "neighbour"], kind="stable")
            found.append(hits[hits.groupby(key).cumcount() < k])
        if not found:
            return pd.DataFrame({key: [], "neighbour": [], "distance": [], "vector": []})
        return pd.concat(found)

    grouping = ["tile", "chunk", "part"]
    candidates = (
        queries.select(*grouping, key, *names, "reach")
        .groupBy(*grouping)
        .cogroup(targets.select(*grouping, key, *names).groupBy(*grouping))
        .applyInPandas(search, f"`{key}` {key_type}, neighbour {key_type}, distance double, vector array<double>")
    )
    nearest = Window.partitionBy(key).orderBy("distance", "neighbour")
    return (
        candidates.withColumn("position", F.row_number().over(nearest))
        .where(F.col("position") <= k)
        .select(key, "position", "neighbour", F.sqrt("distance").alias("distance"), "vector")
    )
