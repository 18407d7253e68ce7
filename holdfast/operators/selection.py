"""Exact order statistics of a whole column without sorting or moving it.

A mergeable quantile sketch gives, for each rank wanted, two values that should enclose it. One counting pass says
how many rows lie below, on and between them, and so whether they do: that the result is exact rests on the
counts alone, the sketch only decides how fast the gap closes. While too many rows remain inside, the gap is sketched
again. What is left, a bounded number of values, is counted by value and read off.

Every pass is an aggregation to one row, so what is shuffled is a sketch and some counts per task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The sketch's rank error is one part in this many; different values read off per gap at most.
ACCURACY, FEW = 10_000, 20_000

VALUE = "_value"


@dataclass
class Gap:
    """Where the value of 0-based ``rank`` lies: strictly between ``low`` and ``high`` (None: unbounded)."""

    rank: int
    low: float | None = None
    high: float | None = None
    below: int = 0  # rows at or under ``low``
    inside: int = 0
    answer: float | None = None

    def holds(self) -> Column:
        tests = [F.col(VALUE) > self.low] if self.low is not None else []
        tests += [F.col(VALUE) < self.high] if self.high is not None else []
        condition = F.lit(True)
        for test in tests:
            condition = condition & test
        return condition

    def narrow(self, low: float, high: float, under: int, on_low: int, between: int, on_high: int) -> None:
        """Take in the counts of rows in this gap under ``low``, on it, between both and on ``high``."""
        place = self.rank - self.below
        if place < under:
            self.high, self.inside = low, under
        elif place < under + on_low:
            self.answer = low
        elif place < under + on_low + between:
            self.low, self.high, self.below, self.inside = low, high, self.below + under + on_low, between
        elif place < under + on_low + between + on_high:
            self.answer = high
        else:
            passed = under + on_low + between + on_high
            self.low, self.below, self.inside = high, self.below + passed, self.inside - passed


def _sketched(values: DataFrame, gaps: list[Gap], accuracy: int) -> list[tuple[float, float]]:
    """For each gap two values of it that should enclose its rank."""
    wanted = []
    for i, gap in enumerate(gaps):
        share, slack = (gap.rank - gap.below + 0.5) / gap.inside, 2 / accuracy
        ends = [max(share - slack, 0.0), min(share + slack, 1.0)]
        wanted.append(F.percentile_approx(F.when(gap.holds(), F.col(VALUE)), ends, accuracy).alias(f"g{i}"))
    row = values.agg(*wanted).first()
    return [tuple(row[f"g{i}"]) for i in range(len(gaps))]


def _counted(values: DataFrame, gaps: list[Gap], ends: list[tuple[float, float]]) -> None:
    wanted = []
    for i, (gap, (low, high)) in enumerate(zip(gaps, ends)):
        value, inside = F.col(VALUE), gap.holds()
        wanted += [
            F.count_if(inside & (value < low)).alias(f"under{i}"),
            F.count_if(inside & (value == low)).alias(f"low{i}"),
            F.count_if(inside & (value > low) & (value < high)).alias(f"between{i}"),
            F.count_if(inside & (value == high) & F.lit(high > low)).alias(f"high{i}"),
        ]
    row = values.agg(*wanted).first()
    for i, (gap, (low, high)) in enumerate(zip(gaps, ends)):
        gap.narrow(low, high, row[f"under{i}"], row[f"low{i}"], row[f"between{i}"], row[f"high{i}"])


def _read_off(values: DataFrame, gap: Gap) -> None:
    """The answer from the at most ``inside`` different values of a small gap."""
    place = gap.rank - gap.below
    for value, count in sorted(values.where(gap.holds()).groupBy(VALUE).count().collect()):
        place -= count
        if place < 0:
            gap.answer = value
            return


def _finite_count(values: DataFrame) -> tuple[int, int]:
    row = values.agg(F.count(VALUE).alias("n"), F.count_if(F.isnan(VALUE)).alias("odd")).first()
    return row.n, row.odd


def at_ranks(
    df: DataFrame, value: str, ranks: Sequence[int], accuracy: int = ACCURACY, few: int = FEW
) -> list[float | None]:
    """The values at 0-based ``ranks`` in ascending order; None beyond the last.

    Nulls take no part, NaN counts as larger than all others, equal values take a rank each, and 0 and -0 are one value. ``df`` is
    read some times: a pass to count, then a sketch and a count for each factor of about ``accuracy`` / 4 by which the rows
    exceed ``few``, and one that reads at most ``few`` values per rank.
    """
    values = df.where(F.col(value).isNotNull()).select((F.col(value).cast("double") + F.lit(0.0)).alias(VALUE))
    n, odd = _finite_count(values)
    return _select(values, n, odd, ranks, accuracy, few)


def _select(values: DataFrame, n: int, odd: int, ranks: Sequence[int], accuracy: int, few: int) -> list[float | None]:
    values = values.where(~F.isnan(VALUE)) if odd else values
    gaps = {rank: Gap(rank, inside=n - odd) for rank in ranks if 0 <= rank < n - odd}
    while open_ := [g for g in gaps.values() if g.answer is None and g.inside > few]:
        _counted(values, open_, _sketched(values, open_, accuracy))
    for gap in gaps.values():
        if gap.answer is None:
            _read_off(values, gap)
    return [gaps[r].answer if r in gaps else math.nan if 0 <= r < n else None for r in ranks]


def quantile_values(
    df: DataFrame, value: str, points: Sequence[float], accuracy: int = ACCURACY, few: int = FEW
) -> list[float | None]:
    """Exact quantiles with linear interpolation, as ``ordering.quantiles`` gives them; None for an empty column."""
    values = df.where(F.col(value).isNotNull()).select((F.col(value).cast("double") + F.lit(0.0)).alias(VALUE))
    n, odd = _finite_count(values)
    if not n:
        return [None] * len(points)
    places = [(n - 1) * point for point in points]
    ranks = sorted({r for p in places for r in (math.floor(p), math.ceil(p))})
    found = dict(zip(ranks, _select(values, n, odd, ranks, accuracy, few)))
    lows, highs = [found[math.floor(p)] for p in places], [found[math.ceil(p)] for p in places]
    return [a if a == b else a + (b - a) * (p - math.floor(p)) for p, a, b in zip(places, lows, highs)]
