"""Column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_days(later: Column, earlier: Column) -> Column:
    """Whole days from ``earlier`` to ``later``, rounded down (one hour early is -1).

    Calendar days first, one less when the clock time has not been reached yet.
    Works on timestamps without zone, so no session zone or DST shift enters.
    """
    calendar = F.date_diff(later, earlier)
    reached = earlier + F.make_dt_interval(calendar) <= later
    return F.when(reached, calendar).otherwise(calendar - 1)


def months_before(ts: Column, months: int) -> Column:
    """Calendar months back; keeps the time of day and clamps to the month end."""
    return ts - F.make_ym_interval(F.lit(0), F.lit(months))


def _bin_tests(value: Column, edges: Sequence[float], right: bool, include_lowest: bool):
    last = len(edges) - 2
    for i, (low, high) in enumerate(zip(edges[:-1], edges[1:])):
        if right:
            above = value >= low if include_lowest and i == 0 else value > low
            below = value <= high
        else:
            above = value >= low
            below = value <= high if include_lowest and i == last else value < high
        yield i, above & below


def _choose(pairs: Sequence[tuple[Column, object]]) -> Column:
    (test, result), *rest = pairs
    return reduce(lambda chain, pair: chain.when(*pair), rest, F.when(test, result))


def cut(
    value: Column,
    edges: Sequence[float],
    labels: Sequence[str],
    right: bool = True,
    include_lowest: bool = False,
) -> Column:
    """Label of the bin that holds ``value``; null outside the edges."""
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per bin is needed")
    return _choose([(t, F.lit(labels[i])) for i, t in _bin_tests(value, edges, right, include_lowest)])


def cut_ordinal(
    value: Column, edges: Sequence[float], right: bool = True, include_lowest: bool = False
) -> Column:
    """Position of the bin that holds ``value``, for ordering labelled bins."""
    return _choose([(t, F.lit(i)) for i, t in _bin_tests(value, edges, right, include_lowest)])


def fraction(condition: Column) -> Column:
    """Share of all rows that meet ``condition``; unknown counts as not met."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def safe_ratio(top: Column, bottom: Column) -> Column:
    """Division that is null, not an error, on a zero denominator."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


MONEY_UNITS = 10_000


def money_units(amount: Column) -> Column:
    """Money as a whole number of 1/10,000 units.

    Whole numbers add up to the same total in any order, so a sum does not depend
    on how rows were partitioned or which task was retried.
    """
    return F.rint(amount * MONEY_UNITS).cast("long")


def from_units(units: Column) -> Column:
    return units.cast("double") / MONEY_UNITS


def class_name(label: Column) -> Column:
    return F.when(label == 1, "Churned").when(label == 0, "Retained")


def percent_text(value: Column, digits: int = 1) -> Column:
    return F.format_string(f"%.{digits}f%%", value.cast("double") * 100)


def currency_text(value: Column, unit: str = "BRL", digits: int = 0) -> Column:
    return F.format_string(f"{unit} %.{digits}f", value.cast("double"))


def key_hash(seed: int, key: Column) -> Column:
    """Hex digest that orders keys pseudo-randomly but the same way on every run."""
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def hash_unit(seed: int, key: Column) -> Column:
    """Uniform number in [0, 1) that depends only on the seed and the key (52 digest bits)."""
    return F.conv(F.substring(key_hash(seed, key), 1, 13), 16, 10).cast("double") / F.lit(16.0**13)


def sigmoid(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
