"""Proportional hazards: how covariates speed up or delay churning.

Newton steps on the partial likelihood with Efron's way for ties. A step needs, for each day, sums over everyone
still at risk. Rows are added up per day first, by an aggregation that combines inside the tasks, and the risk sets are running
totals of the days from the last one backwards: one row per day of the calendar and stratum, whatever
the number of people. A day's ties enter through three sums over the number of its deaths, which are closed up to their
last terms, so that a day on which a third of all people churn costs no more than another.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.session import materialise

# Terms of a tie that are added one by one; those before them come from the Euler-Maclaurin formula.
LAST_TERMS = 32
STEPS, TOLERANCE = 30, 1e-9


@dataclass(frozen=True)
class HazardModel:
    """Coefficients per standard deviation of each covariate, and how the fit went."""

    columns: tuple[str, ...]
    mean: np.ndarray
    deviation: np.ndarray
    weights: np.ndarray
    covariance: np.ndarray
    start: float  # log partial likelihood without covariates
    reached: float
    steps: int
    converged: bool

    def score(self) -> Column:
        """The log of a person's hazard against that of someone with average covariates."""
        total = F.lit(0.0)
        for name, mean, deviation, weight in zip(self.columns, self.mean, self.deviation, self.weights):
            if deviation > 0:
                total = total + (F.col(name).cast("double") - float(mean)) * float(weight / deviation)
        return total


def _pairs(p: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(p) for j in range(i + 1)]


def day_sums(rows: DataFrame, p: int, weights: np.ndarray, strata: Sequence[str] = ()) -> DataFrame:
    """Per day: deaths ``d``; weighted sums of 1, x and xx over all at risk (``s*``) and over the deaths (``t*``)."""
    x = [F.col(f"x{i}") for i in range(p)]
    risk = F.exp(sum((x[i] * float(weights[i]) for i in range(p)), F.lit(0.0)))
    dead = F.col("event") == 1
    parts = {"": F.lit(1.0), **{f"_{i}": x[i] for i in range(p)}, **{f"_{i}_{j}": x[i] * x[j] for i, j in _pairs(p)}}
    days = rows.withColumn("risk", risk).groupBy(*strata, "duration").agg(
        F.count_if(dead).cast("double").alias("d"),
        F.sum(F.when(dead, F.log("risk")).otherwise(0.0)).alias("logs"),
        *[F.sum(F.when(dead, x[i]).otherwise(0.0)).alias(f"sum_{i}") for i in range(p)],
        *[F.sum(F.col("risk") * part).alias(f"own{name}") for name, part in parts.items()],
        *[F.sum(F.when(dead, F.col("risk") * part).otherwise(0.0)).alias(f"t{name}") for name, part in parts.items()],
    )
    later = Window.partitionBy(*strata).orderBy(F.desc("duration")).rowsBetween(Window.unboundedPreceding, 0)
    at_risk = {f"s{name}": F.sum(f"own{name}").over(later) for name in parts}
    return days.withColumns(at_risk).drop(*[f"own{name}" for name in parts])


def _ties(days: DataFrame) -> DataFrame:
    """Add ``a``, ``c`` and ``l``: the sums of 1/D, 1/D^2 and log D over D = s - k t / d for k = 0, ..., d - 1."""
    last = F.greatest(F.col("d") - LAST_TERMS, F.lit(0.0))
    days = days.where("d > 0").withColumns({"u": F.col("s"), "g": F.col("t") / F.col("d"), "m": last})
    days = days.withColumn("v", F.col("s") - F.col("m") * F.col("g"))
    u, v, g, m = (F.col(name) for name in ("u", "v", "g", "m"))

    def drop(power: int) -> Column:
        return F.pow(v, F.lit(-power)) - F.pow(u, F.lit(-power))

    # log(u / v), also where the two are nearly equal.
    span = -F.log1p(-m * g / u)
    closed = {
        "a": span / g - drop(1) / 2 + g * drop(2) / 12 - F.pow(g, F.lit(3)) * drop(4) / 120 + F.pow(g, F.lit(5)) * drop(6) / 252,
        "c": drop(1) / g - drop(2) / 2 + g * drop(3) / 6 - F.pow(g, F.lit(3)) * drop(5) / 30 + F.pow(g, F.lit(5)) * drop(7) / 42,
        "l": (u * F.log(u) - v * F.log(v) - (u - v)) / g + span / 2
        - g * drop(1) / 12 + F.pow(g, F.lit(3)) * drop(3) / 360 - F.pow(g, F.lit(5)) * drop(5) / 1260,
    }
    single = {"a": lambda x: 1 / x, "c": lambda x: 1 / (x * x), "l": F.log}
    terms = F.sequence(m.cast("long"), F.col("d").cast("long") - 1)

    def added(term) -> Column:
        return F.aggregate(terms, F.lit(0.0), lambda acc, k: acc + term(u - k.cast("double") * g))

    return days.withColumns({name: F.when(m > 0, closed[name]).otherwise(0.0) + added(single[name]) for name in closed})


def likelihood(days: DataFrame, p: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Log partial likelihood, its slope and its curvature (negated), from ``day_sums``; one row comes back."""
    tied = _ties(days)
    s, t, d, a, c = (F.col(name) for name in ("s", "t", "d", "a", "c"))
    # Sums of k/d over D, and of k/d and its square over D^2.
    tied = tied.withColumns({"b": (s * a - d) / t, "e": (s * c - a) / t, "h": (s * s * c - 2 * s * a + d) / (t * t)})

    def bent(i: int, j: int) -> Column:
        si, sj, ti, tj = (F.col(name) for name in (f"s_{i}", f"s_{j}", f"t_{i}", f"t_{j}"))
        outer = c * si * sj - F.col("e") * (si * tj + ti * sj) + F.col("h") * ti * tj
        return F.sum(a * F.col(f"s_{i}_{j}") - F.col("b") * F.col(f"t_{i}_{j}") - outer).alias(f"bent_{i}_{j}")

    row = tied.agg(
        F.sum(F.col("logs") - F.col("l")).alias("value"),
        *[F.sum(F.col(f"sum_{i}") - (a * F.col(f"s_{i}") - F.col("b") * F.col(f"t_{i}"))).alias(f"slope_{i}") for i in range(p)],
        *[bent(i, j) for i, j in _pairs(p)],
    ).first()
    slope = np.array([row[f"slope_{i}"] or 0.0 for i in range(p)])
    curve = np.zeros((p, p))
    for i, j in _pairs(p):
        curve[i, j] = curve[j, i] = row[f"bent_{i}_{j}"] or 0.0
    return row["value"] or 0.0, slope, curve


def prepared(lives: DataFrame, columns: Sequence[str], strata: Sequence[str] = ()) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """The rows a fit uses, covariates standardised as ``x0``, ``x1``, ..., with their means and deviations."""
    known = lives.dropna(subset=["duration", "event", *columns]).select(
        *strata, "duration", F.col("event").cast("int").alias("event"), *[F.col(name).cast("double").alias(f"x{i}") for i, name in enumerate(columns)]
    )
    known = materialise(known, "lives")
    row = known.agg(*[f(f"x{i}").alias(f"{f.__name__}{i}") for i in range(len(columns)) for f in (F.avg, F.stddev_pop)]).first()
    mean = np.array([row[f"avg{i}"] or 0.0 for i in range(len(columns))])
    deviation = np.array([row[f"stddev_pop{i}"] or 0.0 for i in range(len(columns))])
    # What is left of rounding in a constant column is no spread.
    deviation[deviation <= 1e-12 * np.abs(mean)] = 0.0
    scaled = {
        f"x{i}": (F.col(f"x{i}") - float(m)) / float(s) if s > 0 else F.lit(0.0)
        for i, (m, s) in enumerate(zip(mean, deviation))
    }
    return known.withColumns(scaled), mean, deviation


def fit_hazards(lives: DataFrame, columns: Sequence[str], strata: Sequence[str] = ()) -> HazardModel:
    """Fit on rows of (duration, event 0/1, covariates); ``strata`` have baselines of their own.

    Rows with a null or NaN among these take no part. A constant column, or one that follows from others, adds nothing:
    the shortest of the best weight vectors is taken. Without events all weights are 0. Steps that would lower the likelihood are
    halved. Where covariates part the deaths perfectly the weights have no end; the fit stops after ``STEPS`` and says so.
    """
    p = len(columns)
    rows, mean, deviation = prepared(lives, columns, strata)
    weights = np.zeros(p)
    value, slope, curve = likelihood(day_sums(rows, p, weights, strata), p)
    start, converged, steps = value, False, 0
    while not converged and steps < STEPS:
        steps += 1
        move = np.linalg.pinv(curve, hermitian=True) @ slope
        # What the step should gain, by the curvature.
        if slope @ move / 2 <= TOLERANCE * max(1.0, abs(value)) * 1e-3:
            converged = True
            break
        for _ in range(20):
            reached = likelihood(day_sums(rows, p, weights + move, strata), p)
            if np.isfinite(reached[0]) and reached[0] >= value - TOLERANCE * abs(value):
                break
            move = move / 2
        weights, (value, slope, curve) = weights + move, reached
    return HazardModel(
        tuple(columns), mean, deviation, weights, np.linalg.pinv(curve, hermitian=True), start, value, steps, converged
    )


def hazard_table(model: HazardModel, spark) -> DataFrame:
    """Per covariate the weight, hazard ratio per standard deviation, standard error and z statistic."""
    error = np.sqrt(np.maximum(np.diag(model.covariance), 0))
    rows = [
        (name, float(w), float(np.exp(w)), float(e), float(w / e) if e > 0 else None)
        for name, w, e in zip(model.columns, model.weights, error)
    ]
    return spark.createDataFrame(rows, "feature string, weight double, hazard_ratio double, standard_error double, z_statistic double")


def baseline_hazard(lives: DataFrame, model: HazardModel, strata: Sequence[str] = ()) -> DataFrame:
    """(duration, events, cumulative_hazard, survival) of someone with average covariates, a row per day with events."""
    known = lives.dropna(subset=["duration", "event", *model.columns])
    risk = F.exp(model.score())
    days = known.groupBy(*strata, "duration").agg(F.sum(F.col("event").cast("long")).alias("events"), F.sum(risk).alias("own"))
    whole = Window.partitionBy(*strata)
    later = whole.orderBy(F.desc("duration")).rowsBetween(Window.unboundedPreceding, 0)
    sofar = whole.orderBy("duration").rowsBetween(Window.unboundedPreceding, 0)
    return (
        days.withColumn("at_risk", F.sum("own").over(later))
        .where("events > 0")
        .withColumn("cumulative_hazard", F.sum(F.col("events") / F.col("at_risk")).over(sofar))
        .select(*strata, "duration", "events", "cumulative_hazard", F.exp(-F.col("cumulative_hazard")).alias("survival"))
    )


def null_scores(lives: DataFrame, columns: Sequence[str], strata: Sequence[str] = ()) -> DataFrame:
    """Score test of each covariate alone at no effect, as in a log-rank test: slope, variance and z statistic."""
    p = len(columns)
    rows, _, _ = prepared(lives, columns, strata)
    _, slope, curve = likelihood(day_sums(rows, p, np.zeros(p), strata), p)
    found = [
        (name, float(slope[i]), float(curve[i, i]), float(slope[i] / np.sqrt(curve[i, i])) if curve[i, i] > 0 else None)
        for i, name in enumerate(columns)
    ]
    return lives.sparkSession.createDataFrame(found, "feature string, slope double, variance double, z_statistic double")
