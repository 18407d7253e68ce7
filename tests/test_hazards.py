import numpy as np
import pandas as pd
import pytest

from holdfast.operators import hazards


def plain(pdf, columns, weights):
    """Efron's log partial likelihood and slope, one death after the other."""
    x = pdf[list(columns)].to_numpy(float)
    x = (x - x.mean(axis=0)) / x.std(axis=0)
    risk = np.exp(x @ weights)
    value, slope = 0.0, np.zeros(len(weights))
    for _, stratum in pdf.groupby("stratum"):
        rows = stratum.index.to_numpy()
        for day in np.unique(pdf.duration[rows]):
            left = rows[(pdf.duration[rows] >= day).to_numpy()]
            dead = rows[((pdf.duration[rows] == day) & (pdf.event[rows] == 1)).to_numpy()]
            for k in range(len(dead)):
                part = k / len(dead)
                base = risk[left].sum() - part * risk[dead].sum()
                mean = (risk[left] @ x[left] - part * (risk[dead] @ x[dead])) / base
                value += np.log(risk[dead[k]]) - np.log(base)
                slope += x[dead[k]] - mean
    return value, slope


def people(n, seed, days=12, ties=False):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(3, 2, n), rng.integers(0, 4, n).astype(float)
    life = rng.exponential(1 / np.exp(0.5 * (a - 3) / 2 - 0.3 * b))
    duration = np.minimum((life * days / 4).astype(int), days)
    if ties:
        duration[: n // 3] = 2
    event = ((life * days / 4 < days) & (rng.random(n) < 0.8)).astype(int)
    return pd.DataFrame({"duration": duration, "event": event, "a": a, "b": b, "stratum": rng.integers(0, 2, n)})


@pytest.mark.parametrize("n,ties", [(60, False), (900, True)])
@pytest.mark.parametrize("strata", [(), ("stratum",)])
def test_likelihood_and_slope_match_a_plain_version(spark, n, ties, strata):
    """Days with hundreds of deaths go through the closed sums, days with few through single terms."""
    pdf = people(n, 5, ties=ties)
    rows, _, _ = hazards.prepared(spark.createDataFrame(pdf), ("a", "b"), strata)
    seen = pdf if strata else pdf.assign(stratum=0)
    for weights in (np.zeros(2), np.array([0.7, -0.4])):
        value, slope, curve = hazards.likelihood(hazards.day_sums(rows, 2, weights, strata), 2)
        want, want_slope = plain(seen, ("a", "b"), weights)
        assert value == pytest.approx(want, rel=1e-11)
        assert slope == pytest.approx(want_slope, rel=1e-8, abs=1e-8)
        step = 1e-5
        for i in range(2):
            move = np.eye(2)[i] * step
            change = (plain(seen, ("a", "b"), weights + move)[1] - plain(seen, ("a", "b"), weights - move)[1]) / (2 * step)
            assert -curve[i] == pytest.approx(change, rel=1e-5, abs=1e-5)


def test_everybody_dies_on_the_last_day(spark):
    pdf = pd.DataFrame({"duration": [3] * 200, "event": [1] * 200, "a": np.arange(200.0), "b": np.arange(200.0) % 3, "stratum": 0})
    rows, _, _ = hazards.prepared(spark.createDataFrame(pdf), ("a", "b"))
    value, slope, _ = hazards.likelihood(hazards.day_sums(rows, 2, np.array([0.2, 0.1])), 2)
    want, want_slope = plain(pdf, ("a", "b"), np.array([0.2, 0.1]))
    assert value == pytest.approx(want, rel=1e-10) and slope == pytest.approx(want_slope, rel=1e-7)


def test_fit_reaches_the_optimum_and_finds_the_planted_effect(spark):
    pdf = people(900, 8, ties=False)
    model = hazards.fit_hazards(spark.createDataFrame(pdf), ("a", "b"))
    value, slope = plain(pdf.assign(stratum=0), ("a", "b"), model.weights)
    assert model.converged and model.reached == pytest.approx(value, rel=1e-10) and model.reached > model.start
    assert np.abs(slope).max() < 1e-3
    per_unit = model.weights / model.deviation
    assert per_unit[0] == pytest.approx(0.25, abs=0.06) and per_unit[1] == pytest.approx(-0.3, abs=0.1)
    table = hazards.hazard_table(model, spark).toPandas().set_index("feature")
    assert table.z_statistic["a"] > 4 and table.z_statistic["b"] < -3


def test_a_wrong_model_shows_a_slope(spark):
    from dataclasses import replace

    from holdfast.plans.checks import hazard_optimum

    lives = spark.createDataFrame(people(400, 2))
    model = hazards.fit_hazards(lives, ("a", "b"))
    assert [r.slope for r in hazard_optimum(model, lives).collect()] == [0.0, 0.0]
    assert all(r.slope > 0.001 for r in hazard_optimum(replace(model, weights=-model.weights), lives).collect())


def test_constant_repeated_and_missing_covariates(spark):
    pdf = people(300, 4)
    pdf["same"], pdf["twice"] = 0.1, pdf.a * 2 + 1
    alone = hazards.fit_hazards(spark.createDataFrame(pdf), ("a", "b"))
    model = hazards.fit_hazards(spark.createDataFrame(pdf), ("a", "b", "same", "twice"))
    assert model.converged and model.weights[2] == 0
    assert model.weights[0] == pytest.approx(model.weights[3], rel=1e-6)
    assert model.reached == pytest.approx(alone.reached, rel=1e-9)
    # Rows with a null or NaN take no part.
    holes = spark.createDataFrame([(None, 1, 1.0, 1.0), (3, None, 1.0, 1.0), (3, 1, None, 1.0), (3, 1, 1.0, float("nan"))], "duration int, event int, a double, b double")
    again = hazards.fit_hazards(spark.createDataFrame(pdf[["duration", "event", "a", "b"]]).union(holes), ("a", "b"))
    assert again.reached == pytest.approx(alone.reached, rel=1e-9)


def test_no_events_and_no_rows(spark):
    lives = spark.createDataFrame(people(30, 1).assign(event=0))
    for df in (lives, lives.limit(0)):
        model = hazards.fit_hazards(df, ("a", "b"))
        assert model.converged and not model.weights.any() and model.reached == 0


def test_baseline_survival_falls_and_starts_from_the_risk_sets(spark):
    pdf = people(300, 6)
    lives = spark.createDataFrame(pdf)
    model = hazards.fit_hazards(lives, ("a", "b"))
    curve = hazards.baseline_hazard(lives, model).toPandas().sort_values("duration")
    x = (pdf[["a", "b"]].to_numpy() - model.mean) / model.deviation
    risk = np.exp(x @ model.weights)
    total, want = 0.0, []
    for day in curve.duration:
        total += ((pdf.duration == day) & (pdf.event == 1)).sum() / risk[pdf.duration >= day].sum()
        want.append(np.exp(-total))
    assert np.allclose(curve.survival, want)
