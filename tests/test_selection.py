import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.operators import selection
from holdfast.operators.ordering import quantiles
from holdfast.operators.retention import spend_concentration


def column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double").repartition(4)


RNG = np.random.default_rng(3)
CASES = {
    "distinct": RNG.normal(size=4000),
    "half one value": np.where(RNG.random(4000) < 0.5, 7.0, RNG.normal(size=4000)),
    "two heavy ends": np.concatenate([np.zeros(1500), np.linspace(1, 2, 1000), np.full(1500, 3.0)]),
    "one value": np.full(500, 2.5),
    "signed zeros and ends": np.array([-0.0, 0.0, -math.inf, math.inf, 1.0, -1.0] * 50),
    "single": np.array([4.0]),
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("accuracy,few", [(10_000, 20_000), (20, 10)])
def test_ranks_match_sorting(spark, name, accuracy, few):
    """A coarse sketch and a small gap take many rounds and end at the same values."""
    values = CASES[name]
    ordered = np.sort(values)
    ranks = sorted({0, len(values) // 3, len(values) // 2, len(values) - 1, 1499 % len(values), 1500 % len(values)})
    got = selection.at_ranks(column(spark, values.tolist()), "v", ranks, accuracy, few)
    assert got == ordered[ranks].tolist()


def test_nulls_nan_and_ranks_beyond(spark):
    df = column(spark, [3.0, None, math.nan, 1.0, None, 2.0])
    got = selection.at_ranks(df, "v", [0, 2, 3, 4, -1])
    assert got[:2] == [1.0, 3.0] and math.isnan(got[2]) and got[3:] == [None, None]
    assert selection.at_ranks(column(spark, [None]), "v", [0]) == [None]
    assert selection.quantile_values(column(spark, [None]), "v", [0.5, 1.0]) == [None, None]


def test_quantiles_match_numpy_and_the_sorting_way(spark):
    values = np.round(RNG.gamma(2, 50, size=3000), 1)
    df, points = column(spark, [*values.tolist(), None, None]), [0.0, 0.05, 0.5, 0.8, 1.0]
    got = selection.quantile_values(df, "v", points, accuracy=50, few=20)
    assert np.allclose(got, np.quantile(values, points), rtol=1e-12)
    row = quantiles(df, "v", points).first()
    assert got == [row[f"q{i}"] for i in range(len(points))]


def test_a_wrong_sketch_costs_rounds_and_not_the_result(spark, monkeypatch):
    """Ends that don't enclose the rank: the counts say so."""
    values = np.arange(3000.0)

    def wrong(df, gaps, accuracy):
        found = []
        for gap in gaps:
            row = df.where(gap.holds()).agg(F.min("_value").alias("a"), F.max("_value").alias("b")).first()
            found.append((row.a + (row.b - row.a) // 4, row.a + (row.b - row.a) // 3))
        return found

    monkeypatch.setattr(selection, "_sketched", wrong)
    ranks = [0, 10, 1499, 2999]
    assert selection.at_ranks(column(spark, values.tolist()), "v", ranks, few=100) == values[ranks].tolist()


def test_no_pass_moves_the_rows(spark, monkeypatch):
    """Only sums, sketches and the few values of the last gap are shuffled."""
    plans = []
    first, collect = type(spark.range(1)).first, type(spark.range(1)).collect

    def note(run):
        def wrapped(df):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return run(df)
        return wrapped

    df = spark.range(50_000).select(F.col("id").cast("double").alias("v"))
    monkeypatch.setattr(type(df), "first", note(first))
    monkeypatch.setattr(type(df), "collect", note(collect))
    assert selection.at_ranks(df, "v", [25_000], accuracy=100, few=500) == [25_000.0]
    assert plans
    for plan in plans:
        assert "rangepartitioning" not in plan
        # Below an exchange there is always the partial aggregate.
        for part in plan.split("Exchange")[1:]:
            assert "Aggregate" in part.split("\n")[1]


def test_spend_of_the_top_tile_with_ties_on_its_edge(spark):
    values = [5.0, 5.0, 5.0, 9.0, 1.0, 1.0, 2.0, 5.0, 3.0, 4.0, 8.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "customer_unique_id int, total_spend double")
    row = spend_concentration(df, tiles=3).first()
    assert (row.top_customers, row.top_spend, row.all_spend) == (4, 27.0, 48.0)
    assert row.top_share == pytest.approx(27 / 48)
    empty = spend_concentration(df.limit(0)).first()
    assert (empty.top_customers, empty.all_spend) == (0, None)
