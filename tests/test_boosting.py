"""Boosted trees against a plain-Python histogram booster, and both ways of growing them against each other."""

import math

import numpy as np
import pytest

from holdfast.operators import boosting as B
from holdfast.session import materialise
from holdfast.sources.schemas import KEY

COLS = ["a", "b", "c", "d"]
PARAMS = B.Params(n_estimators=6, max_depth=4, learning_rate=0.3, subsample=0.7, colsample_bytree=0.75, scale_pos_weight=3.0)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(500, 4)) * [1, 5, 100, 1]
    x[:, 3] = rng.integers(0, 4, 500)  # many ties
    margin = 1.5 * x[:, 0] - 0.2 * x[:, 1] + np.where(x[:, 2] > 50, 1.0, -0.5) + 0.5 * (x[:, 3] == 2)
    y = (rng.random(500) < 1 / (1 + np.exp(-margin))).astype(int)
    return [(f"k{i}", int(y[i]), i % 3, *map(float, x[i])) for i in range(500)]


@pytest.fixture(scope="module")
def table(spark, rows):
    fields = ", ".join(f"{c} double" for c in COLS)
    return materialise(spark.createDataFrame(rows, f"{KEY} string, label int, fold int, {fields}"), "boost")


def plain_cuts(values):
    """Upper ends of equal-frequency bins: a distinct value's bin follows from the rows before it."""
    ends, before = {}, 0
    for v in sorted(set(values)):
        n = values.count(v)
        ends[before * B.BINS // len(values)] = v
        before += n
    return sorted(ends.values())[:-1]


def plain_booster(rows, cuts, hashes, p, held, seed):
    """Row by row and cut by cut, in whole units."""
    margin = [0.0] * len(rows)
    trees = []
    for t in range(p.n_estimators):
        taken = [i for i, r in enumerate(rows) if r[2] != held and bool(B.sampled(hashes[i : i + 1], p.subsample, seed, t)[0])]
        columns = B.drawn_columns(len(cuts), p.colsample_bytree, seed, t).tolist()
        g, h = {}, {}
        for i in taken:
            q = 0.5 * (1 + math.tanh(margin[i] / 2))
            w = p.scale_pos_weight if rows[i][1] == 1 else 1.0
            g[i], h[i] = round(w * (q - rows[i][1]) * B.UNIT), round(w * q * (1 - q) * B.UNIT)

        def score(members):
            return (sum(g[i] for i in members) / B.UNIT) ** 2 / (sum(h[i] for i in members) / B.UNIT + p.reg_lambda)

        def grow(members, depth):
            best = None
            for c in columns if depth < p.max_depth else []:
                for cut in cuts[c]:
                    left = [i for i in members if rows[i][3 + c] <= cut]
                    right = [i for i in members if rows[i][3 + c] > cut]
                    if min(sum(h[i] for i in left), sum(h[i] for i in right)) < p.min_child_weight * B.UNIT:
                        continue
                    gain = 0.5 * (score(left) + score(right) - score(members))
                    if gain > B.LEAST_GAIN and (best is None or gain > best[0] + 1e-12):
                        best = (gain, c, cut, left, right)
            if best is None:
                value = -p.learning_rate * sum(g[i] for i in members) / (sum(h[i] for i in members) + p.reg_lambda * B.UNIT)
                return ("leaf", value)
            return (best[1], best[2], grow(best[3], depth + 1), grow(best[4], depth + 1))

        tree = grow(taken, 0)
        trees.append(tree)
        for i, r in enumerate(rows):
            node = tree
            while node[0] != "leaf":
                node = node[2] if r[3 + node[0]] <= node[1] else node[3]
            margin[i] += node[1]
    return trees, margin


def as_nested(tree, cuts, p, node=0):
    n = tree[node]
    if n["feature"] < 0:
        return ("leaf", float(B.leaf_values(tree, p)[node]))
    return (int(n["feature"]), float(cuts[n["feature"]][n["cut"]]), as_nested(tree, cuts, p, n["left"]), as_nested(tree, cuts, p, n["right"]))


def same_tree(one, other):
    if one[0] == "leaf" or other[0] == "leaf":
        return one[0] == other[0] and abs(one[1] - other[1]) < 1e-12
    return one[:2] == other[:2] and same_tree(one[2], other[2]) and same_tree(one[3], other[3])


def pairwise_area(margins, labels):
    bad, good = ([m for m, y in zip(margins, labels) if y == x] for x in (1, 0))
    return sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))


@pytest.fixture(scope="module")
def both_ways(table):
    fits = [B.Fit(PARAMS, 1), B.Fit(B.Params(n_estimators=13, max_depth=2), 0), B.Fit(PARAMS, None)]
    return fits, B.fit_many(table, COLS, fits), B.fit_many(table.repartition(5), COLS, fits, rows_at_once=10)


def test_booster_equals_plain_python(spark, table, rows, both_ways):
    fits, (grown, cuts), _ = both_ways
    assert [c.tolist() for c in cuts] == [plain_cuts([r[3 + i] for r in rows]) for i in range(4)]
    hashes = {r[0]: r[1] for r in table.selectExpr(KEY, f"xxhash64({KEY})").collect()}
    hashes = np.array([hashes[r[0]] for r in rows], dtype=np.int64)
    for fit, got in zip(fits[:2], grown[:2]):
        trees, margin = plain_booster(rows, [c.tolist() for c in cuts], hashes, fit.params, fit.held, 42)
        assert len(got.trees) == len(trees)
        assert all(same_tree(as_nested(a, cuts, fit.params), b) for a, b in zip(got.trees, trees))
        seen = [(m, r[1]) for m, r in zip(margin, rows) if r[2] == fit.held]
        assert abs(got.area - pairwise_area(*zip(*seen))) < 1e-9


def test_levels_as_jobs_give_the_same_trees(both_ways):
    fits, (here, _), (spread, _) = both_ways
    for fit, one, other in zip(fits, here, spread):
        assert [t.tolist() for t in one.trees] == [t.tolist() for t in other.trees]
        assert len(one.trees) == fit.params.n_estimators
        assert (one.area is None) == (other.area is None) == (fit.held is None)
        assert one.area is None or abs(one.area - other.area) < 1e-12


def test_a_million_rows_take_no_job_per_level(spark, monkeypatch):
    def by_level(*_):
        raise AssertionError("a job per level")

    monkeypatch.setattr(B, "_grow_by_level", by_level)
    rows = spark.range(1_100_000).selectExpr(f"id AS {KEY}", "int(id % 7 < 3) AS label", "int(id % 5) AS fold", "double(id % 7) AS a")
    fits = [B.Fit(B.Params(n_estimators=2, max_depth=2), fold) for fold in (0, 3)]
    grown, _ = B.fit_many(rows, ["a"], fits)
    assert [len(g.trees) for g in grown] == [2, 2] and all(g.area == 1 for g in grown)


def test_areas_of_levels_need_the_held_rows_only(spark):
    rows = B.Rows(np.zeros((1, 90), dtype="u1"), np.arange(90) % 2, np.arange(90) % 3, np.arange(90))
    margins = np.stack([np.arange(90.0), -(np.arange(90) % 2.0), np.zeros(90)])
    fits = [B.Fit(PARAMS, 1), B.Fit(PARAMS, 2), B.Fit(PARAMS, None)]
    written = B._judged(spark, spark.sparkContext.parallelize([(rows, margins)], 1), fits)
    assert written.selectExpr("sum(length(margin))").first()[0] == 2 * 30 * 8
    found = B._areas(written)
    assert set(found) == {0, 1} and found[1] == 0
    held = rows.fold == 1
    assert abs(found[0] - pairwise_area(margins[0][held], rows.label[held])) < 1e-12


def test_sampling_is_by_row_and_round():
    hashes = np.random.default_rng(1).integers(-(2**62), 2**62, 20_000)
    one, two = (B.sampled(hashes, 0.7, 42, r) for r in (0, 1))
    assert abs(one.mean() - 0.7) < 0.02 and abs((one & two).mean() - 0.49) < 0.02
    assert B.sampled(hashes, 1.0, 42, 0).all()
    assert (B.sampled(hashes[::-1], 0.7, 42, 0) == one[::-1]).all()
    picks = [tuple(B.drawn_columns(9, 0.7, 42, r).tolist()) for r in range(50)]
    assert {len(p) for p in picks} == {6} and len(set(picks)) > 20
    assert B.drawn_columns(9, 0.01, 42, 0).size == 1


def test_boosting_of_few_or_alike_rows(spark):
    fields = ", ".join(f"{c} double" for c in COLS)
    schema = f"{KEY} string, label int, {fields}"
    alike = spark.createDataFrame([(f"k{i}", i % 2, 1.0, 2.0, 3.0, 4.0) for i in range(40)], schema)
    model = B.fit(alike, COLS, B.Params(n_estimators=2))
    assert all(len(t) == 1 for t in model.trees) and all(len(c) == 0 for c in model.cuts)
    empty = B.fit(spark.createDataFrame([], schema), COLS, B.Params(n_estimators=2))
    assert empty.trees == []
    (grown,), _ = B.fit_many(alike.selectExpr("*", "0 AS fold"), COLS, [B.Fit(B.Params(n_estimators=1), 3)], rows_at_once=1)
    assert grown.area is None and len(grown.trees) == 1


def test_a_level_walks_no_tree_of_earlier_rounds_again(spark, table, monkeypatch):
    walks, real = spark.sparkContext.accumulator(0), B.reached

    def counted(tree, bins):
        walks.add(1)
        return real(tree, bins)

    monkeypatch.setattr(B, "reached", counted)
    params = B.Params(n_estimators=8, max_depth=2)
    (grown,), _ = B.fit_many(table.coalesce(1), COLS, [B.Fit(params)], rows_at_once=10)
    # A block meets the tree that grows once a level, and once when it is done.
    assert len(grown.trees) == 8 and walks.value <= 8 * (params.max_depth + 1)


def test_only_the_smaller_sister_is_added_up(monkeypatch):
    rng = np.random.default_rng(3)
    bins = rng.integers(0, B.BINS, (4, 20_000)).astype(np.uint8)
    label = (bins[0].astype(int) + bins[1] + rng.integers(0, 200, 20_000) > 350).astype(np.int64)
    added, real = [], B.histogram

    def counted(bins, slot, *rest):
        added.append(len(slot))
        return real(bins, slot, *rest)

    monkeypatch.setattr(B, "histogram", counted)
    rows = B.Rows(bins, label, np.full(20_000, -1, dtype="<i4"), np.arange(20_000))
    B.grow_here(rows, B.Fit(B.Params(n_estimators=1, max_depth=5)), [B.BINS - 1] * 4, 42)
    assert len(added) == 5 and sum(added) <= 20_000 * (1 + 4 / 2)
