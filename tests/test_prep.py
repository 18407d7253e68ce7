import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.operators import neighbours as N
from holdfast.operators import prep as P
from holdfast.operators.explore import balance_report
from holdfast.operators.neighbours import nearest_neighbours
from holdfast.session import materialise
from holdfast.sources.schemas import KEY

COLS = ["a", "b", "c"]


def points(spark, n, seed=0, copies=0):
    rng = np.random.default_rng(seed)
    values = np.round(rng.normal(size=(n, 3)) * [100, 10, 1], 1)
    values[: n // 10, 1] = 0.0
    rows = [(f"k{i:05d}", *map(float, v)) for i, v in enumerate(values)]
    rows += [(f"copy{i:05d}", 1.0, 2.0, 3.0) for i in range(copies)]
    return spark.createDataFrame(rows, f"{KEY} string, a double, b double, c double")


@pytest.mark.parametrize(
    "tile_rows, block_rows, top, fan", [(16, 24, 4, 8), (4096, 32768, 1024, 256)]
)
def test_neighbours_equal_brute_force(spark, monkeypatch, tile_rows, block_rows, top, fan):
    monkeypatch.setattr(N, "TOP_BOXES", top)
    monkeypatch.setattr(N, "FAN", fan)
    df = points(spark, 400).dropDuplicates(COLS)
    got = nearest_neighbours(df, KEY, COLS, 5, tile_rows, block_rows).toPandas()
    pdf = df.toPandas().sort_values(KEY, ignore_index=True)
    x, keys = pdf[COLS].to_numpy(), pdf[KEY].to_numpy()
    gaps = sum((x[:, None, j] - x[None, :, j]) ** 2 for j in range(3))
    np.fill_diagonal(gaps, np.inf)
    nearest = np.argsort(gaps, axis=1, kind="stable")[:, :5]
    want = {k: list(keys[row]) for k, row in zip(keys, nearest)}
    found = got.sort_values([KEY, "position"]).groupby(KEY)["neighbour"].apply(list).to_dict()
    assert found == want


def tied(spark, n):
    """Distinct points, half of them alike in the two widest columns."""
    rng = np.random.default_rng(4)
    values = rng.normal(size=(n, 3)) * [100, 10, 1]
    values[: n // 2, :2] = [50.0, 7.0]
    return spark.createDataFrame([(f"k{i:06d}", *map(float, v)) for i, v in enumerate(values)], f"{KEY} string, a double, b double, c double")


def test_work_a_point_does_not_grow_with_the_points(spark):
    work = []
    for n in (1_500, 6_000):
        tiled, boxes = (df.toPandas() for df in N._tile(tied(spark, n), COLS, 32))
        assert boxes.n.max() <= 64 and boxes.n.sum() == n
        boxes = boxes.rename(columns={"tile": "box"})
        compared = 0
        for _, own in tiled.groupby("tile"):
            # Reaches as the points' own tile bounds them.
            gaps = np.sort(N.squared_distances(own[COLS].to_numpy(), own[COLS].to_numpy()), axis=1)
            own = own.assign(reach=gaps[:, 5] if len(own) > 5 else np.inf)
            compared += N._within(own, boxes, COLS, 5).merge(boxes[["box", "n"]], on="box")["n"].sum()
        work.append(compared / n)
    assert work[1] < 1.5 * work[0]


def test_fewer_points_than_neighbours(spark):
    assert nearest_neighbours(points(spark, 3), KEY, COLS, 5).count() == 6


def test_split_sizes_are_exact_and_repeatable(spark):
    df = spark.range(1003).select(
        F.col("id").alias(KEY), (F.col("id") % 10 == 0).cast("int").alias("label")
    )
    split = P.stratified_split(df)
    counts = {(r.label, r.split): r["count"] for r in split.groupBy("label", "split").count().collect()}
    # 201 test rows in all: 0.2 * 101 and 0.2 * 902, rounded by largest remainder
    assert counts == {(0, "test"): 181, (0, "train"): 721, (1, "test"): 20, (1, "train"): 81}
    again = P.stratified_split(df.repartition(5))
    assert split.exceptAll(again).count() == 0
    assert P.stratified_split(df, seed=7).exceptAll(split).count() > 0


def test_folds_are_balanced(spark):
    df = spark.range(1003).select(F.col("id").alias(KEY), (F.col("id") % 10 == 0).cast("int").alias("label"))
    sizes = P.with_folds(df, 5).groupBy("label", "fold").count().toPandas()
    for _, part in sizes.groupby("label"):
        assert len(part) == 5 and part["count"].max() - part["count"].min() <= 1


def test_scaling_uses_population_deviation_and_keeps_constants(spark):
    train = spark.createDataFrame([("x", 1.0, 7.0), ("y", 3.0, 7.0)], f"{KEY} string, a double, b double")
    scaled = P.scale(train, P.scaling_stats(train, ["a", "b"]), ["a", "b"]).orderBy("a").collect()
    assert [(r.a, r.b) for r in scaled] == [(-1.0, 0.0), (1.0, 0.0)]


def test_matrix_and_vector(spark):
    df = spark.createDataFrame([("x", None, 1)], f"{KEY} string, a double, churned int")
    row = P.assemble_vector(P.matrix(df, ["a"]), ["a"]).first()
    assert row.label == 1 and row.features.toArray().tolist() == [0.0]


def labelled(spark, copies):
    small = points(spark, 60, 1, copies).withColumn("label", F.lit(0))
    large = points(spark, 300, 2).withColumn(KEY, F.concat(F.lit("big-"), KEY)).withColumn("label", F.lit(1))
    return materialise(small.unionByName(large), "labelled")


@pytest.mark.parametrize("copies", [0, 40])
def test_smote_balances_and_stays_between_seed_and_neighbour(spark, copies):
    train = labelled(spark, copies)
    out = materialise(P.smote(train, COLS, tile_rows=16), "smote")
    counts = {r.label: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts == {0: 300, 1: 300}
    assert out.where("NOT synthetic").count() == train.count()
    x = train.where("label = 0").select(*COLS).toPandas().to_numpy()
    gaps = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(gaps, np.inf)
    # 5th smallest distance of each seed row bounds the neighbour it was paired with
    reach = np.sort(gaps, axis=1)[:, 4]
    made = out.where("synthetic").select(*COLS).toPandas().to_numpy()
    for row in made:
        to_seed = np.sqrt(((x - row) ** 2).sum(axis=1))
        near = gaps <= reach[:, None] + 1e-9
        onward = to_seed[:, None] + to_seed[None, :] - np.where(np.isinf(gaps), 0.0, gaps)
        same = np.eye(len(x), dtype=bool) & (to_seed < 1e-9)[:, None]
        assert ((np.abs(onward) < 1e-6) & near | same).any()


def test_smote_is_repeatable_and_counts_are_reported(spark):
    train = labelled(spark, 5)
    first, second = P.smote(train, COLS), P.smote(train.repartition(7), COLS)
    assert first.exceptAll(second).count() == 0
    report = {(r.stage, r.label): r.rows for r in balance_report({"before": train, "after": first}, "label").collect()}
    assert report[("before", 0)] == 65 and report[("after", 0)] == report[("after", 1)] == 300


def test_smote_leaves_balanced_data_alone(spark):
    train = points(spark, 10).withColumn("label", F.pmod(F.hash(KEY), F.lit(1)))
    pair = train.unionByName(train.withColumn("label", F.lit(1)))
    assert P.smote(pair, COLS).where("synthetic").count() == 0
