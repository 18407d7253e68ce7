from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from holdfast.functions import class_name, currency_text, cut, floor_days, fraction, hash_unit, months_before
from holdfast.functions import percent_text, safe_ratio
from holdfast.operators import segments

BASE = datetime(2018, 3, 5, 12, 0)


def test_floor_days_rounds_down(spark):
    shifts = [(-1, -1), (1, 0), (25, 1), (-25, -2), (24, 1), (-24, -1), (0, 0)]
    rows = [(BASE + timedelta(hours=h), BASE, want) for h, want in shifts] + [(None, BASE, None)]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz, want int")
    for got, want in df.select(floor_days(F.col("a"), F.col("b")), "want").collect():
        assert got == want


def test_floor_days_matches_timedelta_days(spark):
    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.integers(-10**13, 10**13), min_size=20, max_size=40))
    def check(shifts):
        rows = [(BASE + timedelta(microseconds=s), BASE, timedelta(microseconds=s).days) for s in shifts]
        df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz, want int")
        assert df.where(floor_days(F.col("a"), F.col("b")) != F.col("want")).count() == 0

    check()


def test_floor_days_ignores_daylight_saving(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        rows = [(datetime(2018, 3, 12, 0, 0), datetime(2018, 3, 11, 0, 0))]
        df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
        assert df.select(floor_days(F.col("a"), F.col("b"))).first()[0] == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_months_before_clamps_and_keeps_time(spark):
    df = spark.createDataFrame([(datetime(2018, 8, 31, 15, 0, 37),)], "t timestamp_ntz")
    assert df.select(months_before(F.col("t"), 6)).first()[0] == datetime(2018, 2, 28, 15, 0, 37)


def test_delay_bins_are_right_closed(spark):
    values = [-100.0, -99.0, -98.0, 0.0, 1.0, 3.0, 7.0, 99.0, 100.0]
    one, four, seven = segments.DELAY_LABELS[1:]
    on_time = segments.DELAY_LABELS[0]
    want = [None, None, on_time, on_time, one, one, four, seven, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    labelled = df.orderBy("i").select(cut(F.col("v"), segments.DELAY_EDGES, segments.DELAY_LABELS))
    assert [r[0] for r in labelled.collect()] == want


def test_cut_left_closed_and_lowest(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "v double").orderBy("v")
    left = [r[0] for r in df.select(cut(F.col("v"), [0, 1, 2], ["a", "b"], right=False)).collect()]
    lowest = [r[0] for r in df.select(cut(F.col("v"), [0, 1, 2], ["a", "b"], include_lowest=True)).collect()]
    assert left == ["a", "b", None] and lowest == ["a", "a", "b"]
    with pytest.raises(ValueError):
        cut(F.col("v"), [0, 1], ["a", "b"])


def test_both_tier_rules(spark):
    values = [0.0, 0.3, 0.30001, 0.6, 1.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, p double").orderBy("i")
    right = [r[0] for r in df.select(segments.risk_tier(F.col("p"))).collect()]
    left = [r[0] for r in df.select(segments.risk_tier(F.col("p"), "left")).collect()]
    low, medium, high = segments.TIER_LABELS
    assert right == [None, low, medium, medium, high, None]
    assert left == [low, medium, medium, high, high, None]


def test_fraction_keeps_unknown_in_the_denominator(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,), (5,)], "d int")
    assert df.agg(fraction(F.col("d") > 0)).first()[0] == 0.5


def test_text_and_ratio_helpers(spark):
    row = spark.range(1).select(
        percent_text(F.lit(0.3456)), currency_text(F.lit(1234.4)), class_name(F.lit(1)), safe_ratio(F.lit(1), F.lit(0))
    ).first()
    assert tuple(row) == ("34.6%", "BRL 1234", "Churned", None)


def test_hash_unit_is_uniform_and_repeatable(spark):
    units = spark.range(20000).select(hash_unit(1, F.col("id")).alias("u"))
    row = units.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= row[0] and row[1] < 1 and abs(row[2] - 0.5) < 0.01
    assert units.limit(5).collect() == units.limit(5).collect()
