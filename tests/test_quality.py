"""Boundaries of the date tests and masks, computed by hand."""

import datetime as dt

import pytest

from skylattice.functions import masks
from skylattice.operators import quality
from pyspark.sql import functions as F

DAY = dt.date(2018, 5, 1)


def cube(spark, rows):
    """Rows (t, x, b02, clm, scl) of one series, ten pixels per date."""
    data = [("T", 0, "s2", t, 0, x, b, c, s) for t, x, b, c, s in rows]
    return spark.createDataFrame(
        data,
        "tile string, patch_id int, modality string, t date, y int, x int, b02 double, clm int, scl int",
    )


def date_with(day, missing=0, cloudy=0, nodata=0):
    return [
        (DAY + dt.timedelta(days=day), x, None if x < missing else 1.0, int(x < cloudy),
         0 if x < nodata else 4)
        for x in range(10)
    ]


def kept(df):
    return sorted((r.t - DAY).days for r in df.select("t").distinct().collect())


def test_share_of_exactly_30_percent_is_dropped(spark):
    df = cube(spark, date_with(0, missing=2) + date_with(1, missing=3) + date_with(2, missing=4))
    assert kept(quality.filter_nodata_dates(df, "b02")) == [0]


def test_cloud_and_scene_class_limits_are_strict(spark):
    df = cube(
        spark,
        date_with(0, cloudy=4)
        + date_with(1, cloudy=5)
        + date_with(2, nodata=4)
        + date_with(3, nodata=5)
        + date_with(4),
    )
    assert kept(quality.filter_cloud_dates(df, 0.5)) == [0, 2, 4]


def test_no_cloud_limit_means_no_cloud_test(spark):
    df = cube(spark, date_with(0, cloudy=10, nodata=10))
    assert kept(quality.usable_pixels(df, "b02")) == [0]


def test_known_grid_size_counts_absent_pixels(spark):
    sparse = [r for r in date_with(0) if r[1] < 5]
    df = cube(spark, sparse)
    assert kept(quality.filter_nodata_dates(df, "b02")) == [0]
    assert kept(quality.filter_nodata_dates(df, "b02", area=6)) == [0]
    assert kept(quality.filter_nodata_dates(df, "b02", area=10)) == []
    assert quality.date_quality(df, "b02", area=10).first().n_nan == 5


def test_nan_counts_as_missing(spark):
    rows = [(DAY, x, float("nan") if x < 3 else 1.0, 0, 4) for x in range(10)]
    assert kept(quality.filter_nodata_dates(cube(spark, rows), "b02")) == []


def test_cloud_sum_only_tests_optical_series(spark):
    s2 = cube(spark, date_with(0, cloudy=10))
    s1 = s2.withColumn("modality", F.lit("s1_asc"))
    both = s2.unionByName(s1)
    assert [r.modality for r in quality.cloud_sum_frames(both, 0.5).collect()] == ["s1_asc"]


def test_mask_truth_table(spark):
    rows = [(DAY, s, 1.0, c, s) for c in (0, 1) for s in range(13)]
    out = quality.with_invalid(cube(spark, rows)).collect()
    valid = {r.scl for r in out if r.clm == 0 and not r.invalid}
    assert valid == {2, 4, 5, 6, 11, 12}
    assert all(r.invalid for r in out if r.clm == 1)


def test_clean_keeps_minus_infinity(spark):
    values = [float("nan"), float("inf"), 1.1e9, 1e9, float("-inf"), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r.v for r in df.select("i", masks.clean_value(F.col("v")).alias("v")).orderBy("i").collect()]
    assert got == [None, None, None, 1e9, float("-inf"), None]


def test_assert_no_nan(spark):
    df = cube(spark, date_with(0))
    assert quality.assert_no_nan(df, ["b02"]) is df
    with pytest.raises(ValueError, match="b02"):
        quality.assert_no_nan(cube(spark, date_with(0, missing=1)), ["b02"])
