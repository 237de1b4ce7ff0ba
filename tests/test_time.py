import datetime as dt

import pytest
from pyspark.sql import functions as F

from skylattice.functions import dates
from skylattice.operators import timeline

SERIES = "tile string, patch_id int, modality string, t date, x int"


def series(spark, days, patch=0, modality="s2", start=dt.date(2018, 1, 1)):
    rows = [("T", patch, modality, start + dt.timedelta(days=d), 0) for d in days]
    return spark.createDataFrame(rows, SERIES)


def test_leap_years(spark):
    days = ["2016-12-31", "2017-12-31", "2016-03-01", "2017-03-01", "2014-03-04"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("d"))
    rows = df.select(dates.doy_fraction("d").alias("f"), dates.days_since("d").alias("n")).collect()
    assert [r.f for r in rows][:4] == [1.0, 1.0, 61 / 366, 60 / 365]
    assert rows[4].n == 1


def test_year_slice_includes_both_ends(spark):
    df = series(spark, [-1, 0, 364, 365])
    got = timeline.slice_years(df, [2018])
    assert sorted(r.t.isoformat() for r in got.collect()) == ["2018-01-01", "2018-12-31"]
    assert [r.year for r in timeline.missing_years(df, [2018, 2020]).collect()] == [2020]


def test_window_length_bounds_and_determinism(spark):
    items = spark.range(500).select(F.lit("T").alias("tile"), F.col("id").alias("patch_id"))
    out = timeline.random_windows(items, 3)
    rows = out.collect()
    assert rows == timeline.random_windows(items.repartition(7), 3).orderBy("patch_id").collect() or (
        sorted(rows) == sorted(timeline.random_windows(items.repartition(7), 3).collect())
    )
    lengths = {(r.win_end - r.win_start).days for r in rows}
    assert lengths == {30 * m for m in range(6, 13)}
    assert min(r.win_start for r in rows) >= dt.date(2017, 1, 1)
    assert max(r.win_end for r in rows) <= dt.date(2020, 12, 31)


def test_window_end_is_inclusive(spark):
    df = series(spark, [0, 9, 10, 11])
    win = spark.createDataFrame(
        [("T", 0, dt.date(2018, 1, 1), dt.date(2018, 1, 11))],
        "tile string, patch_id int, win_start date, win_end date",
    )
    assert timeline.crop_time(df, win).count() == 3


def test_modalities_share_the_window(spark):
    days = range(0, 1000, 10)
    both = series(spark, days).unionByName(series(spark, days, modality="s1_asc"))
    out = timeline.crop_time_random(both, 11, repeat=3)
    per = out.groupBy("rep").agg(F.countDistinct("win_start").alias("n")).collect()
    assert [r.n for r in per] == [1] * len(per)
    times = {
        m: sorted((r.rep, r.t) for r in out.where(F.col("modality") == m).collect())
        for m in ("s2", "s1_asc")
    }
    assert times["s2"] == times["s1_asc"]


def test_subsample_is_a_subset_of_fixed_size(spark):
    df = series(spark, range(30)).unionByName(series(spark, range(5), patch=1))
    out = timeline.subsample_dates(df, 10, 1)
    sizes = {r.patch_id: r["count"] for r in out.groupBy("patch_id").count().collect()}
    assert sizes == {0: 10, 1: 5}
    assert out.exceptAll(df).count() == 0
    assert timeline.subsample_dates(df, None, 1) is df
    with pytest.raises(ValueError, match="shorter"):
        timeline.subsample_dates(df, 10, 1, strict=True)


def test_repeats_differ(spark):
    items = series(spark, [0]).select("tile", "patch_id")
    out = timeline.random_windows(timeline.repeat_items(items, 8), 5)
    assert out.count() == 8
    assert out.select("win_start", "win_end").distinct().count() > 1


def test_many_windows_equal_a_plain_test_of_each_date(spark):
    """Windows of all lengths, empty ones too, against every date; layers without a date are in all."""
    days = range(-700, 900, 7)
    cube = series(spark, days).unionByName(series(spark, days, patch=1))
    static = series(spark, [0]).withColumn("t", F.lit(None).cast("date"))
    first = dt.date(2016, 1, 1)
    wins = [("T", p, i, first + dt.timedelta(days=11 * i), first + dt.timedelta(days=11 * i + 5 * i - 20)) for p in (0, 1) for i in range(60)]
    windows = spark.createDataFrame(wins, "tile string, patch_id int, n int, win_start date, win_end date")
    rows = cube.unionByName(static)
    dates = [(r.patch_id, r.t) for r in rows.collect()]
    want = sorted((p, n, str(t)) for _, p, n, a, b in wins for q, t in dates if p == q and (t is None or a <= t <= b))
    for bin_days in (1, 50, 10000):
        got = timeline.crop_time(rows, windows, bin_days=bin_days)
        assert got.columns == ["tile", "patch_id", "modality", "t", "x", "n", "win_start", "win_end"]
        assert sorted((r.patch_id, r.n, str(r.t)) for r in got.collect()) == want


def test_a_date_meets_near_windows_only(spark):
    cube = series(spark, range(1000))
    starts = spark.range(1000).select(
        F.lit("T").alias("tile"), F.lit(0).alias("patch_id"),
        F.date_add(F.lit("2018-01-01").cast("date"), F.col("id").cast("int")).alias("win_start"),
    )
    out = timeline.crop_time(cube, starts.withColumn("win_end", F.date_add("win_start", 1)), bin_days=10)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and plan.count("_bin") > 1
    assert out.count() == 1999
