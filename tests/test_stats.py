import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylattice.operators import normalize, quantiles, stats
from skylattice.operators.quantiles import Quantile, exact_quantiles
from skylattice.plans import statistics
from skylattice.sources import stats_files

QS = [Quantile("med", 0.5), Quantile("low", 0.5, lower=True), Quantile("a", 0.05), Quantile("z", 0.95)]


def values_df(spark, groups):
    rows = [(g, None if v is None else float(v)) for g, vs in groups.items() for v in vs]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, "g string, v double")


def expected(vs):
    clean = sorted(v for v in vs if v is not None and not np.isnan(v))
    return [
        np.quantile(clean, 0.5),
        clean[(len(clean) - 1) // 2],
        np.quantile(clean, 0.05),
        np.quantile(clean, 0.95),
    ]


rng = np.random.default_rng(0)
GROUPS = {
    "one": [4.0],
    "two": [1.0, 2.0],
    "ties": [5.0] * 300 + [7.0] * 301,
    "missing": [1.0, None, float("nan"), 10.0, 2.0, 3.0],
    # two thirds of all rows in one group, with a heavy tail and a hot value
    "hot": list(np.exp(rng.normal(size=6000) * 4)) + [0.5] * 4000,
    "signed": list(rng.normal(size=3001)),
    "extreme": [-1e300, 1e300, 0.0, 1e-300, -1e-300, 5.0],
}


@pytest.mark.parametrize("method", ["direct", "located"])
def test_quantiles_are_exact(spark, method):
    out = exact_quantiles(values_df(spark, GROUPS), ["g"], "v", QS, method)
    got = {r.g: [r.med, r.low, r.a, r.z] for r in out.collect()}
    assert set(got) == set(GROUPS)
    for g, vs in GROUPS.items():
        assert got[g] == pytest.approx(expected(vs), rel=1e-9), g


def test_located_does_not_depend_on_the_sketch(spark):
    """With a sketch this coarse the brackets miss; the result is exact all the same."""
    df = values_df(spark, GROUPS).select("g", F.col("v").alias("value"))
    df = df.where(F.col("value").isNotNull() & ~F.isnan("value"))
    brackets = quantiles._brackets(df, ["g"], QS, accuracy=3)
    out = quantiles._located(df, ["g"], QS, brackets, cells=4)
    for r in out.collect():
        assert [r.med, r.low, r.a, r.z] == pytest.approx(expected(GROUPS[r.g]), rel=1e-9), r.g


def test_groups_of_any_size_are_located(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "_direct", None)
    assert exact_quantiles(values_df(spark, {"a": [1, 2]}), ["g"], "v", QS).count() == 1
    out = exact_quantiles(values_df(spark, GROUPS), ["g"], "v", QS)
    assert {r.g for r in out.collect()} == set(GROUPS)


def test_small_integers_need_no_sketch(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "_brackets", None)
    df = spark.range(1000).select(F.lit("a").alias("g"), (F.col("id") % 7).cast("smallint").alias("v"))
    assert exact_quantiles(df, ["g"], "v", QS).first().med == 3.0


def test_median_flavours(spark):
    df = spark.createDataFrame([("s2", v) for v in (1.0, 2.0, 3.0, 10.0)], "modality string, b double")
    mean, lower = (stats.band_stats(df, ["b"], median=m).first() for m in ("mean", "lower"))
    assert (mean.med, lower.med) == (2.5, 2.0)
    assert (mean.qmin, mean.qmax) == (pytest.approx(1.15), pytest.approx(8.95))


def test_ratio_log_edges(spark):
    rows = [(1.0, 0.0), (0.0, 1.0), (-1.0, 2.0), (4.0, 2.0), (None, 1.0)]
    out = stats.ratio_log(spark.createDataFrame(rows, "a double, b double"), "a", "b").collect()
    assert [r.ratio for r in out] == [None, None, None, pytest.approx(np.log(2)), None]
    assert out[0].b is None and out[0].a == 0.0 and out[1].a is None


def make_stats(spark):
    return spark.createDataFrame(
        [("s2", "a", 5.0, 0.0, 10.0), ("s2", "b", 1.0, 1.0, 1.0)],
        "modality string, band string, med double, qmin double, qmax double",
    )


def test_clip_and_normalise(spark):
    cube = spark.createDataFrame(
        [("s2", -3.0, 1.0), ("s2", float("nan"), 2.0), ("s2", None, 0.0), ("s2", 7.0, 1.0), ("dem", 99.0, 9.0)],
        "modality string, a double, b double",
    )
    table = make_stats(spark)
    clipped = normalize.clip_bands(cube, table, ["a", "b"]).collect()
    assert [r.a for r in clipped if r.modality == "s2"] == [0.0, 10.0, 10.0, 7.0]
    out = normalize.transform_modality(cube, table, ["a", "b"]).collect()
    assert [r.a for r in out if r.modality == "s2"] == [-0.5, 0.5, 0.5, pytest.approx(0.2)]
    # a band whose quantiles coincide has no scale; modalities without statistics pass through
    assert {r.b for r in out if r.modality == "s2"} == {None}
    assert [(r.a, r.b) for r in out if r.modality == "dem"] == [(99.0, 9.0)]


def test_normalisation_never_shuffles_the_cube(spark):
    cube = spark.createDataFrame([("s2", 1.0, 1.0)], "modality string, a double, b double")
    plan = normalize.transform_modality(cube, make_stats(spark), ["a", "b"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_stats_files_roundtrip(spark, tmp_path):
    table = make_stats(spark)
    path = stats_files.write_stats(table, ["a", "b"], str(tmp_path / "stats"))
    back = stats_files.read_stats(spark, path, ["a", "b"], "s2")
    assert sorted(back.collect()) == sorted(table.select(back.columns).collect())
    merged = stats_files.read_merged_stats(spark, [(path, ["a"]), (path, ["b"])])
    assert {(r.ord, r.modality, r.band, r.qmax) for r in merged.collect()} == {
        (0, "agera5", "a", 10.0), (1, "agera5", "b", 1.0),
    }


def test_sampling_is_a_stable_top_n(spark):
    files = spark.createDataFrame([(f"T{i % 3}", f"p{i}") for i in range(300)], "tile string, path string")
    some = stats.sample_scenes(files, 10, 1)
    assert some.count() == 10
    assert sorted(some.collect()) == sorted(stats.sample_scenes(files.repartition(5), 10, 1).collect())
    per = stats.sample_scenes(files, 4, 1, by="tile").groupBy("tile").count().collect()
    assert {r["count"] for r in per} == {4}
    short = stats.sample_shortfall(files, 101, ["T0", "T9"], "tile").collect()
    assert {(r.tile, r.n_scenes) for r in short} == {("T0", 100), ("T9", 0)}


def test_stored_sample_stats(spark):
    frames = spark.createDataFrame(
        [("T", p, "s2", t, 2, 2, [float(p), 1.0, 2.0, 3.0]) for p in range(4) for t in range(3)],
        "tile string, patch_id int, modality string, t int, h int, w int, a array<double>",
    )
    out = statistics.stored_sample_stats(frames, ["a"], 4, 1, size=1).collect()
    assert {r.stat: r.a for r in out}["med"] == 1.0
