import datetime as dt

import pytest
from pyspark.sql import functions as F

from skylattice.operators import merge, samples
from skylattice.plans import convert as conv
from skylattice.plans import load

DAY = dt.date(2018, 1, 1)


def frames(spark, lengths, h=2, w=2):
    rows = [
        ("T", p, "s2", DAY + dt.timedelta(days=5 * t), h, w, [float(100 * p + 10 * t + i) for i in range(h * w)])
        for p, n in enumerate(lengths)
        for t in range(n)
    ]
    return spark.createDataFrame(
        rows, "tile string, patch_id int, modality string, t date, h int, w int, a array<float>"
    )


def test_padding_15_to_30_dates(spark):
    out = samples.pad_time(frames(spark, [15], 4, 4), ["a"], 4, 4, 30).orderBy("ti").collect()
    assert [r.ti for r in out] == list(range(30))
    assert [r.padded for r in out] == [False] * 15 + [True] * 15
    assert out[-1].a == [0.0] * 16 and out[-1].doy == 0
    assert len({r.doy for r in out[:15]}) == 15


def test_short_maximum_cuts_the_series(spark):
    out = samples.pad_time(frames(spark, [5, 1]), ["a"], 2, 2, 3)
    sizes = {r.patch_id: r["count"] for r in out.groupBy("patch_id").count().collect()}
    assert sizes == {0: 3, 1: 3}
    assert out.where("patch_id = 0 and padded").count() == 0


@pytest.mark.parametrize("pad", [0, 10])
def test_crop_select_pad(spark, pad):
    nested = samples.to_samples(frames(spark, [30], 8, 8), ["a"], 8, 8, 30)
    out = samples.select_dates(nested, list(range(20)), pad).first()
    assert len(out.sits[0]) == len(out.doy) == 20 + pad
    if pad:
        assert set(out.sits[0][-pad]) == {0.0} and out.padd_mask[-1]
    appended = samples.append_frames(frames(spark, [20]), ["a"], 2, 2, pad).orderBy("ti").collect()
    assert len(appended) == 20 + pad and appended[-1].padded == bool(pad)


def test_samples_roundtrip(spark):
    fr = frames(spark, [4, 2])
    back = samples.from_samples(samples.to_samples(fr, ["a"], 2, 2, 4)).where("not padded")
    direct = samples.from_frames(samples.with_time_encoding(samples.with_time_index(fr)), ["a"])
    got = sorted((r.patch_id, r.ti, r.y, r.x, r.value) for r in back.collect())
    want = sorted(
        (p, t, i // 2, i % 2, float(100 * p + 10 * t + i)) for p, n in ((0, 4), (1, 2)) for t in range(n) for i in range(4)
    )
    assert got == want and direct.count() == len(want)


def test_permute_is_its_own_inverse(spark):
    nested = samples.to_samples(frames(spark, [3]).withColumn("b", F.col("a")), ["a", "b"], 2, 2, 3)
    there = samples.permute(nested)
    first = there.first().sits
    assert (len(first), len(first[0])) == (3, 2)
    assert samples.permute(there).first().sits == nested.first().sits


def test_dense_frames_survive_duplicates_and_gaps(spark):
    rows = [("T", 0, "s2", DAY, 0, 1, 5.0)] * 50 + [("T", 0, "s2", DAY, 1, 0, None)]
    cube = spark.createDataFrame(
        rows, "tile string, patch_id int, modality string, t date, y int, x int, a double"
    )
    assert samples.to_frames(cube, ["a"], 2, 2).first().a == [0.0, 5.0, 0.0, 0.0]
    assert samples.to_frames(cube, ["a"], 2, 2, fill=None).first().a == [None, 5.0, None, None]
    assert samples.to_frames(cube, ["a"], 2, 2, fills={"a": 9}).first().a == [9.0, 5.0, 9.0, 9.0]
    with pytest.raises(Exception, match="outside the 1 x 2 grid"):
        samples.to_frames(cube, ["a"], 1, 2).collect()


def test_frames_that_are_not_square_are_not_one_crop(spark):
    with pytest.raises(ValueError):
        samples.tile_frames(frames(spark, [1], 8, 4), ["a"], 8, 4, 4)


def test_static_layers_are_one_frame(spark):
    rows = [("T", 0, "dem", None, y, x, float(y)) for y in range(2) for x in range(2)]
    rows += [("T", 1, "s2", DAY, y, x, 1.0) for y in range(2) for x in range(2)]
    cube = spark.createDataFrame(
        rows, "tile string, patch_id int, modality string, t date, y int, x int, a double"
    )
    fr = samples.to_frames(cube, ["a"], 2, 2)
    heads = {r.modality: r.n_dates for r in samples.sample_heads(fr).collect()}
    assert heads == {"dem": 1, "s2": 1}
    out = {r.modality: r for r in samples.to_samples(fr, ["a"], 2, 2, 3).collect()}
    assert out["dem"].sits == [[[0.0, 0.0, 1.0, 1.0]]] and out["dem"].padd_mask == [False]
    assert out["s2"].padd_mask == [False, True, True]


def test_items_are_samples(spark):
    rows = [("T", 0, "s2", 0, 5), ("T", 0, "s2", 1, 7), ("T", 0, "dem", 0, 1)]
    heads = spark.createDataFrame(rows, "tile string, patch_id int, modality string, crop_id int, n_dates int")
    out = {r.crop_id: r for r in merge.assemble_items(heads, ["s2", "dem"]).collect()}
    assert out[0].s2.n_dates == 5 and out[1].s2.n_dates == 7 and out[1].dem is None
    with pytest.raises(Exception, match="more than one s2"):
        merge.assemble_items(heads, ["s2", "dem"], on=["tile", "patch_id"]).collect()


def test_windows_go_on_after_a_stored_repetition(spark):
    args = dict(seed=1, repeat=3, begin="2018-01-01", end="2020-01-01")
    full = conv.multimodal_windows(raw(spark), [S2], 4, 4, 4, **args)
    done = full.where("rep = 0").select("tile", "patch_id", "modality", "rep").distinct()
    rest = conv.multimodal_windows(raw(spark), [S2], 4, 4, 4, done=done, **args)
    assert {r.rep for r in rest.select("rep").collect()} == {1, 2}


def test_absent_radar_pixels_are_masked(spark):
    rows = [("T", 0, "s1_asc", DAY, 0, 0, 5.0)]
    cube = spark.createDataFrame(
        rows, "tile string, patch_id int, modality string, t date, y int, x int, a double"
    )
    radar = conv.Modality("s1_asc", ["a"], dtype="double")
    assert conv.convert(cube, [radar], 2, 2, 2).first().mask_nan == [0, 1, 1, 1]
    window = dict(seed=1, repeat=1, begin="2017-01-01", end="2021-01-01")
    assert conv.multimodal_windows(cube, [radar], 2, 2, 2, **window).count() == 0


def test_tile_frames_equals_cropping(spark):
    fr = frames(spark, [1], 4, 4)
    grid = samples.tile_frames(fr, ["a"], 4, 4, 2, "grid").where("crop_id = 1").first()
    assert grid.a == [2.0, 3.0, 6.0, 7.0]
    diagonal = samples.tile_frames(fr, ["a"], 4, 4, 2).where("crop_id = 1").first()
    assert diagonal.a == [10.0, 11.0, 14.0, 15.0] and diagonal.w == 2


def test_load_samples_cuts_masks_alike(spark):
    fr = frames(spark, [6], 8, 8).withColumn("m", F.col("a"))
    out = load.load_samples(fr, ["a"], 8, 8, 3, 5, max_len=4, crop_mode="random", masks=["m"])
    rows = out.collect()
    assert len(rows) == 4
    assert all(r.a == r.m and len(r.a) == 9 for r in rows)


def test_assembled_items_meet_by_key(spark):
    heads = spark.createDataFrame(
        [("T", 0, "s2", 4), ("T", 1, "s1_asc", 2), ("T", 1, "s2", 3)],
        "tile string, patch_id int, modality string, n_dates int",
    )
    out = {r.patch_id: r for r in merge.assemble_items(heads, ["s2", "s1_asc"]).collect()}
    assert out[0].s1_asc is None and out[0].s2.n_dates == 4
    assert out[1].s1_asc.n_dates == 2 and out[1].s2.n_dates == 3


def test_merge_reports_conflicts(spark):
    schema = "tile string, t int, a double"
    one = spark.createDataFrame([("T", 0, 1.0), ("T", 1, None), ("T", 2, 5.0)], schema)
    two = spark.createDataFrame([("T", 0, 1.0), ("T", 1, 3.0), ("T", 2, 6.0), ("T", 3, 2.0)], schema)
    merged = {r.t: r.a for r in merge.merge_variables(one, two, keys=["tile", "t"]).collect()}
    assert merged == {0: 1.0, 1: 3.0, 2: None, 3: 2.0}
    conflicts = merge.merge_conflicts(one, two, keys=["tile", "t"]).collect()
    assert [(r.t, r.band) for r in conflicts] == [(2, "a")]


def test_item_keys_are_consecutive(spark):
    rows = [(f"T{i % 4}", i * 37 % 1000) for i in range(500)]
    df = spark.createDataFrame(rows + rows[:100], "tile string, patch_id int")
    out = [(r.item, r.tile, r.patch_id) for r in merge.item_keys(df).collect()]
    want = [(i, *k) for i, k in enumerate(sorted(set(rows)))]
    assert sorted(out) == want


def test_item_keys_of_named_patches(spark):
    rows = [(t, f"openEO_{i}_clip.nc") for t in "BA" for i in (10, 9, 9, 2)]
    out = merge.item_keys(spark.createDataFrame(rows, "tile string, patch_id string")).orderBy("item").collect()
    assert [(r.tile, r.patch_id) for r in out] == sorted(set(rows)) and [r.item for r in out] == list(range(6))


def test_merge_keeps_values_beside_nan(spark):
    schema = "tile string, t int, a double"
    one = spark.createDataFrame([("T", 0, float("nan"))], schema)
    two = spark.createDataFrame([("T", 0, 5.0)], schema)
    assert merge.merge_series(one, two, keys=["tile", "t"]).first().a == 5.0
    assert merge.merge_conflicts(one, two, keys=["tile", "t"]).count() == 0


def raw(spark):
    rows = []
    for p in range(2):
        for d in range(4):
            for y in range(4):
                for x in range(4):
                    missing = p == 0 and d == 1 and y < 2
                    rows.append(
                        ("T", p, "s2", dt.date(2018, 1, 1) + dt.timedelta(days=200 * d), y, x,
                         None if missing else float(y * 4 + x), 0, 4)
                    )
    return spark.createDataFrame(
        rows, "tile string, patch_id int, modality string, t date, y int, x int, a double, clm int, scl int"
    )


S2 = conv.Modality("s2", ["a"], "a", "clm", "scl", "smallint")


def test_convert_skips_done_and_bad_dates(spark):
    done = spark.createDataFrame([("T", 1, "s2")], "tile string, patch_id int, modality string")
    out = conv.convert(raw(spark), [S2], 4, 4, 2, done=done).collect()
    assert {(r.patch_id, r.crop_id) for r in out} == {(0, 0), (0, 1)}
    assert len(out) == 2 * 3
    assert {tuple(r.a) for r in out} == {(0, 1, 4, 5), (10, 11, 14, 15)}


def test_yearly_and_repeated_samples_stay_apart(spark):
    out = conv.yearly_convert(raw(spark), [S2], [2018, 2019], 4, 4, 4)
    assert {(r.patch_id, r.year, r["count"]) for r in out.groupBy("patch_id", "year").count().collect()} == {
        (0, 2018, 1), (0, 2019, 2), (1, 2018, 2), (1, 2019, 2),
    }
    many = conv.multimodal_windows(raw(spark), [S2], 4, 4, 4, seed=1, repeat=6, begin="2018-01-01", end="2020-01-01")
    keys = many.select("patch_id", "rep", "t").collect()
    assert len(keys) == len(set(keys)) and len({k.rep for k in keys}) > 1


def test_all_modalities_with_a_static_layer(spark):
    """Elevation has no date; every other modality keeps its own dates."""
    modalities = conv.modalities_for("all")
    assert [m.name for m in modalities] == ["s2", "s1_asc", "s1_desc", "dem", "agera5"]
    bands = sorted({b for m in modalities for b in m.bands})
    base = raw(spark).where("patch_id = 0").withColumnsRenamed({"clm": "CLM", "scl": "SCL"})
    base = base.withColumns({b: F.col("a").cast("double") for b in bands}).drop("a")
    cube = merge.union_all(
        *[
            base.withColumn("modality", F.lit(m.name)).withColumn(
                "t", F.lit(None).cast("date") if m.name == "dem" else F.col("t")
            )
            for m in modalities
        ]
    )
    out = conv.convert(cube, modalities, 4, 4, 2).select("modality", "t", "crop_id", "DEM", "VV").collect()
    sizes = {}
    for r in out:
        sizes[r.modality] = sizes.get(r.modality, 0) + 1
    # two crops; the optical series loses one date, elevation is a single frame
    assert sizes == {"s2": 6, "s1_asc": 8, "s1_desc": 8, "dem": 2, "agera5": 8}
    dem = [r for r in out if r.modality == "dem"]
    assert all(r.t is None and len(r.DEM) == 4 and r.VV is None for r in dem)


def test_direct_load_checks_length(spark):
    with pytest.raises(ValueError, match="shorter"):
        load.load_direct(raw(spark), ["a"], 4, 4, 2, 1, max_len=9, strict=True)
    radar = raw(spark).drop("clm", "scl").withColumn("modality", F.lit("s1_asc"))
    out = load.load_direct(radar, ["a"], 4, 4, 4, 1, max_len=9).where("mask_nan = 1")
    assert {r.a for r in out.collect()} == {0.0} and out.count() == 8


def test_one_hot_frame(spark):
    """Half of all rows are copies of one pixel of one frame."""
    hot = raw(spark).where("patch_id = 1 and y = 0 and x = 1 and year(t) = 2018").limit(1)
    many = merge.union_all(raw(spark), *[hot] * 8)
    for _ in range(2):
        many = many.unionByName(many.where("patch_id = 1 and y = 0 and x = 1 and year(t) = 2018"))
    plain, heavy = (
        sorted((r.patch_id, str(r.t), r.crop_id, tuple(r.a)) for r in conv.convert(c, [S2], 4, 4, 2).collect())
        for c in (raw(spark), many)
    )
    assert plain == heavy


def test_frames_read_the_cube_once(spark, tmp_path):
    """Absent pixels are laid out after the exchanges: the plan has one scan and no union."""
    rows = [("T1", 1, "s2", dt.date(2018, 1, 1), y, x, float(y * 3 + x), None) for y in range(2) for x in range(2)]
    rows.append(("T1", 1, "s2", dt.date(2018, 1, 2), 2, 2, None, 5))
    schema = "tile string, patch_id int, modality string, t date, y int, x int, a double, b int"
    path = str(tmp_path / "cube")
    spark.createDataFrame(rows, schema).write.parquet(path)
    out = samples.to_frames(spark.read.parquet(path), ["a", "b"], 3, 3, fill=-1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan
    found = {r.t.day: (r.a, r.b) for r in out.collect()}
    assert found[1] == ([0.0, 1.0, -1.0, 3.0, 4.0, -1.0, -1.0, -1.0, -1.0], [-1] * 9)
    assert found[2] == ([-1.0] * 9, [-1] * 8 + [5])
