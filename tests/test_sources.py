import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from skylattice import session
from skylattice.operators import quality, spatial
from skylattice.plans import cubes as cube_plans
from skylattice.plans import regions
from skylattice.functions.geometry import PixelGrid
from skylattice.schema import cube_schema
from skylattice.sources import catalog, cubes, manifests, rois
from skylattice.streaming import ingest


def paths(spark, names):
    return spark.createDataFrame([(n, 10) for n in names], "path string, length bigint")


def scene(tile, year, folder, patch):
    return f"base/{tile}/{year}/{folder}/openEO_{patch}_clip.nc"


LISTING = [
    scene("A", 2017, "Sentinel2_A_2017", 0),
    scene("A", 2018, "Sentinel2_A_2018", 0),
    scene("A", 2017, "Sentinel2_A_2017", 1),
    scene("B", 2017, "Sentinel2_B_2017", 0),
    scene("B", 2017, "AGERA5_TEMP_MAX", 0),
    scene("C", 2017, "Sentinel2_C_2017", 2),
    "base/A/2017/Sentinel2_A_2017/openEO_9.nc",
    "base/Sentinel2/A/openEO_7_clip.nc",
]


def test_catalog_keeps_one_row_per_file(spark):
    cat = catalog.build_catalog(paths(spark, LISTING), ["s2", "temp_max"], ["A", "B"])
    got = sorted((r.mod, r.s2_tile, r.patch_id, r.sits_path) for r in cat.collect())
    assert [g[:3] for g in got] == [
        ("s2", "A", "openEO_0_clip.nc"),
        ("s2", "A", "openEO_0_clip.nc"),
        ("s2", "A", "openEO_1_clip.nc"),
        ("s2", "B", "openEO_0_clip.nc"),
        ("temp_max", "B", "openEO_0_clip.nc"),
    ]
    summary = {(r.s2_tile, r.patch_id): r.n_files for r in catalog.catalog_summary(cat).where("mod = 's2'").collect()}
    assert summary[("A", "openEO_0_clip.nc")] == 2


def test_missing_scenes_and_length(spark):
    cat = catalog.build_catalog(paths(spark, LISTING), ["s2", "temp_max"], ["A", "B"])
    missing = {(r.mod, r.patch_id, r.s2_tile) for r in catalog.missing_scenes(cat, ["A", "B"]).collect()}
    assert missing == {
        ("s2", "openEO_1_clip.nc", "B"), ("temp_max", "openEO_0_clip.nc", "A"),
    }
    only = catalog.catalog_len(cat.where("mod = 's2'")).first()
    assert (only.mod, only.n_items) == ("s2", 3)
    # a patch that only an unrequested tile has is missing in the requested ones
    one = {(r.mod, r.patch_id) for r in catalog.missing_scenes(cat, ["B"]).collect()}
    assert one == {("s2", "openEO_1_clip.nc")}


def test_path_with_two_requested_tiles(spark):
    files = paths(spark, ["A/B/2017/Sentinel2_x/openEO_0_clip.nc"])
    cat = catalog.build_catalog(files, ["s2"], ["A", "B"])
    assert sorted(r.s2_tile for r in cat.collect()) == ["A", "B"]


def test_manifests_without_assets_are_listed(spark):
    rows = [(1, None), (2, "{broken"), (3, '{"properties":{"title":"x"}}'), (4, '{"assets":{"a":{"href":"u"}}}')]
    df = spark.createDataFrame(rows, "id int, manifest string")
    out = {r.id: r.reason for r in manifests.manifest_errors(df).collect()}
    assert out == {1: "absent", 2: "malformed", 3: "no assets"}
    assert [r.id for r in manifests.manifest_assets(df, "base").collect()] == [4]


def test_rings_of_holes_and_parts(spark, tmp_path):
    outer, hole = [[0, 0], [9, 0], [9, 9], [0, 9], [0, 0]], [[3, 3], [6, 3], [6, 6], [3, 6], [3, 3]]
    part = [[20, 20], [22, 20], [22, 22], [20, 22], [20, 20]]
    features = [
        {"type": "Feature", "properties": {"Name": "T1", "id": 1}, "geometry": {"type": "Polygon", "coordinates": [outer, hole]}},
        {"type": "Feature", "properties": {"Name": "T1"}, "geometry": {"type": "MultiPolygon", "coordinates": [[outer, hole], [part]]}},
    ]
    (tmp_path / "rois_T1.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    found = rois.read_roi_collections(spark, f"file://{tmp_path}")
    rois.write_rois(found, f"file://{tmp_path}/out")
    again = rois.read_rois(spark, f"file://{tmp_path}/out")
    cells = spark.createDataFrame(
        [("T1", y, x) for y in range(24) for x in range(24)], "tile string, y int, x int"
    )
    inside = lambda r: {(p.roi, p.y, p.x) for p in spatial.sample_by_feature(cells, r, PixelGrid(0.0, 0.0, 1.0)).collect()}
    square = {(y, x) for y in range(9) for x in range(9)} - {(y, x) for y in range(3, 6) for x in range(3, 6)}
    more = {(y, x) for y in (20, 21) for x in (20, 21)}
    assert inside(found) == inside(again) == {(1, *p) for p in square | more} | {(1, *p) for p in square}


def test_sample_catalog_patch_numbers(spark):
    names = ["r/A/Patch_id_openEO_3_clip_id0_s2.pt", "r/A/Patch_id_openEO_12_clip_id0_s2.pt", "r/Z/openEO_1_s2.pt"]
    out = catalog.sample_catalog(paths(spark, names), ["A"], ["s2"]).collect()
    assert [(r.patch_id, r.patch_no) for r in out] == [("12", 12), ("3_", 3)]


def test_small_files_round_up(spark):
    df = spark.createDataFrame([("a", 49 * 1024), ("b", 49 * 1024 + 1)], "path string, length bigint")
    assert [r.path for r in catalog.small_files(df).collect()] == ["a"]


def test_listing_reads_no_contents(spark, tmp_path):
    folder = tmp_path / "A" / "2017" / "Sentinel2_A"
    folder.mkdir(parents=True)
    (folder / "openEO_0_clip.nc").write_bytes(b"x" * 2000)
    out = catalog.list_files(spark, str(tmp_path), "*_clip.nc")
    row = out.first()
    assert row.length == 2000 and row.path.endswith("A/2017/Sentinel2_A/openEO_0_clip.nc")
    assert catalog.scene_catalog(out, "s2", ["A"]).count() == 1


def test_job_report(spark, tmp_path):
    (tmp_path / "r.csv").write_text("state,jobId\nfinished,j-1\nfinished,j-2\n")
    assert [r.job_id for r in catalog.job_ids(spark, str(tmp_path / "r.csv")).collect()] == ["vito-j-1", "vito-j-2"]


def manifest(extent, tile, assets):
    return json.dumps(
        {
            "properties": {
                "title": "S2",
                "card4l:processing_chain": {
                    "process_graph": {
                        "loadcollection1": {"arguments": {"temporal_extent": extent}},
                        "filterspatial1": {
                            "arguments": {"geometries": {"features": [{"properties": {"Name": tile}}]}}
                        },
                    }
                },
            },
            "assets": {a: {"href": f"http/{a}"} for a in assets},
        }
    )


def test_manifests_resolve_to_pending_assets(spark):
    rows = [
        ("vito-1", manifest(["2018-01-01", "2018-12-31"], "T1", ["a.nc", "b.nc"])),
        ("vito-2", manifest(None, "T2", ["c.nc"])),
        ("vito-3", manifest(None, "T3", ["d.nc"])),
    ]
    df = spark.createDataFrame(rows, "job_id string, manifest string")
    report = spark.createDataFrame([("1",), ("2",)], "jobId string")
    done = spark.createDataFrame([("out/T1/2018/S2/b.nc",)], "target string")
    out = cube_plans.resolve_manifests(report, df, "out", done).collect()
    assert {(r.target, r.href) for r in out} == {
        ("out/T1/2018/S2/a.nc", "http/a.nc"), ("out/T2/S2/c.nc", "http/c.nc"),
    }


def test_target_path(spark):
    df = spark.createDataFrame([("T", "2018"), ("T", None), (None, "2018")], "tile string, year string")
    out = df.select(manifests.target_path(F.col("tile"), F.col("year"), F.lit("S2")).alias("p")).collect()
    assert [r.p for r in out] == ["T/2018/S2", "T/S2", "S2"]


def test_roi_files(spark, tmp_path):
    ring = [[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 2.0], [0.0, 0.0]]
    feature = {"type": "Feature", "properties": {"Name": None}, "geometry": {"type": "Polygon", "coordinates": [ring]}}
    named = {**feature, "properties": {"Name": "31TDL"}}
    folder = tmp_path / "geo"
    folder.mkdir()
    (folder / "pretrain_val_30TYR.geojson").write_text(
        json.dumps({"type": "FeatureCollection", "features": [feature, named]})
    )
    got = rois.read_roi_collections(spark, str(folder)).collect()
    assert {(r.tile, r.roi) for r in got} == {("30TYR", 0), ("31TDL", 1)}
    assert len(got[0].ring) == 5
    df = rois.read_roi_collections(spark, str(folder))
    path = rois.write_rois(df, str(tmp_path / "out"))
    assert sorted(rois.read_rois(spark, path).collect()) == sorted(df.collect())


def test_tiles(spark):
    df = spark.createDataFrame([("31TDL",), ("30TYR",)], "tile string")
    assert [r.tile for r in rois.select_tiles(df).collect()] == ["31TDL"]
    assert [r.tile for r in rois.missing_tiles(df, ["30TYR", "X"]).collect()] == ["X"]


def cube(spark, n=40):
    return spark.range(n).select(
        F.lit("T").alias("tile"),
        F.lit(0).alias("patch_id"),
        F.lit("s2").alias("modality"),
        F.date_add(F.lit("2017-12-01").cast("date"), (F.floor(F.col("id") / 4) * 20).cast("int")).alias("t"),
        F.lit(0).alias("y"),
        (F.col("id") % 4).cast("int").alias("x"),
        F.when(F.col("id") % 9 != 0, F.col("id").cast("double")).alias("b02"),
        F.when(F.col("id") % 11 == 0, 1).otherwise(0).alias("clm"),
        F.lit(4).alias("scl"),
    )


def test_cube_directories_are_pruned(spark, tmp_path):
    path = cubes.write_cube(cube(spark), str(tmp_path / "cube"))
    schema = cube_schema(["b02"])
    back = cubes.read_cube(spark, path, schema, "s2", ["T"], [2017])
    assert back.count() == cube(spark).where("year(t) = 2017").count() == 8
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(modality" in plan
    assert cubes.read_cube(spark, path, schema, tiles=["none"]).count() == 0


def test_stream_equals_batch_over_several_runs(spark, tmp_path):
    """Pixels of a date arrive in different files and different runs of the stream."""
    source, target = str(tmp_path / "in"), ingest.IngestTarget(str(tmp_path / "out"))
    parts = cube(spark).withColumn("part", F.col("x") % 2)
    for part in (0, 1):
        parts.where(F.col("part") == part).drop("part").repartition(3).write.mode("append").parquet(source)
        stream = spark.readStream.schema(cube(spark).schema).option("maxFilesPerTrigger", 1).parquet(source)
        ingest.ingest_stream(stream, target, ["b02"], "b02").awaitTermination()
    want = quality.usable_pixels(cube(spark), "b02", 0.2, 0.3)
    got = ingest.ingested_usable(spark, target, 0.2, 0.3).select(want.columns)
    assert 0 < want.count() < cube(spark).count()
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def deliver(spark, rows, source, target, delay_days):
    rows.repartition(2).write.mode("append").parquet(source)
    stream = spark.readStream.schema(cube(spark).schema).parquet(source)
    ingest.ingest_stream(stream, target, ["b02"], "b02", delay_days=delay_days).awaitTermination()


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_repeated_deliveries_change_nothing(spark, tmp_path):
    """A file twice in one batch and again in later ones, with a layer that has no date."""
    source, target = str(tmp_path / "in"), ingest.IngestTarget(str(tmp_path / "out"))
    static = cube(spark, 4).withColumn("t", F.lit(None).cast("date")).withColumn("modality", F.lit("dem"))
    everything = cube(spark).unionByName(static)
    early = everything.where("t is null or t < '2018-03-01'")
    deliver(spark, early.unionByName(early), source, target, 400)
    deliver(spark, early, source, target, 400)
    deliver(spark, everything, source, target, 400)
    back = ingest.ingested_pixels(spark, target)
    assert rows_of(back) == rows_of(everything)
    want = quality.date_quality(everything, "b02", "clm", "scl")
    assert rows_of(ingest.ingested_quality(spark, target).select(want.columns)) == rows_of(want)
    assert ingest.ingested_late(spark, target).count() == ingest.ingested_revised(spark, target).count() == 0


def test_late_and_revised_rows_are_listed(spark, tmp_path):
    source, target = str(tmp_path / "in"), ingest.IngestTarget(str(tmp_path / "out"))
    young = cube(spark).where("t >= '2018-01-01'")
    deliver(spark, young, source, target, 30)
    # the latest date is 2018-05-30: rows before 2018-04-30 are late from now on
    other = young.where("x = 1").withColumn("b02", F.col("b02") + 1000)
    old = cube(spark).where("t < '2018-01-01'")
    deliver(spark, old.unionByName(old).unionByName(other), source, target, 30)
    assert rows_of(ingest.ingested_pixels(spark, target)) == rows_of(young)
    late = old.unionByName(other.where("t < '2018-04-30'"))
    assert rows_of(ingest.ingested_late(spark, target)) == rows_of(late)
    revised = other.where("t >= '2018-04-30' and b02 is not null")
    assert rows_of(ingest.ingested_revised(spark, target)) == rows_of(revised) != []


def test_rows_of_one_batch_that_differ(spark, tmp_path):
    source, target = str(tmp_path / "in"), ingest.IngestTarget(str(tmp_path / "out"))
    more = cube(spark).where("x = 2").withColumn("b02", F.col("b02") + 1000)
    deliver(spark, cube(spark).unionByName(more), source, target, 30)
    assert rows_of(ingest.ingested_pixels(spark, target)) == rows_of(cube(spark))
    assert rows_of(ingest.ingested_revised(spark, target)) == rows_of(more.where("b02 is not null"))


def test_pixels_that_never_came_are_missing(spark, tmp_path):
    source, target = str(tmp_path / "in"), ingest.IngestTarget(str(tmp_path / "out"))
    for part in (0, 1):
        deliver(spark, cube(spark).where(F.col("x") % 2 == part), source, target, 400)
    want = quality.date_quality(cube(spark), "b02", "clm", "scl", area=6)
    got = ingest.ingested_quality(spark, target, area=6).select(want.columns)
    assert rows_of(got) == rows_of(want)


def test_a_batch_without_counts_is_not_read(spark, tmp_path):
    source, target = str(tmp_path / "in"), ingest.IngestTarget(str(tmp_path / "out"))
    deliver(spark, cube(spark), source, target, None)
    cube(spark).write.parquet(f"{target.pixels}/batch=1")
    assert ingest.ingested_pixels(spark, target).count() == 40


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        assert session.shared_folder(spark) == folder.rstrip("/")
    assert session.new_folder(spark, "a") != session.new_folder(spark, "a")


def test_settled_tables_keep_rows_and_types(spark):
    df = cube(spark)
    again = session.settle(df, "test")
    assert again.schema.simpleString() == df.schema.simpleString()
    assert again.exceptAll(df).count() == 0 and again.count() == df.count()


def test_clip_scenes_skips_done_regions(spark):
    tiles = [("T", r, 0.0, 0.0, 20.0, 20.0) for r in (0, 1, 2)]
    boxes = spark.createDataFrame(tiles, "tile string, roi int, xmin double, ymin double, xmax double, ymax double")
    data = cube(spark, 8).withColumn("patch_id", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    files = paths(spark, ["T/2017/S2/openEO_0.nc", "T/2017/S2/openEO_1.nc"])
    done = spark.createDataFrame([("T", 1)], "tile string, roi int")
    out = regions.clip_scenes(data, boxes, files, ["b02"], PixelGrid(0.0, 0.0, 10.0), max_cloud=0.5, done=done)
    rows = out.collect()
    assert {r.roi for r in rows} == {0} and {r.x for r in rows} == {0, 1}
    assert {(r.h, r.w) for r in rows} == {(2, 2)}
    assert all(r.t > dt.date(2017, 1, 1) for r in rows)


def test_unknown_arguments():
    with pytest.raises(ValueError):
        from skylattice.operators.select import select_modalities

        select_modalities(None, "nothing")


def test_regions_of_many_tiles_share_files(spark, tmp_path):
    """Not a folder and a file per tile: tiles may be as many as regions."""
    df = spark.range(300).selectExpr(
        "concat('T', id) as tile", "cast(id % 7 as int) as roi",
        "array(struct(1D as x, 2D as y), struct(3D as x, 2D as y), struct(3D as x, id / 10D as y), struct(1D as x, 2D as y)) as ring",
    )
    path = tmp_path / "out"
    rois.write_rois(df, str(path))
    assert len(list(path.rglob("part-*"))) <= 8 and not [p for p in path.iterdir() if p.is_dir()]
    assert sorted(rois.read_rois(spark, str(path)).collect()) == sorted(df.collect())
