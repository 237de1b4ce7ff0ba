import math
import random

import pytest
from pyspark.sql import functions as F

from skylattice.functions import geometry
from skylattice.functions.geometry import PixelGrid
from skylattice.operators import resample, spatial

GRID = PixelGrid(0.0, 0.0, 1.0)


def grid(spark, h, w, tile="T"):
    return spark.range(h * w).select(
        F.lit(tile).alias("tile"),
        F.lit(0).alias("patch_id"),
        F.lit("s2").alias("modality"),
        F.lit("2018-01-01").cast("date").alias("t"),
        F.floor(F.col("id") / w).cast("int").alias("y"),
        (F.col("id") % w).cast("int").alias("x"),
        F.col("id").cast("double").alias("v"),
    )


def test_diagonal_and_grid_tiling(spark):
    cube = grid(spark, 6, 6)
    diagonal = spatial.tile_crops(cube, 6, 6, 2)
    assert {(r.crop_id, r["count"]) for r in diagonal.groupBy("crop_id").count().collect()} == {
        (0, 4), (1, 4), (2, 4),
    }
    whole = spatial.tile_crops(cube, 6, 6, 2, "grid")
    assert whole.count() == 36
    cell = whole.where("crop_id = 5 and y = 1 and x = 0").first()
    assert cell.v == 3 * 6 + 4
    assert spatial.tile_crops(cube, 6, 6, 6).select("crop_id").distinct().collect()[0][0] == 0


@pytest.mark.parametrize("h, w, size", [(6, 8, 2), (6, 6, 4)])
def test_tiling_needs_square_divisible_frames(spark, h, w, size):
    with pytest.raises(ValueError):
        spatial.tile_crops(grid(spark, h, w), h, w, size)


def test_crop_too_large(spark):
    with pytest.raises(ValueError):
        spatial.crop_items(grid(spark, 4, 4), 4, 4, 5)


def test_center_crop_of_odd_rest(spark):
    out = spatial.crop_items(grid(spark, 5, 5), 5, 5, 2)
    assert sorted(r.v for r in out.collect()) == [6.0, 7.0, 11.0, 12.0]


def even_odd(px, py, ring):
    inside = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:]):
        if (ay > py) != (by > py) and px < (bx - ax) * (py - ay) / (by - ay) + ax:
            inside = not inside
    return inside


def ring_rows(spark, rings):
    rows = [("T", i, [{"x": x, "y": y} for x, y in ring]) for i, ring in enumerate(rings)]
    return spark.createDataFrame(rows, "tile string, roi int, ring array<struct<x double, y double>>")


RINGS = [
    [(1.0, 1.0), (9.0, 2.0), (4.0, 8.5), (1.0, 1.0)],
    # concave, so that a pixel row has several runs
    [(0.2, 0.3), (11.7, 0.3), (11.7, 11.1), (6.1, 2.2), (0.2, 11.1), (0.2, 0.3)],
    # reaches over the edge of the grid, with a horizontal edge through pixel centres
    [(5.0, 4.5), (30.0, 4.5), (30.0, 20.0), (5.0, 20.0), (5.0, 4.5)],
]


def test_regions_match_ray_test(spark):
    cube, rois = grid(spark, 12, 12), ring_rows(spark, RINGS)
    expected = {
        (i, y, x)
        for i, ring in enumerate(RINGS)
        for y in range(12)
        for x in range(12)
        if even_odd(x + 0.5, y + 0.5, ring)
    }
    got = spatial.sample_by_feature(cube, rois, GRID).collect()
    assert len(got) == len(expected)
    assert {(r.roi, r.y, r.x) for r in got} == expected
    union = {(y, x) for _, y, x in expected}
    assert {(r.y, r.x) for r in spatial.filter_spatial(cube, rois, GRID).collect()} == union
    inside = geometry.point_in_ring(F.col("x") + 0.5, F.col("y") + 0.5, F.col("ring"))
    direct = cube.drop("tile").join(F.broadcast(rois)).where(inside)
    assert {(r.roi, r.y, r.x) for r in direct.collect()} == expected


def test_regions_of_many_rows_on_wide_frames(spark):
    """Runs that reach over several column blocks."""
    cube = grid(spark, 3, 300)
    rois = spark.createDataFrame(
        [("T", 0, 10.0, 0.0, 250.0, 2.0)],
        "tile string, roi int, xmin double, ymin double, xmax double, ymax double",
    )
    got = spatial.sample_by_feature(cube, rois, GRID).collect()
    assert {(r.y, r.x) for r in got} == {(y, x) for y in (0, 1) for x in range(10, 250)}
    assert len(got) == 480


def test_clip_keeps_the_box_and_blanks_outside(spark):
    out = spatial.clip_polygon(grid(spark, 12, 12), ring_rows(spark, RINGS[:1]), ["v"], GRID)
    rows = out.collect()
    # the box [1, 9] x [1, 8.5] is closed and holds the centres 1.5 to 8.5 on both axes
    assert {(r.h, r.w) for r in rows} == {(8, 8)}
    assert len(rows) == 64
    assert min(r.y for r in rows) == min(r.x for r in rows) == 0
    for r in rows:
        y, x = r.y + 1, r.x + 1
        assert (r.v is not None) == even_odd(x + 0.5, y + 0.5, RINGS[0])


def test_rois_lie_inside_the_tile(spark):
    tiles = spark.createDataFrame(
        [("T", 0.0, 0.0, 1000.0, 600.0)],
        "tile string, xmin double, ymin double, xmax double, ymax double",
    )
    boxes = spatial.sample_rois(tiles, 200, 100, 3)
    b = boxes.agg(F.min("xmin"), F.min("ymin"), F.max("xmax"), F.max("ymax"), F.count("*")).first()
    assert b[0] >= 0 and b[1] >= 0 and b[2] <= 1000 and b[3] <= 600 and b[4] == 200
    checked = spatial.validate_rois(boxes, 100).first()
    assert checked.area_ok and checked.perimeter_ok
    with pytest.raises(ValueError):
        spatial.sample_rois(tiles, 1, 5, 3)


def test_utm_known_point_and_south(spark):
    df = spark.createDataFrame([(2.2945, 48.8582), (-70.5, -33.4)], "lon double, lat double")
    zone = geometry.utm_zone(F.col("lon"))
    e, n = geometry.to_utm(F.col("lon"), F.col("lat"), zone)
    lon, lat = geometry.to_lonlat(e, n, zone, F.col("lat") < 0)
    rows = df.select(zone.alias("z"), e.alias("e"), n.alias("n"), lon.alias("lo"), lat.alias("la")).collect()
    assert rows[0].z == 31
    assert abs(rows[0].e - 448251.80) < 0.01 and abs(rows[0].n - 5411932.68) < 0.01
    assert abs(rows[1].lo + 70.5) < 1e-8 and abs(rows[1].la + 33.4) < 1e-8


def keys_kernel(d):
    d = abs(d)
    if d <= 1:
        return 1.5 * d**3 - 2.5 * d**2 + 1
    return -0.5 * d**3 + 2.5 * d**2 - 4 * d + 2 if d < 2 else 0.0


@pytest.mark.parametrize("factor", [2.0, 3.0, 0.5, 1.6])
def test_cubic_matches_gathering_neighbours(spark, factor):
    rng = random.Random(1)
    h, w = 7, 9
    values = {(y, x): rng.random() for y in range(h) for x in range(w) if rng.random() < 0.8}
    rows = [("T", y, x, v) for (y, x), v in values.items()] + [("T", 0, 0, None)]
    values.pop((0, 0), None)
    rows = [r for r in rows if r[3] is None or (r[1], r[2]) in values]
    df = spark.createDataFrame(rows, "tile string, y int, x int, v double")
    height, width = int(h * factor), int(w * factor)
    got = {
        (r.y, r.x): r.v
        for r in resample.resample_cubic(df, ["v"], factor, height, width, ["tile"]).collect()
        if r.v is not None
    }
    for ty in range(height):
        for tx in range(width):
            sy, sx = (ty + 0.5) / factor - 0.5, (tx + 0.5) / factor - 0.5
            num = den = 0.0
            for (y, x), v in values.items():
                weight = keys_kernel(sy - y) * keys_kernel(sx - x)
                num, den = num + weight * v, den + weight
            if abs(den) > 1e-9:
                assert got[(ty, tx)] == pytest.approx(num / den, rel=1e-6, abs=1e-9)


def test_cubic_keeps_a_ramp(spark):
    cube = grid(spark, 8, 8).withColumn("v", F.col("x") * 3.0 + F.col("y"))
    out = resample.resample_cubic(cube, ["v"], 2.0, 16, 16, ["tile"]).collect()
    for r in out:
        if 4 <= r.y < 12 and 4 <= r.x < 12:
            assert r.v == pytest.approx(((r.x + 0.5) / 2 - 0.5) * 3 + (r.y + 0.5) / 2 - 0.5)


def test_near_covers_each_cell_once(spark):
    out = resample.resample_near(grid(spark, 4, 4), 2.5, 10, 10).collect()
    assert sorted((r.y, r.x) for r in out) == [(y, x) for y in range(10) for x in range(10)]
    down = resample.resample_near(grid(spark, 4, 4), 0.5, 2, 2).collect()
    assert sorted((r.y, r.x) for r in down) == [(0, 0), (0, 1), (1, 0), (1, 1)]


def test_match_rois(spark):
    files = spark.createDataFrame(
        [("A/2017/S2/openEO_1.nc", 5), ("A/2017/S2/openEO_12.nc", 5), ("A/2017/S2/openEO_1_clip.nc", 5),
         ("B/2017/S2/openEO_1.nc", 5)], "path string, length bigint")
    rois = spark.createDataFrame([("A", 1), ("A", 2)], "tile string, roi int")
    assert [r.path for r in spatial.match_rois(rois, files).collect()] == ["A/2017/S2/openEO_1.nc"]


def test_pixels_meet_few_runs_they_are_not_in(spark):
    """Small regions side by side: a pixel is compared with little more than its own regions."""
    rings = [[(x + 0.1, 0.1), (x + 2.9, 0.1), (x + 2.9, 2.9), (x + 0.1, 2.9), (x + 0.1, 0.1)] for x in range(60)]
    rois, cube = ring_rows(spark, rings), grid(spark, 3, 64)
    columns = spatial.cell_columns(rois, GRID)
    runs = spatial.roi_segments(rois, GRID, columns).where("inside")
    pixels = cube.withColumn("_cell", F.floor(F.col("x") / columns))
    met = pixels.join(runs, ["tile", "y", "_cell"]).count()
    assert met <= 2 * spatial.sample_by_feature(cube, rois, GRID).count()
    wide = ring_rows(spark, [[(x, 0.0), (x + 5000.0, 0.0), (x, 900.0), (x, 0.0)] for x in (0.0, 7.0)])
    assert spatial.cell_columns(wide, GRID) == spatial.CELL_COLUMNS
    assert spatial.cell_columns(rois.limit(0), GRID) == 1 and not spatial.sample_by_feature(cube, rois.limit(0), GRID).count()


def join_rows(df):
    """Rows that the joins of a query that has run gave on."""
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name.endswith("Join"):
            found.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(found)


def crowd(spark, n):
    """Regions over each other, every other one repeated."""
    rings = [[(x, 0.2), (x + 6.0, 0.2), (x, 7.9), (x, 0.2)] for x in (0.3 * (i // 2 % 9) for i in range(n))]
    return ring_rows(spark, rings)


def copies_of(spark, n, cut):
    cube, rois = grid(spark, 12, 12), crowd(spark, n)
    df = cut(cube, rois)
    rows = df.collect()
    rings = [[(p.x, p.y) for p in r.ring] for r in rois.orderBy("roi").collect()]
    inside = {(i, y, x) for i, ring in enumerate(rings) for y in range(12) for x in range(12) if even_odd(x + 0.5, y + 0.5, ring)}
    return rows, inside, join_rows(df)


@pytest.mark.parametrize("dealt", [False, True])
def test_sample_meets_runs_once_per_pixel(spark, monkeypatch, dealt):
    """Copies of a pixel are laid out after the join, also if blocks are dealt out and their runs in several rows."""
    if dealt:
        monkeypatch.setattr(spatial, "RUNS_AT_ONCE", 16, raising=False)
    rows, inside, met = copies_of(spark, 60, lambda c, r: spatial.sample_by_feature(c, r, GRID))
    assert sorted((r.roi, r.y, r.x) for r in rows) == sorted(inside)
    assert {r.v for r in rows if (r.y, r.x) == (3, 2)} == {38.0}
    parts = 4 if dealt else 1  # rows that the runs of a block come in
    assert met <= 144 * parts < len(rows)


@pytest.mark.parametrize("dealt", [False, True])
def test_clip_meets_runs_once_per_pixel(spark, monkeypatch, dealt):
    if dealt:
        monkeypatch.setattr(spatial, "RUNS_AT_ONCE", 32, raising=False)
    rows, inside, met = copies_of(spark, 60, lambda c, r: spatial.clip_polygon(c, r, ["v"], GRID))
    first = [math.ceil(0.3 * (i // 2 % 9) - 0.5) for i in range(60)]  # a box's first column; its rows begin at 0
    assert {(r.roi, r.y, r.x + first[r.roi]) for r in rows if r.v is not None} == inside
    assert len(rows) == sum(8 * r.w for r in {r.roi: r for r in rows}.values()) and {r.h for r in rows} == {8}
    parts = 4 if dealt else 1
    assert met <= 144 * parts < len(rows)
