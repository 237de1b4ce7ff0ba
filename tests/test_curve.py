"""Cubes in the order of a space-filling curve, and scans of the parts that regions reach."""

import random

import pytest
from pyspark.sql import functions as F

from skylattice.functions.curve import OFFSET, position
from skylattice.functions.geometry import PixelGrid, to_lonlat
from skylattice.operators import spatial
from skylattice.plans import regions
from skylattice.schema import cube_schema
from skylattice.sources import cubes, rois

GRID = PixelGrid(0.0, 0.0, 1.0)


def plain_position(y, x):
    y, x, out = y + OFFSET, x + OFFSET, 0
    for b in range(31):
        out |= (y >> b & 1) << (2 * b + 1) | (x >> b & 1) << (2 * b)
    return out


def square_cube(spark, side, tiles=("A", "B")):
    names = F.explode(F.array(*[F.lit(t) for t in tiles]))
    pixels = spark.range(side * side).select(names.alias("tile"), "id")
    return pixels.select(
        "tile", F.lit(0).alias("patch_id"), F.lit("s2").alias("modality"), F.lit("2018-05-01").cast("date").alias("t"),
        F.floor(F.col("id") / side).cast("int").alias("y"), (F.col("id") % side).cast("int").alias("x"),
        F.col("id").cast("double").alias("v"),
    )


def boxes(spark, rows):
    return spark.createDataFrame(rows, "tile string, roi int, xmin double, ymin double, xmax double, ymax double")


def scans(df):
    """The file scans of a query that has run, and the names of all its operators."""
    found, names = [], []

    def walk(node):
        names.append(node.nodeName())
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if "QueryStageExec" in kind:
            return walk(node.plan())
        if kind == "FileSourceScanExec":
            found.append(node)
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found, names


def metric(scan, name):
    return scan.metrics().apply(name).value()


def test_position_interleaves_bits(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(-(1 << k), 1 << k), rng.randrange(-(1 << k), 1 << k)) for k in range(1, 31) for _ in range(5)]
    df = spark.createDataFrame(rows, "y int, x int")
    assert all(r.p == plain_position(r.y, r.x) for r in df.select("y", "x", position(F.col("y"), F.col("x")).alias("p")).collect())


@pytest.mark.parametrize("limit", [1, 3, 1000])
def test_ranges_hold_every_pixel_of_the_regions(spark, limit):
    rng = random.Random(limit)
    rows = []
    for i in range(30):
        x, y = rng.uniform(-40, 200), rng.uniform(-40, 200)
        rows.append((rng.choice("AB"), i, x, y, x + rng.uniform(0, 60), y + rng.uniform(0, 60)))
    rows.append(("C", 99, 5.6, 5.6, 6.4, 6.4))  # between pixel centres: no pixel
    found = spatial.curve_ranges(boxes(spark, rows), GRID, limit).collect()
    spans = {}
    for r in found:
        spans.setdefault(r.tile, []).append((r.low, r.high))
    for tile, _, x0, y0, x1, y1 in rows[:-1]:
        for y in range(-45, 265):
            for x in range(-45, 265):
                if x0 <= x + 0.5 <= x1 and y0 <= y + 0.5 <= y1:
                    p = plain_position(y, x)
                    assert any(a <= p <= b for a, b in spans[tile])
    assert "C" not in spans and len(found) <= max(limit, 2)
    for of_tile in spans.values():  # apart, so no pixel is named twice
        of_tile.sort()
        assert all(a[1] + 1 < b[0] for a, b in zip(of_tile, of_tile[1:]))


def test_regions_are_read_from_their_blocks_only(spark, tmp_path):
    side = 64
    cube = square_cube(spark, side)
    path = cubes.write_curve_cube(cube, f"file://{tmp_path}/cube", block_bits=3)
    schema = cube_schema(["v"])
    areas = boxes(spark, [("A", 1, 3.0, 3.0, 9.0, 6.0), ("A", 2, 40.0, 50.0, 44.0, 55.0), ("B", 3, 60.0, 0.0, 63.0, 3.0)])
    ranges = spatial.curve_ranges(areas, GRID)
    stored = cubes.read_curve_cube(spark, path, schema, ranges)
    found = spatial.sample_by_feature(stored, areas, GRID)
    key = ["roi", "tile", "y", "x", "v"]
    want = spatial.sample_by_feature(cube, areas, GRID)
    assert sorted(found.select(*key).collect()) == sorted(want.select(*key).collect())

    found = spatial.sample_by_feature(stored, areas, GRID)
    found.collect()
    read, names = scans(found)
    scan = next(s for s in read if "curve" in s.simpleString(1000))
    everything = cubes.read_curve_cube(spark, path, schema)
    everything.collect()
    whole = scans(everything)[0][0]
    assert metric(whole, "numFiles") == 2 * (side // 8) ** 2
    assert metric(scan, "numFiles") <= 2 + 4 + 2  # blocks that the three regions reach
    assert metric(scan, "numOutputRows") <= metric(scan, "numFiles") * 64
    assert "Exchange" not in names and "SortMergeJoin" not in names
    assert "BroadcastHashJoin" in names


def test_no_region_reads_nothing(spark, tmp_path):
    cube = square_cube(spark, 8)
    path = cubes.write_curve_cube(cube, f"file://{tmp_path}/cube")
    none = spatial.curve_ranges(boxes(spark, []), GRID)
    assert none.count() == 0
    assert cubes.read_curve_cube(spark, path, cube_schema(["v"]), none).count() == 0
    assert cubes.read_curve_cube(spark, path, cube_schema(["v"])).count() == 128


def test_clip_geojson(spark, tmp_path):
    """A ring written in degrees cuts the pixels of its square in metres, per tile's grid."""
    cube = square_cube(spark, 32).withColumn("clm", F.when((F.col("tile") == "B") & (F.col("x") < 12), 1).otherwise(0))
    path = cubes.write_curve_cube(cube, f"file://{tmp_path}/cube", block_bits=3)
    grids = spark.createDataFrame([("A", 500_000.0, 5_200_320.0), ("B", 400_000.0, 5_000_320.0)], "tile string, x0 double, y0 double")
    west_north = {"A": (500_000.0, 5_200_320.0), "B": (400_000.0, 5_000_320.0)}
    rows = []
    for roi, tile, row, col, h, w in ((1, "A", 4, 6, 5, 3), (2, "B", 10, 12, 4, 4), (3, "B", 10, 2, 4, 4)):
        x0, y0 = west_north[tile]
        west, east = x0 + 10 * col + 1, x0 + 10 * (col + w) - 1
        north, south = y0 - 10 * row - 1, y0 - 10 * (row + h) + 1
        rows.append((tile, roi, [(west, south), (east, south), (east, north), (west, north), (west, south)]))
    made = spark.createDataFrame(rows, "tile string, roi int, ring array<struct<x: double, y: double>>")

    def point(p):
        lon, lat = to_lonlat(p["x"], p["y"], F.lit(31), F.lit(False))
        return F.struct(lon.alias("x"), lat.alias("y"))

    geojson = rois.write_roi_collections(made.withColumn("ring", F.transform("ring", point)), f"file://{tmp_path}/geojson")
    schema = cube_schema(["v"]).add("clm", "integer")
    cut = regions.clip_geojson(spark, geojson, path, schema, grids, ["v"]).collect()
    assert {(r.tile, r.roi, r.h, r.w) for r in cut} == {("A", 1, 5, 3), ("B", 2, 4, 4), ("B", 3, 4, 4)}
    assert {(r.y, r.x): r.v for r in cut if r.roi == 1} == {(i, j): (i + 4) * 32.0 + j + 6 for i in range(5) for j in range(3)}
    clear = regions.clip_geojson(spark, geojson, path, schema, grids, ["v"], max_cloud=0.5)
    assert {r.roi for r in clear.select("roi").distinct().collect()} == {1, 2}
    only = regions.clip_geojson(spark, geojson, path, schema, grids, ["v"], tiles=["A"])
    assert {r.roi for r in only.select("roi").distinct().collect()} == {1}
    with pytest.raises(Exception, match="no grid for tile B"):
        regions.clip_geojson(spark, geojson, path, schema, grids.where("tile = 'A'"), ["v"]).collect()
