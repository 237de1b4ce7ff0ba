"""Longitude/latitude grids on metric grids of tiles."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from skylattice.functions.geometry import to_lonlat
from skylattice.operators.warp import LonLatGrid, lattice_cells, warp_to

SOURCE = LonLatGrid(2.0, 47.0, 0.1)
DAY = datetime.date(2018, 1, 1)
GRIDS = "tile string, x0 double, y0 double, res double, h int, w int, zone int, south boolean"


@pytest.fixture(scope="module")
def grids(spark):
    rows = [("A", 431_234.0, 5_180_000.0, 1700.0, 13, 21, 31, False), ("B", 500_017.0, 5_120_011.0, 900.0, 8, 5, 31, False)]
    return spark.createDataFrame(rows, GRIDS)


def places(grids):
    """Exact place of each target pixel on the source."""
    rows = grids.withColumn("y", F.explode(F.expr("sequence(0, h - 1)"))).withColumn("x", F.explode(F.expr("sequence(0, w - 1)")))
    east = F.col("x0") + (F.col("x") + 0.5) * F.col("res")
    north = F.col("y0") - (F.col("y") + 0.5) * F.col("res")
    lon, lat = to_lonlat(east, north, F.col("zone"), F.col("south"))
    sy, sx = (F.lit(SOURCE.lat0) - lat) / 0.1 - 0.5, (lon - F.lit(SOURCE.lon0)) / 0.1 - 0.5
    return {(r.tile, r.y, r.x): (r.sy, r.sx) for r in rows.select("tile", "y", "x", sy.alias("sy"), sx.alias("sx")).collect()}


def layer(spark, value, days=(0,), skip=lambda y, x: False):
    rows = [
        (DAY + datetime.timedelta(days=d), y, x, float(value(y, x)) + d, float(x))
        for d in days for y in range(-5, 30) for x in range(-5, 30) if not skip(y, x)
    ]
    return spark.createDataFrame(rows, "t date, y int, x int, v double, u double")


def kernel(d):
    d = abs(d)
    return 1.5 * d**3 - 2.5 * d**2 + 1 if d <= 1 else -0.5 * d**3 + 2.5 * d**2 - 4 * d + 2 if d < 2 else 0.0


def test_cubic_is_exact_on_a_plane(spark, grids):
    """Cubic convolution reproduces a plane, so values tell the places of the pixels."""
    out = warp_to(layer(spark, lambda y, x: 3 * y - 2 * x, (0, 4)), ["v", "u"], SOURCE, grids, ["t"]).collect()
    at = places(grids)
    assert len(out) == 2 * len(at) and {(r.tile, r.y, r.x) for r in out} == set(at)
    for r in out:
        sy, sx = at[r.tile, r.y, r.x]
        assert r.v == pytest.approx(3 * sy - 2 * sx + (r.t - DAY).days, abs=0.02)  # a thousandth of a cell, or less
        assert r.u == pytest.approx(sx, abs=0.005)


def test_cubic_and_near_against_all_neighbours(spark, grids):
    value = lambda y, x: (y * 37 + x * 11) % 23
    gap = lambda y, x: (y * x) % 7 == 3
    fine = {(r.tile, r.y, r.x): r.v for r in warp_to(layer(spark, value, skip=gap), ["v"], SOURCE, grids, ["t"], spacing=1).collect()}
    near = {(r.tile, r.y, r.x): r.v for r in warp_to(layer(spark, value, skip=gap), ["v"], SOURCE, grids, ["t"], "near", 1).collect()}
    for key, (sy, sx) in places(grids).items():  # with a lattice point per pixel places are exact
        total = weights = 0.0
        for y in range(math.floor(sy) - 1, math.floor(sy) + 3):
            for x in range(math.floor(sx) - 1, math.floor(sx) + 3):
                if not gap(y, x):
                    k = kernel(sy - y) * kernel(sx - x)
                    total, weights = total + k * value(y, x), weights + k
        want = total / weights if weights >= 0.5 else None
        assert fine[key] == (None if want is None else pytest.approx(want, abs=1e-6))
        y, x = math.floor(sy + 0.5), math.floor(sx + 0.5)
        assert near[key] == (None if gap(y, x) else value(y, x))


def test_lattice_places_are_close(spark, grids):
    cells = {(r.tile, r.cy, r.cx): r for r in lattice_cells(grids, SOURCE, 8).collect()}
    assert len(cells) == 2 * 3 + 1 * 1
    for (tile, y, x), (sy, sx) in places(grids).items():
        c, fy, fx = cells[tile, y // 8, x // 8], y % 8 / 8, x % 8 / 8
        for corners, want in ((c.sy, sy), (c.sx, sx)):
            a, b, d, e = corners
            got = (a + (b - a) * fx) * (1 - fy) + (d + (e - d) * fx) * fy
            assert got == pytest.approx(want, abs=1e-3)


def test_missing_values_and_empty_tables(spark, grids):
    cube = layer(spark, lambda y, x: 1).withColumn("v", F.when(F.col("x") % 2 == 0, F.lit(float("nan"))).otherwise(F.lit(1.0)))
    found = {r.v for r in warp_to(cube, ["v"], SOURCE, grids, ["t"]).collect()}
    assert all(v is None or v == pytest.approx(1.0) for v in found)
    assert warp_to(cube.limit(0), ["v"], SOURCE, grids, ["t"]).count() == 0
    assert warp_to(cube, ["v"], SOURCE, grids.limit(0), ["t"]).count() == 0
    static = layer(spark, lambda y, x: 2).withColumn("t", F.lit(None).cast("date"))
    assert warp_to(static, ["v"], SOURCE, grids, ["t"]).where("t is null and abs(v - 2) < 1e-9").count() == 13 * 21 + 8 * 5
    with pytest.raises(ValueError):
        warp_to(cube, ["v"], SOURCE, grids, ["t"], "average")


def test_repeated_grids_and_source_cells(spark, grids):
    """A repeated grid gives its pixels once; repeated source cells all count, the least is nearest."""
    cube = layer(spark, lambda y, x: y + x)
    one = {(r.tile, r.y, r.x): r.v for r in warp_to(cube, ["v"], SOURCE, grids, ["t"]).collect()}
    twice = warp_to(cube.unionByName(cube), ["v"], SOURCE, grids.unionByName(grids), ["t"]).collect()
    assert len(twice) == len(one)
    for r in twice:
        assert r.v == pytest.approx(one[r.tile, r.y, r.x])
    low = warp_to(cube.unionByName(cube.withColumn("v", F.col("v") - 1)), ["v"], SOURCE, grids, ["t"], "near").collect()
    near = {(r.tile, r.y, r.x): r.v for r in warp_to(cube, ["v"], SOURCE, grids, ["t"], "near").collect()}
    assert {(r.tile, r.y, r.x): r.v for r in low} == {k: v - 1 for k, v in near.items()}


def test_source_in_a_corner_only(spark, grids):
    """Lattice cells without a source row in their window have no pixels, the others all."""
    cells = {(r.tile, r.cy, r.cx): r for r in lattice_cells(grids, SOURCE, 8).collect()}
    last = cells["A", 1, 2]
    at = math.floor(max(last.sy)) + 2, math.floor(max(last.sx)) + 2
    cube = spark.createDataFrame([(DAY, *at, 1.0)], "t date, y int, x int, v double")
    reached = {
        k for k, r in cells.items()
        if all(math.floor(min(c)) - 1 <= i <= math.floor(max(c)) + 2 for c, i in zip((r.sy, r.sx), at))
    }
    out = warp_to(cube, ["v"], SOURCE, grids, ["t"], "near").collect()
    assert {(r.tile, r.y // 8, r.x // 8) for r in out} == reached
    assert 0 < len(reached) < len(cells)


def test_near_moves_blocks_not_windows(spark, grids):
    """What is stored before the pixels is at most four copies of a source cell, however many
    lattice cells have it in their window."""
    many = grids.select(F.explode(F.sequence(F.lit(1), F.lit(50))).alias("i"), "*")
    many = many.withColumn("tile", F.concat("tile", F.col("i").cast("string"))).drop("i")
    cube = layer(spark, lambda y, x: y)
    out = warp_to(cube, ["v"], SOURCE, many, ["t"], "near")
    paths = [f for f in out.inputFiles() if "warp-windows" in f or "warp-blocks" in f]
    stored = spark.read.parquet(*paths)
    block = next(c for c in ("_block", "_window") if c in stored.columns)
    assert stored.agg(F.sum(F.size(block))).first()[0] <= 4 * cube.count()
    assert out.count() == 50 * (13 * 21 + 8 * 5)


def test_cubic_is_not_interpreted_per_pixel(spark, grids):
    """Weights of all pixels of a batch are one array operation, no lambda over a window per pixel."""
    out = warp_to(layer(spark, lambda y, x: y), ["v", "u"], SOURCE, grids, ["t"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan and "MapInArrow" in plan
