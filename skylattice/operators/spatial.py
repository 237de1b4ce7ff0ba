"""Spatial operators: crops, regions of interest, polygon selection."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylattice.functions.curve import OFFSET, position
from skylattice.functions.draws import uniform, uniform_between, uniform_int
from skylattice.functions.geometry import PixelGrid, box_ring, ring_bounds, ring_crossings
from skylattice.session import settle

# ---------------------------------------------------------------- crops


def crop(cube: DataFrame, row0, col0, size: int) -> DataFrame:
    """Pixels of the window [row0, row0+size) x [col0, col0+size), re-based to 0."""
    row0 = row0 if isinstance(row0, Column) else F.lit(row0)
    col0 = col0 if isinstance(col0, Column) else F.lit(col0)
    y, x = F.col("y") - row0, F.col("x") - col0
    # one comparison per axis, so an offset that is drawn in place is drawn once
    inside = (F.floor(y / size) == 0) & (F.floor(x / size) == 0)
    return cube.where(inside).withColumn("y", y).withColumn("x", x)


def center_offset(n: int, size: int) -> int:
    return (n - size) // 2


def _check_fits(h: int, w: int, size: int):
    if size > h or size > w:
        raise ValueError(f"crop of {size} does not fit into {h} x {w}")


def crop_offsets(items, h, w, size, mode="center", seed=0, keys=None) -> DataFrame:
    """``row0, col0`` of the crop of each item: centred or uniformly random."""
    row0, col0 = offset_columns(h, w, size, mode, seed, keys or items.columns)
    return items.withColumn("row0", row0).withColumn("col0", col0)


def offset_columns(h, w, size, mode, seed, keys) -> tuple[Column, Column]:
    """Crop offset of a row's item."""
    _check_fits(h, w, size)
    if mode == "center":
        return F.lit(center_offset(h, size)), F.lit(center_offset(w, size))
    if mode == "random":
        return (
            uniform_int(0, h - size, uniform(seed, "row", *keys)),
            uniform_int(0, w - size, uniform(seed, "col", *keys)),
        )
    raise ValueError(f"unknown crop mode {mode!r}")


def crop_items(cube, h, w, size, mode="center", seed=0, keys=("tile", "patch_id")) -> DataFrame:
    """Crop every item at its own offset; a random offset is derived from the item keys in
    place, so all bands, masks and modalities of an item share it without a join."""
    return crop(cube, *offset_columns(h, w, size, mode, seed, list(keys)), size)


def tile_crops(cube: DataFrame, h: int, w: int, size: int, mode="diagonal") -> DataFrame:
    """Cut square frames into crops of ``size`` pixels, numbered by ``crop_id``.

    ``diagonal`` emits the blocks (n, n); ``grid`` emits every block, row by row.
    """
    y, x = F.col("y"), F.col("x")
    if h == w == size:
        return cube.withColumn("crop_id", F.lit(0))
    if h != w or w % size:
        raise ValueError(f"cannot cut {h} x {w} frames into crops of {size}")
    block_y, block_x = F.floor(y / size).cast("int"), F.floor(x / size).cast("int")
    if mode == "diagonal":
        cube = cube.where(block_y == block_x).withColumn("crop_id", block_y)
    elif mode == "grid":
        cube = cube.withColumn("crop_id", block_y * F.lit(w // size) + block_x)
    else:
        raise ValueError(f"unknown tiling mode {mode!r}")
    return cube.withColumn("y", F.pmod(y, F.lit(size))).withColumn("x", F.pmod(x, F.lit(size)))


# ---------------------------------------------------------------- regions


def sample_rois(tiles: DataFrame, n: int, size: float, seed: int, keep=()) -> DataFrame:
    """``n`` random square boxes per tile, fully inside the bounds of the tile.

    ``tiles`` has tile, xmin, ymin, xmax, ymax in metres; boxes may overlap. ``keep`` names
    further columns of the tile to carry along.
    """
    if size % 2:
        raise ValueError(f"box size should be even, got {size}")
    half = F.lit(size / 2.0)
    rois = tiles.withColumn("roi", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    cx = uniform_between(
        F.col("xmin") + half, F.col("xmax") - half, uniform(seed, "cx", "tile", "roi")
    )
    cy = uniform_between(
        F.col("ymin") + half, F.col("ymax") - half, uniform(seed, "cy", "tile", "roi")
    )
    return rois.withColumn("cx", cx).withColumn("cy", cy).select(
        "tile",
        "roi",
        *keep,
        (F.col("cx") - half).alias("xmin"),
        (F.col("cy") - half).alias("ymin"),
        (F.col("cx") + half).alias("xmax"),
        (F.col("cy") + half).alias("ymax"),
    )


def with_ring(boxes: DataFrame) -> DataFrame:
    return boxes.withColumn("ring", box_ring(*[F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")]))


def validate_rois(rois: DataFrame, size: float) -> DataFrame:
    """Per tile: number of boxes and whether total area and perimeter match the box size."""
    w, h = F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")
    n = F.count(F.lit(1))
    area_ok = F.sum(F.round(w * h).cast("long")) == n * F.lit(round(size * size))
    perimeter_ok = F.sum(F.round(2 * (w + h)).cast("long")) == n * F.lit(round(4 * size))
    return rois.groupBy("tile").agg(
        n.alias("n_roi"), area_ok.alias("area_ok"), perimeter_ok.alias("perimeter_ok")
    )


# ---------------------------------------------------------------- polygon selection

CELL_COLUMNS = 64  # widest block of pixel columns that pixels and runs are joined by
RUNS_AT_ONCE = 512  # runs of a block that a pixel meets as one row
DEALS = 4  # tasks that share the pixels of a block, where there are many runs
MOST_TASKS = 2000  # tasks that pixels are dealt out to
CURVE_RANGES = 256  # stretches of the curve that a scan takes as predicates


def cell_columns(rois: DataFrame, grid: PixelGrid) -> int:
    """Width of the blocks of pixel columns, for regions like these.

    About a quarter of a region's, a power of two and ``CELL_COLUMNS`` at most: a pixel then meets
    few runs of its block that end before it, and a run goes to few blocks.
    """
    first_x, last_x = grid.range_x("xmin", "xmax")
    wide = _with_bounds(rois).agg(F.avg((last_x - first_x + 1).cast("double"))).first()[0]
    cells = 1
    while wide is not None and 8 * cells <= wide and cells < CELL_COLUMNS:
        cells *= 2
    return cells


def roi_segments(rois: DataFrame, grid: PixelGrid, columns: int = CELL_COLUMNS) -> DataFrame:
    """Each region as runs of pixels: one row per pixel row and run, ``inside`` or not.

    A pixel row is cut at its crossings with the ring; by the even-odd rule the runs between
    them lie outside and inside in turn. Ring arithmetic is thus done once per region and
    pixel row, and a pixel only compares its centre with the two ends of a run. The table
    is small: the height of a region times its runs. Regions without a ring are boxes.

    ``_cell`` is the block of ``columns`` pixel columns a run reaches into, for use as a join key.
    """
    has_ring = "ring" in rois.columns
    origin = [c for c in (grid.x0, grid.y0) if isinstance(c, str)]
    regions = _with_bounds(rois)
    first_y, last_y = grid.range_y("ymin", "ymax")
    rows = regions.withColumn("y", F.explode(F.when(first_y <= last_y, F.sequence(first_y, last_y))))
    if has_ring:
        cuts = F.array_sort(ring_crossings(F.col("ring"), grid.center_y(F.col("y"))))
    else:
        # everything from the left edge of the box on; its right edge is tested by `in_box`
        cuts = F.array(F.col("xmin"))
    rows = rows.withColumn("_cuts", cuts)
    starts = F.concat(F.array(F.lit(float("-inf"))), F.col("_cuts"))
    ends = F.concat(F.col("_cuts"), F.array(F.lit(float("inf"))))
    rows = rows.select(
        "tile",
        "roi",
        "y",
        "xmin",
        "ymin",
        "xmax",
        "ymax",
        *origin,
        F.posexplode(F.arrays_zip(starts.alias("start"), ends.alias("end"))).alias("_i", "_run"),
    )
    # the part of the run that lies in the box; a run only goes to the blocks it reaches
    rows = rows.withColumns(
        {
            "start": F.col("_run.start"),
            "end": F.col("_run.end"),
            "_low": F.greatest(F.col("_run.start"), F.col("xmin")),
            "_high": F.least(F.col("_run.end"), F.col("xmax")),
        }
    )
    first_x, last_x = grid.range_x("_low", "_high")
    cells = F.sequence(F.floor(first_x / columns), F.floor(last_x / columns))
    return rows.select(
        "tile",
        "roi",
        "y",
        "xmin",
        "ymin",
        "xmax",
        "ymax",
        "start",
        "end",
        *origin,
        (F.col("_i") % 2 == 1).alias("inside"),
        F.explode(F.when((F.col("_low") <= F.col("_high")) & (first_x <= last_x), cells)).alias("_cell"),
    )


def _with_bounds(rois: DataFrame) -> DataFrame:
    """Bounding box columns of each ring; boxes without a ring keep their own."""
    if "ring" not in rois.columns:
        return rois
    b = ring_bounds(F.col("ring"))
    return rois.withColumn("_b", b).select(
        *[c for c in rois.columns if c not in ("xmin", "ymin", "xmax", "ymax")],
        *[F.col(f"_b.{c}").alias(c) for c in ("xmin", "ymin", "xmax", "ymax")],
    )


def _meet(cube, rois, grid: PixelGrid, how: str, own=False, inside=True) -> DataFrame:
    """Join pixels with the run of each region that their centre lies in.

    An equi-join on tile, pixel row and column block with two comparisons left over, and no
    cross product. The runs are written first: they are many more than the regions they come
    from, and only their true size may decide on a broadcast. Beyond that the join is
    sort-merged, and split where one block of a tile is hot. ``own`` also matches the
    region's number with the patch; ``inside`` leaves out the runs outside the rings.
    """
    columns = cell_columns(rois, grid)
    segments = roi_segments(rois, grid, columns)
    segments = segments.drop(*[c for c in (grid.x0, grid.y0) if isinstance(c, str)])
    segments = settle(segments.where("inside") if inside else segments, "regions")
    pixels = cube.withColumn("_cell", F.floor(F.col("x") / columns))
    p, s = pixels.alias("p"), segments.alias("s")
    on = [F.col(f"p.{k}") == F.col(f"s.{k}") for k in ("tile", "y", "_cell")]
    if own:
        on.append(F.col("p.patch_id") == F.col("s.roi"))
    px = grid.center_x(F.col("p.x"))
    on += [px >= F.col("s.start"), px < F.col("s.end")]
    on += [px >= F.col("s.xmin"), px <= F.col("s.xmax")]
    return p.join(s, on, how)


def _copies(
    cube, rois, grid: PixelGrid, keep: dict[str, Column], inside=True
) -> tuple[DataFrame, dict[str, str]]:
    """A copy of each pixel per run of a region that its centre lies in, and the names that the
    cube's columns have there.

    The join is that of ``_meet``, but the runs of a block come in rows of ``RUNS_AT_ONCE``, which a
    pixel meets once and then lays out: its own columns are evaluated per pixel, not per copy, and
    a copy costs three comparisons and no step of the join. ``keep`` are the columns of a run that
    its copies get.
    """
    columns = cell_columns(rois, grid)
    segments = roi_segments(rois, grid, columns)
    segments = segments.where("inside") if inside else segments
    block = ["tile", "y", "_cell"]
    # a copy's centre is at ``_low`` or after it, before ``_end`` and not after ``_xmax``
    start, xmin = F.col("start"), F.col("xmin")
    low = F.when(start >= xmin, start).when(start < xmin, xmin)
    bounds = {"_low": low, "_end": F.col("end"), "_xmax": F.col("xmax")}
    run = F.struct(*[c.alias(n) for n, c in {**bounds, **keep}.items()])
    order = Window.partitionBy(*block).orderBy("roi")
    part = F.floor((F.row_number().over(order) - 1) / RUNS_AT_ONCE)
    packed = segments.select(*block, run.alias("_run"), part.alias("_part"))
    packed = packed.groupBy(*block, "_part").agg(F.collect_list("_run").alias("_runs")).drop("_part")
    packed = settle(packed, "regions")
    pixels = cube.withColumn("_cell", F.floor(F.col("x") / columns))
    dates = [c for c in ("t",) if c in cube.columns]
    runs = packed.agg(F.sum(F.size("_runs"))).first()[0] or 0
    tasks = min(runs // RUNS_AT_ONCE, MOST_TASKS)
    if tasks > int(cube.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        # what a task makes does not show in the bytes it reads: blocks are dealt out by their
        # runs, the pixels of a block over ``DEALS`` places; so many runs are not broadcast
        packed = packed.withColumn("_deal", F.explode(F.array(*[F.lit(i) for i in range(DEALS)])))
        packed = packed.hint("merge")
        pixels = pixels.withColumn("_deal", F.pmod(F.hash(*dates, "x"), F.lit(DEALS)))
        block = [*block, "_deal"]
        pixels = pixels.repartition(tasks, *block)
    # a block's pixels follow each other date by date, so their copies reach the same few groups of
    # what comes next; the condition, always true, keeps the order from being left out before a join
    pixels = pixels.sortWithinPartitions(*block, *dates).where(F.spark_partition_id() >= 0)
    p, s = pixels.alias("p"), packed.alias("s")
    met = p.join(s, [F.col(f"p.{k}") == F.col(f"s.{k}") for k in block])
    names = {c: f"_p{i}" for i, c in enumerate(cube.columns)}
    px = grid.center_x(F.col("p.x"))
    met = met.select(*[F.col(f"p.{c}").alias(n) for c, n in names.items()], px.alias("_px"), F.inline("s._runs"))
    return met.where("_px >= _low and _px < _end and _px <= _xmax"), names


def filter_spatial(cube: DataFrame, rois: DataFrame, grid: PixelGrid) -> DataFrame:
    """Pixels whose centre lies in any region of their tile."""
    return _meet(cube, rois, grid, "left_semi").drop("_cell")


def sample_by_feature(cube: DataFrame, rois: DataFrame, grid: PixelGrid) -> DataFrame:
    """One copy of a pixel per region that contains it, with the region's ``roi``."""
    met, names = _copies(cube, rois, grid, {"_roi": F.col("roi")})
    return met.select(*[F.col(n).alias(c) for c, n in names.items()], F.col("_roi").alias("roi"))


def clip_polygon(cube, rois, bands, grid: PixelGrid, own=False) -> DataFrame:
    """Cut the cube to the bounding box of each region it meets; pixels of the box that lie
    outside the ring become no-data.

    Indices are re-based to the box, whose size is known from the pixel grid, so nothing
    but the region join moves data. ``own`` is for cubes that are stored per region
    (``patch_id`` is the region's number): each patch meets its own region only.
    """
    at = "s." if own else ""
    first_y, last_y = grid.range_y(f"{at}ymin", f"{at}ymax")
    first_x, last_x = grid.range_x(f"{at}xmin", f"{at}xmax")
    box = {"y": first_y, "x": first_x, "h": last_y - first_y + 1, "w": last_x - first_x + 1}
    if own:
        met, names = _meet(cube, rois, grid, "inner", own, inside=False), {c: f"p.{c}" for c in cube.columns}
        run = {"inside": F.col("s.inside"), "roi": F.col("s.roi"), **box}
    else:
        kept = {"_inside": F.col("inside"), "_roi": F.col("roi"), **{f"_{n}": c for n, c in box.items()}}
        met, names = _copies(cube, rois, grid, kept, inside=False)
        run = {n: F.col(f"_{n}") for n in ("inside", "roi", *box)}
    changed = {b: F.when(run["inside"], F.col(names[b])) for b in bands}
    changed["y"], changed["x"] = F.col(names["y"]) - run["y"], F.col(names["x"]) - run["x"]
    return met.select(
        *[changed.get(c, F.col(names[c])).alias(c) for c in cube.columns],
        run["roi"].alias("roi"),
        run["h"].alias("h"),
        run["w"].alias("w"),
    )


def curve_ranges(rois: DataFrame, grid: PixelGrid, limit=CURVE_RANGES) -> DataFrame:
    """``tile, low, high``: stretches of the curve that hold all pixels of the regions.

    A region's box is covered by at most 16 squares, each one stretch; stretches of a tile that
    overlap or touch are one. While there are more than ``limit``, the squares are made twice
    as wide and merged again, down to one stretch per tile; so what a scan takes as predicates
    has at most ``limit`` rows, or one row per tile if there are more tiles than that.
    """
    regions = _with_bounds(rois)
    first_y, last_y = grid.range_y("ymin", "ymax")
    first_x, last_x = grid.range_x("xmin", "xmax")
    boxes = regions.select("tile", first_y.alias("y0"), last_y.alias("y1"), first_x.alias("x0"), last_x.alias("x1"))
    boxes = boxes.where("y0 <= y1 and x0 <= x1")
    side = F.greatest(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0")) + 1
    level = F.greatest(F.lit(0), F.ceil(F.log2(side / F.lit(3)))).cast("int")
    boxes = boxes.withColumn("level", level)

    def steps(low, high):  # corners of the squares, as pixel indices
        at = f"transform(sequence(shiftright({low} + {OFFSET}, level), shiftright({high} + {OFFSET}, level)), i -> shiftleft(i, level) - {OFFSET})"
        return F.explode(F.expr(at))

    cells = boxes.withColumn("y", steps("y0", "y1")).withColumn("x", steps("x0", "x1"))
    low = position(F.col("y"), F.col("x"))
    spans = cells.select("tile", low.alias("low"), (low + F.expr("shiftleft(1L, 2 * level)") - 1).alias("high"))

    def merged(spans):
        order = Window.partitionBy("tile").orderBy("low", "high")
        reach = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
        begins = (F.coalesce(reach, F.lit(-2)) + 1 < F.col("low")).cast("int")
        runs = spans.distinct().withColumn("_new", begins).withColumn("_run", F.sum("_new").over(order))
        return settle(runs.groupBy("tile", "_run").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("_run"), "curve-ranges")

    found, bits = merged(spans), 0
    while found.count() > limit and bits < 62:
        bits += 2
        wide = F.expr(f"shiftleft(shiftright(low, {bits}), {bits})").alias("low")
        found = merged(found.select("tile", wide, F.col("high").bitwiseOR(F.lit((1 << bits) - 1)).alias("high")))
    return found


def match_rois(rois: DataFrame, files: DataFrame) -> DataFrame:
    """Pair region ``roi`` of a tile with the scene files ``.../openEO_{roi}.nc`` of that tile."""
    number = F.regexp_extract("path", r"/openEO_(\d+)\.nc$", 1)
    scenes = (
        files.where(number != "")
        .withColumn("roi", number.cast("int"))
        .withColumn("tile", F.element_at(F.split("path", "/"), 1))
    )
    return rois.join(scenes, ["tile", "roi"])
