"""Bringing a longitude/latitude grid onto the metric grids of tiles.

The target's pixels are mapped back to the source. Exact inverse projection is done at the
corners of a lattice of target pixels only; within a lattice cell a pixel's place on the source
is interpolated between the four corners, which is closer than a thousandth of a source cell
for cells of some kilometres. A lattice cell's pixels reach a small window of source cells. The
source is cut into blocks that overlap by a window, so that every lattice cell finds its whole
window in the one block that holds the window's corner: packs of lattice cells meet the images
of their block in one join, and the many target pixels are only made after that, in their row's
task. A block that many lattice cells want is copied, a copy for every ``PIXELS`` target pixels.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylattice.functions.geometry import to_lonlat
from skylattice.session import settle

SPACING = 8  # target pixels between lattice points
LEAST_WEIGHT = 0.5  # of the cubic kernel's weights that a pixel's known neighbours must have
PIXELS = 500_000  # target pixels that a task makes
SIDE = 8  # least side of a block, in source cells
PACK = 8  # a pack holds at most so many lattice cells a side
AT_ONCE = 60_000  # target pixels, or cells of blocks, that are arrays at a time
CORNERS = [(0, 0), (0, 1), (1, 0), (1, 1)]


@dataclass(frozen=True)
class LonLatGrid:
    """North-west corner and cell size in degrees; row 0 is the northernmost."""

    lon0: float
    lat0: float
    step: float


def lattice_cells(grids: DataFrame, source: LonLatGrid, spacing: int = SPACING) -> DataFrame:
    """Cells of ``spacing`` pixels of each target grid, with ``sy, sx`` of their four corners.

    ``grids``: tile, x0, y0 (north-west corner in metres), res, h, w, zone, south. A corner is
    the centre of a target pixel; ``sy, sx`` are places on the source, whole numbers at the
    centres of its cells.
    """

    def steps(size: str) -> Column:
        return F.explode(F.expr(f"sequence(0, cast(floor(({size} - 1) / {spacing}) as int))"))

    cells = grids.withColumn("cy", steps("h")).withColumn("cx", steps("w"))
    rows, cols = [], []
    for dy, dx in CORNERS:
        east = F.col("x0") + ((F.col("cx") + dx) * spacing + F.lit(0.5)) * F.col("res")
        north = F.col("y0") - ((F.col("cy") + dy) * spacing + F.lit(0.5)) * F.col("res")
        lon, lat = to_lonlat(east, north, F.col("zone"), F.col("south"))
        cols.append((lon - F.lit(source.lon0)) / F.lit(source.step) - F.lit(0.5))
        rows.append((F.lit(source.lat0) - lat) / F.lit(source.step) - F.lit(0.5))
    return cells.select("tile", "h", "w", "cy", "cx", F.array(*rows).alias("sy"), F.array(*cols).alias("sx"))


def cubic_weights(f: np.ndarray) -> list[np.ndarray]:
    """Keys cubic weights (a = -1/2) of the neighbours -1, 0, 1, 2 of a place ``f`` after number 0."""
    out = []
    for k in range(-1, 3):
        d = np.abs(f - k)
        near = 1.5 * d * d * d - 2.5 * d * d + 1.0
        far = -0.5 * d * d * d + 2.5 * d * d - 4.0 * d + 2.0
        out.append(np.where(d <= 1, near, np.where(d < 2, far, 0.0)))
    return out


def _numbers(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False)


def _flat(lists: pa.Array) -> tuple[pa.StructArray, np.ndarray]:
    """All structs of a column of lists, and the row of each."""
    return pc.list_flatten(lists), _numbers(pc.list_parent_indices(lists)).astype(np.int64)


class _Pixels:
    """Target pixels of some rows, each a pack of lattice cells with a block of one image."""

    def __init__(self, rows: pa.RecordBatch, spacing: int):
        cells, row = _flat(rows.column("_cells"))
        part = {f.name: cells.field(f.name) for f in cells.type}
        get = {c: _numbers(part[c]).astype(np.int64) for c in ("cy", "cx", "h", "w", "n", "top", "bottom", "left", "right")}
        sy, sx = (_numbers(part[c].flatten()).reshape(-1, 4) for c in ("sy", "sx"))
        self.entries, self.at = _flat(rows.column("_block"))
        iy, ix = (_numbers(self.entries.field(c)).astype(np.int64) for c in ("_iy", "_ix"))
        # the dense blocks of all rows one after the other, each with the origin of its row
        side = _numbers(rows.column("_side")).astype(np.int64)
        self.wide = 2 * side + 4
        self.y0, self.x0 = (_numbers(rows.column(c)).astype(np.int64) * side - 2 for c in ("_by", "_bx"))
        size = self.wide * self.wide
        self.first, self.total = np.cumsum(size) - size, int(size.sum())
        self.cells = self.place(self.at, iy, ix)
        # a lattice cell is left out if no source cell of its window has a row
        there = np.zeros(self.total, bool)
        there[self.cells] = True
        some = np.zeros(len(row), bool)
        deep = (get["bottom"] - get["top"] + 1).max(initial=0), (get["right"] - get["left"] + 1).max(initial=0)
        for dy in range(int(deep[0])):
            for dx in range(int(deep[1])):
                y, x = get["top"] + dy, get["left"] + dx
                inside = (y <= get["bottom"]) & (x <= get["right"])
                some |= inside & there[np.where(inside, self.place(row, y, x), 0)]
        # the pixels of the others
        step = np.arange(spacing)
        y = (get["cy"] * spacing)[:, None, None] + step[None, :, None]
        x = (get["cx"] * spacing)[:, None, None] + step[None, None, :]
        cell, ry, rx = np.nonzero((y < get["h"][:, None, None]) & (x < get["w"][:, None, None]) & some[:, None, None])
        self.y, self.x = get["cy"][cell] * spacing + ry, get["cx"][cell] * spacing + rx
        self.row, self.times = row[cell], get["n"][cell]
        fy, fx = ry / float(spacing), rx / float(spacing)
        self.py, self.px = self.between(sy[cell], fy, fx), self.between(sx[cell], fy, fx)
        self.known = np.isfinite(self.py) & np.isfinite(self.px)
        self.py, self.px = np.where(self.known, self.py, 0.0), np.where(self.known, self.px, 0.0)

    @staticmethod
    def between(c: np.ndarray, fy: np.ndarray, fx: np.ndarray) -> np.ndarray:
        """Bilinear interpolation between the corners of a cell."""
        upper = c[:, 0] + (c[:, 1] - c[:, 0]) * fx
        lower = c[:, 2] + (c[:, 3] - c[:, 2]) * fx
        return upper + (lower - upper) * fy

    def place(self, row, y, x) -> np.ndarray:
        return self.first[row] + (y - self.y0[row]) * self.wide[row] + (x - self.x0[row])

    def dense(self, name: str) -> np.ndarray:
        out = np.zeros(self.total)
        out[self.cells] = _numbers(self.entries.field(name).fill_null(0.0))
        return out

    def near(self, bands: int) -> list[pa.Array]:
        iy, ix = (np.floor(p + 0.5).astype(np.int64) for p in (self.py, self.px))
        at = self.place(self.row, np.where(self.known, iy, self.y0[self.row]), np.where(self.known, ix, self.x0[self.row]))
        return [pa.array(self.dense(f"v{b}")[at], mask=~((self.dense(f"w{b}")[at] > 0) & self.known)) for b in range(bands)]

    def cubic(self, bands: int) -> list[pa.Array]:
        iy, ix = np.floor(self.py).astype(np.int64), np.floor(self.px).astype(np.int64)
        wy, wx = cubic_weights(self.py - iy), cubic_weights(self.px - ix)
        wide = self.wide[self.row]
        corner = self.place(self.row, np.where(self.known, iy, self.y0[self.row] + 1), np.where(self.known, ix, self.x0[self.row] + 1))
        values, counts = ([self.dense(f"{c}{b}") for b in range(bands)] for c in "vw")
        sums, weights = ([np.zeros(len(self.y)) for _ in range(bands)] for _ in "vw")
        for j in range(4):
            for k in range(4):
                at, weight = corner + (j - 1) * wide + (k - 1), wy[j] * wx[k]
                # at the end of the kernel's reach not even an infinite value counts
                beyond = (self.py == iy) & (j == 3) | (self.px == ix) & (k == 3)
                for b in range(bands):
                    value = values[b][at]
                    sums[b] += weight * (np.where(beyond, 0.0, value) if max(j, k) == 3 else value)
                    weights[b] += weight * counts[b][at]
        out = []
        for sum_, weight in zip(sums, weights):
            known = self.known & (weight * self.times >= LEAST_WEIGHT)
            out.append(pa.array(np.divide(sum_, weight, out=np.zeros(len(sum_)), where=known), mask=~known))
        return out


def _slices(batch: pa.RecordBatch, spacing: int):
    """A batch in parts whose pixels and blocks are not too many at a time."""
    pixels = _numbers(pc.list_value_length(batch.column("_cells"))).astype(np.int64) * spacing * spacing
    cells = 4 * _numbers(batch.column("_side")).astype(np.int64) ** 2
    part = (np.cumsum(np.maximum(pixels, cells)) - 1) // AT_ONCE
    begins = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(begins, [*begins[1:], batch.num_rows]):
        yield batch.slice(a, b - a)


def warp_to(
    cube: DataFrame,
    bands: list[str],
    source: LonLatGrid,
    grids: DataFrame,
    keys: list[str],
    method="cubic",
    spacing: int = SPACING,
) -> DataFrame:
    """``tile``, ``keys``, ``y``, ``x`` and ``bands``: the cube on each target grid.

    ``keys`` tell one image of the source from another (a date, a variable's name), NULLs
    included; y and x of the cube are source indices. ``cubic`` leaves out missing neighbours
    and normalises the weights of the others; a pixel whose known neighbours have less than
    half of the weight is NULL. ``near`` takes the source cell whose centre is nearest. A pixel
    is absent where no source cell near its lattice cell has a row. The smaller ``spacing``, the
    smaller the windows; a source as fine as the target wants few pixels.
    """
    if method not in ("cubic", "near"):
        raise ValueError(f"unknown resampling method {method!r}")
    # rows and columns of the source that a lattice cell's pixels can reach
    def ends(corners: str) -> list[Column]:
        low, high = F.floor(F.array_min(corners)).cast("int") - 1, F.floor(F.array_max(corners)).cast("int") + 2
        return [F.least(low, high), F.greatest(low, high)]

    cells = lattice_cells(grids, source, spacing)
    names = ["h", "w", "sy", "sx"]
    # repeated grids are one, and their source cells count as often
    cells = cells.groupBy("tile", "cy", "cx").agg(F.first(F.struct(*names)).alias("_cell"), F.count("*").alias("n"))
    cells = cells.select("tile", "cy", "cx", "n", "_cell.*")
    bounds = zip(("top", "bottom", "left", "right"), [*ends("sy"), *ends("sx")])
    cells = cells.withColumns(dict(bounds)).where("top is not null and left is not null")
    reach = F.greatest(F.col("bottom") - F.col("top"), F.col("right") - F.col("left")) + 1
    # the least power of two, so that there are few sizes of blocks
    cells = cells.withColumn("_reach", reach)
    cells = cells.withColumn("_side", F.expr(f"greatest({SIDE}, shiftleft(1, cast(ceil(log2(_reach)) as int)))"))
    block = {"_by": F.floor(F.col("top") / F.col("_side")).cast("int"), "_bx": F.floor(F.col("left") / F.col("_side")).cast("int")}
    where = ["_side", "_by", "_bx"]
    pack = [F.floor(F.col(c) / PACK).alias(f"_{c}") for c in ("cy", "cx")]
    cell = F.struct("cy", "cx", "n", *names, "top", "bottom", "left", "right")
    packs = cells.withColumns(block).groupBy(*where, "tile", *pack).agg(F.collect_list(cell).alias("_cells"))
    packs = settle(packs, "warp-cells")
    wanted = settle(packs.groupBy(*where).agg(F.sum(F.size("_cells")).alias("n")), "warp-wanted")

    # every source cell goes to the blocks whose windows can hold it: those of its own place and
    # of a side before
    sides = [r[0] for r in wanted.select("_side").distinct().collect()]
    values = [F.when(~F.isnan(F.col(b)), F.col(b).cast("double")).alias(f"v{i}") for i, b in enumerate(bands)]
    pixels = cube.select(F.struct(*keys).alias("_key"), F.col("y").alias("_iy"), F.col("x").alias("_ix"), *values)
    pixels = pixels.where("_iy is not null and _ix is not null")
    spread = pixels.withColumn("_side", F.explode(F.array([F.lit(s) for s in sides]).cast("array<int>")))
    for b, i in (("_by", "_iy"), ("_bx", "_ix")):
        own = F.floor(F.col(i) / F.col("_side")).cast("int")
        spread = spread.withColumn(b, F.explode(F.array(own - 1, own)))
    spread = spread.join(wanted, where, "left_semi")
    # repeated source cells: all count for cubic, the least of them for near
    n = len(bands)
    if method == "near":
        spread = spread.groupBy(*where, "_key", "_iy", "_ix").agg(F.min(F.struct(*[f"v{i}" for i in range(n)])).alias("_v"))
        entry = [F.col(f"_v.v{i}").alias(f"v{i}") for i in range(n)]
        entry += [F.col(f"_v.v{i}").isNotNull().cast("double").alias(f"w{i}") for i in range(n)]
    else:
        sums = [F.sum(f"v{i}").alias(f"v{i}") for i in range(n)] + [F.count(f"v{i}").cast("double").alias(f"w{i}") for i in range(n)]
        spread = spread.groupBy(*where, "_key", "_iy", "_ix").agg(*sums)
        entry = [f"{c}{i}" for c in "vw" for i in range(n)]
    blocks = spread.groupBy(*where, "_key").agg(F.collect_list(F.struct("_iy", "_ix", *entry)).alias("_block"))
    blocks = settle(blocks, "warp-blocks")

    # the packs are small and the pixels many: a block has a copy per so many pixels
    images = blocks.groupBy(*where).agg(F.count("*").alias("_images"))
    counted = wanted.join(images, where)
    total = counted.agg(F.sum(F.col("n") * F.col("_images"))).first()[0] or 0
    total *= spacing * spacing
    least = cube.sparkSession.sparkContext.defaultParallelism
    share = max(min(PIXELS, total // (4 * least)), 10_000)
    copies = F.ceil(F.col("n") * F.col("_images") * spacing * spacing / F.lit(float(share))).cast("int")
    copies = settle(counted.select(*where, copies.alias("_copies")), "warp-copies")
    tasks = total // share + 1
    to = [*where, "_copy"]
    met = packs.join(copies, where)
    met = met.withColumn("_copy", F.pmod(F.xxhash64("tile", "_cy", "_cx"), F.col("_copies")).cast("int")).repartition(tasks, *to)
    images = blocks.join(copies, where).withColumn("_copy", F.explode(F.expr("sequence(0, _copies - 1)"))).repartition(tasks, *to)
    met = met.join(images, to).select("tile", "_key", *where, "_cells", "_block")

    fields = [met.schema["tile"], met.schema["_key"], T.StructField("y", T.IntegerType()), T.StructField("x", T.IntegerType())]
    fields += [T.StructField(f"v{i}", T.DoubleType()) for i in range(n)]

    def run(batches):
        for batch in batches:
            for rows in _slices(batch, spacing):
                found = _Pixels(rows, spacing)
                columns = [rows.column(c).take(pa.array(found.row)) for c in ("tile", "_key")]
                columns += [pa.array(c, pa.int32()) for c in (found.y, found.x)]
                columns += found.near(n) if method == "near" else found.cubic(n)
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    rows = met.mapInArrow(run, T.StructType(fields))
    return rows.select("tile", *[F.col("_key")[k].alias(k) for k in keys], "y", "x", *[F.col(f"v{i}").alias(b) for i, b in enumerate(bands)])
