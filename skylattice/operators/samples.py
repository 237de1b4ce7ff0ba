"""Dense frames and training samples.

A sample is kept as one row per date (``frames``) plus one row with its time axis
(``heads``). Both are bounded by the grid and the calendar: a frame has h*w pixels however
many source rows it is built from, and a head has one entry per distinct date. The single
nested array of a whole sample is only built after its length was fixed by ``max_len``.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylattice.functions.arrays import (
    append_fill,
    crop_pixels,
    fit_length,
    padding_mask,
    swap_axes,
    take_at,
)
from skylattice.functions.dates import days_since, doy_fraction
from skylattice.schema import FRAME, KEY

SAMPLE_ID = ["crop_id", "rep", "year", "roi"]


def frame_keys(df: DataFrame) -> list[str]:
    """Frame key of a table, including whatever tells several samples of a patch apart."""
    return [*FRAME, *[c for c in SAMPLE_ID if c in df.columns]]


def sample_keys(df: DataFrame) -> list[str]:
    return [k for k in frame_keys(df) if k != "t"]


# ---------------------------------------------------------------- frames


def to_frames(cube, bands, h: int, w: int, fill=0, complete=False, fills=None) -> DataFrame:
    """One row per frame with one row-major array of h*w pixels per band.

    Pixels given several times are combined first (largest value), on the map side, so what
    is collected per frame is the grid and not the rows. Pixels that are absent or NULL
    become ``fill``, or what ``fills`` names for a band. A pixel off the grid is an error.
    ``complete`` promises that every frame has all its pixels, which spares
    looking for absent ones. The cube is read once.
    """
    keys = frame_keys(cube)
    on_grid = F.col("y").between(0, h - 1) & F.col("x").between(0, w - 1)
    off = F.concat(F.lit(f"pixel outside the {h} x {w} grid: y, x = "), F.concat_ws(", ", "y", "x"))
    pos = F.when(on_grid, (F.col("y") * F.lit(w) + F.col("x")).cast("int")).otherwise(
        F.raise_error(off).cast("int")
    )
    rows = cube.select(*keys, pos.alias("pos"), *bands)
    pixels = rows.groupBy(*keys, "pos").agg(*[F.max(b).alias(b) for b in bands])
    frames = pixels.groupBy(*keys).agg(F.collect_list(F.struct("pos", *bands)).alias("_grid"))
    if not complete:
        # absent pixels are laid out within the frame's row: none of them is shuffled
        absent = F.array_except(F.sequence(F.lit(0), F.lit(h * w - 1)), F.col("_grid.pos"))
        nothing = [F.lit(None).cast(cube.schema[b].dataType).alias(b) for b in bands]
        absent = F.transform(absent, lambda p: F.struct(p.alias("pos"), *nothing))
        frames = frames.withColumn("_grid", F.concat("_grid", absent))
    frames = frames.withColumn("_grid", F.array_sort("_grid"))

    def layer(band: str) -> Column:
        values = F.col("_grid")[band]
        own = (fills or {}).get(band, fill)
        if own is None:
            return values
        return F.transform(values, lambda v: F.coalesce(v, F.lit(own).cast(cube.schema[band].dataType)))

    return frames.select(
        *keys, F.lit(h).alias("h"), F.lit(w).alias("w"), *[layer(b).alias(b) for b in bands]
    )


def from_frames(frames: DataFrame, bands: list[str]) -> DataFrame:
    """Pixel rows of dense frames; inverse of ``to_frames``."""
    keys = frame_keys(frames)
    pixels = F.arrays_zip(*[F.col(b).alias(b) for b in bands])
    rows = frames.select(*keys, "w", F.posexplode(pixels).alias("pos", "_p"))
    y = F.floor(F.col("pos") / F.col("w")).cast("int")
    return rows.select(
        *keys,
        y.alias("y"),
        (F.col("pos") - y * F.col("w")).alias("x"),
        *[F.col("_p")[b].alias(b) for b in bands],
    )


def flatten_pixels(frames: DataFrame, bands: list[str], crop: int | None = None) -> DataFrame:
    """Pixel rows of the top-left ``crop`` x ``crop`` window (all pixels by default)."""
    if crop is not None:
        frames = crop_frames(frames, bands, F.lit(0), F.lit(0), crop)
    return from_frames(frames, bands)


def crop_frames(frames, bands, row0: Column, col0: Column, size: int) -> DataFrame:
    """Cut all bands of each frame to the same window."""
    cut = {b: crop_pixels(F.col(b), F.col("w"), row0, col0, size) for b in bands}
    # the size is replaced in a second step: the crops still need the old width
    return frames.withColumns(cut).withColumns({"h": F.lit(size), "w": F.lit(size)})


def tile_frames(frames, bands, h: int, w: int, size: int, mode="diagonal") -> DataFrame:
    """Frames cut into crops with a ``crop_id``; no pixel leaves its row."""
    if h == w == size:
        return frames.withColumn("crop_id", F.lit(0))
    if h != w or w % size:
        raise ValueError(f"cannot cut {h} x {w} frames into crops of {size}")
    n = w // size
    if mode not in ("diagonal", "grid"):
        raise ValueError(f"unknown tiling mode {mode!r}")
    count = n if mode == "diagonal" else n * n
    rows = frames.withColumn("crop_id", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    block = F.col("crop_id")
    by, bx = (block, block) if mode == "diagonal" else (F.floor(block / n), block % n)
    row0, col0 = (by * size).cast("int"), (bx * size).cast("int")
    return crop_frames(rows, bands, row0, col0, size)


def frame_quality(frames, nodata_band=None, cloud="clm", scene_class="scl") -> DataFrame:
    """``date_quality`` of frames stored with their no-data (fill NULL): a narrow step."""

    def count(band: str, test) -> Column:
        return F.size(F.filter(F.col(band), test)).cast("long")

    cols = {"n": (F.col("h") * F.col("w")).cast("long")}
    if nodata_band:
        cols["n_nan"] = count(nodata_band, lambda v: v.isNull() | F.isnan(v))
    if cloud in frames.columns:
        cols["n_cld"] = count(cloud, lambda v: v == 1)
    if scene_class in frames.columns:
        cols["n_scl0"] = count(scene_class, lambda v: v == 0)
    return frames.withColumns(cols)


# ---------------------------------------------------------------- time axis


def sample_heads(frames: DataFrame) -> DataFrame:
    """One row per sample: its dates, their day numbers and fractions of the year.

    A static layer is one frame without a date: ``n_dates`` is 1 and the arrays hold NULL.
    """
    keys = sample_keys(frames)
    # collect_set leaves out the NULL date of a static layer
    found = F.array_sort(F.collect_set("t"))
    dates = F.when(F.count("t") < F.count("*"), F.concat(F.array(F.lit(None).cast("date")), found))
    heads = frames.select(*keys, "t").distinct().groupBy(*keys).agg(dates.otherwise(found).alias("dates"))
    return heads.select(
        *keys,
        F.size("dates").alias("n_dates"),
        F.transform("dates", lambda t: days_since(t)).alias("doy"),
        F.transform("dates", lambda t: doy_fraction(t).cast("float")).alias("true_doy"),
    )


def with_time_encoding(frames: DataFrame) -> DataFrame:
    return frames.withColumns(
        {"doy": days_since("t"), "true_doy": doy_fraction("t").cast("float")}
    )


def with_time_index(frames: DataFrame) -> DataFrame:
    """Position ``ti`` of each frame on its sample's time axis; a static layer is first.

    A window holds one entry per date of a sample.
    """
    order = Window.partitionBy(*sample_keys(frames)).orderBy("t")
    return frames.withColumn("ti", F.row_number().over(order) - 1)


def pad_heads(heads: DataFrame, max_len: int) -> DataFrame:
    """Time arrays of exactly ``max_len`` entries and the mask of the padded ones."""
    mask = padding_mask(F.col("n_dates"), max_len)
    return heads.withColumns(
        {
            "doy": fit_length(F.col("doy"), max_len, F.lit(0)),
            "true_doy": fit_length(F.col("true_doy"), max_len, F.lit(0.0).cast("float")),
            "padd_mask": mask,
        }
    )


def pad_time(frames, bands, h: int, w: int, max_len: int) -> DataFrame:
    """Series of exactly ``max_len`` frames: later ones are cut, missing ones are zero.

    Padded frames have no date (``t`` NULL) and ``padded`` true; ``ti`` numbers all frames.
    A static layer is not padded: its one frame stands for all dates.
    """
    keys = sample_keys(frames)
    encoded = with_time_encoding(with_time_index(frames)).where(F.col("ti") < max_len)
    encoded = encoded.withColumn("padded", F.lit(False))
    lengths = frames.groupBy(*keys).agg(F.count("*").cast("int").alias("_n"), F.count("t").alias("_dated"))
    lengths = lengths.where("_dated > 0").drop("_dated")
    tail = F.when(
        F.col("_n") < max_len, F.sequence(F.col("_n"), F.lit(max_len - 1))
    )
    zeros = {
        b: F.array_repeat(F.lit(0).cast(frames.schema[b].dataType.elementType), h * w)
        for b in bands
    }
    padding = lengths.withColumn("ti", F.explode(tail)).drop("_n").withColumns(
        {
            **zeros,
            "h": F.lit(h),
            "w": F.lit(w),
            "doy": F.lit(0),
            "true_doy": F.lit(0.0).cast("float"),
            "padded": F.lit(True),
        }
    )
    return encoded.unionByName(padding, allowMissingColumns=True)


def append_frames(frames, bands, h: int, w: int, k: int) -> DataFrame:
    """``k`` zero frames after the last date of every sample."""
    if k == 0:
        return with_time_index(frames).withColumn("padded", F.lit(False))
    keys = sample_keys(frames)
    lengths = frames.groupBy(*keys).agg(F.count("*").cast("int").alias("_n"))
    zeros = {
        b: F.array_repeat(F.lit(0).cast(frames.schema[b].dataType.elementType), h * w)
        for b in bands
    }
    padding = (
        lengths.withColumn("ti", F.explode(F.sequence(F.col("_n"), F.col("_n") + (k - 1))))
        .drop("_n")
        .withColumns({**zeros, "h": F.lit(h), "w": F.lit(w), "padded": F.lit(True)})
    )
    own = with_time_index(frames).withColumn("padded", F.lit(False))
    return own.unionByName(padding, allowMissingColumns=True)


# ---------------------------------------------------------------- samples


def to_samples(frames: DataFrame, bands: list[str], h: int, w: int, max_len: int) -> DataFrame:
    """One row per sample: ``sits[band][date][pixel]``, time axis and padding mask.

    Every sample has exactly ``max_len`` frames of h*w pixels, so the collected size is
    fixed by the arguments.
    """
    keys = sample_keys(frames)
    padded = pad_time(frames, bands, h, w, max_len)
    packed = F.array_sort(F.collect_list(F.struct("ti", "doy", "true_doy", "padded", *bands)))
    grouped = padded.groupBy(*keys).agg(packed.alias("_s"))
    return grouped.select(
        *keys,
        F.lit(h).alias("h"),
        F.lit(w).alias("w"),
        F.array(*[F.lit(b) for b in bands]).alias("bands"),
        F.col("_s.doy").alias("doy"),
        F.col("_s.true_doy").alias("true_doy"),
        F.col("_s.padded").alias("padd_mask"),
        F.array(*[F.col("_s")[b] for b in bands]).alias("sits"),
    )


def from_samples(samples: DataFrame) -> DataFrame:
    """Pixel values of samples: (keys, band, ti, y, x, doy, value, padded)."""
    keys = [c for c in [*KEY, *SAMPLE_ID] if c in samples.columns]
    per_band = samples.select(
        *keys, "w", "bands", "doy", "padd_mask", F.posexplode("sits").alias("_b", "_band")
    )
    per_date = per_band.select(
        *keys,
        "w",
        F.element_at("bands", F.col("_b") + 1).alias("band"),
        "doy",
        "padd_mask",
        F.posexplode("_band").alias("ti", "_px"),
    )
    rows = per_date.select(
        *keys,
        "w",
        "band",
        "ti",
        F.element_at("doy", F.col("ti") + 1).alias("doy"),
        F.element_at("padd_mask", F.col("ti") + 1).alias("padded"),
        F.posexplode("_px").alias("pos", "value"),
    )
    y = F.floor(F.col("pos") / F.col("w")).cast("int")
    return rows.select(
        *keys, "band", "ti", "doy", "padded", y.alias("y"),
        (F.col("pos") - y * F.col("w")).alias("x"), "value",
    )


def permute(samples: DataFrame, name="sits") -> DataFrame:
    """[band][date] <-> [date][band]."""
    return samples.withColumn(name, swap_axes(F.col(name)))


def select_dates(samples: DataFrame, positions: list[int], pad=0) -> DataFrame:
    """The listed dates of each sample, then ``pad`` zero dates, on arrays."""
    at = F.array(*[F.lit(int(p)) for p in positions])
    element = samples.schema["sits"].dataType.elementType.elementType.elementType
    zero_frame = F.array_repeat(F.lit(0).cast(element), F.col("h") * F.col("w"))

    def chosen(name: str, fill: Column) -> Column:
        return append_fill(take_at(F.col(name), at), pad, fill)

    return samples.withColumns(
        {
            "sits": F.transform("sits", lambda band: append_fill(take_at(band, at), pad, zero_frame)),
            "doy": chosen("doy", F.lit(0)),
            "true_doy": chosen("true_doy", F.lit(0.0).cast("float")),
            "padd_mask": chosen("padd_mask", F.lit(True)),
        }
    )
