"""From raw cubes to training samples."""

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylattice.constants import (
    DEM_BANDS,
    MAX_NODATA_FRACTION,
    OPTIONS,
    S1_BANDS,
    S2_BANDS,
    SERIES_END,
    SERIES_START,
    WEATHER_BANDS,
    WINDOW_MONTHS,
)
from skylattice.functions.masks import nan_count_of
from skylattice.operators.merge import union_all
from skylattice.operators.quality import (
    clean_missing,
    date_quality,
    join_frames,
    usable_frames,
)
from skylattice.operators.samples import to_frames, with_time_encoding
from skylattice.operators.select import cast_bands
from skylattice.operators.spatial import tile_crops
from skylattice.operators.timeline import crop_time_random, slice_years
from skylattice.schema import KEY
from skylattice.session import settle
from skylattice.sources.cubes import pending


@dataclass(frozen=True)
class Modality:
    """How one modality is converted.

    ``nodata_band`` is the band whose missing share drops a date; without it no date is
    dropped for missing data. ``cloud`` and ``scene_class`` name the mask bands if any.
    """

    name: str
    bands: list[str] = field(default_factory=list)
    nodata_band: str | None = None
    cloud: str | None = None
    scene_class: str | None = None
    dtype: str = "float"


OPTICAL = Modality("s2", S2_BANDS, S2_BANDS[0], "CLM", "SCL", "smallint")
RADAR_ASC = Modality("s1_asc", S1_BANDS)
RADAR_DESC = Modality("s1_desc", S1_BANDS)
# the multimodal set also drops radar dates by their missing share
RADAR = ("s1_asc", "s1_desc")
ELEVATION = Modality("dem", DEM_BANDS)
WEATHER = Modality("agera5", WEATHER_BANDS)
BY_NAME = {m.name: m for m in (OPTICAL, RADAR_ASC, RADAR_DESC, ELEVATION, WEATHER)}


def modalities_for(opt: str) -> list[Modality]:
    """The modalities an option selects. Elevation is static: its frames have no date."""
    return [BY_NAME[name] for name in OPTIONS[opt]]


def open_frames(
    cube, m: Modality, max_cloud=None, max_nodata=MAX_NODATA_FRACTION, done=None, area=None
):
    """Keys of the usable frames of one modality that are not done yet.

    ``area`` is the number of pixels of a whole frame: absent ones count as missing.

    They are written once: the true size of the key table then decides whether the pixels
    meet it by broadcast (no shuffle of the cube) or by a sort-merge join.
    """
    wants_cloud = max_cloud is not None and m.cloud is not None
    quality = date_quality(
        cube.where(F.col("modality") == m.name),
        m.nodata_band,
        m.cloud if wants_cloud else None,
        m.scene_class if wants_cloud else None,
        area,
    )
    frames = usable_frames(quality, max_nodata, max_cloud if wants_cloud else None)
    if done is not None:
        frames = pending(frames, done, KEY)
    return settle(frames, "open-frames")


def prepare(cube, m: Modality, frames: DataFrame) -> DataFrame:
    """Cleaned pixels of the given frames, with the count of missing bands.

    Columns that ``frames`` has beyond the frame key (repetition, year) come along; a frame
    that is listed several times gives several copies of its pixels.
    """
    rows = join_frames(cube.where(F.col("modality") == m.name), frames)
    # clean before casting: a cast would turn missing values into numbers or errors
    rows = clean_missing(rows, m.bands)
    rows = rows.withColumn("mask_nan", nan_count_of(rows, m.bands))
    return cast_bands(rows, m.bands, m.dtype)


def _layers(m: Modality) -> list[str]:
    return [*m.bands, "mask_nan", *[b for b in (m.cloud, m.scene_class) if b]]


def sample_frames(rows, m: Modality, h, w, crop, tiling="diagonal") -> DataFrame:
    """Dense frames of each crop with encoded dates. Crops are cut from the pixel rows, so
    pixels outside every crop are not shuffled."""
    cut = tile_crops(rows, h, w, crop, tiling)
    # a pixel that is absent misses all its bands
    absent = {"mask_nan": len(m.bands)}
    return with_time_encoding(to_frames(cut, _layers(m), crop, crop, fill=0, fills=absent))


def not_done(frames: DataFrame, done: DataFrame | None, more: list[str]) -> DataFrame:
    """Frames whose sample is not stored yet. A sample is a patch's repetition or year, so
    one that is stored does not hide the others; a run that broke off goes on."""
    if done is None:
        return frames
    return pending(frames, done, [*KEY, *[k for k in more if k in done.columns]])


def convert(
    cube,
    modalities: list[Modality],
    h,
    w,
    crop,
    max_cloud=0.5,
    done=None,
    tiling="diagonal",
    whole_frames=True,
) -> DataFrame:
    """Sample frames of every patch and modality that is not in ``done`` yet.

    The date tests take a frame as h*w pixels, of which absent ones are missing; without
    ``whole_frames`` a frame is the pixels it has rows for.
    """
    area = h * w if whole_frames else None

    def one(m: Modality) -> DataFrame:
        frames = open_frames(cube, m, max_cloud, done=done, area=area)
        return sample_frames(prepare(cube, m, frames), m, h, w, crop, tiling)

    return union_all(*[one(m) for m in modalities])


def yearly_convert(
    cube,
    modalities,
    years,
    h,
    w,
    crop,
    max_cloud=0.5,
    done=None,
    tiling="diagonal",
    whole_frames=True,
) -> DataFrame:
    """One sample per year. Years without dates are listed by ``timeline.missing_years``."""
    in_years = slice_years(cube, years).drop("year")
    area = h * w if whole_frames else None

    def one(m: Modality) -> DataFrame:
        frames = slice_years(open_frames(in_years, m, max_cloud, area=area), years)
        frames = not_done(frames, done, ["year"])
        return sample_frames(prepare(in_years, m, frames), m, h, w, crop, tiling)

    return union_all(*[one(m) for m in modalities])


def multimodal_windows(
    cube,
    modalities,
    h,
    w,
    crop,
    seed,
    repeat=4,
    months=WINDOW_MONTHS,
    begin=SERIES_START,
    end=SERIES_END,
    max_cloud=0.5,
    done=None,
    tiling="diagonal",
    whole_frames=True,
) -> DataFrame:
    """``repeat`` samples per patch, each cut to a random window that all its modalities share.

    Tests, repetitions and windows are settled on frame keys; pixels are only repeated for
    the windows they lie in. A static layer is part of every repetition.
    """
    area = h * w if whole_frames else None
    in_span = F.col("t").between(F.lit(begin).cast("date"), F.lit(end).cast("date"))
    span = cube.where(F.col("t").isNull() | in_span)

    def one(m: Modality) -> DataFrame:
        if m.name in RADAR:
            m = replace(m, nodata_band=m.nodata_band or m.bands[0])
        frames = open_frames(span, m, max_cloud, area=area)
        windows = crop_time_random(frames, seed, repeat, months, begin, end)
        windows = not_done(windows, done, ["rep"])
        rows = prepare(span, m, windows.drop("win_start", "win_end"))
        return sample_frames(rows, m, h, w, crop, tiling)

    return union_all(*[one(m) for m in modalities])
