"""Loading training items, straight from cubes or from stored samples."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylattice.constants import MAX_NODATA_FRACTION
from skylattice.functions.masks import nan_count_of, scl_nodata
from skylattice.operators.normalize import transform_frames, transform_modality
from skylattice.operators.quality import (
    clean_missing,
    date_quality,
    join_frames,
    keep_frames,
    usable_frames,
)
from skylattice.operators.samples import crop_frames
from skylattice.operators.spatial import crop, offset_columns
from skylattice.operators.timeline import check_length, subsample_frames
from skylattice.schema import SCENE
from skylattice.session import settle


def load_direct(
    cube,
    bands,
    h,
    w,
    size,
    seed,
    max_len=None,
    crop_mode="center",
    max_cloud=None,
    nodata_band=None,
    cloud="clm",
    scene_class="scl",
    stats=None,
    max_nodata=MAX_NODATA_FRACTION,
    strict=False,
    whole_frames=True,
) -> DataFrame:
    """Pixels of randomly chosen usable dates, cropped, cleaned and normalised.

    Date tests and date sampling are settled on frame keys, which are written once so that
    their true size decides how the cube meets them. The crop offset of an item is drawn on
    the keys as well. ``mask_nan`` is the scene class's no-data flag, or the number of
    missing bands where there is no scene class. ``strict`` raises if a series has fewer than
    ``max_len`` usable dates. With ``whole_frames`` the date tests take a frame as h*w pixels,
    of which absent ones are missing.
    """
    wants_cloud = max_cloud is not None
    quality = date_quality(
        cube,
        nodata_band,
        cloud if wants_cloud else None,
        scene_class if wants_cloud else None,
        h * w if whole_frames else None,
    )
    usable = usable_frames(quality, max_nodata, max_cloud)
    if strict and max_len is not None:
        check_length(usable, max_len)
    row0, col0 = offset_columns(h, w, size, crop_mode, seed, SCENE)
    chosen = subsample_frames(usable, max_len, seed)
    chosen = settle(chosen.withColumn("row0", row0).withColumn("col0", col0), "chosen-frames")
    rows = crop(join_frames(cube, chosen), F.col("row0"), F.col("col0"), size)
    rows = rows.drop("row0", "col0")
    if scene_class in rows.columns:
        nodata = F.coalesce(scl_nodata(F.col(scene_class)), F.lit(False)).cast("int")
        rows = clean_missing(rows, bands)
    else:
        rows = clean_missing(rows, bands)
        nodata = nan_count_of(rows, bands)
    rows = rows.withColumn("mask_nan", nodata).fillna(0, bands)
    return rows if stats is None else transform_modality(rows, stats, bands)


def load_samples(
    frames, bands, h, w, size, seed, max_len=None, crop_mode="center", stats=None, masks=()
) -> DataFrame:
    """Stored sample frames: random dates, one crop per item, transformed bands.

    Masks get the same dates and the same window but no transform. Offsets depend on
    (tile, patch), so the modalities of an item are cut alike; pixels never leave their row.
    """
    if max_len is not None:
        frames = keep_frames(frames, subsample_frames(frames, max_len, seed))
    if stats is not None:
        frames = transform_frames(frames, stats, bands)
    row0, col0 = offset_columns(h, w, size, crop_mode, seed, SCENE)
    return crop_frames(frames, [*bands, *masks], row0, col0, size)
