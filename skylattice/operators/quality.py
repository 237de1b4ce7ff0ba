"""Which dates of a series are usable, and which pixels of a date are valid.

The no-data, cloud and scene-class tests are all per date and share one denominator, so
they are one aggregate over frames. Only its counters are shuffled (they combine on the
map side); the pixels then meet the surviving frame keys in a left semi join. The side of
that join with the pixels can be split when a frame is hot, and the key side holds one
row per frame. No broadcast is forced, since the number of frames grows with the data: the
measured size of the key table decides.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylattice.constants import MAX_NODATA_FRACTION
from skylattice.functions.masks import (
    clean_value,
    invalid_pixel,
    is_floating,
    missing,
    nan_count_of,
    scl_nodata,
)
from skylattice.schema import FRAME, KEY
from skylattice.session import settle


def date_quality(cube, nodata_band=None, cloud=None, scene_class=None, area=None) -> DataFrame:
    """Per frame: grid size ``n`` and the counts the date tests need.

    ``area`` is the grid size h*w when it is known; by default the rows of the frame. Pixels
    of the area that have no row count as missing.
    """
    aggs = [(F.count(F.lit(1)) if area is None else F.lit(area).cast("long")).alias("n")]
    if nodata_band:
        gone = F.count_if(missing(cube, nodata_band))
        if area is not None:
            gone = F.greatest(F.lit(area).cast("long") - F.count_if(~missing(cube, nodata_band)), F.lit(0))
        aggs.append(gone.alias("n_nan"))
    if cloud:
        aggs.append(F.count_if(F.col(cloud) == 1).alias("n_cld"))
        aggs.append(_sum_present(cube, cloud).alias("cld_sum"))
    if scene_class:
        aggs.append(F.count_if(scl_nodata(F.col(scene_class))).alias("n_scl0"))
    return cube.groupBy(*FRAME).agg(*aggs)


def _sum_present(cube: DataFrame, band: str) -> Column:
    """Sum that skips missing values; 0 when there are none."""
    return F.coalesce(F.sum(F.when(~missing(cube, band), F.col(band))), F.lit(0)).cast("double")


def usable_frames(quality: DataFrame, max_nodata=MAX_NODATA_FRACTION, max_cloud=None) -> DataFrame:
    """Frame keys that pass every test; all comparisons are strict.

    The no-data test runs if the counts hold it, the two cloud tests if ``max_cloud`` is given.
    """
    n = F.col("n").cast("double")
    keep = F.lit(True)
    if "n_nan" in quality.columns:
        keep = keep & (F.col("n_nan") < F.lit(float(max_nodata)) * n)
    if max_cloud is not None:
        limit = F.lit(float(max_cloud)) * n
        keep = keep & (F.col("n_cld") < limit) & (F.col("n_scl0") < limit)
    return quality.where(keep).select(*FRAME)


def join_frames(cube: DataFrame, frames: DataFrame, how="inner") -> DataFrame:
    """Pixels of the listed frames, with the further columns of ``frames`` (if inner).

    The date is compared null-safely: a static layer has frames without a date.
    """
    c, f = cube.alias("c"), frames.alias("f")
    same = [F.col(f"c.{k}") == F.col(f"f.{k}") for k in KEY]
    same.append(F.col("c.t").eqNullSafe(F.col("f.t")))
    met = c.join(f, same, how)
    if how == "left_semi":
        return met.select(*[F.col(f"c.{n}") for n in cube.columns])
    extra = [n for n in frames.columns if n not in FRAME]
    return met.select(*[F.col(f"c.{n}") for n in cube.columns], *[F.col(f"f.{n}") for n in extra])


def keep_frames(cube: DataFrame, frames: DataFrame) -> DataFrame:
    """Pixels of the listed frames.

    The key table is written first. Its true size is then known before the join is planned:
    a small one is broadcast and the cube stays where it is, a large one is sort-merged.
    """
    return join_frames(cube, settle(frames, "frames"), "left_semi")


def usable_pixels(
    cube,
    nodata_band=None,
    max_nodata=MAX_NODATA_FRACTION,
    max_cloud=None,
    cloud="clm",
    scene_class="scl",
    area=None,
) -> DataFrame:
    """Pixels of the dates that pass the no-data, cloud and scene-class tests."""
    wants_cloud = max_cloud is not None
    quality = date_quality(
        cube,
        nodata_band,
        cloud if wants_cloud else None,
        scene_class if wants_cloud else None,
        area,
    )
    return keep_frames(cube, usable_frames(quality, max_nodata, max_cloud))


def filter_nodata_dates(cube, band, max_nodata=MAX_NODATA_FRACTION, area=None) -> DataFrame:
    return usable_pixels(cube, nodata_band=band, max_nodata=max_nodata, area=area)


def filter_cloud_dates(cube, max_cloud, cloud="clm", scene_class="scl", area=None) -> DataFrame:
    return usable_pixels(
        cube, max_cloud=max_cloud, cloud=cloud, scene_class=scene_class, area=area
    )


def cloud_sum_frames(cube, max_cloud, cloud="clm", modality="s2", area=None) -> DataFrame:
    """Frames kept by the test applied while clipping: sum of the mask < max_cloud * h*w.

    Only optical series are tested; every frame of another modality is kept. ``area`` may
    be a column (h*w of the clipped box).
    """
    size = F.count(F.lit(1)) if area is None else F.max(area) if isinstance(area, Column) else (
        F.lit(area)
    )
    quality = cube.groupBy(*FRAME).agg(
        size.cast("double").alias("n"), _sum_present(cube, cloud).alias("cld_sum")
    )
    passes = F.col("cld_sum") < F.lit(float(max_cloud)) * F.col("n")
    return quality.where((F.col("modality") != modality) | passes).select(*FRAME)


def filter_cloud_sum(cube, max_cloud, cloud="clm", modality="s2", area=None) -> DataFrame:
    return keep_frames(cube, cloud_sum_frames(cube, max_cloud, cloud, modality, area))


def clean_missing(cube: DataFrame, bands: list[str], fill=None) -> DataFrame:
    """NaN and values above 1e9 become NULL, or ``fill`` when one is given."""

    def cleaned(band: str) -> Column:
        c = F.col(band)
        value = clean_value(c) if is_floating(cube, band) else F.when(~(c > F.lit(10**9)), c)
        return value if fill is None else F.coalesce(value, F.lit(fill)).cast(
            cube.schema[band].dataType
        )

    return cube.withColumns({b: cleaned(b) for b in bands})


def with_nan_count(cube: DataFrame, bands: list[str], name="nan_count") -> DataFrame:
    return cube.withColumn(name, nan_count_of(cube, bands))


def with_scl_nodata(cube: DataFrame, scene_class="scl", name="nodata") -> DataFrame:
    return cube.withColumn(name, F.coalesce(scl_nodata(F.col(scene_class)), F.lit(False)))


def with_invalid(cube, cloud="clm", scene_class="scl", name="invalid") -> DataFrame:
    return cube.withColumn(name, invalid_pixel(F.col(cloud), F.col(scene_class)))


def audit_no_nan(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column: number of missing values (0 when the table is clean)."""
    counts = df.agg(*[F.count_if(missing(df, c)).alias(c) for c in cols])
    return counts.unpivot([], cols, "column_name", "n_missing")


def assert_no_nan(df: DataFrame, cols: list[str]) -> DataFrame:
    """``df`` itself; raises if a listed column has a missing value."""
    bad = {r["column_name"]: r["n_missing"] for r in audit_no_nan(df, cols).collect()}
    bad = {c: n for c, n in bad.items() if n}
    if bad:
        raise ValueError(f"missing values after the transform: {bad}")
    return df
