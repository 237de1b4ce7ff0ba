"""Robust clipping and normalisation with per-band statistics.

The statistics meet the cube as one row per modality (a struct per band), for whatever
modalities they hold. That table is written first, so its measured size decides whether the
cube stays where it is.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylattice.constants import CLIP_HEADROOM
from skylattice.functions.masks import missing
from skylattice.session import settle


def stats_by_modality(stats: DataFrame, bands: list[str], modalities=None) -> DataFrame:
    """(modality, _big, _<band> STRUCT<med, qmin, qmax>), one row per modality."""
    own = stats.where(F.col("band").isin(bands))
    if modalities is not None:
        own = own.where(F.col("modality").isin(list(modalities)))
    pack = F.struct("med", "qmin", "qmax")
    return own.groupBy("modality").agg(
        (F.max("qmax") + F.lit(CLIP_HEADROOM)).alias("_big"),
        *[
            F.first(F.when(F.col("band") == b, pack), ignorenulls=True).alias(f"_{b}")
            for b in bands
        ],
    )


def _with_stats(cube, stats, bands, change, as_type="double") -> DataFrame:
    """Apply ``change`` to each band; rows without statistics keep their values and are
    listed by ``without_stats``."""
    wide = settle(stats_by_modality(stats, bands), "band-stats")
    joined = cube.join(wide, "modality", "left")

    def changed(b: str) -> Column:
        s = F.col(f"_{b}")
        return F.when(s.isNull(), F.col(b).cast(as_type)).otherwise(change(b, s))

    return joined.withColumns({b: changed(b) for b in bands}).select(*cube.columns)


def without_stats(cube: DataFrame, stats: DataFrame, bands: list[str]) -> DataFrame:
    """(modality, band) of the cube that have no statistics."""
    wanted = cube.select("modality").distinct()
    wanted = wanted.withColumn("band", F.explode(F.array(*[F.lit(b) for b in bands])))
    return wanted.join(stats.select("modality", "band").distinct(), ["modality", "band"], "left_anti")


def clipped(value: Column, is_missing: Column, s: Column, big: Column) -> Column:
    """Clamp to [qmin, qmax]; a missing value counts as larger than every value."""
    present = F.when(~is_missing, value.cast("double"))
    return F.least(F.greatest(F.coalesce(present, big), s["qmin"]), s["qmax"])


def normalized(value: Column, s: Column) -> Column:
    return F.try_divide(value.cast("double") - s["med"], s["qmax"] - s["qmin"])


def clip_bands(cube: DataFrame, stats: DataFrame, bands: list[str]) -> DataFrame:
    gone = {b: missing(cube, b) for b in bands}
    return _with_stats(
        cube, stats, bands, lambda b, s: clipped(F.col(b), gone[b], s, F.col("_big"))
    )


def normalize_bands(cube: DataFrame, stats: DataFrame, bands: list[str]) -> DataFrame:
    """(v - med) / (qmax - qmin) for the listed bands; all other columns stay as they are."""
    return _with_stats(cube, stats, bands, lambda b, s: normalized(F.col(b), s))


def transform_modality(cube: DataFrame, stats: DataFrame, bands: list[str]) -> DataFrame:
    """Clip, then normalise, with the statistics of each row's modality; one join for both."""
    gone = {b: missing(cube, b) for b in bands}
    return _with_stats(
        cube,
        stats,
        bands,
        lambda b, s: normalized(clipped(F.col(b), gone[b], s, F.col("_big")), s),
    )


def transform_frames(frames: DataFrame, stats: DataFrame, bands: list[str]) -> DataFrame:
    """``transform_modality`` on frames, whose bands are pixel arrays."""

    def change(band: str, s: Column) -> Column:
        big = F.col("_big")
        return F.transform(
            F.col(band),
            lambda v: normalized(clipped(v, v.isNull() | F.isnan(v), s, big), s),
        )

    return _with_stats(frames, stats, bands, change, "array<double>")
