"""Per-band statistics of a dataset, from raw cubes or from stored samples."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylattice.constants import STATS_CROP, STATS_QMAX, STATS_QMIN
from skylattice.operators.samples import flatten_pixels, sample_keys
from skylattice.operators.select import order_bands
from skylattice.operators.spatial import crop
from skylattice.operators.stats import band_stats, ratio_log, sample_scenes, stats_table
from skylattice.session import settle


def dataset_stats(
    cube, scenes, bands, n_scenes, seed, qmin=STATS_QMIN, qmax=STATS_QMAX, method="auto"
) -> DataFrame:
    """Statistics over all pixels of ``n_scenes`` random scenes (tile, patch_id)."""
    chosen = sample_scenes(
        scenes.select("tile", "patch_id").distinct().withColumn(
            "path", F.concat_ws("/", "tile", "patch_id")
        ),
        n_scenes,
        seed,
    ).select("tile", "patch_id")
    # n_scenes rows, whatever the size of the catalog
    rows = cube.join(F.broadcast(chosen), ["tile", "patch_id"], "left_semi")
    return stats_table(band_stats(order_bands(rows, bands), bands, qmin=qmin, qmax=qmax, method=method), bands)


def sample_stats(
    pixels,
    bands,
    n_per_tile,
    seed,
    size=STATS_CROP,
    ratio_of=None,
    qmin=STATS_QMIN,
    qmax=STATS_QMAX,
    method="auto",
) -> DataFrame:
    """Statistics over the top-left window of ``n_per_tile`` random patches of each tile.

    ``ratio_of=(a, b)`` adds the band a/b and takes logarithms of all three.
    """
    patches = pixels.select("tile", "patch_id").distinct()
    patches = patches.withColumn("path", F.concat_ws("/", "tile", "patch_id"))
    chosen = sample_scenes(patches, n_per_tile, seed, by="tile").select("tile", "patch_id")
    rows = crop(pixels.join(chosen, ["tile", "patch_id"], "left_semi"), 0, 0, size)
    return _window_stats(rows, bands, ratio_of, qmin, qmax, method)


def _window_stats(
    rows, bands, ratio_of=None, qmin=STATS_QMIN, qmax=STATS_QMAX, method="auto"
) -> DataFrame:
    if ratio_of:
        rows, bands = ratio_log(rows, *ratio_of), [*ratio_of, "ratio"]
    stats = band_stats(rows, bands, qmin=qmin, qmax=qmax, median="lower", method=method)
    return stats_table(stats, bands)


def stored_sample_stats(frames, bands, n_per_tile, seed, size=STATS_CROP, **options) -> DataFrame:
    """Statistics over the top-left window of ``n_per_tile`` random stored samples of each tile.

    A stored sample is a patch with its crop, repetition, year and region. Samples are drawn
    on their keys, and only the frames of the drawn ones become rows.
    """
    keys = [k for k in sample_keys(frames) if k != "modality"]
    samples = frames.select(*keys).distinct().withColumn("path", F.concat_ws("/", *keys))
    chosen = settle(sample_scenes(samples, n_per_tile, seed, by="tile").drop("path"), "stats-samples")
    f, c = frames.alias("f"), chosen.alias("c")
    same = [F.col(f"f.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    own = f.join(c, same, "left_semi")
    return _window_stats(flatten_pixels(own, bands, size), bands, **options)
