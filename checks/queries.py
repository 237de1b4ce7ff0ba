"""One query per operator, over the given tables."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import tables as tb
from checks.tables import GRID, OPTICAL_BANDS, TILES
from skylattice.functions import dates, geometry
from skylattice.functions.geometry import PixelGrid, join_rings
from skylattice.operators import (
    merge,
    normalize,
    quality,
    resample,
    samples,
    select,
    spatial,
    stats,
    timeline,
    warp,
)
from skylattice.plans import convert as conv
from skylattice.plans import cubes as cube_plans
from skylattice.plans import items as item_plans
from skylattice.plans import load, regions, statistics
from skylattice.plans.items import ItemOption
from skylattice.schema import FRAME, PIXEL, cube_schema
from skylattice.session import new_folder
from skylattice.sources import catalog, manifests, rois, series, stats_files
from skylattice.sources import cubes as cube_files
from skylattice.sources.items import ItemStore
from skylattice.streaming import ingest

SEED = 7
MAX_CLOUD = 0.5
SPAN = ("1995-01-01", "2000-12-31")
PIXEL_GRID = PixelGrid(0.0, 0.0, 10.0)
OPTICAL = conv.Modality("s2", OPTICAL_BANDS, "b02", "clm", "scl", "double")
RADAR = conv.Modality("s1_asc", tb.RADAR_BANDS, None, None, None, "double")
REGISTRY = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def _rounded(df, cols, digits=6):
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in cols})


def _both(spark, sf):
    return merge.union_all(tb.cube_s2(spark, sf), tb.cube_s1(spark, sf))


# ------------------------------------------------------------ scans and sinks


@query
def read_cube(spark, sf):
    path = cube_files.write_cube(tb.cube_s2(spark, sf), new_folder(spark, "cube"))
    schema = cube_schema(OPTICAL_BANDS)
    for mask in ("clm", "scl"):
        schema = schema.add(mask, T.IntegerType())
    cube = cube_files.read_cube(spark, path, schema, "s2", ["T1", "T3"], [1996, 1999])
    return cube.drop("modality", "year")


@query
def write_samples(spark, sf):
    df = tb.frames(spark, sf)
    path = cube_files.write_samples(df, new_folder(spark, "samples"))
    back = cube_files.read_samples(spark, path, df.schema, "s2", ["T1", "T2", "T3"])
    pixels = samples.from_frames(back, ["pixels"])
    return pixels.select("tile", "patch_id", "t", "y", "x", F.col("pixels").cast("double"))


@query
def merge_series(spark, sf):
    """Two overlapping files: even and all months of the same pixels."""
    cube = tb.unique_s2(spark, sf)
    part = select.select_bands(cube.where(F.month("t") <= 6), ["b02", "clm"])
    rest = select.select_bands(cube, ["b02", "b03"])
    return merge.merge_series(part, rest).drop("modality")


@query
def merge_conflicts(spark, sf):
    """Raw rows give several values for some pixels."""
    cube = select.select_bands(tb.cube_s2(spark, sf), ["b02", "b03", "b08"])
    return merge.merge_conflicts(cube).drop("modality")


FILES = ("month(t) <= 5", "month(t) >= 4 and t < '1998-01-01'", "y % 3 = 0")


def _merged_files(spark, sf):
    """Three overlapping deliveries merged into a stored cube, one after the other."""
    raw = tb.unique_s2(spark, sf)
    cube = select.select_bands(raw, ["b02", "b03"])
    path = new_folder(spark, "series")
    for i, part in enumerate(FILES):
        # the last one says otherwise for some pixels
        b03 = F.when(F.col("x") == i * 3, F.col("b03") + i).otherwise(F.col("b03"))
        series.merge_into(cube.where(part).withColumn("b03", b03), path)
    return path, cube.schema


@query
def merge_into_stored(spark, sf):
    path, schema = _merged_files(spark, sf)
    return cube_files.read_cube(spark, path, schema).drop("modality", "year")


@query
def merge_into_conflicts(spark, sf):
    path, schema = _merged_files(spark, sf)
    return series.stored_conflicts(spark, path, schema).drop("modality", "year")


@query
def pending(spark, sf):
    work = tb.cube_s2(spark, sf).select(*FRAME).distinct()
    done = tb.cube_s2(spark, sf).where("clm = 1 and b04 > 0.09").select(*FRAME)
    return cube_files.pending(work, done, FRAME)


# ------------------------------------------------------------ catalogs


@query
def scene_catalog(spark, sf):
    return catalog.scene_catalog(tb.scene_files(spark, sf), "s2", tb.file_tiles(spark, sf))


@query
def build_catalog(spark, sf):
    return catalog.build_catalog(tb.scene_files(spark, sf), ["s2", "s1_asc"], tb.file_tiles(spark, sf))


@query
def catalog_summary(spark, sf):
    cat = catalog.build_catalog(tb.scene_files(spark, sf), ["s2", "s1_asc"], tb.file_tiles(spark, sf))
    return catalog.catalog_summary(cat)


@query
def missing_scenes(spark, sf):
    files = tb.scene_files(spark, sf).where("length > 5000")
    cat = catalog.build_catalog(files, ["s2", "s1_asc"], tb.file_tiles(spark, sf))
    return catalog.missing_scenes(cat, [f"T{i}" for i in range(40)])


@query
def union_catalogs(spark, sf):
    files = tb.scene_files(spark, sf)
    return merge.union_all(
        catalog.scene_catalog(files, "s2", ["T1"]), catalog.scene_catalog(files, "s1_asc", ["T2"])
    )


@query
def distinct_patches(spark, sf):
    cat = catalog.build_catalog(tb.scene_files(spark, sf), ["s2", "s1_asc"], tb.file_tiles(spark, sf))
    return catalog.distinct_patches(cat)


@query
def sample_catalog(spark, sf):
    return catalog.sample_catalog(tb.sample_files(spark, sf), TILES, ["s2", "s1_asc"])


@query
def catalog_len(spark, sf):
    cat = catalog.build_catalog(tb.scene_files(spark, sf), ["s1_asc", "s2"], tb.file_tiles(spark, sf))
    return catalog.catalog_len(cat)


@query
def small_files(spark, sf):
    return catalog.small_files(tb.scene_files(spark, sf))


@query
def job_ids(spark, sf):
    path = new_folder(spark, "report")
    tb.manifests(spark, sf).select("jobId").write.option("header", "true").csv(path)
    return catalog.job_ids(spark, path)


@query
def manifest_assets(spark, sf):
    return manifests.manifest_assets(tb.manifests(spark, sf), "base")


@query
def target_path(spark, sf):
    cube = tb.cube_s2(spark, sf).select("tile", "t").distinct()
    tile = F.when(F.month("t") != 3, F.col("tile"))
    year = F.when(F.month("t") != 5, F.year("t").cast("string"))
    path = manifests.target_path(tile, year, F.lit("S2"))
    return cube.select("tile", "t", path.alias("target"))


@query
def read_rois(spark, sf):
    path = rois.write_rois(tb.rois(spark, sf), new_folder(spark, "rois"))
    return rois.roi_boxes(rois.read_rois(spark, path))


@query
def select_tiles(spark, sf):
    return rois.select_tiles(tb.tiles_metric(spark, sf), ["C1", "C20", "C77", "C149"])


@query
def item_keys(spark, sf):
    scenes = tb.table(spark, sf, "orders").select(
        F.concat(F.lit("T"), (F.col("o_custkey") % 50).cast("string")).alias("tile"),
        (F.col("o_orderkey") % 900).cast("int").alias("patch_id"),
    )
    return merge.item_keys(scenes)


# ------------------------------------------------------------ selection


@query
def load_collection(spark, sf):
    cube = select.load_collection(tb.cube_s2(spark, sf), "1996-03-01", "1998-01-01", ["b04", "b02"])
    return cube.drop("modality")


@query
def load_collection_stored(spark, sf):
    """Dates and the tiles of the regions, of a stored cube."""
    cube = tb.unique_s2(spark, sf)
    path = cube_files.write_cube(cube, new_folder(spark, "cube"))
    stored = cube_files.read_cube(spark, path, cube.schema, "s2")
    regions = tb.rois(spark, sf).where("tile < 'T3'")
    return select.load_collection(stored, "1996-03-01", "1998-01-01", ["b04", "b02"], regions).drop("modality")


@query
def filter_props(spark, sf):
    return select.filter_props(
        tb.cube_s1(spark, sf), {"orbit": "ASCENDING", "modality": "s1_asc"}
    ).drop("modality")


@query
def filter_scene_cloud(spark, sf):
    kept = select.filter_scene_cloud(tb.cube_s2(spark, sf), tb.scenes(spark, sf), 33.0)
    return kept.groupBy("tile", "t").agg(
        F.count("*").alias("n"), F.round(F.sum("b03"), 2).alias("b03")
    )


@query
def select_modalities(spark, sf):
    kept = select.select_modalities(_both(spark, sf), "s1")
    return kept.groupBy("modality", "tile").agg(F.count("*").alias("n"))


@query
def split_bands(spark, sf):
    wide = merge.pivot_variables(
        tb.weather(spark, sf).withColumn("variable", _weather_name()), _WEATHER, ["tile", "t"]
    )
    return select.split_bands(wide, _WEATHER).where(F.col("value").isNotNull())


_WEATHER = ["temperature-max", "temperature-min", "wind-speed"]


def _weather_name():
    v = F.col("variable")
    return (
        F.when(v == "click", "temperature-max")
        .when(v == "view", "temperature-min")
        .otherwise("wind-speed")
    )


@query
def select_bands(spark, sf):
    return select.select_bands(tb.cube_s2(spark, sf), ["b04", "b03"])


@query
def drop_bands(spark, sf):
    return select.drop_bands(tb.cube_s2(spark, sf), ["b02", "scl", "modality"])


@query
def order_bands(spark, sf):
    return select.order_bands(tb.cube_s1(spark, sf)).drop("modality", "orbit")


@query
def stack_bands(spark, sf):
    return select.stack_bands(tb.cube_s2(spark, sf), OPTICAL_BANDS).drop("modality")


@query
def cast_bands(spark, sf):
    cube = quality.clean_missing(tb.raw_s2(spark, sf), ["b02", "b03", "b08"])
    cast = select.cast_bands(cube, ["b02", "b03"], "smallint").drop("modality", "clm", "scl")
    return cast.withColumns({b: F.col(b).cast("int") for b in ("b02", "b03")})


# ------------------------------------------------------------ quality


@query
def date_quality(spark, sf):
    return quality.date_quality(tb.cube_s2(spark, sf), "b02", "clm", "scl")


@query
def usable_dates(spark, sf):
    counts = quality.date_quality(tb.cube_s2(spark, sf), "b02", "clm", "scl")
    return quality.usable_frames(counts, 0.3, MAX_CLOUD)


@query
def usable_pixels(spark, sf):
    return quality.usable_pixels(tb.cube_s2(spark, sf), "b02", 0.3, MAX_CLOUD)


@query
def filter_nodata_dates(spark, sf):
    kept = quality.filter_nodata_dates(tb.cube_s2(spark, sf), "b02")
    return kept.select("tile", "patch_id", "t", "y", "x", "b02")


@query
def filter_cloud_dates(spark, sf):
    kept = quality.filter_cloud_dates(tb.cube_s2(spark, sf), 0.3)
    return kept.select("tile", "patch_id", "t", "y", "x", "clm", "scl")


@query
def cloud_sum_dates(spark, sf):
    return quality.cloud_sum_frames(_both(spark, sf), 0.3)


@query
def clean_missing(spark, sf):
    return quality.clean_missing(tb.raw_s2(spark, sf), ["b02", "b03", "b08"], fill=0).drop("modality")


@query
def nan_count(spark, sf):
    cube = quality.clean_missing(tb.raw_s2(spark, sf), ["b02", "b03", "b08"])
    counted = quality.with_nan_count(cube, ["b02", "b03", "b08"])
    return counted.select("tile", "patch_id", "t", "y", "x", "nan_count")


@query
def scl_nodata(spark, sf):
    return quality.with_scl_nodata(tb.cube_s2(spark, sf)).select(
        "tile", "patch_id", "t", "y", "x", F.col("nodata").cast("int").alias("nodata")
    )


@query
def merge_mask(spark, sf):
    return quality.with_invalid(tb.cube_s2(spark, sf)).select(
        "tile", "patch_id", "t", "y", "x", F.col("invalid").cast("int").alias("invalid")
    )


@query
def audit_no_nan(spark, sf):
    return quality.audit_no_nan(tb.raw_s2(spark, sf), ["b02", "b03", "b04", "b08"])


@query
def frame_quality(spark, sf):
    """Date counts on array frames; the values are centred, so negatives stand for class 0."""
    df = tb.frames(spark, sf).withColumns(
        {
            "scl": F.transform("pixels", lambda v: F.when(v < 0, 0).otherwise(4)),
            "clm": F.transform("pixels", lambda v: F.when(v > 0.1, 1).otherwise(0)),
            "pixels": F.transform("pixels", lambda v: F.when(v < 0.2, v)),
        }
    )
    return samples.frame_quality(df, "pixels").select(
        "tile", "patch_id", "t", "n", "n_nan", "n_cld", "n_scl0"
    )


# ------------------------------------------------------------ time


@query
def days_since(spark, sf):
    cube = tb.cube_s2(spark, sf).select("tile", "patch_id", "t").distinct()
    return cube.withColumns(
        {
            "days": dates.days_since("t"),
            "scaled": F.round(dates.days_since("t", scale=8.0), 6),
            "from_day_number": dates.days_since_epoch_day(F.unix_date("t")),
        }
    )


@query
def doy_fraction(spark, sf):
    daily = tb.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("t")).distinct()
    return daily.withColumn("doy", F.round(dates.doy_fraction("t"), 9))


@query
def slice_years(spark, sf):
    return timeline.slice_years(tb.cube_s2(spark, sf), [1996, 1998]).drop("modality")


@query
def missing_years(spark, sf):
    return timeline.missing_years(tb.region_cube(spark, sf), [1994, 1998, 2001, 2002])


def _items(spark, sf):
    return tb.region_cube(spark, sf).select("tile", "patch_id").distinct()


@query
def repeat_items(spark, sf):
    return timeline.repeat_items(_items(spark, sf), 4)


@query
def random_windows(spark, sf):
    items = timeline.repeat_items(_items(spark, sf), 4)
    return timeline.random_windows(items, SEED, begin=SPAN[0], end=SPAN[1])


@query
def crop_time(spark, sf):
    cube = tb.region_cube(spark, sf)
    windows = timeline.random_windows(
        timeline.repeat_items(_items(spark, sf), 2), SEED, begin=SPAN[0], end=SPAN[1]
    )
    return timeline.crop_time(cube, windows).drop("modality")


@query
def crop_time_random(spark, sf):
    cube = tb.region_cube(spark, sf)
    return timeline.crop_time_random(cube, SEED, 2, begin=SPAN[0], end=SPAN[1]).drop("modality")


@query
def subsample_dates(spark, sf):
    return timeline.subsample_dates(tb.cube_s2(spark, sf), 20, SEED).drop("modality")


@query
def pad_time(spark, sf):
    padded = samples.pad_time(tb.frames(spark, sf), ["pixels"], 8, 8, 12)
    rows = padded.select(
        "tile",
        "patch_id",
        "ti",
        "doy",
        F.round(F.col("true_doy").cast("double"), 5).alias("true_doy"),
        F.col("padded").cast("int").alias("padded"),
        F.posexplode("pixels").alias("pos", "value"),
    )
    return rows.withColumn("value", F.col("value").cast("double"))


@query
def pad_heads(spark, sf):
    heads = samples.pad_heads(samples.sample_heads(tb.frames(spark, sf)), 12)
    return heads.select(
        "tile",
        "patch_id",
        F.posexplode(F.arrays_zip("doy", "padd_mask")).alias("ti", "p"),
    ).select(
        "tile", "patch_id", "ti", F.col("p.doy").alias("doy"),
        F.col("p.padd_mask").cast("int").alias("padded"),
    )


@query
def pad_k(spark, sf):
    padded = samples.append_frames(tb.frames(spark, sf), ["pixels"], 8, 8, 3)
    return padded.select(
        "tile",
        "patch_id",
        "ti",
        F.col("padded").cast("int").alias("padded"),
        F.posexplode("pixels").alias("pos", "value"),
    ).withColumn("value", F.col("value").cast("double"))


# ------------------------------------------------------------ space


@query
def crop_center(spark, sf):
    return spatial.crop_items(tb.cube_s2(spark, sf), GRID, GRID, 6).drop("modality")


@query
def crop_random(spark, sf):
    return spatial.crop_items(tb.cube_s2(spark, sf), GRID, GRID, 6, "random", SEED).drop("modality")


@query
def crop_offsets(spark, sf):
    return spatial.crop_offsets(_items(spark, sf), 512, 512, 128, "random", SEED)


@query
def crop_topleft(spark, sf):
    return spatial.crop(tb.cube_s2(spark, sf), 0, 0, 8).drop("modality")


@query
def crop_frames(spark, sf):
    cut = samples.crop_frames(tb.frames(spark, sf), ["pixels"], F.lit(2), F.lit(3), 4)
    return _pixel_rows(cut)


def _pixel_rows(frames):
    keys = [k for k in samples.frame_keys(frames) if k != "modality"]
    pixels = samples.from_frames(frames, ["pixels"])
    return pixels.select(*keys, "y", "x", F.col("pixels").cast("double").alias("value"))


@query
def tile_crops_diag(spark, sf):
    return spatial.tile_crops(tb.cube_s2(spark, sf), GRID, GRID, 4).drop("modality")


@query
def tile_crops_grid(spark, sf):
    return spatial.tile_crops(tb.cube_s2(spark, sf), GRID, GRID, 4, "grid").drop("modality")


@query
def tile_frames(spark, sf):
    return _pixel_rows(samples.tile_frames(tb.frames(spark, sf), ["pixels"], 8, 8, 4, "grid"))


@query
def sample_rois(spark, sf):
    boxes = spatial.sample_rois(tb.tiles_metric(spark, sf), 10, 5120, SEED)
    return _rounded(boxes, ["xmin", "ymin", "xmax", "ymax"], 3)


@query
def validate_rois(spark, sf):
    boxes = spatial.sample_rois(tb.tiles_metric(spark, sf), 10, 5120, SEED)
    # every seventh tile gets a box that is too wide
    bad = F.substring("tile", 2, 9).cast("int") % 7 == 0
    boxes = boxes.withColumn("xmax", F.when(bad, F.col("xmax") + 10.0).otherwise(F.col("xmax")))
    checked = spatial.validate_rois(boxes, 5120)
    return checked.withColumns({c: F.col(c).cast("int") for c in ("area_ok", "perimeter_ok")})


def _pixels(spark, sf):
    return tb.cube_s2(spark, sf).drop("modality")


@query
def filter_spatial(spark, sf):
    return spatial.filter_spatial(_pixels(spark, sf), tb.rois(spark, sf), PIXEL_GRID)


@query
def sample_by_feature(spark, sf):
    cut = spatial.sample_by_feature(_pixels(spark, sf), tb.rois(spark, sf), PIXEL_GRID)
    return cut.groupBy("tile", "roi", "t").agg(
        F.count("*").alias("n"), F.round(F.sum("b03"), 2).alias("b03")
    )


@query
def clip_polygon(spark, sf):
    cut = spatial.clip_polygon(_pixels(spark, sf), tb.rois(spark, sf), ["b02", "b03"], PIXEL_GRID)
    return cut.groupBy("tile", "roi", "y", "x", "h", "w").agg(
        F.count("*").alias("n"),
        F.count("b03").alias("n_inside"),
        F.round(F.sum("b03"), 2).alias("b03"),
    )


@query
def match_rois(spark, sf):
    return spatial.match_rois(tb.rois(spark, sf).select("tile", "roi"), tb.roi_files(spark, sf))


@query
def to_utm_roundtrip(spark, sf):
    points = tb.tiles_lonlat(spark, sf).select(
        "tile", F.col("xmin").alias("lon"), F.col("ymin").alias("lat")
    )
    zone = geometry.utm_zone(F.col("lon"))
    east, north = geometry.to_utm(F.col("lon"), F.col("lat"), F.col("zone"))
    projected = points.withColumn("zone", zone).withColumn("east", east).withColumn("north", north)
    lon, lat = geometry.to_lonlat(F.col("east"), F.col("north"), F.col("zone"), F.lit(False))
    back = projected.withColumn("lon_error", F.abs(lon - F.col("lon"))).withColumn(
        "lat_error", F.abs(lat - F.col("lat"))
    )
    small = (F.col("lon_error") < 1e-8) & (F.col("lat_error") < 1e-8)
    return _rounded(back, ["east", "north"], 3).select(
        "tile", "zone", "east", "north", small.cast("int").alias("returns")
    )


@query
def resample_cubic(spark, sf):
    rows = tb.table(spark, sf, "part").count() // 20
    fine = resample.resample_cubic(
        tb.coarse_grid(spark, sf), ["v"], 2.0, 2 * rows, 40, ["tile"]
    )
    return _rounded(fine, ["v"])


@query
def resample_series(spark, sf):
    """Radar dates with gaps, three times as fine."""
    cube = merge.merge_series(select.select_bands(tb.cube_s1(spark, sf), ["vv", "vh"]))
    fine = resample.resample_cubic(cube, ["vv"], 3.0, 3 * GRID, 3 * GRID, FRAME)
    # weights of sparse neighbours may nearly cancel; compare what they can determine
    return fine.groupBy("tile", "patch_id", "t").agg(
        F.count("*").alias("n_cells"), F.min("y").alias("y_min"), F.max("x").alias("x_max")
    )


@query
def resample_near(spark, sf):
    rows = tb.table(spark, sf, "part").count() // 20
    return resample.resample_near(tb.coarse_grid(spark, sf), 3.0, 3 * rows, 60)


WEATHER_GRID = warp.LonLatGrid(2.0, 46.6, 0.1)


def _warped(spark, sf, bands, method, digits):
    cube, grids = tb.weather_grid(spark, sf), tb.warp_grids(spark, sf)
    out = warp.warp_to(cube, bands, WEATHER_GRID, grids, ["t"], method).where(F.col(bands[0]).isNotNull())
    place = F.col("y") * 20 + F.col("x") + 1
    sums = [F.round(F.sum(F.col(b) * place), digits).alias(b) for b in bands]
    return out.groupBy("tile", "t").agg(F.count("*").alias("n"), *sums)


@query
def warp_cubic(spark, sf):
    """Weather of 0.1 degrees on metric grids whose origins differ."""
    return _warped(spark, sf, ["temp", "rain"], "cubic", 1)


@query
def warp_near(spark, sf):
    return _warped(spark, sf, ["temp", "rain"], "near", 2)


@query
def resample_resolution(spark, sf):
    rows = tb.table(spark, sf, "part").count() // 20
    return resample.resample_resolution(tb.coarse_grid(spark, sf), 0.0004, 0.0001, 4 * rows, 80)


# ------------------------------------------------------------ merging


@query
def merge_variables(spark, sf):
    long = tb.weather(spark, sf).where("n % 7 != 0")
    one = lambda v: long.where(F.col("variable") == v).select(
        "tile", "t", F.col("v").alias(v)
    )
    names = ["click", "view", "purchase", "signup", "error", "view"]
    return merge.merge_variables(*[one(v) for v in names], keys=["tile", "t"])


@query
def assemble_items(spark, sf):
    heads = samples.sample_heads(_both(spark, sf)).select(
        "tile", "patch_id", "modality", "n_dates", F.element_at("doy", 1).alias("first_day")
    )
    items = merge.assemble_items(heads, ["s2", "s1_asc", "dem"])
    return items.select(
        "tile",
        "patch_id",
        F.col("s2.n_dates").alias("s2_dates"),
        F.col("s2.first_day").alias("s2_first"),
        F.col("s1_asc.n_dates").alias("s1_dates"),
        F.col("s1_asc.first_day").alias("s1_first"),
        F.col("dem").isNull().cast("int").alias("no_dem"),
    )


# ------------------------------------------------------------ statistics


@query
def sample_scenes(spark, sf):
    return stats.sample_scenes(tb.scene_files(spark, sf), 50, SEED)


@query
def sample_scenes_by_tile(spark, sf):
    files = tb.scene_files(spark, sf).withColumn("tile", F.split_part("path", F.lit("/"), F.lit(1)))
    return stats.sample_scenes(files, 5, SEED, by="tile")


@query
def flatten_pixels(spark, sf):
    rows = samples.flatten_pixels(tb.frames(spark, sf), ["pixels"], 3)
    return rows.select(
        "tile", "patch_id", "t", "y", "x", F.col("pixels").cast("double").alias("value")
    )


@query
def band_stats(spark, sf):
    cube = quality.usable_pixels(tb.cube_s2(spark, sf), "b02", 0.3, MAX_CLOUD)
    cube = quality.clean_missing(cube, OPTICAL_BANDS)
    out = stats.band_stats(cube, OPTICAL_BANDS, by=["tile"])
    return _rounded(out, stats.STAT_NAMES)


@query
def band_stats_lower(spark, sf):
    out = stats.band_stats(tb.cube_s2(spark, sf), OPTICAL_BANDS, by=["tile"], median="lower")
    return _rounded(out, stats.STAT_NAMES)


@query
def band_stats_located(spark, sf):
    """The path for groups too large for one task."""
    out = stats.band_stats(
        tb.cube_s2(spark, sf), OPTICAL_BANDS, by=["modality"], method="located"
    )
    return _rounded(out, stats.STAT_NAMES)


@query
def band_stats_integer(spark, sf):
    """Small integer bands keep their type, which bounds the state of their quantiles."""
    cube = select.cast_bands(tb.cube_s2(spark, sf), ["b02", "scl"], "smallint")
    out = stats.band_stats(cube, ["b02", "scl"], by=["tile"])
    return _rounded(out, stats.STAT_NAMES)


@query
def ratio_log_stats(spark, sf):
    cube = stats.ratio_log(tb.cube_s1(spark, sf), "vv", "vh")
    out = stats.band_stats(cube, ["vv", "vh", "ratio"], by=["tile"], median="lower")
    return _rounded(out, stats.STAT_NAMES)


def _global_stats(spark, sf, bands=OPTICAL_BANDS):
    return stats.band_stats(tb.cube_s2(spark, sf), bands)


@query
def stats_table(spark, sf):
    table = stats.stats_table(_global_stats(spark, sf), OPTICAL_BANDS)
    return _rounded(table, OPTICAL_BANDS).drop("modality")


@query
def stats_roundtrip(spark, sf):
    both = merge.union_all(
        _global_stats(spark, sf),
        stats.band_stats(tb.cube_s1(spark, sf), tb.RADAR_BANDS),
    )
    bands = [*OPTICAL_BANDS, *tb.RADAR_BANDS]
    path = stats_files.write_stats(both, bands, new_folder(spark, "stats"))
    back = stats_files.read_stats(spark, path, bands)
    return _rounded(back.where(F.col("med").isNotNull()), stats.STAT_NAMES)


@query
def merge_stats(spark, sf):
    long = tb.weather(spark, sf)
    parts = [
        stats.band_stats(
            long.where(F.col("variable") == v).select("tile", F.col("v").alias(v)), [v], by=[]
        )
        for v in ("click", "view", "purchase", "signup", "error")
    ]
    return _rounded(stats.merge_stats(parts), stats.STAT_NAMES)


@query
def approximate_band_stats(spark, sf):
    """The sketch's rank error: share of values at or below each answer, against its target."""
    cube = tb.cube_s2(spark, sf)
    approx = stats.approximate_band_stats(cube, ["b03"], accuracy=1000)
    shares = cube.join(approx, "modality").agg(
        *[
            (F.count_if(F.col("b03") <= F.col(s)) / F.count("b03")).alias(s)
            for s in stats.STAT_NAMES
        ],
        F.count("b03").alias("n"),
    )
    targets = {"med": 0.5, "qmin": 0.05, "qmax": 0.95}
    return shares.select(
        "n",
        *[(F.abs(F.col(s) - q) < 0.01).cast("int").alias(f"{s}_ok") for s, q in targets.items()],
    )


# ------------------------------------------------------------ normalisation


def _stats_for_norm(spark, sf):
    """Statistics with at most two decimals, so results do not hinge on rounding."""
    out = _global_stats(spark, sf)
    return out.withColumns({s: F.round(s, 2) for s in stats.STAT_NAMES})


@query
def clip_bands(spark, sf):
    cube = normalize.clip_bands(tb.cube_s2(spark, sf), _stats_for_norm(spark, sf), OPTICAL_BANDS)
    return cube.drop("modality")


@query
def normalize_bands(spark, sf):
    cube = normalize.normalize_bands(
        tb.cube_s2(spark, sf), _stats_for_norm(spark, sf), OPTICAL_BANDS
    )
    return _rounded(cube.drop("modality"), OPTICAL_BANDS)


@query
def normalize_partial(spark, sf):
    """Only the leading bands; the rest, masks included, stay as they are."""
    cube = normalize.normalize_bands(
        tb.cube_s2(spark, sf), _stats_for_norm(spark, sf), OPTICAL_BANDS[:2]
    )
    return _rounded(cube.drop("modality"), OPTICAL_BANDS[:2])


@query
def transform_modality(spark, sf):
    cube = normalize.transform_modality(
        tb.cube_s2(spark, sf), _stats_for_norm(spark, sf), OPTICAL_BANDS
    )
    return _rounded(cube.drop("modality"), OPTICAL_BANDS)


@query
def transform_frames(spark, sf):
    fr = tb.frames(spark, sf)
    pixel_stats = stats.band_stats(samples.from_frames(fr, ["pixels"]), ["pixels"])
    pixel_stats = pixel_stats.withColumns({s: F.round(s, 2) for s in stats.STAT_NAMES})
    out = _pixel_rows(normalize.transform_frames(fr, pixel_stats, ["pixels"]))
    return _rounded(out, ["value"])


# ------------------------------------------------------------ samples


@query
def to_frames(spark, sf):
    """Dense frames from sparse pixels, as one checksum per frame and band."""
    fr = samples.to_frames(tb.cube_s2(spark, sf), ["b02", "b03", "scl"], GRID, GRID)
    return _frame_sums(fr, ["b02", "b03", "scl"])


def _frame_sums(frames, bands):
    """Size, sum and position-weighted sum of every band of a frame."""

    def weighted(b):
        terms = F.transform(F.col(b), lambda v, i: v.cast("double") * (i + 1))
        return F.aggregate(terms, F.lit(0.0), lambda acc, v: acc + v)

    def plain(b):
        return F.aggregate(F.col(b), F.lit(0.0), lambda acc, v: acc + v.cast("double"))

    keys = [k for k in samples.frame_keys(frames) if k != "modality" or "vv" in bands]
    cols = []
    for b in bands:
        cols += [F.round(plain(b), 2).alias(f"{b}_sum"), F.round(weighted(b), 2).alias(f"{b}_pos")]
    return frames.select(*keys, F.size(bands[0]).alias("n_pixels"), *cols)


@query
def from_frames(spark, sf):
    return _pixel_rows(tb.frames(spark, sf))


def _samples(spark, sf):
    return samples.to_samples(tb.frames(spark, sf), ["pixels"], 8, 8, 12)


def _sample_rows(rows):
    return rows.select(
        "tile", "patch_id", "band", "ti", "doy", F.col("padded").cast("int").alias("padded"),
        "y", "x", F.col("value").cast("double").alias("value"),
    )


@query
def to_samples(spark, sf):
    return _sample_rows(samples.from_samples(_samples(spark, sf)))


@query
def permute(spark, sf):
    """Dates first, then back again."""
    there = samples.permute(_samples(spark, sf))
    first = there.select(
        "tile", "patch_id", F.size("sits").alias("n_dates"), F.posexplode("sits").alias("ti", "d")
    )
    return first.select(
        "tile", "patch_id", "n_dates", "ti", F.size("d").alias("n_bands"),
        F.element_at("d", 1)[5].cast("double").alias("sixth"),
    )


@query
def select_dates(spark, sf):
    chosen = samples.select_dates(_samples(spark, sf), [0, 2, 5], pad=2)
    return _sample_rows(samples.from_samples(chosen))


@query
def load_samples(spark, sf):
    out = load.load_samples(
        tb.frames(spark, sf), ["pixels"], 8, 8, 4, SEED, max_len=6, crop_mode="random"
    )
    return _pixel_rows(out)


# ------------------------------------------------------------ whole tasks


@query
def convert(spark, sf):
    done = tb.cube_s2(spark, sf).where("tile = 'T4' and patch_id = 2").select(
        "tile", "patch_id", "modality"
    )
    fr = conv.convert(tb.cube_s2(spark, sf), [OPTICAL], GRID, GRID, 8, MAX_CLOUD, done, whole_frames=False)
    out = _frame_sums(fr, ["b02", "b03", "mask_nan", "clm"])
    return out.join(
        fr.select("tile", "patch_id", "t", "crop_id", "doy"), ["tile", "patch_id", "t", "crop_id"]
    )


@query
def yearly_convert(spark, sf):
    fr = conv.yearly_convert(
        _both(spark, sf), [OPTICAL, RADAR], [1997, 1999], GRID, GRID, GRID, MAX_CLOUD, whole_frames=False
    )
    return _modal_sums(fr)


DENSE = [conv.Modality("s2", ["v"], "v", "clm", "scl", "double"), conv.Modality("s1_asc", ["v"]), conv.Modality("dem", ["v"])]


def _dense_sums(fr):
    total = F.aggregate("v", F.lit(0.0), lambda acc, v: acc + v)
    nan = F.aggregate(F.col("mask_nan").cast("array<int>"), F.lit(0), lambda acc, v: acc + v)
    return fr.select(*samples.frame_keys(fr), F.round(total, 3).alias("total"), nan.alias("n_nan"))


@query
def convert_whole(spark, sf):
    """Dates judged on whole frames: absent pixels are missing ones."""
    return _dense_sums(conv.convert(tb.dense_cube(spark, sf), DENSE, 8, 8, 4, max_cloud=0.12))


@query
def yearly_whole(spark, sf):
    return _dense_sums(conv.yearly_convert(tb.dense_cube(spark, sf), DENSE[:2], [2016, 2017], 8, 8, 4, 0.12))


@query
def windows_whole(spark, sf):
    """Random windows over whole frames; the layer without a date is part of each repetition."""
    fr = conv.multimodal_windows(
        tb.dense_cube(spark, sf), DENSE, 8, 8, 4, SEED, begin="2017-01-01", end="2018-06-30", max_cloud=0.12
    )
    return _dense_sums(fr)


@query
def crop_time_many(spark, sf):
    """Overlapping windows per item, the first one empty, and layers without a date."""
    starts = F.date_add(F.lit("2016-11-20").cast("date"), F.col("rep") * 23)
    windows = timeline.repeat_items(tb.frames(spark, sf).select("tile", "patch_id").distinct(), 20)
    windows = windows.withColumn("win_start", starts).withColumn("win_end", F.date_add(starts, F.col("rep") * 9 - 9))
    cut = timeline.crop_time(tb.dense_cube(spark, sf), windows)
    return cut.groupBy("modality", "tile", "patch_id", "rep", "win_start").agg(
        F.count("*").alias("n"), F.count_distinct("t").alias("dates"), F.max("t").alias("last")
    )


def _modal_sums(fr):
    keys = samples.frame_keys(fr)
    value = F.coalesce("b03", "vv")
    size = F.size(value)
    total = F.aggregate(value, F.lit(0.0), lambda acc, v: acc + v)
    return fr.select(*keys, size.alias("n_pixels"), F.round(total, 2).alias("total"))


@query
def multimodal_windows(spark, sf):
    fr = conv.multimodal_windows(
        _both(spark, sf),
        [OPTICAL, RADAR],
        GRID,
        GRID,
        8,
        SEED,
        repeat=4,
        begin=SPAN[0],
        end=SPAN[1],
        max_cloud=MAX_CLOUD,
        whole_frames=False,
    )
    return _modal_sums(fr)


@query
def windows_resume(spark, sf):
    """A run that finds one repetition of each patch stored gives the others."""
    done = tb.cube_s2(spark, sf).select("tile", "patch_id", "modality").distinct()
    done = done.unionByName(tb.cube_s1(spark, sf).select("tile", "patch_id", "modality").distinct())
    fr = conv.multimodal_windows(
        _both(spark, sf), [OPTICAL, RADAR], GRID, GRID, 8, SEED, repeat=4, begin=SPAN[0], end=SPAN[1],
        max_cloud=MAX_CLOUD, done=done.withColumn("rep", F.lit(1)), whole_frames=False,
    )
    return _modal_sums(fr)


@query
def nodata_area(spark, sf):
    """Missing pixels per date of a grid of known size; pixels without a row are missing."""
    return quality.date_quality(tb.cube_s2(spark, sf), "b02", area=GRID * GRID).drop("modality")


@query
def normalize_other_modality(spark, sf):
    """Statistics hold for any modality they name; one without statistics stays as it is."""
    name = F.element_at(F.array(*map(F.lit, ("s2", "s2_l1c", "s3"))), F.col("patch_id") % 3 + 1)
    cube = tb.cube_s2(spark, sf).withColumn("modality", name)
    table = [("s2", "b03", 1000.0, 0.0, 5000.0), ("s2_l1c", "b03", 2000.0, 500.0, 9000.0)]
    table = spark.createDataFrame(table, "modality string, band string, med double, qmin double, qmax double")
    out = normalize.transform_modality(cube, table, ["b03"])
    return out.groupBy("modality", "tile").agg(F.round(F.sum("b03"), 4).alias("b03"), F.count("*").alias("n"))


@query
def without_stats(spark, sf):
    table = spark.createDataFrame([("s2", "b03")], "modality string, band string")
    return normalize.without_stats(_both(spark, sf), table, ["b03", "vv"])


@query
def merge_nan(spark, sf):
    """NaN in one file does not hide the value of another."""
    cube = tb.weather(spark, sf).select("tile", "t", "variable", "v")
    nan = F.lit(float("nan"))
    one = cube.withColumn("v", F.when(F.dayofmonth("t") % 2 == 0, nan).otherwise(F.col("v")))
    two = cube.withColumn("v", F.when(F.dayofmonth("t") % 3 == 0, nan).otherwise(F.col("v")))
    return merge.merge_series(one, two, keys=["tile", "t", "variable"])


@query
def rois_with_holes(spark, sf):
    """Pixels in regions of two parts, the first with a hole."""
    tiles = tb.cube_s2(spark, sf).select("tile").distinct()
    rings = F.array(*[
        F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ring])
        for ring in (
            [(1.0, 1.0), (9.0, 1.0), (9.0, 9.0), (1.0, 9.0), (1.0, 1.0)],
            [(3.0, 3.0), (6.0, 3.0), (6.0, 7.0), (3.0, 7.0), (3.0, 3.0)],
            [(11.0, 10.0), (15.0, 10.0), (15.0, 14.0), (11.0, 14.0), (11.0, 10.0)],
        )
    ])
    regions = tiles.withColumn("roi", F.lit(1)).withColumn("ring", join_rings(rings))
    inside = spatial.filter_spatial(tb.cube_s2(spark, sf), regions, PixelGrid(0.0, 0.0, 1.0))
    return inside.groupBy("tile", "y", "x").agg(F.count("*").alias("n"))


@query
def manifest_errors(spark, sf):
    """Manifests without assets or that cannot be read, with the reason."""
    rows = tb.manifests(spark, sf)
    number = F.substring("jobId", 3, 20).cast("int")
    text = F.when(number % 5 == 0, F.substring("manifest", 1, 40)).when(number % 5 == 1, F.lit('{"assets":{}}'))
    text = F.when(number % 5 == 2, F.lit(None).cast("string")).otherwise(F.coalesce(text, "manifest"))
    return manifests.manifest_errors(rows.withColumn("manifest", text)).select("jobId", "reason")


@query
def load_direct(spark, sf):
    out = load.load_direct(
        tb.cube_s2(spark, sf),
        OPTICAL_BANDS,
        GRID,
        GRID,
        8,
        SEED,
        max_len=20,
        crop_mode="random",
        max_cloud=MAX_CLOUD,
        nodata_band="b02",
        stats=_stats_for_norm(spark, sf),
        whole_frames=False,
    )
    return _rounded(out.drop("modality"), OPTICAL_BANDS)


@query
def load_stored(spark, sf):
    """Stored frames: catalog order, dates, crop, transform, padding."""
    fr = tb.frames(spark, sf)
    pixel_stats = stats.band_stats(samples.from_frames(fr, ["pixels"]), ["pixels"])
    pixel_stats = pixel_stats.withColumns({s: F.round(s, 2) for s in stats.STAT_NAMES})
    loaded = load.load_samples(fr, ["pixels"], 8, 8, 4, SEED, max_len=10, stats=pixel_stats)
    rows = samples.from_samples(samples.to_samples(loaded, ["pixels"], 4, 4, 10))
    return _rounded(_sample_rows(rows), ["value"])


def _item_store(spark, sf):
    """Five stored modalities with dates, bands and masks of their own; one lacks a tile."""
    fr = tb.frames(spark, sf).drop("modality")

    def times(k):
        return F.transform("pixels", lambda v: v * F.lit(k).cast("float"))

    radar = fr.where("day(t) % 2 = 0").select(
        "tile", "patch_id", "t", "h", "w", times(2.0).alias("vv"), times(4.0).alias("vh"),
        F.transform("pixels", lambda v: (v > 0).cast("int")).alias("clm"),
    )
    made = ItemStore(spark, new_folder(spark, "items"), f"items_{uuid.uuid4().hex}", 8)
    made.write("s2", fr)
    made.write("s1_asc", radar)
    made.write("s1_desc", radar.where("tile <> 'T1'"))
    made.write("agera5", fr.withColumn("temp", times(0.5)).drop("pixels"))
    first = fr.groupBy("tile", "patch_id", "h", "w").agg(F.min_by("pixels", "t").alias("height"))
    made.write("dem", first.withColumn("t", F.lit(None).cast("date")))
    return made


@query
def load_items(spark, sf):
    """Five modalities of an item in one row, each with its bands, length, masks and statistics."""
    fr = tb.frames(spark, sf)
    pixel_stats = stats.band_stats(samples.from_frames(fr, ["pixels"]), ["pixels"])
    pixel_stats = pixel_stats.withColumns({s: F.round(s, 2) for s in stats.STAT_NAMES})
    options = [
        ItemOption("s2", ("pixels",), 10, stats=pixel_stats),
        ItemOption("s1_asc", ("vv", "vh"), 6, masks=("clm",)),
        ItemOption("s1_desc", ("vv",), 4),
        ItemOption("agera5", ("temp",)),
        ItemOption("dem", ("height",), 3),
    ]
    loaded = item_plans.load_items(_item_store(spark, sf), options, 8, 8, 4, SEED)

    def digest(o):
        m = F.col(o.modality)
        sum_of = lambda a: F.aggregate(F.flatten(F.flatten(a)), F.lit(0.0), lambda x, v: x + v.cast("double"))
        days = F.aggregate(m["doy"], F.lit(0).cast("bigint"), lambda x, v: x + F.coalesce(v, F.lit(0)))
        return F.struct(
            F.lit(o.modality).alias("modality"),
            m["n_dates"].alias("n_dates"),
            F.when(m.isNotNull(), F.size(F.filter(m["padd_mask"], lambda v: v))).alias("padded"),
            F.round(sum_of(m["sits"]), 4).alias("total"),
            days.alias("days"),
            (sum_of(m["masks"]).cast("bigint") if o.masks else F.lit(None).cast("bigint")).alias("masked"),
        )

    return loaded.select("tile", "patch_id", F.inline(F.array(*[digest(o) for o in options])))


@query
def dataset_stats(spark, sf):
    cube = tb.region_cube(spark, sf).withColumn("b04", F.col("clm") * 2.0)
    keys = cube.select("tile", "patch_id")
    return _rounded(
        statistics.dataset_stats(cube, keys, ["b04", "b02"], 10, SEED), ["b02", "b04"]
    ).drop("modality")


@query
def sample_stats(spark, sf):
    table = statistics.sample_stats(
        tb.cube_s1(spark, sf).drop("orbit"), tb.RADAR_BANDS, 3, SEED, 8, ("vv", "vh")
    )
    return _rounded(table, ["vv", "vh", "ratio"]).drop("modality")


@query
def clip_scenes(spark, sf):
    cut = regions.clip_scenes(
        tb.region_cube(spark, sf),
        tb.rois(spark, sf),
        tb.roi_files(spark, sf),
        ["b02", "clm"],
        PIXEL_GRID,
        max_cloud=0.02,
        done=tb.rois(spark, sf).where("roi % 10 = 3").select("tile", "roi"),
    )
    return cut.groupBy("tile", "roi", "t", "h", "w").agg(
        F.count("*").alias("n"), F.count("b02").alias("n_inside"), F.sum("b02").alias("b02")
    )


@query
def clip_tile_grid(spark, sf):
    """Clipping on grids that differ by tile and whose rows run from north to south."""
    number = F.substring("tile", 2, 9).cast("int")
    cube = tb.region_cube(spark, sf).withColumn("y", F.lit(999) - F.col("y"))
    grids = cube.select("tile").distinct().withColumns({"x0": number * 1000.0, "y0": F.lit(10_000.0)})
    moved = F.transform("ring", lambda p: F.struct((p["x"] + number * 1000.0).alias("x"), p["y"].alias("y")))
    areas = tb.rois(spark, sf).withColumn("ring", moved)
    cut = spatial.clip_polygon(
        regions.with_tile_grid(cube, grids),
        regions.with_tile_grid(areas, grids),
        ["b02"],
        regions.TILE_GRID,
        own=True,
    )
    return cut.groupBy("tile", "roi", "t", "h", "w").agg(
        F.count("*").alias("n"), F.count("b02").alias("n_inside"), F.sum("b02").alias("b02")
    )


def _placed_regions(spark, sf):
    """The regions as lon/lat rings of UTM zone 31, 400 km east and 5,000 km north of their pixels."""

    def point(p):
        lon, lat = geometry.to_lonlat(p["x"] + 400_000.0, p["y"] + 5_000_000.0, F.lit(31), F.lit(False))
        return F.struct(lon.alias("x"), lat.alias("y"))

    return tb.rois(spark, sf).withColumn("ring", F.transform("ring", point))


@query
def clip_geojson(spark, sf):
    """Regions of GeoJSON collections, projected and cut from a cube in curve order.

    Each tile's grid has its own origin, which shifts its rows and columns.
    """
    number = F.substring("tile", 2, 9).cast("int")
    cube = tb.region_cube(spark, sf)
    cube = cube.withColumns({"y": F.lit(999) + number - F.col("y"), "x": F.col("x") + 1000 * number})
    path = cube_files.write_curve_cube(cube, new_folder(spark, "curve-cube"))
    geojson = rois.write_roi_collections(_placed_regions(spark, sf), new_folder(spark, "geojson"))
    grids = cube.select("tile").distinct().withColumns(
        {"x0": F.lit(400_000.0) - number * 10_000.0, "y0": F.lit(5_010_000.0) + number * 10.0}
    )
    schema = cube_schema(["b02"]).add("clm", T.IntegerType())
    cut = regions.clip_geojson(spark, geojson, path, schema, grids, ["b02", "clm"], 0.02)
    return cut.groupBy("tile", "roi", "patch_id", "t", "h", "w").agg(
        F.count("*").alias("n"), F.count("b02").alias("n_inside"), F.sum("b02").alias("b02")
    )


@query
def clip_stored(spark, sf):
    """Polygons cut from a cube in curve order, as from one in memory."""
    cube = tb.cube_s2(spark, sf)
    path = cube_files.write_curve_cube(cube, new_folder(spark, "curve-cube"), block_bits=3)
    schema = cube_schema(OPTICAL_BANDS)
    for mask in ("clm", "scl"):
        schema = schema.add(mask, T.IntegerType())
    ranges = spatial.curve_ranges(tb.rois(spark, sf), PIXEL_GRID, 20)
    stored = cube_files.read_curve_cube(spark, path, schema, ranges)
    inside = spatial.sample_by_feature(stored, tb.rois(spark, sf), PIXEL_GRID)
    return inside.groupBy("tile", "roi", "t").agg(
        F.count("*").alias("n"), F.round(F.sum("b03"), 2).alias("b03")
    )


@query
def missing_scenes_everywhere(spark, sf):
    """Gaps among all tiles of the listing."""
    files = tb.scene_files(spark, sf).where("length > 5000")
    tiles = tb.file_tiles(spark, sf)
    return catalog.missing_scenes(catalog.build_catalog(files, ["s2", "s1_asc"], tiles), tiles)


@query
def project_rings(spark, sf):
    """Regions written as lon/lat GeoJSON come back to the metres they were made in."""
    made = regions.generate_rois(tb.tiles_lonlat(spark, sf), 3, 5120, SEED)
    read = rois.read_rois(spark, rois.write_rois(made, new_folder(spark, "rois")))
    read = read.join(made.select("tile", "roi", "zone", "south"), ["tile", "roi"])
    boxes = rois.roi_boxes(regions.project_rings(read))
    size = [F.round(F.col(a) - F.col(b), 1).alias(n) for a, b, n in (("xmax", "xmin", "w"), ("ymax", "ymin", "h"))]
    off = made.select("tile", "roi", F.col("xmin").alias("x"), F.col("ymin").alias("y"))
    met = boxes.join(off, ["tile", "roi"])
    away = F.round(F.abs(F.col("xmin") - F.col("x")) + F.abs(F.col("ymin") - F.col("y")), 1)
    return met.select("tile", "roi", *size, away.alias("away"))


@query
def read_user_stats(spark, sf):
    """Statistics files as users hold them: a file and a header per modality."""
    folder = new_folder(spark, "user-stats")
    for name, cube, bands in (
        ("s2", tb.cube_s2(spark, sf), OPTICAL_BANDS), ("s1_asc", tb.cube_s1(spark, sf), tb.RADAR_BANDS)
    ):
        table = stats.stats_table(stats.band_stats(cube, bands), bands)
        table = table.select(F.col("stat").alias("index"), *bands)
        header = F.concat(F.lit(""), F.lit("," + ",".join(bands)))
        lines = table.select(F.concat_ws(",", "index", *bands).alias("value"))
        lines = table.limit(1).select(header.alias("value"), F.lit(0).alias("i")).unionByName(lines.withColumn("i", F.lit(1)))
        lines.coalesce(1).sortWithinPartitions("i").select("value").write.text(f"{folder}/dataset_{name}.csv")
    return _rounded(stats_files.read_user_stats(spark, folder, ["s2", "s1_asc"]), stats.STAT_NAMES)


@query
def sample_shortfall(spark, sf):
    files = tb.scene_files(spark, sf).withColumn("tile", F.split_part("path", F.lit("/"), F.lit(1)))
    return stats.sample_shortfall(files, 60, [f"T{i}" for i in range(0, 200, 3)], "tile")


@query
def missing_tiles(spark, sf):
    return rois.missing_tiles(tb.tiles_metric(spark, sf), [f"C{i}" for i in range(0, 2000, 7)])


@query
def generate_rois(spark, sf):
    out = regions.generate_rois(tb.tiles_lonlat(spark, sf), 3, 5120, SEED)
    first = F.element_at("ring", 1)
    rows = out.select(
        "tile", "roi", "zone", "xmin", "ymax", F.size("ring").alias("corners"),
        first["x"].alias("lon"), first["y"].alias("lat"),
    )
    return _rounded(_rounded(rows, ["xmin", "ymax"], 3), ["lon", "lat"], 7)


@query
def create_cubes(spark, sf):
    """Optical and radar cubes on one grid, cut per region, with their folder."""
    optical = cube_plans.optical_cube(
        tb.cube_s2(spark, sf), tb.scenes(spark, sf), ["b03"], "1996-01-01", "1998-01-01", 34.0
    )
    radar = cube_plans.aligned_cube(
        tb.cube_s1(spark, sf),
        ["vv"],
        "1996-01-01",
        "1998-01-01",
        1.0,
        GRID,
        GRID,
        FRAME,
        "near",
        {"orbit": "ASCENDING"},
    )
    regions_ = tb.rois(spark, sf)
    cut = merge.union_all(
        cube_plans.cut_per_region(optical, regions_, PIXEL_GRID, "S2"),
        cube_plans.cut_per_region(radar, regions_, PIXEL_GRID, "S1_ASCENDING"),
    )
    return cut.groupBy("target", "roi", "modality").agg(
        F.count("*").alias("n"),
        F.round(F.coalesce(F.sum("b03"), F.sum("vv")), 2).alias("total"),
    )


@query
def resolve_manifests(spark, sf):
    listed = tb.manifests(spark, sf)
    keyed = listed.select(
        F.concat(F.lit("vito-"), "jobId").alias("job_id"), "manifest"
    )
    report = listed.select("jobId").where("length(manifest) % 3 != 0")
    done = manifests.manifest_assets(keyed, "base").where("asset = 'stac.json' and year = '2018'")
    return cube_plans.resolve_manifests(report, keyed, "base", done)


@query
def ingest_stream(spark, sf):
    target = ingest.IngestTarget(new_folder(spark, "ingest"))
    staged = new_folder(spark, "arrivals")
    tb.cube_s2(spark, sf).write.option("maxRecordsPerFile", 20000).parquet(staged)
    source = (
        spark.readStream.schema(tb.cube_s2(spark, sf).schema)
        .option("maxFilesPerTrigger", 8)
        .parquet(staged)
    )
    ingest.ingest_stream(source, target, OPTICAL_BANDS, "b02").awaitTermination()
    usable = ingest.ingested_usable(spark, target, 0.3, MAX_CLOUD)
    return usable.select(*PIXEL, *OPTICAL_BANDS)


@query
def ingest_redelivered(spark, sf):
    """Years in three deliveries that repeat earlier ones; the first years come after the watermark."""
    target = ingest.IngestTarget(new_folder(spark, "ingest"))
    staged = new_folder(spark, "arrivals")
    cube = tb.unique_s2(spark, sf)
    for arrives in ("t >= '1998-01-01' and t < '2001-01-01'", "month(t) < 10 and t >= '1996-06-01'", "true"):
        cube.where(arrives).write.mode("append").parquet(staged)
        source = spark.readStream.schema(cube.schema).parquet(staged)
        ingest.ingest_stream(source, target, OPTICAL_BANDS, "b02", delay_days=1500).awaitTermination()
    usable = ingest.ingested_usable(spark, target, 0.3, MAX_CLOUD).withColumn("late", F.lit(False))
    late = ingest.ingested_late(spark, target).withColumn("late", F.lit(True))
    return merge.union_all(usable, late).select(*PIXEL, *OPTICAL_BANDS, "late")
