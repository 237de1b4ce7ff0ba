"""Selection: collections, properties, modalities, bands and their types.

All of these are filters and projections, so they reach the Parquet scan as pushed
predicates and a pruned read schema.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylattice.constants import OPTIONS, WEATHER_SHORT_NAMES
from skylattice.schema import PIXEL
from skylattice.session import settle


def _keys(cube: DataFrame) -> list[str]:
    return [c for c in PIXEL if c in cube.columns]


def load_collection(cube, start=None, end=None, bands=None, tiles: DataFrame | None = None) -> DataFrame:
    """Dates in the half-open range [start, end), the listed bands and the tiles of ``tiles``.

    Of a stored cube, whose directories are years, the range is also stated on ``year``, so
    that directories outside it are not listed.
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    stored = "year" in cube.columns
    if start is not None:
        cube = cube.where(F.col("t") >= first)
        cube = cube.where(F.col("year") >= F.year(first)) if stored else cube
    if end is not None:
        cube = cube.where(F.col("t") < last)
        cube = cube.where(F.col("year") <= F.year(F.date_sub(last, 1))) if stored else cube
    if tiles is not None:
        cube = of_tiles(cube, tiles)
    return cube if bands is None else select_bands(cube, bands)


def of_tiles(cube: DataFrame, tiles: DataFrame, keys=("tile",)) -> DataFrame:
    """Rows whose tile (or other ``keys``) occurs in ``tiles``.

    The distinct keys are written first. While they are small enough to be broadcast, the
    predicate on their count lets Spark prune a stored cube's directories by them at run time.
    """
    wanted = settle(tiles.groupBy(*keys).agg(F.count("*").alias("n")), "tiles").where("n > 0")
    return cube.join(wanted, list(keys), "left_semi")


def filter_props(cube: DataFrame, props: dict) -> DataFrame:
    """Keep rows whose scene properties equal the given values."""
    for name, value in props.items():
        cube = cube.where(F.col(name) == F.lit(value))
    return cube


def filter_scene_cloud(cube: DataFrame, scenes: DataFrame, max_cloud=100.0) -> DataFrame:
    """Keep dates whose scene (tile, t) reports at most ``max_cloud`` percent cloud."""
    clear = scenes.where(F.col("cloud_cover") <= F.lit(float(max_cloud))).select("tile", "t")
    return cube.join(clear, ["tile", "t"], "left_semi")


def select_modalities(cube: DataFrame, opt: str) -> DataFrame:
    if opt not in OPTIONS:
        raise ValueError(f"unknown option {opt!r}, expected one of {sorted(OPTIONS)}")
    return cube.where(F.col("modality").isin(OPTIONS[opt]))


def select_bands(cube: DataFrame, bands: list[str]) -> DataFrame:
    return cube.select(*_keys(cube), *bands)


def drop_bands(cube: DataFrame, names: list[str]) -> DataFrame:
    return cube.drop(*names)


def order_bands(cube: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Bands in the given order, alphabetically by default; keys stay in front."""
    keys = _keys(cube)
    bands = order or sorted(c for c in cube.columns if c not in keys)
    return cube.select(*keys, *bands)


def stack_bands(cube: DataFrame, bands: list[str], as_type="double") -> DataFrame:
    """One row per pixel and band."""
    keys = _keys(cube)
    typed = cube.select(*keys, *[F.col(b).cast(as_type).alias(b) for b in bands])
    return typed.unpivot(keys, bands, "band", "value")


def cast_bands(cube: DataFrame, bands: list[str], dtype: str) -> DataFrame:
    """Cast bands; values that do not fit (NaN, infinities) become NULL."""
    return cube.withColumns({b: F.col(b).try_cast(dtype) for b in bands})


def weather_suffix(bands: list[str]) -> str:
    """Name suffix of a weather cube that holds these bands."""
    return "_".join(WEATHER_SHORT_NAMES[b] for b in bands)


def split_bands(cube: DataFrame, bands: list[str]) -> DataFrame:
    """One cube per band in long form; ``suffix`` names the cube each row belongs to."""
    short = F.create_map(*[F.lit(v) for b in bands for v in (b, WEATHER_SHORT_NAMES.get(b, b))])
    return stack_bands(cube, bands).withColumn("suffix", short[F.col("band")])
