"""Cube and sample tables on disk."""

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylattice.functions.curve import position

DIRECTORIES = ["modality", "tile", "year"]
BLOCK = "block_"
BLOCK_BITS = 9  # a block of a curve-ordered cube is a square of 2^9 pixels


def write_cube(cube: DataFrame, path: str, mode="error") -> str:
    """Parquet under modality / tile / year.

    Rebalancing gathers each directory's rows and splits a directory that is too large for
    one task, so a hot tile becomes several files. Rows are sorted by patch and date within
    each task, which gives row groups narrow ranges to skip by.
    """
    by_year(cube.withColumn("year", F.year("t"))).mode(mode).parquet(path)
    return path


def by_year(rows: DataFrame):
    """Writer of rows that have their ``year``."""
    return (
        rows.hint("rebalance", *DIRECTORIES)
        .sortWithinPartitions(*DIRECTORIES, "patch_id", "t")
        .write.partitionBy(*DIRECTORIES)
    )


def read_cube(
    spark: SparkSession, path: str, schema, modality=None, tiles=None, years=None
) -> DataFrame:
    """Scan of a cube; modality, tiles and years prune directories.

    A patch's yearly files are simply rows of several partitions, so a multi-file series
    needs no concatenation step.
    """
    with_year = T.StructType([*schema.fields, T.StructField("year", T.IntegerType())])
    cube = spark.read.schema(with_year).parquet(path)
    if modality is not None:
        cube = cube.where(F.col("modality") == modality)
    if tiles is not None:
        cube = cube.where(F.col("tile").isin(list(tiles)))
    if years is not None:
        cube = cube.where(F.col("year").isin([int(y) for y in years]))
    return cube


def write_curve_cube(cube: DataFrame, path: str, mode="error", block_bits=BLOCK_BITS) -> str:
    """Parquet under modality / tile / year / block, in the order of a space-filling curve.

    A block is a square of pixels, so a region's surroundings are the only directories it
    needs, and within a block row groups hold narrow ranges of ``curve``. A large directory is
    split over several tasks, and so over files. The directory's name tells the block's size.
    """
    block = f"{BLOCK}{block_bits}"
    keys = ["modality", "tile", "year", block]
    placed = cube.withColumn("year", F.year("t")).withColumn("curve", position(F.col("y"), F.col("x")))
    (
        placed.withColumn(block, F.shiftright("curve", 2 * block_bits))
        .hint("rebalance", *keys)
        .sortWithinPartitions(*keys, "curve", "t")
        .write.mode(mode)
        .partitionBy(*keys)
        .parquet(path)
    )
    return path


def read_curve_cube(
    spark: SparkSession, path: str, schema, ranges: DataFrame | None = None
) -> DataFrame:
    """Scan of a curve-ordered cube, of the stretches ``tile, low, high`` of the curve only.

    ``ranges`` comes from ``operators.spatial.curve_ranges``, which bounds the number of its
    rows; they become predicates on tile and block, which prune directories, and on ``curve``,
    which row groups are skipped by. More pixels than asked for may come back, never fewer.
    """
    block = next((c for c in spark.read.parquet(path).columns if c.startswith(BLOCK)), None)
    if block is None:
        raise ValueError(f"{path} is not a cube in curve order")
    block_bits = int(block.removeprefix(BLOCK))
    more = [("curve", T.LongType()), ("year", T.IntegerType()), (block, T.LongType())]
    stored = T.StructType([*schema.fields, *[T.StructField(*f) for f in more]])
    cube = spark.read.schema(stored).parquet(path)
    if ranges is not None:
        by_tile: dict[str, list] = {}
        for r in ranges.select("tile", "low", "high").collect():
            by_tile.setdefault(r.tile, []).append((r.low, r.high))
        wanted = [
            (F.col("tile") == tile)
            & reduce(or_, [F.col(block).between(a >> 2 * block_bits, b >> 2 * block_bits) & F.col("curve").between(a, b) for a, b in spans])
            for tile, spans in sorted(by_tile.items())
        ]
        cube = cube.where(reduce(or_, wanted, F.lit(False)))
    return cube.select(*schema.names)


def write_samples(samples: DataFrame, path: str, mode="error") -> str:
    """Sample rows (frames, heads or nested samples) under modality / tile.

    Patch, crop, year and repetition stay columns, so a sample is found by its keys.
    """
    (
        samples.hint("rebalance", "modality", "tile")
        .write.mode(mode)
        .partitionBy("modality", "tile")
        .parquet(path)
    )
    return path


def read_samples(spark, path, schema, modality=None, tiles=None) -> DataFrame:
    samples = spark.read.schema(schema).parquet(path)
    if modality is not None:
        samples = samples.where(F.col("modality") == modality)
    if tiles is not None:
        samples = samples.where(F.col("tile").isin(list(tiles)))
    return samples


def pending(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work items whose keys are not among the finished ones."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")
