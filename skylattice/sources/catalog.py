"""Catalogs of scene and sample files.

A catalog has one row per file. A patch with several yearly files has several rows; they
are not packed into one array, so no task has to hold all files of a patch.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skylattice.constants import (
    JOB_ID_PREFIX,
    MODALITY_TOKENS,
    RAW_LENGTH_PRIORITY,
    SAMPLE_SUFFIX,
    SCENE_STEM,
    SCENE_SUFFIX,
    SMALL_FILE_KIB,
)
from skylattice.session import settle


def list_files(spark: SparkSession, root: str, glob="*") -> DataFrame:
    """(path, length) of all files below ``root``; the contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "length")
    )


def _file_name(path: str) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def tile_table(spark: SparkSession, tiles: list[str] | DataFrame) -> DataFrame:
    """The different requested tiles as a written table ``s2_tile``; a table's first column counts.

    Its true size is known, so Spark broadcasts it only if it is small.
    """
    if isinstance(tiles, DataFrame):
        named = tiles.select(F.col(tiles.columns[0]).alias("s2_tile")).where("s2_tile is not null")
    else:
        named = spark.createDataFrame([(t,) for t in tiles], "s2_tile string")
    return settle(named.distinct(), "tiles")


def _in_requested_tile(files: DataFrame, tiles: DataFrame) -> DataFrame:
    """Rows with the requested tile that names one of the path's directories, as ``s2_tile``,
    and the directories below it, as ``_below``. A path that names two of them is in both.

    Directories are joined with the tiles, so a file costs its depth and not the number of
    tiles.
    """
    parts = F.split("path", "/")
    rows = files.withColumn("_dirs", F.slice(parts, F.lit(1), F.size(parts) - 1))
    rows = rows.withColumn("s2_tile", F.explode(F.array_distinct("_dirs"))).join(tiles, "s2_tile")
    at = F.array_position("_dirs", F.col("s2_tile")).cast("int")
    return rows.withColumn("_below", F.slice("_dirs", at + 1, F.size("_dirs"))).drop("_dirs")


def scene_catalog(files: DataFrame, modality: str, tiles: list[str] | DataFrame) -> DataFrame:
    """Clipped scene files of one modality in the requested tiles."""
    return build_catalog(files, [modality], tiles)


def build_catalog(files: DataFrame, modalities: list[str], tiles: list[str] | DataFrame) -> DataFrame:
    """(mod, patch_id, s2_tile, sits_path) for several modalities in one pass.

    A file belongs to a modality if a directory below the tile contains its token. The
    tokens are a literal list, so this is a per-row test and not a join.
    """
    wanted = tile_table(files.sparkSession, tiles)
    scenes = _in_requested_tile(files.where(F.col("path").endswith(SCENE_SUFFIX)), wanted)
    known = F.array(
        *[
            F.struct(F.lit(m).alias("mod"), F.lit(MODALITY_TOKENS[m]).alias("token"))
            for m in modalities
        ]
    )
    matching = F.filter(
        known, lambda k: F.exists("_below", lambda d: F.contains(d, k["token"]))
    )
    return scenes.withColumn("_m", F.explode(matching)).select(
        F.col("_m.mod").alias("mod"),
        _file_name("path").alias("patch_id"),
        "s2_tile",
        F.col("path").alias("sits_path"),
        *[c for c in ("length",) if c in files.columns],
    )


def catalog_summary(catalog: DataFrame) -> DataFrame:
    """One row per scene: number of its files and the first and last path."""
    return catalog.groupBy("mod", "patch_id", "s2_tile").agg(
        F.count("*").alias("n_files"),
        F.min("sits_path").alias("first_path"),
        F.max("sits_path").alias("last_path"),
    )


def missing_scenes(catalog: DataFrame, tiles: list[str] | DataFrame) -> DataFrame:
    """(mod, patch_id, s2_tile) for each requested tile that lacks a patch found elsewhere.

    Patches of all tiles of the catalog count, requested or not. Requested tiles are numbered,
    and what lies between two neighbouring numbers of a patch is missing, so the work is that
    of the scenes at hand and of the gaps; a complete patch makes no rows.
    """
    wanted = tile_table(catalog.sparkSession, tiles)
    # one row per tile of the survey: a small table in one task
    numbered = wanted.withColumn("_n", F.row_number().over(Window.orderBy("s2_tile")) - 1)
    numbered = settle(numbered, "numbered-tiles")
    end = numbered.count()
    present = catalog.select("mod", "patch_id", "s2_tile").distinct()
    have = present.join(numbered, "s2_tile").select("mod", "patch_id", "_n")
    before_all = present.select("mod", "patch_id", F.lit(-1).alias("_n")).distinct()
    after = F.lead("_n", 1, end).over(Window.partitionBy("mod", "patch_id").orderBy("_n"))
    gaps = have.unionByName(before_all).withColumn("_next", after).where("_next > _n + 1")
    lacking = gaps.select("mod", "patch_id", F.explode(F.expr("sequence(_n + 1, _next - 1)")).alias("_n"))
    return lacking.join(numbered, "_n").select("mod", "patch_id", "s2_tile")


def distinct_patches(catalog: DataFrame) -> DataFrame:
    return catalog.select("mod", "patch_id").distinct()


def sample_catalog(files: DataFrame, tiles: list[str], modalities: list[str]) -> DataFrame:
    """Stored samples, sorted by path. ``patch_id`` is the fixed two characters that follow
    the last scene stem; ``patch_no`` is the whole number."""
    samples = files.where(F.col("path").endswith(SAMPLE_SUFFIX))
    name = _file_name("path")
    parent = F.element_at(F.split("path", "/"), -2)
    known = F.array(*[F.lit(m) for m in modalities])
    after_stem = F.element_at(F.split(name, SCENE_STEM), -1)
    return (
        samples.where(parent.isin(list(tiles)))
        .withColumn("mod", F.explode(F.filter(known, lambda m: F.contains(name, m))))
        .select(
            "mod",
            F.substring(after_stem, 1, 2).alias("patch_id"),
            F.regexp_extract(after_stem, r"^(\d+)", 1).try_cast("int").alias("patch_no"),
            parent.alias("s2_tile"),
            F.col("path").alias("sits_path"),
        )
        .orderBy("sits_path")
    )


def catalog_len(catalog: DataFrame, priority=RAW_LENGTH_PRIORITY) -> DataFrame:
    """Number of items, a patch of a tile each, of the first modality of ``priority`` that is
    present; yearly files of a patch are one item."""
    order = F.array_position(F.array(*[F.lit(m) for m in priority]), F.col("mod"))
    items = catalog.where(F.col("mod").isin(priority)).select("mod", "s2_tile", "patch_id").distinct()
    counts = items.groupBy("mod").agg(F.count("*").alias("n_items"))
    return counts.withColumn("_order", order).orderBy("_order").limit(1).drop("_order")


def small_files(files: DataFrame, kib=SMALL_FILE_KIB) -> DataFrame:
    """Files whose size, rounded up to whole KiB, is below ``kib``."""
    return files.where(F.ceil(F.col("length") / F.lit(1024)) < kib)


def job_ids(spark: SparkSession, path: str) -> DataFrame:
    """Prefixed ids of a job report (CSV with a header and a ``jobId`` column)."""
    report = spark.read.option("header", "true").csv(path)
    return report.select(F.concat(F.lit(JOB_ID_PREFIX), F.col("jobId")).alias("job_id"))
