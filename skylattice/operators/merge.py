"""Merging series, variables and modalities of the same patch."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylattice.functions.masks import missing
from skylattice.operators.samples import sample_keys
from skylattice.schema import PIXEL
from skylattice.session import settle


def union_all(*tables: DataFrame) -> DataFrame:
    """Row-wise union by column name; columns a table lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def _merged(rows: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    """Value and conflict flag per key and band.

    Min and max of the present values tell both the common value and whether it is common;
    unlike a distinct count they combine on the map side. NaN counts as absent.
    """
    aggs = []
    for b in bands:
        present = F.when(~missing(rows, b), F.col(b))
        aggs.append(F.max(present).alias(b))
        aggs.append((F.min(present) != F.max(present)).alias(f"_{b}_differs"))
    return rows.groupBy(*keys).agg(*aggs)


def merge_series(*cubes: DataFrame, keys=PIXEL) -> DataFrame:
    """Outer merge of several files of the same patches: the present value of each pixel.

    Use ``merge_conflicts`` to see pixels for which the files disagree; they are set to NULL.
    """
    rows = union_all(*cubes)
    bands = [c for c in rows.columns if c not in keys]
    merged = _merged(rows, keys, bands)
    clean = [F.when(~F.coalesce(F.col(f"_{b}_differs"), F.lit(False)), F.col(b)).alias(b) for b in bands]
    return merged.select(*keys, *clean)


def merge_conflicts(*cubes: DataFrame, keys=PIXEL) -> DataFrame:
    """One row per key and band whose present values differ between the inputs."""
    rows = union_all(*cubes)
    bands = [c for c in rows.columns if c not in keys]
    merged = _merged(rows, keys, bands)
    flags = merged.select(
        *keys, *[F.coalesce(F.col(f"_{b}_differs"), F.lit(False)).alias(b) for b in bands]
    )
    return flags.unpivot(keys, bands, "band", "differs").where("differs").drop("differs")


def merge_variables(*cubes: DataFrame, keys) -> DataFrame:
    """Outer merge of one-variable cubes into one wide cube.

    One union and one aggregate instead of a chain of full outer joins: a single shuffle for
    any number of variables. A variable given twice collapses.
    """
    return merge_series(*cubes, keys=keys)


def pivot_variables(long: DataFrame, variables: list[str], keys, name="variable", value="v"):
    """Wide cube from (keys, variable, value) rows that already share one table."""
    wide = long.groupBy(*keys).agg(
        *[F.max(F.when(F.col(name) == v, F.col(value))).alias(v) for v in variables]
    )
    return wide


def assemble_items(heads: DataFrame, modalities: list[str], on=None) -> DataFrame:
    """One row per item with one struct per modality, NULL where the modality is absent.

    An item is a sample: by default a patch with its crop, repetition, year and region as far
    as ``heads`` has them. Every modality keeps its own time axis. Modalities meet by key,
    never by position; two rows of a modality in one item are an error.
    """
    on = [k for k in (on or sample_keys(heads)) if k != "modality"]
    fields = [c for c in heads.columns if c not in on and c != "modality"]
    pack = F.struct(*fields)

    def one(m: str):
        own = F.col("modality") == m
        name = F.concat_ws(" ", *on)
        twice = F.raise_error(F.concat(F.lit(f"more than one {m} in item "), F.first(name)))
        only = F.first(F.when(own, pack), ignorenulls=True)
        return F.when(F.count_if(own) < 2, only).otherwise(F.when(twice.isNull(), only)).alias(m)

    return heads.groupBy(*on).agg(*[one(m) for m in modalities])


def item_keys(catalog: DataFrame, tile="tile", patch="patch_id") -> DataFrame:
    """Consecutive item numbers in (tile, patch) order, as integer ``item``.

    Patches may be numbers or names; several files of a patch are one item. The items are
    written in ranges of their order, and the number is the count of the ranges before plus
    the rank within the range. A range is what one task sorts; no task receives the whole
    catalog, however many patches a tile has.
    """
    items = catalog.select(tile, patch).distinct()
    ranges = items.repartitionByRange(tile, patch).withColumn("_range", F.spark_partition_id())
    items = settle(ranges, "items")
    counts = items.groupBy("_range").agg(F.count("*").alias("_n"))
    # one row per range
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_range").orderBy(tile, patch)) - 1
    numbered = items.withColumn("_rank", rank).join(counts, "_range")
    return numbered.select((F.col("_before") + F.col("_rank")).alias("item"), tile, patch)
