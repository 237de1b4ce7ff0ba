"""Statistics as CSV: rows med, qmin, qmax and one column per band."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.operators.merge import union_all
from skylattice.operators.stats import merge_stats, stats_from_table, stats_table


def write_stats(stats: DataFrame, bands: list[str], path: str, mode="error") -> str:
    """Statistics of all modalities, in a folder per modality (three rows each)."""
    table = stats_table(stats, bands).orderBy("modality", "stat")
    table.coalesce(1).write.mode(mode).partitionBy("modality").option("header", "true").csv(path)
    return path


def read_stats(
    spark: SparkSession, path: str, bands: list[str], modality: str | None = None
) -> DataFrame:
    """(modality, band, med, qmin, qmax) of the listed bands, found by their header."""
    table = spark.read.option("header", "true").csv(path)
    if modality is not None:
        table = table.where(F.col("modality") == modality)
    typed = table.select("modality", "stat", *[F.col(b).cast("double").alias(b) for b in bands])
    return stats_from_table(typed, bands)


def read_user_stats(spark: SparkSession, folder: str, modalities: list[str]) -> DataFrame:
    """Statistics in the layout users hold: one ``dataset_<modality>.csv`` per modality, an
    unnamed first column with ``med``, ``qmin``, ``qmax``, and the bands of that modality."""

    def one(modality: str) -> DataFrame:
        table = spark.read.option("header", "true").csv(f"{folder}/dataset_{modality}.csv")
        index, *bands = table.columns
        typed = table.select(
            F.lit(modality).alias("modality"),
            F.col(f"`{index}`").alias("stat"),
            *[F.col(f"`{b}`").cast("double").alias(b) for b in bands],
        )
        return stats_from_table(typed, bands)

    return union_all(*[one(m) for m in modalities])


def read_merged_stats(spark, paths_and_bands: list[tuple[str, list[str]]], modality="agera5"):
    """Per-variable statistics files as the statistics of one modality."""
    return merge_stats([read_stats(spark, p, b) for p, b in paths_and_bands], modality)
