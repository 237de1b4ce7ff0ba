"""Sketches of stored files, kept beside them and extended when files are added.

Each run takes the files that no earlier run took and appends their sketches, one per file,
group and band. Statistics of everything stored are sums over the kept sketches, so adding
files reads the new ones only. Exact statistics divide only the cells that hold the wanted ranks.

Sketches are written under the batch number and a repeated batch replaces its own folder, so
a batch that is run again after a failure counts nothing twice. Files are taken as they were
when first seen: a file that is rewritten under its old name is not read again.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.constants import STATS_QMAX, STATS_QMIN
from skylattice.operators.sketches import (
    Quantile,
    merge_sketches,
    refined_quantiles,
    sketch,
    sketch_quantiles,
)


@dataclass(frozen=True)
class SketchStore:
    """Folder of the sketches of one dataset and of the progress over its files."""

    root: str

    @property
    def cells(self) -> str:
        return f"{self.root}/cells"

    @property
    def progress(self) -> str:
        return f"{self.root}/progress"


def _long(cube: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    typed = cube.select(*keys, *[F.col(b).cast("double").alias(b) for b in bands])
    return typed.unpivot(keys, bands, "band", "value")


def sketch_new_files(source: DataFrame, store: SketchStore, bands, by=("modality",)):
    """Start a run over the files of a streaming cube; it ends once all at hand are taken in."""
    keys = ["file", *by]

    def take_in(batch: DataFrame, batch_id: int):
        found = sketch(_long(batch, keys, bands), [*keys, "band"], "value")
        found.write.mode("overwrite").parquet(f"{store.cells}/batch={batch_id}")

    named = source.select("*", F.col("_metadata.file_path").alias("file"))
    return (
        named.writeStream.foreachBatch(take_in)
        .option("checkpointLocation", store.progress)
        .trigger(availableNow=True)
        .start()
    )


def stored_sketch(spark: SparkSession, store: SketchStore, by=("modality",)) -> DataFrame:
    """The sketch of all files taken in so far, per group and band."""
    return merge_sketches(spark.read.parquet(store.cells), [*by, "band"])


def stored_stats(
    spark: SparkSession,
    store: SketchStore,
    bands=None,
    by=("modality",),
    qmin=STATS_QMIN,
    qmax=STATS_QMAX,
    median="mean",
    cube: DataFrame | None = None,
) -> DataFrame:
    """Median and two quantiles per group and band over all files taken in so far.

    Without ``cube`` no pixel is read and each figure is within two percent of its value. With
    the stored ``cube`` and its ``bands`` they are exact: its first pass is spared, and only the
    cells of the wanted ranks are looked up. The cube must hold the files that were taken in.
    """
    if median not in ("mean", "lower"):
        raise ValueError(f"unknown median {median!r}")
    keys = [*by, "band"]
    quantiles = [Quantile("med", 0.5, median == "lower"), Quantile("qmin", qmin), Quantile("qmax", qmax)]
    kept = stored_sketch(spark, store, by)
    if bands is not None:
        kept = kept.where(F.col("band").isin(list(bands)))
    if cube is None:
        return sketch_quantiles(kept, keys, quantiles)
    if bands is None:
        raise ValueError("exact statistics need the bands of the cube")
    return refined_quantiles(_long(cube, list(by), list(bands)), kept, keys, "value", quantiles)
