"""Incremental ingest of new cube files.

Each trigger takes the files that arrived since the last one, cleans their pixels and
appends them, together with the frames' partial quality counts. Counts of a frame add up
over batches, so a date whose pixels arrive in several files is judged on all of them: the
stream gives the same usable dates as a batch run over everything.

All outputs are written under the batch number and a repeated batch replaces its own
folder, so a batch that is run again after a failure leaves no duplicates. Counts are written
last; pixels of a batch without counts are not seen by readers.

With ``delay_days`` the ingest also withstands deliveries that repeat. The stored table is its
own state: a batch looks up only those frames of its own that earlier batches hold, from the
earliest batch that holds one, so a batch of new dates looks up nothing. A pixel that comes
again is taken once; if its values differ, the first stay and the others are listed. Rows more
than ``delay_days`` before the latest date of the earlier batches are listed as late and not
taken, so what has passed the watermark no longer changes.
"""

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylattice.operators.quality import (
    clean_missing,
    date_quality,
    join_frames,
    keep_frames,
    usable_frames,
)
from skylattice.schema import FRAME, PIXEL
from skylattice.session import settle


@dataclass(frozen=True)
class IngestTarget:
    """Folders of one ingest: pixels, frame counts, rejected rows and the stream's progress."""

    root: str

    @property
    def pixels(self) -> str:
        return f"{self.root}/pixels"

    @property
    def counts(self) -> str:
        return f"{self.root}/counts"

    @property
    def late(self) -> str:
        return f"{self.root}/late"

    @property
    def revised(self) -> str:
        return f"{self.root}/revised"

    @property
    def progress(self) -> str:
        return f"{self.root}/progress"


def _earlier(spark: SparkSession, path: str, schema, batch_id: int) -> DataFrame:
    """What the batches before ``batch_id`` wrote, with their number."""
    stored = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    if batch_id == 0:
        return spark.createDataFrame([], stored)
    return spark.read.schema(stored).parquet(path).where(F.col("batch") < batch_id)


def _one_per_pixel(batch: DataFrame) -> DataFrame:
    """One row per pixel, the least by value, and ``others``: whether another one differs."""
    values = F.struct(*[c for c in batch.columns if c not in PIXEL])
    each = batch.groupBy(*PIXEL).agg(F.min(values).alias("values"), F.max(values).alias("most"))
    return each.select(*PIXEL, "values", (~F.col("values").eqNullSafe(F.col("most"))).alias("others"))


def _same_pixel(a: str, b: str):
    """Dates are compared null-safely: a static layer has none."""
    keys = [F.col(f"{a}.{k}") == F.col(f"{b}.{k}") for k in PIXEL if k != "t"]
    return reduce(and_, keys, F.col(f"{a}.t").eqNullSafe(F.col(f"{b}.t")))


def _judge(clean: DataFrame, target: IngestTarget, batch_id: int, quality_schema, delay_days: int):
    """The written batch, its pixels with ``verdict`` (take, again or revised), the test for late rows."""
    spark = clean.sparkSession
    clean = settle(clean, "ingest-batch")
    counts = _earlier(spark, target.counts, quality_schema, batch_id)
    latest = counts.agg(F.max("t")).first()[0]
    limit = F.date_sub(F.lit(latest).cast("date"), delay_days)
    late = F.coalesce(F.col("t") < limit, F.lit(False))
    once = _one_per_pixel(clean.where(~late))
    mine = clean.where(~late).select(*FRAME).distinct()
    seen = settle(join_frames(counts.select(*FRAME, "batch"), mine, "left_semi"), "ingest-seen")
    first, low, high, undated = seen.agg(
        F.min("batch"), F.min("t"), F.max("t"), F.count_if(F.col("t").isNull())
    ).first()
    if first is None:
        judged = once.withColumn("verdict", F.lit("take"))
    else:
        span = F.col("t").between(F.lit(low), F.lit(high)) if low is not None else F.lit(False)
        stored = _earlier(spark, target.pixels, clean.schema, batch_id).where(F.col("batch") >= first)
        stored = stored.where(span | F.col("t").isNull() if undated else span)
        stored = join_frames(stored, seen.select(*FRAME).distinct(), "left_semi")
        held = stored.select(*PIXEL, F.struct(*[c for c in clean.columns if c not in PIXEL]).alias("values"))
        same = F.col("n.values").eqNullSafe(F.col("h.values"))
        verdict = F.when(F.col("h.tile").isNull(), "take").when(same, "again").otherwise("revised")
        judged = once.alias("n").join(held.alias("h"), _same_pixel("n", "h"), "left")
        judged = judged.select("n.*", verdict.alias("verdict"))
    return clean, judged, late


def ingest_stream(
    source: DataFrame,
    target: IngestTarget,
    bands,
    nodata_band,
    cloud="clm",
    scene_class="scl",
    delay_days: int | None = None,
):
    """Start the ingest of a streaming cube; it ends once everything at hand is taken in.

    Without ``delay_days`` every row that arrives is taken, pixels with several rows included.
    """

    def write(df: DataFrame, folder: str, batch_id: int) -> str:
        path = f"{folder}/batch={batch_id}"
        df.write.mode("overwrite").parquet(path)
        return path

    def take_in(batch: DataFrame, batch_id: int):
        clean = taken = clean_missing(batch, bands)
        spark = batch.sparkSession
        if delay_days is not None:
            empty = date_quality(clean, nodata_band, cloud, scene_class)
            clean, judged, late = _judge(clean, target, batch_id, empty.schema, delay_days)
            judged = settle(judged, "ingest-judged")
            columns = [F.col(c) if c in PIXEL else F.col(f"values.{c}") for c in clean.columns]
            taken = judged.where("verdict = 'take'").select(*columns)
            # rows of a pixel that differ: from the stored ones, or among those of the batch
            differ = judged.where("verdict = 'revised' or others").select(*PIXEL, "values", "verdict")
            values = F.struct(*[F.col(f"c.{c}") for c in clean.columns if c not in PIXEL])
            other = (F.col("d.verdict") == "revised") | ~values.eqNullSafe(F.col("d.values"))
            revised = clean.alias("c").join(differ.alias("d"), _same_pixel("c", "d")).where(other)
            write(revised.select("c.*").distinct(), target.revised, batch_id)
            write(clean.where(late).distinct(), target.late, batch_id)
        written = write(taken, target.pixels, batch_id)
        # counted on what was written: the batch is evaluated once
        taken = spark.read.schema(clean.schema).parquet(written)
        write(date_quality(taken, nodata_band, cloud, scene_class), target.counts, batch_id)

    return (
        source.writeStream.foreachBatch(take_in)
        .option("checkpointLocation", target.progress)
        .trigger(availableNow=True)
        .start()
    )


def ingested_pixels(spark: SparkSession, target: IngestTarget) -> DataFrame:
    """Pixels of all batches that are complete, which is known by their counts."""
    done = spark.read.parquet(target.counts).agg(F.max("batch")).first()[0]
    pixels = spark.read.parquet(target.pixels)
    return pixels.where(F.col("batch") <= (-1 if done is None else done)).drop("batch")


def ingested_late(spark: SparkSession, target: IngestTarget) -> DataFrame:
    """Distinct rows that came after the watermark had passed their date."""
    return spark.read.parquet(target.late).drop("batch").distinct()


def ingested_revised(spark: SparkSession, target: IngestTarget) -> DataFrame:
    """Distinct rows whose pixel was taken with other values."""
    return spark.read.parquet(target.revised).drop("batch").distinct()


def ingested_quality(spark: SparkSession, target: IngestTarget, area: int | None = None) -> DataFrame:
    """``date_quality`` over all batches: partial counts summed per frame.

    With ``area``, the grid size h*w, pixels that never came count as missing.
    """
    partial = spark.read.parquet(target.counts).drop("batch")
    counters = [c for c in partial.columns if c not in FRAME]
    total = partial.groupBy(*FRAME).agg(*[F.sum(c).alias(c) for c in counters])
    if area is None:
        return total
    size = F.lit(area).cast("long")
    if "n_nan" in counters:
        total = total.withColumn("n_nan", F.greatest(size - (F.col("n") - F.col("n_nan")), F.lit(0)))
    return total.withColumn("n", size)


def ingested_usable(spark, target, max_nodata, max_cloud, area: int | None = None) -> DataFrame:
    """Pixels taken in so far whose date passes the tests."""
    frames = usable_frames(ingested_quality(spark, target, area), max_nodata, max_cloud)
    return keep_frames(ingested_pixels(spark, target), frames)
