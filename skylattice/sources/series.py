"""Cubes that grow by merging further deliveries into the stored files."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylattice.functions.masks import missing
from skylattice.operators.merge import union_all
from skylattice.operators.select import of_tiles
from skylattice.schema import PIXEL
from skylattice.session import settle
from skylattice.sources.cubes import DIRECTORIES, by_year


def _conflicts(path: str) -> str:
    return f"{path.rstrip('/')}_conflicts"


def _stored_schema(schema, bands) -> T.StructType:
    return T.StructType([schema[k] for k in PIXEL] + bands + [T.StructField("year", T.IntegerType())])


def _reached(spark: SparkSession, path: str, schema, new: DataFrame) -> DataFrame | None:
    """Rows stored in the directories that ``new`` has rows for, None before the first write."""
    try:
        stored = spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    dated = of_tiles(stored, new.where("year is not null"), DIRECTORIES)
    # layers without a date
    static = of_tiles(stored.where("year is null"), new.where("year is null"), ["modality", "tile"])
    return dated.unionByName(static)


def merge_into(cube: DataFrame, path: str) -> None:
    """Merge another delivery into the cube stored at ``path``, which need not exist yet.

    Only the directories (modality, tile, year) that the delivery reaches are read and written
    anew; all other files stay as they are. A present value fills a missing one. Where
    deliveries disagree the value becomes NULL, and stays so whatever comes later: pixel and
    band are kept in ``stored_conflicts``. So the order of deliveries does not matter, a
    repeated one changes nothing, and the result is ``merge_series`` of all of them. All
    deliveries have the same bands. A run that broke off is repeated with the same delivery.
    One writer at a time.
    """
    spark = cube.sparkSession
    bands = [c for c in cube.columns if c not in PIXEL]
    new = settle(cube.select(*PIXEL, *bands).withColumn("year", F.year("t")), "delivery")
    stored = _reached(spark, path, _stored_schema(cube.schema, [cube.schema[b] for b in bands]), new)
    disputed = _reached(spark, _conflicts(path), conflict_schema(cube.schema), new)
    # a known conflict is one more row of its pixel: no join, whatever their number
    rows = union_all(*[r for r in (new, stored, disputed) if r is not None])
    if disputed is None:
        rows = rows.withColumn("band", F.lit(None).cast("string"))
    aggs = []
    for b in bands:
        value = F.when(~missing(rows, b), F.col(b))
        aggs.append(F.max(value).alias(b))
        apart = F.coalesce(F.min(value) != F.max(value), F.lit(False))
        aggs.append((apart | (F.count_if(F.col("band") == b) > 0)).alias(f"_{b}_differs"))
    merged = rows.groupBy(*PIXEL, "year").agg(*aggs)
    values = [F.when(~F.col(f"_{b}_differs"), F.col(b)).alias(b) for b in bands]
    differ = F.array_compact(F.array(*[F.when(F.col(f"_{b}_differs"), F.lit(b)) for b in bands]))
    merged = settle(merged.select(*PIXEL, "year", *values, differ.alias("_differ")), "merged")
    found = merged.select(*PIXEL, "year", F.explode("_differ").alias("band"))
    # conflicts first: a run that breaks off in between is repeated with them known
    for part, folder in ((found, _conflicts(path)), (merged.drop("_differ"), path)):
        by_year(part).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(folder)


def conflict_schema(schema) -> T.StructType:
    return _stored_schema(schema, [T.StructField("band", T.StringType())])


def stored_conflicts(spark: SparkSession, path: str, schema) -> DataFrame:
    """Pixel keys, year and ``band`` on which the deliveries merged into ``path`` disagree.

    ``schema`` is the cube's, or that of its pixel keys.
    """
    return spark.read.schema(conflict_schema(schema)).parquet(_conflicts(path))
