"""Mergeable sketches of values, and exact quantiles that start from them.

A sketch counts the values of a group per cell. A cell holds the values of one sign whose
sizes lie between neighbouring powers of ``GROWTH``, so a group has at most 160,000 cells
whatever its size, and in practice some hundreds. Counts add up: sketches of files, days or
tiles merge by sums, and neither the order of merging nor a repeated task changes them.

A quantile from a sketch alone is off by less than one cell, two percent of its value. For the
exact one, the cell that holds its rank is divided again and again until it holds at most
``MOST`` values or only one different value; each division reads the rows once and keeps counts
only. What finally is sorted are the at most ``MOST`` values of a cell.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylattice.session import settle

GROWTH = 1.02  # upper edge of a cell over its lower edge
CENTRE = 40_000  # added to the logarithms of sizes: doubles have -37,600 to 35,900
MOST = 4096  # values of a cell that are sorted
PARTS = 2048  # a crowded cell is divided into so many


@dataclass(frozen=True)
class Quantile:
    """``q`` in [0, 1]; ``lower`` takes the lower of two middle values instead of averaging."""

    name: str
    q: float
    lower: bool = False


def cell_of(value: Column) -> Column:
    """Cell number, which never decreases with the value; infinities have cells of their own."""
    size = F.least(F.ln(F.abs(value)) / F.lit(math.log(GROWTH)), F.lit(float(CENTRE)))
    place = F.ceil(size).cast("int") + CENTRE
    return F.when(value == 0, 0).when(value < 0, -place).otherwise(place)


def sketch(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys, cell, n, low, high``: number, least and largest value of each cell.

    NULL and NaN values are skipped. NULL keys are a group of their own.
    """
    v = F.col("_value")
    kept = rows.select(*keys, F.col(value).cast("double").alias("_value")).where(v.isNotNull() & ~F.isnan(v))
    counts = [F.count("*").alias("n"), F.min(v).alias("low"), F.max(v).alias("high")]
    return kept.groupBy(*keys, cell_of(v).alias("cell")).agg(*counts)


def merge_sketches(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of parts as one of their union, for the groups of ``keys``."""
    counts = [F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")]
    return sketches.groupBy(*keys, "cell").agg(*counts)


def sketch_quantiles(sketches: DataFrame, keys: list[str], quantiles: list[Quantile]) -> DataFrame:
    """keys and one column per quantile, each off by less than its cell; no row is read."""
    within = F.try_divide(F.col("rank") - F.col("first"), F.col("n") - 1)
    value = F.col("low") + F.when(F.col("low") < F.col("high"), (F.col("high") - F.col("low")) * within).otherwise(0.0)
    return _add_up(_held(sketches, keys, quantiles).withColumn("value", value), keys, quantiles)


def refined_quantiles(
    rows: DataFrame, sketches: DataFrame, keys: list[str], value: str, quantiles: list[Quantile], most=MOST, parts=PARTS
) -> DataFrame:
    """keys and one exact column per quantile; ``sketches`` are those of the ``rows``."""
    rows = rows.select(*keys, F.col(value).cast("double").alias("value"))
    rows = rows.where(F.col("value").isNotNull() & ~F.isnan("value"))
    ranks = ["name", "rank", "share"]
    cell = ["first", "n", "low", "high"]
    columns = [*keys, *ranks, *cell]
    wanted = settle(_held(sketches, keys, quantiles).select(*columns), "rank-cells")
    crowded = (F.col("n") > most) & (F.col("low") < F.col("high"))
    while not (open_ := wanted.where(crowded)).isEmpty():
        share = (F.col("value") - F.col("low")) / (F.col("high") - F.col("low"))
        part = F.least(F.floor(share * parts), F.lit(parts - 1)).cast("int")
        inside = _inside(rows, open_, keys).withColumn("part", part)
        counts = [F.count("*").alias("n"), F.min("value").alias("_low"), F.max("value").alias("_high")]
        finer = inside.groupBy(*keys, "low", "first", "part").agg(*counts)
        before = Window.partitionBy(*keys, "low").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        finer = finer.withColumn("first", F.col("first") + F.coalesce(F.sum("n").over(before), F.lit(0)))
        found = _meet(open_.select(*keys, *ranks, "low"), finer, [*keys, "low"], ["first", "n", "_low", "_high"])
        found = found.where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("n")))
        found = found.drop("low").withColumnsRenamed({"_low": "low", "_high": "high"}).select(*columns)
        wanted = settle(found.unionByName(wanted.where(~crowded)), "rank-cells")

    several = wanted.where("low < high")
    counted = _inside(rows, several, keys).groupBy(*keys, "low", "first", "value").agg(F.count("*").alias("_n"))
    upto = Window.partitionBy(*keys, "low").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    counted = counted.withColumn("_stop", F.col("first") + F.sum("_n").over(upto)).drop("first")
    sorted_ = _meet(several.select(*keys, *ranks, "low"), counted, [*keys, "low"], ["value", "_n", "_stop"])
    sorted_ = sorted_.where((F.col("rank") < F.col("_stop")) & (F.col("rank") >= F.col("_stop") - F.col("_n")))
    single = wanted.where("low = high").withColumn("value", F.col("low"))
    out = [*keys, *ranks, "value"]
    return _add_up(sorted_.select(*out).unionByName(single.select(*out)), keys, quantiles)


def _meet(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows of ``left`` with ``columns`` of the ``right`` rows of the same keys, NULL ones included."""
    same = [F.col(f"_a.{k}").eqNullSafe(F.col(f"_b.{k}")) for k in keys]
    both = left.alias("_a").join(right.alias("_b"), same)
    return both.select(*[F.col(f"_a.{c}") for c in left.columns], *[F.col(f"_b.{c}") for c in columns])


def _inside(rows: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """Values within the cells, which are a few per group and do not overlap."""
    cells = cells.select(*keys, "low", "high", "first").distinct()
    found = _meet(rows, cells, keys, ["low", "high", "first"])
    return found.where((F.col("value") >= F.col("low")) & (F.col("value") <= F.col("high")))


def _targets(sizes: DataFrame, keys: list[str], quantiles: list[Quantile]) -> DataFrame:
    """(keys, name, rank, share): the 0-based ranks that make up each quantile, and their shares."""
    n, parts = F.col("total").cast("double"), []
    for q in quantiles:
        name = F.lit(q.name).alias("name")
        if q.lower:
            rank = F.greatest(F.ceil(F.lit(q.q) * n) - 1, F.lit(0)).cast("long")
            parts.append(F.struct(name, rank.alias("rank"), F.lit(1.0).alias("share")))
            continue
        place = F.lit(q.q) * (n - F.lit(1.0))
        rank, fraction = F.floor(place).cast("long"), place - F.floor(place)
        upper = F.least(rank + 1, F.col("total") - 1)
        parts.append(F.struct(name, rank.alias("rank"), (F.lit(1.0) - fraction).alias("share")))
        parts.append(F.struct(name, upper.alias("rank"), fraction.alias("share")))
    return sizes.select(*keys, F.inline(F.array(*parts)))


def _held(sketches: DataFrame, keys: list[str], quantiles: list[Quantile]) -> DataFrame:
    """The wanted ranks with the cell that holds each; ``first`` values lie below the cell."""
    sketches = settle(sketches, "sketch")
    before = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = sketches.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    wanted = _targets(sketches.groupBy(*keys).agg(F.sum("n").alias("total")), keys, quantiles)
    found = _meet(wanted, cells, keys, ["first", "n", "low", "high"])
    return found.where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("n")))


def _add_up(found: DataFrame, keys: list[str], quantiles: list[Quantile]) -> DataFrame:
    """A rank with no share counts nothing, infinite or not."""
    part = F.when(F.col("share") > 0, F.col("value") * F.col("share")).otherwise(F.lit(0.0))
    return found.groupBy(*keys).agg(*[F.sum(F.when(F.col("name") == q.name, part)).alias(q.name) for q in quantiles])
