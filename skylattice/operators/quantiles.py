"""Exact quantiles per group, for groups of any size.

Two ways, chosen by the type of the values and never by their number:

* integer bands of at most 16 bits have at most 65,536 distinct values, so Spark's
  ``percentile`` (a value -> count map) is bounded whatever the number of rows;
* for all other types the answer is located step by step. A sketch brackets every wanted rank, an
  exact histogram over the brackets finds the one cell that holds the rank, and only the
  values of that cell are counted one by one. The sketch affects speed only: values outside
  the brackets have cells of their own, so the result is exact in any case. No task ever
  holds a group: the state is the sketch, a few thousand cells, or one cell's distinct values.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylattice.session import settle

SMALL_DOMAIN = (T.ByteType, T.ShortType, T.BooleanType)


@dataclass(frozen=True)
class Quantile:
    """``q`` in [0, 1]; ``lower`` takes the lower of two middle values instead of averaging."""

    name: str
    q: float
    lower: bool = False


def _direct(rows: DataFrame, keys: list[str], quantiles: list[Quantile]) -> DataFrame:
    """Built-in percentiles; all interpolated ones share one value -> count map."""
    smooth = [q for q in quantiles if not q.lower]
    aggs = [
        F.expr(f"percentile_disc({q.q}D) within group (order by value)").alias(q.name)
        for q in quantiles
        if q.lower
    ]
    if smooth:
        aggs.append(F.percentile("value", F.array(*[F.lit(q.q) for q in smooth])).alias("_all"))
    place = {q.name: i for i, q in enumerate(smooth)}
    found = rows.groupBy(*keys).agg(*aggs)
    return found.select(
        *keys,
        *[
            (F.col(q.name) if q.lower else F.col("_all")[place[q.name]]).cast("double").alias(q.name)
            for q in quantiles
        ],
    )


def exact_quantiles(
    rows: DataFrame, keys: list[str], value: str, quantiles: list[Quantile], method="auto"
) -> DataFrame:
    """keys and one column per quantile; NULL and NaN values are skipped."""
    small_domain = isinstance(rows.schema[value].dataType, SMALL_DOMAIN)
    rows = rows.select(*keys, F.col(value).cast("double").alias("value"))
    rows = rows.where(F.col("value").isNotNull() & ~F.isnan("value"))
    if method == "direct" or (method == "auto" and small_domain):
        return _direct(rows, keys, quantiles)
    return _located(rows, keys, quantiles, _brackets(rows, keys, quantiles))


def _brackets(rows, keys, quantiles, accuracy=4000) -> DataFrame:
    """Per group: its size, and sketched values a little below and above each quantile."""
    slack = 2.0 / accuracy
    edges = [p for q in quantiles for p in (max(q.q - slack, 0.0), min(q.q + slack, 1.0))]
    sketch = F.percentile_approx("value", edges, accuracy).alias("edges")
    return settle(rows.groupBy(*keys).agg(F.count("*").alias("n"), sketch), "brackets")


def _ranks(quantile: Quantile) -> tuple[Column, Column]:
    """0-based position of the quantile among n sorted values, as (floor, fraction)."""
    n = F.col("n").cast("double")
    if quantile.lower:
        return F.greatest(F.ceil(F.lit(quantile.q) * n) - 1, F.lit(0)), F.lit(0.0)
    position = F.lit(quantile.q) * (n - F.lit(1.0))
    return F.floor(position), position - F.floor(position)


def _located(rows, keys, quantiles, brackets, cells=2048) -> DataFrame:
    targets = _targets(brackets, keys, quantiles)
    celled = rows.join(brackets, keys).select(*keys, "value", _cell(len(quantiles), cells))

    # exact counts per cell; at most len(quantiles) * (cells + 1) + 1 rows per group
    histogram = celled.groupBy(*keys, "cell").agg(F.count("*").alias("n_cell"))
    before = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    histogram = histogram.withColumn("first", F.coalesce(F.sum("n_cell").over(before), F.lit(0)))
    holds_rank = (F.col("rank") >= F.col("first")) & (
        F.col("rank") < F.col("first") + F.col("n_cell")
    )
    wanted = settle(
        histogram.join(targets, keys).where(holds_rank).drop("n_cell"), "rank-cells"
    )

    # the values of the chosen cells only, one row per distinct value
    chosen = wanted.select(*keys, "cell", "first").distinct()
    values = (
        celled.join(chosen, [*keys, "cell"])
        .groupBy(*keys, "cell", "first", "value")
        .agg(F.count("*").alias("n_value"))
    )
    upto = Window.partitionBy(*keys, "cell").orderBy("value")
    values = values.withColumn("stop", F.col("first") + F.sum("n_value").over(upto)).withColumn(
        "start", F.col("stop") - F.col("n_value")
    )
    found = values.drop("first").join(wanted.drop("first"), [*keys, "cell"]).where(
        (F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("stop"))
    )
    return found.groupBy(*keys).agg(
        *[
            F.sum(F.when(F.col("name") == q.name, F.col("value") * F.col("share"))).alias(q.name)
            for q in quantiles
        ]
    )


def _cell(n_brackets: int, cells: int) -> Column:
    """Cell number that never decreases with the value.

    Each bracket contributes 0 below it, 1..cells inside it and cells + 1 above it; the sum
    of the contributions is the cell, so values share a cell only if they share it in every
    bracket.
    """
    v, total = F.col("value"), F.lit(0)
    for i in range(n_brackets):
        low, high = F.col("edges")[2 * i], F.col("edges")[2 * i + 1]
        share = (v - low) / F.nullif(high - low, F.lit(0.0))
        inside = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * cells), F.lit(cells - 1)) + 1
        total = total + F.when(v < low, 0).when(v > high, cells + 1).otherwise(inside)
    return total.cast("int").alias("cell")


def _targets(brackets, keys, quantiles) -> DataFrame:
    """(keys, name, rank, share): the ranks that make up each quantile and their shares."""
    parts = []
    for q in quantiles:
        rank, fraction = _ranks(q)
        rank, name = rank.cast("long"), F.lit(q.name).alias("name")
        upper = F.least(rank + 1, F.col("n") - 1)
        parts.append(F.struct(name, rank.alias("rank"), (F.lit(1.0) - fraction).alias("share")))
        if not q.lower:
            parts.append(F.struct(name, upper.alias("rank"), fraction.alias("share")))
    return brackets.select(*keys, F.inline(F.array(*parts)))
