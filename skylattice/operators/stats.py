"""Scene sampling and robust per-band statistics."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylattice.constants import STATS_QMAX, STATS_QMIN
from skylattice.functions.draws import draw_hash
from skylattice.operators.merge import union_all
from skylattice.operators.quantiles import Quantile, exact_quantiles

STAT_NAMES = ["med", "qmin", "qmax"]


def sample_scenes(catalog, n: int, seed: int, by: str | None = None, path="path") -> DataFrame:
    """``n`` random scenes overall, or per value of ``by``.

    A top-n by hash: every task keeps its n best before anything is exchanged.
    """
    order = draw_hash(seed, "scenes", path)
    if by is None:
        return catalog.orderBy(order, path).limit(n)
    rank = F.row_number().over(Window.partitionBy(by).orderBy(order, path))
    return catalog.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def sample_shortfall(catalog, n: int, groups: list[str], by: str) -> DataFrame:
    """Requested groups that hold fewer than ``n`` scenes (also those that hold none)."""
    counts = catalog.groupBy(by).agg(F.count("*").alias("n_scenes"))
    wanted = catalog.sparkSession.createDataFrame([(g,) for g in groups], f"{by} string")
    have = wanted.join(counts, by, "left").fillna(0, ["n_scenes"])
    return have.where(F.col("n_scenes") < n)


def ratio_log(cube: DataFrame, a: str, b: str, ratio="ratio") -> DataFrame:
    """Adds a/b and replaces a, b and the ratio by their natural logarithms.

    Division by zero and logarithms of non-positive values give NULL.
    """
    quotient = F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    wide = cube.withColumn(ratio, quotient)
    return wide.withColumns({c: F.ln(F.col(c).cast("double")) for c in (a, b, ratio)})


def band_stats(
    cube: DataFrame,
    bands: list[str],
    by=("modality",),
    qmin=STATS_QMIN,
    qmax=STATS_QMAX,
    median="mean",
    method="auto",
) -> DataFrame:
    """Median and two quantiles per band over all dates and pixels, missing values skipped.

    ``median='lower'`` takes the lower middle value, ``'mean'`` averages the two. Quantiles
    interpolate linearly. Bands of one small integer type stay in that type, which bounds
    the state of their quantiles.
    """
    if median not in ("mean", "lower"):
        raise ValueError(f"unknown median {median!r}")
    types = {cube.schema[b].dataType.simpleString() for b in bands}
    as_type = types.pop() if len(types) == 1 else "double"
    rows = _stack(cube, list(by), bands, as_type)
    quantiles = [
        Quantile("med", 0.5, lower=median == "lower"),
        Quantile("qmin", qmin),
        Quantile("qmax", qmax),
    ]
    return exact_quantiles(rows, [*by, "band"], "value", quantiles, method)


def _stack(cube, by, bands, as_type) -> DataFrame:
    typed = cube.select(*by, *[F.col(b).cast(as_type).alias(b) for b in bands])
    return typed.unpivot(by, bands, "band", "value")


def approximate_band_stats(
    cube, bands, by=("modality",), qmin=STATS_QMIN, qmax=STATS_QMAX, accuracy=10000
) -> DataFrame:
    """One-pass sketch of ``band_stats``; each rank is off by at most n/accuracy."""
    rows = _stack(cube, list(by), bands, "double").where(~F.isnan("value"))
    cuts = F.percentile_approx("value", [0.5, qmin, qmax], accuracy)
    stats = rows.groupBy(*by, "band").agg(cuts.alias("cuts"))
    return stats.select(
        *by, "band", *[F.col("cuts")[i].alias(s) for i, s in enumerate(STAT_NAMES)]
    )


def stats_table(stats: DataFrame, bands: list[str], by=("modality",)) -> DataFrame:
    """Rows med, qmin, qmax; one column per band."""
    long = stats.unpivot([*by, "band"], STAT_NAMES, "stat", "value")
    return long.groupBy(*by, "stat").pivot("band", bands).agg(F.first("value"))


def stats_from_table(table: DataFrame, bands: list[str], by=("modality",)) -> DataFrame:
    """Inverse of ``stats_table``."""
    long = table.unpivot([*by, "stat"], bands, "band", "value")
    return long.groupBy(*by, "band").pivot("stat", STAT_NAMES).agg(F.first("value"))


def merge_stats(parts: list[DataFrame], modality="agera5") -> DataFrame:
    """Statistics of single variables as those of one modality, bands numbered in order."""
    numbered = [p.withColumn("ord", F.lit(i)) for i, p in enumerate(parts)]
    return union_all(*numbered).withColumn("modality", F.lit(modality))
