"""Temporal operators on the frames of a series."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylattice.constants import DAYS_PER_MONTH, SERIES_END, SERIES_START, WINDOW_MONTHS
from skylattice.functions.draws import choose, draw_hash, uniform, uniform_int
from skylattice.operators.quality import keep_frames
from skylattice.schema import FRAME, KEY

WINDOW_BIN = 120  # days of a calendar bin in which dates meet windows


def slice_years(cube: DataFrame, years: list[int]) -> DataFrame:
    """Rows of the listed years with a ``year`` column (one series per year).

    The year ranges are also stated on ``t`` itself, so they prune row groups.
    """
    years = sorted(int(y) for y in years)
    t = F.col("t")
    first, last = f"{years[0]:04d}-01-01", f"{years[-1] + 1:04d}-01-01"
    in_span = (t >= F.lit(first).cast("date")) & (t < F.lit(last).cast("date"))
    return cube.where(in_span).withColumn("year", F.year(t)).where(F.col("year").isin(years))


def missing_years(cube: DataFrame, years: list[int]) -> DataFrame:
    """(KEY, year) without a single date; the fan-out is the length of ``years``."""
    present = slice_years(cube, years).select(*KEY, "year").distinct()
    wanted = (
        cube.select(*KEY)
        .distinct()
        .withColumn("year", F.explode(F.array(*[F.lit(int(y)) for y in years])))
    )
    return wanted.join(present, [*KEY, "year"], "left_anti")


def _window_columns(seed: int, months, begin, end, keys) -> tuple[Column, Column]:
    days = choose([int(m) * DAYS_PER_MONTH for m in months], uniform(seed, "months", *keys))
    first, last = F.lit(begin).cast("date"), F.lit(end).cast("date")
    latest = F.date_diff(last, first) - days
    offset = uniform_int(0, latest, uniform(seed, "start", *keys))
    start = F.date_add(first, offset)
    return start, F.date_add(start, days)


def random_windows(
    items: DataFrame, seed: int, months=WINDOW_MONTHS, begin=SERIES_START, end=SERIES_END, keys=None
) -> DataFrame:
    """A random window of 30*m days inside [begin, end] for every row of ``items``."""
    keys = keys or items.columns
    start, stop = _window_columns(seed, months, begin, end, keys)
    return items.withColumn("win_start", start).withColumn("win_end", stop)


def repeat_items(items: DataFrame, repeat: int) -> DataFrame:
    """Every row ``repeat`` times with its repetition number ``rep``."""
    return items.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(repeat - 1))))


def crop_time(cube: DataFrame, windows: DataFrame, on=("tile", "patch_id"), bin_days=WINDOW_BIN) -> DataFrame:
    """Rows with win_start <= t <= win_end for every window of their item.

    ``windows`` is any table of windows. Each is listed for the calendar bins it reaches, and
    rows meet the windows of their own bin: a date is compared with windows near it only,
    however many its item has. A window is listed once per ``bin_days``. A static layer has no
    date and is part of every window.
    """
    day = lambda c: F.date_diff(F.col(c), F.lit(SERIES_START).cast("date"))
    bin_of = lambda d: F.floor(d / bin_days).cast("int")
    bins = F.sequence(bin_of(day("win_start")), bin_of(day("win_end")))
    # an empty window has no bins
    bins = F.when(F.col("win_start") <= F.col("win_end"), bins).otherwise(F.array().cast("array<int>"))
    static = F.lit(None).cast("int")
    listed = windows.withColumn("_bin", F.explode(F.concat(bins, F.array(static))))
    rows = cube.withColumn("_bin", bin_of(day("t"))).alias("c")
    listed = listed.alias("w")
    same = [F.col(f"c.{k}") == F.col(f"w.{k}") for k in on]
    met = rows.join(listed, reduce(and_, same, F.col("c._bin").eqNullSafe(F.col("w._bin"))))
    met = met.where(F.col("c.t").isNull() | F.col("c.t").between(F.col("w.win_start"), F.col("w.win_end")))
    rest = [F.col(f"c.{n}") for n in cube.columns if n not in on]
    extra = [F.col(f"w.{n}") for n in windows.columns if n not in on]
    return met.select(*[F.col(f"c.{k}") for k in on], *rest, *extra)


def crop_time_random(
    cube: DataFrame,
    seed: int,
    repeat=1,
    months=WINDOW_MONTHS,
    begin=SERIES_START,
    end=SERIES_END,
    on=("tile", "patch_id"),
) -> DataFrame:
    """``random_windows`` and ``crop_time`` in one narrow step.

    The window is a function of the item keys, so each row derives it on the spot; all
    modalities of an item get the same one without a join or a shuffle. Best applied to
    frame keys, before the pixels join them. A static layer has no date and is part of every
    window.
    """
    in_span = F.col("t").isNull() | F.col("t").between(F.lit(begin).cast("date"), F.lit(end).cast("date"))
    rows = repeat_items(cube.where(in_span), repeat)
    start, stop = _window_columns(seed, months, begin, end, [*on, "rep"])
    return (
        rows.withColumn("win_start", start)
        .withColumn("win_end", stop)
        .where(F.col("t").isNull() | F.col("t").between(F.col("win_start"), F.col("win_end")))
    )


def subsample_frames(cube: DataFrame, max_len: int | None, seed: int) -> DataFrame:
    """Frame keys of at most ``max_len`` randomly chosen dates per series.

    The rank runs over distinct dates, so a window holds one row per date of a series
    whatever the number of pixels, and the rank limit is applied before the shuffle too.
    """
    frames = cube.select(*FRAME).distinct()
    if max_len is None:
        return frames
    order = Window.partitionBy(*KEY).orderBy(draw_hash(seed, "dates", *FRAME), "t")
    ranked = frames.withColumn("_rank", F.row_number().over(order))
    return ranked.where(F.col("_rank") <= max_len).drop("_rank")


def too_short(cube: DataFrame, max_len: int) -> DataFrame:
    """Series with fewer than ``max_len`` dates."""
    counts = cube.select(*FRAME).distinct().groupBy(*KEY).agg(F.count("*").alias("n_dates"))
    return counts.where(F.col("n_dates") < max_len)


def check_length(cube: DataFrame, max_len: int):
    """Raise, naming a few, if there are series with fewer than ``max_len`` dates."""
    short = too_short(cube, max_len).limit(5).collect()
    if short:
        raise ValueError(f"series shorter than {max_len} dates: {short}")


def subsample_dates(cube: DataFrame, max_len: int | None, seed: int, strict=False) -> DataFrame:
    """Pixels of at most ``max_len`` dates per series; bands and masks share the dates.

    ``strict`` raises when a series has fewer dates than asked for.
    """
    if max_len is None:
        return cube
    if strict:
        check_length(cube, max_len)
    return keep_frames(cube, subsample_frames(cube, max_len, seed))
