"""Multimodal training items from stored samples, in one plan."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylattice.functions.arrays import fit_length, padding_mask
from skylattice.functions.dates import days_since, doy_fraction
from skylattice.functions.draws import draw_hash
from skylattice.operators.normalize import transform_frames
from skylattice.operators.samples import crop_frames
from skylattice.operators.spatial import offset_columns
from skylattice.schema import SCENE
from skylattice.sources.items import ItemStore


@dataclass(frozen=True)
class ItemOption:
    """How one modality of an item is loaded.

    ``max_len``: dates of a series, drawn at random where there are more and padded with zeros
    where there are fewer; None takes the dates there are. ``stats``: a statistics table, by
    which pixels are clipped and normalised. ``transform``: a user's own change of a pixel,
    ``(value, band) -> value``, applied after the statistics. ``masks``: columns that get the
    same dates and window but no transform. ``strict``: fewer dates than ``max_len`` are an error.
    """

    modality: str
    bands: tuple[str, ...]
    max_len: int | None = None
    masks: tuple[str, ...] = ()
    stats: DataFrame | None = None
    transform: Callable[[Column, str], Column] | None = None
    strict: bool = False


def _chosen_dates(frames: DataFrame, option: ItemOption, keys: list[str], seed: int) -> DataFrame:
    """Frames of at most ``max_len`` dates per item, drawn as ``subsample_frames`` draws them."""
    if option.max_len is None:
        return frames
    draw = draw_hash(seed, "dates", *SCENE, F.lit(option.modality), "t")
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(draw, "t"))
    return frames.withColumn("_turn", turn).where(F.col("_turn") <= option.max_len).drop("_turn")


def item_modality(
    frames: DataFrame, option: ItemOption, keys: list[str], h, w, size, seed, crop_mode="center"
) -> DataFrame:
    """One row per item with one struct, named like the modality.

    It has ``n_dates``, ``doy``, ``true_doy``, ``padd_mask`` and the bands' and masks' pixels as
    ``sits[band][date][pixel]`` and ``masks[mask][date][pixel]``, dates in order. A static layer
    (a frame without a date) is not padded, and has NULL in its time arrays. Absent pixels
    become 0 in ``sits``.
    """
    bands, masks = list(option.bands), list(option.masks)
    rows = frames.withColumn("modality", F.lit(option.modality))
    rows = _chosen_dates(rows, option, keys, seed)
    row0, col0 = offset_columns(h, w, size, crop_mode, seed, SCENE)
    rows = crop_frames(rows, [*bands, *masks], row0, col0, size)
    if option.stats is not None:
        rows = transform_frames(rows, option.stats, bands)
    zero = F.lit(0.0)

    def final(b: str) -> Column:
        def pixel(v):
            v = v.cast("double")
            v = v if option.transform is None else option.transform(v, b)
            return F.coalesce(F.nanvl(v, zero), zero)

        return F.transform(F.col(b), pixel)

    rows = rows.withColumns({b: final(b) for b in bands})
    packed = F.array_sort(F.collect_list(F.struct("t", *bands, *masks))).alias("_s")
    rows = rows.groupBy(*keys).agg(packed, F.count("t").alias("_dated"), F.count("*").cast("int").alias("_n"))
    longest = option.max_len
    fixed = longest is not None

    def fit(a: Column, fill: Column) -> Column:
        return F.when(F.col("_dated") > 0, fit_length(a, longest, fill)).otherwise(a) if fixed else a

    def layers(names: list[str], kind: str) -> Column:
        empty = F.array_repeat(F.lit(0).cast(kind), size * size)
        return F.array(*[fit(F.transform(F.col("_s")[b], lambda p: F.transform(p, lambda v: v.cast(kind))), empty) for b in names])

    doy = fit(F.transform(F.col("_s")["t"], lambda t: days_since(t)), F.lit(0))
    true_doy = fit(F.transform(F.col("_s")["t"], lambda t: doy_fraction(t).cast("float")), F.lit(0.0).cast("float"))
    mask = padding_mask(F.col("_n"), longest) if fixed else F.array_repeat(F.lit(False), F.col("_n"))
    mask = F.when(F.col("_dated") > 0, mask).otherwise(F.array(F.lit(False)))
    count = F.col("_n")
    if option.strict and fixed:
        name = F.concat_ws(" ", F.lit(f"fewer than {longest} dates of {option.modality}:"), *keys)
        count = F.when((F.col("_dated") > 0) & (F.col("_n") < longest), F.raise_error(name).cast("int")).otherwise(count)
    fields = [count.alias("n_dates"), doy.alias("doy"), true_doy.alias("true_doy"), mask.alias("padd_mask")]
    fields.append(layers(bands, "double").alias("sits"))
    if masks:
        fields.append(layers(masks, "int").alias("masks"))
    return rows.select(*keys, F.struct(*fields).alias(option.modality))


def load_items(
    store: ItemStore, options: list[ItemOption], h, w, size, seed, crop_mode="center"
) -> DataFrame:
    """One row per item with a struct per modality, NULL where the item lacks it.

    All modalities of an item are cut to the same window. Only item keys are exchanged: every
    modality is grouped and joined within its buckets, and the join keeps their places, so any
    number of modalities meets without a shuffle of pixels. Items are those that any of the
    modalities has.
    """
    names = [o.modality for o in options]
    if len(set(names)) < len(names):
        raise ValueError(f"a modality is asked for twice: {names}")
    items = store.items(names)
    for option in options:
        own = item_modality(store.read(option.modality), option, store.keys, h, w, size, seed, crop_mode)
        items = items.join(own, store.keys, "left")
    return items.select(*store.keys, *names)
