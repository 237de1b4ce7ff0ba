"""Pixel and time arrays held in one row."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def fit_length(a: Column, length: int, fill: Column) -> Column:
    """Pad at the end with ``fill``, or cut, to exactly ``length`` entries."""
    return F.slice(F.concat(a, F.array_repeat(fill, length)), 1, length)


def append_fill(a: Column, k: int, fill: Column) -> Column:
    return F.concat(a, F.array_repeat(fill, k))


def padding_mask(n: Column, length: int) -> Column:
    """True at the positions that ``fit_length`` filled in."""
    return F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda i: i >= n)


def crop_pixels(pixels: Column, width: Column, row0: Column, col0: Column, size: int) -> Column:
    """Window of a row-major frame, again row-major."""
    rows = F.sequence(row0, row0 + F.lit(size - 1))
    return F.flatten(
        F.transform(rows, lambda r: F.slice(pixels, r * width + col0 + 1, F.lit(size)))
    )


def take_at(a: Column, positions: Column) -> Column:
    """Entries of ``a`` at 0-based ``positions``."""
    return F.transform(positions, lambda i: F.element_at(a, (i + 1).cast("int")))


def swap_axes(nested: Column) -> Column:
    """[c][t][...] -> [t][c][...]; its own inverse."""
    inner = F.size(F.element_at(nested, 1))
    steps = F.when(inner > 0, F.sequence(F.lit(0), inner - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(
        steps, lambda i: F.transform(nested, lambda row: F.element_at(row, (i + 1).cast("int")))
    )
