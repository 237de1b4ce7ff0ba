"""Reproducible random draws.

A draw is a pure function of a seed, a label and the row's keys. It can therefore be
computed wherever the keys are present - no shuffle, no driver state - and gives the same
value again when a lost task is re-run.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX_DIGITS = 13
_RANGE = float(2**52)


def draw_hash(seed: int, label: str, *keys: str | Column) -> Column:
    """Hex digest that orders rows randomly but reproducibly."""
    parts = [F.lit(str(seed)), F.lit(label)]
    parts += [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    return F.md5(F.concat_ws(":", *parts))


def uniform(seed: int, label: str, *keys: str | Column) -> Column:
    """Uniform double in [0, 1)."""
    digits = F.substring(draw_hash(seed, label, *keys), 1, _HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(_RANGE)


def uniform_between(low: Column, high: Column, u: Column) -> Column:
    return low + u * (high - low)


def uniform_int(low: int | Column, high: int | Column, u: Column) -> Column:
    """Uniform integer in [low, high], both ends included."""
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return (low + F.floor(u * (high - low + F.lit(1)))).cast("int")


def choose(values: list, u: Column) -> Column:
    """One entry of a literal list."""
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (F.floor(u * F.lit(len(values))) + 1).cast("int"))
