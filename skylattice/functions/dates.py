"""Date encodings of a time axis."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from skylattice.constants import REFERENCE_DATE


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def days_since(t: str | Column, ref: str = REFERENCE_DATE, scale: float | None = None) -> Column:
    """Whole days between ``ref`` and ``t``; divided by ``scale`` when one is given."""
    days = F.date_diff(F.to_date(_col(t)), F.lit(ref).cast("date"))
    return days if scale is None else days.cast("double") / F.lit(float(scale))


def days_since_epoch_day(day: str | Column, ref: str = REFERENCE_DATE) -> Column:
    """As ``days_since`` for a date stored as days after 1970-01-01."""
    return days_since(F.date_from_unix_date(_col(day).cast("int")), ref)


def doy_fraction(t: str | Column) -> Column:
    """Day of year as a fraction of the year's length (1/365 .. 1)."""
    year_length = F.dayofyear(F.make_date(F.year(_col(t)), F.lit(12), F.lit(31)))
    return F.dayofyear(_col(t)).cast("double") / year_length.cast("double")
