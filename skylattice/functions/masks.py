"""Missing values and validity masks of a pixel."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylattice.constants import MISSING_ABOVE


def is_floating(df: DataFrame, band: str) -> bool:
    return isinstance(df.schema[band].dataType, (T.FloatType, T.DoubleType))


def missing(df: DataFrame, band: str) -> Column:
    """NULL, or NaN in a floating-point band."""
    c = F.col(band)
    return c.isNull() | F.isnan(c) if is_floating(df, band) else c.isNull()


def clean_value(value: Column) -> Column:
    """NaN and fill values above 1e9 become NULL; -inf stays."""
    return F.when(~(F.isnan(value) | (value > F.lit(MISSING_ABOVE))), value)


def nan_count_of(df: DataFrame, bands: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [missing(df, b).cast("int") for b in bands])


def scl_nodata(scl: Column) -> Column:
    return scl == F.lit(0)


def invalid_pixel(clm: Column, scl: Column) -> Column:
    """True where the cloud mask or the scene class rules a pixel out.

    Fixed values: classes 0 and 1 (no data, saturated), 3 (shadow) and 7 to 10 (clouds,
    cirrus) are invalid; written as ranges so that classes outside 0..11 keep a meaning.
    """
    bad_class = (scl < 2) | (scl == 3) | scl.between(7, 10)
    no = F.lit(False)
    return F.coalesce(clm == F.lit(1), no) | F.coalesce(bad_class, no)
