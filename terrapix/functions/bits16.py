"""Unsigned 16-bit band values in Parquet's 16-bit integers.

Spark's SMALLINT is signed, so values are stored less 32768.  Encoding checks
every value; nothing is cut or wrapped silently."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BIAS, _TOP = 32768, 65535


def encode16(value: Column) -> Column:
    """A whole number from 0 to 65535 as a SMALLINT; null stays null, any other
    value (fractions and NaN too) is an error of the job."""
    fits = value.between(0, _TOP) & (value == F.floor(value.cast("double")))
    wrong = F.raise_error(F.concat(F.lit("not an unsigned 16-bit value: "), value.cast("string")))
    return F.when(value.isNull(), F.lit(None)).when(fits, (value - _BIAS).cast("smallint")).otherwise(wrong.cast("smallint"))


def decode16(value: Column) -> Column:
    """The value that ``encode16`` stored, as an int."""
    return value.cast("int") + _BIAS
