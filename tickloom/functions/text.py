"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Trimming removes the space and every control character below it.
_BLANKS = "".join(chr(code) for code in range(1, 33))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANKS))


def blank_to_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def price_value(text: Column) -> Column:
    """The number in ``text`` if it is finite and above zero, else NULL."""
    number = text.try_cast("double")
    return F.when(~F.isnan(number) & (number < F.lit(float("inf"))) & (number > 0), number)
