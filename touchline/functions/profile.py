"""Texts of the player info box."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline import fixed
from touchline.functions.dates import parse_date
from touchline.functions.numbers import cast_match


def birth_date(text: Column) -> Column:
    """The date in `21/07/2000 (25)`."""
    return parse_date(F.regexp_extract(text, fixed.BIRTH_PATTERN, 1))


def birth_age(text: Column) -> Column:
    """The age in `21/07/2000 (25)`; NULL where no date stands before it."""
    return cast_match(text, fixed.BIRTH_PATTERN, "int", 2)


def height_cm(text: Column) -> Column:
    """`1,95 m` becomes 195. The fraction is read as centimetres, so `1,9 m` gives 109."""
    metres = cast_match(text, fixed.HEIGHT_PATTERN, "int", 1)
    centimetres = cast_match(text, fixed.HEIGHT_PATTERN, "bigint", 2)
    # A fraction of three digits or more is no centimetres: only the metres count.
    return F.try_add(F.try_multiply(metres, F.lit(100)), F.when(centimetres < 100, centimetres).otherwise(0)).try_cast("int")
