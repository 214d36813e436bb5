"""Text normalisers: Column in, Column out, all evaluated in the JVM.

Functions here and in the sister modules are written as chains in which every step is used
once. A step used twice would be compiled and run twice, and nested a few levels deep that
outgrows what one generated method can hold.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline import fixed

_BASIC = [chr(code) for code in range(0x3001)]  # no space character lies beyond U+3000
_WHITESPACE = "".join(char for char in _BASIC if char.isspace())
_SPACES = "".join(char for char in _BASIC if unicodedata.category(char) == "Zs")


def strip_all(text: Column) -> Column:
    """Remove leading and trailing whitespace of every kind, no-break spaces included."""
    return F.btrim(text, F.lit(_WHITESPACE))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def squeeze(text: Column) -> Column:
    """Collapse whitespace runs to one space, trim, and turn blank into NULL."""
    return blank_to_null(F.trim(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", " ")))


def strip_spaces(text: Column) -> Column:
    """Trim space characters only (no tabs or line ends), as the SQL `trim` of names does."""
    return F.btrim(text, F.lit(_SPACES))


def drop_jersey_number(name: Column) -> Column:
    """`#9 Some Name` becomes `Some Name`."""
    return strip_all(F.regexp_replace(name, fixed.JERSEY_PATTERN, ""))
