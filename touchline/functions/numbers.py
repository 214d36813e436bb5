"""Number texts. Nothing here raises: a text that is no number gives NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.functions.text import strip_all

_INTEGER = r"^([+-]?\d+)$"
_DECIMAL = r"^([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)$"


def cast_match(text: Column, pattern: str, kind: str, group: int = 1) -> Column:
    """Cast the part of a text that a pattern captures; no match gives NULL.

    A text without a match never reaches the cast: a number cast that fails costs an exception
    inside the JVM, some hundred times the price of a regex test. What is left to fail is a
    number out of range. The pattern is tried once: a blank text made NULL would be worked out twice.
    """
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.lit(1)).try_cast(kind)


def parse_decimal(text: Column, kind: str = "int") -> Column:
    """A number whose decimal mark may be a comma; as an int, any decimal mark gives NULL."""
    plain = F.translate(strip_all(text), ",", ".")
    return cast_match(plain, _INTEGER if kind == "int" else _DECIMAL, kind)


def parse_count(text: Column) -> Column:
    """A count with grouping marks: `2.509'` becomes 2509. A dash means no data, not zero."""
    return cast_match(F.translate(strip_all(text), "'.,", ""), _INTEGER, "int")


def first_integer(text: Column) -> Column:
    """The first run of digits: `4 days` becomes 4."""
    return cast_match(text, r"(\d+)", "int")


def season_year(text: Column) -> Column:
    """The year of a season written as a plain year; `25/26` and other texts give NULL, and so does a year 0."""
    return cast_match(text, r"^\s*([1-9]\d{3}|0?[1-9]\d\d|0{0,2}[1-9]\d|0{0,3}[1-9])\s*$", "int")
