"""Date texts, season dates and date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline import fixed
from touchline.functions.numbers import season_year
from touchline.functions.text import strip_all

# A month name, its first three letters as the group `{0}`. (Not captured in a look-ahead: what such a group
# has taken stays when the form fails.)
_REST = "|".join(f"(?<={name[:3]}){name[3:]}" for name in fixed.MONTHS_LONG + fixed.MONTH_ALIASES if name[3:])
_MONTH = "(?<{0}>" + "|".join(fixed.MONTHS_SHORT) + f")(?:{_REST})?\\.?"
_CLOCK = r"(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d+)?)?"
_ZONE = r"(?:\s*(?:z|utc|gmt|[+-]\d{2}(?::?\d{2})?))?"

# The written forms, with year, month and day as the groups y, m and d and the number of the form.
_FORMS = [
    _MONTH.format("m0") + r"\s+(?<d0>\d{1,2})(?:st|nd|rd|th)?(?:\s*,\s*|\s+)(?<y0>\d{4})",
    r"(?<d1>\d{1,2})(?:st|nd|rd|th)?[\s.-]+(?:of\s+)?" + _MONTH.format("m1") + r"(?:\s*[,-]\s*|\s+)(?<y1>\d{4})",
    r"(?<y2>\d{4})(?<s2>[./-])(?<m2>\d{1,2}|" + "|".join(fixed.MONTHS_SHORT) + r")\k<s2>(?<d2>\d{1,2})",
    # The day comes first, unless only the second number can be one.
    r"(?<m3>\d{1,2})(?<s3>[./-])(?<d3>1[3-9]|2\d|3[01])\k<s3>(?<y3>\d{4}|\d{2})",
    r"(?<d4>\d{1,2})(?<s4>[./-])(?<m4>\d{1,2})\k<s4>(?<y4>\d{4}|\d{2})",
]
# A whole text of one of the forms, with a weekday before and a time behind it; else any text, without groups.
_TEXT = (
    rf"^(?:(?:{fixed.WEEKDAYS})\.?,?\s+)?(?:{'|'.join(_FORMS)})(?:(?:t|,?\s+){_CLOCK}{_ZONE})?\z" + r"|^[\s\S]*\z"
)
# Groups that took no part are empty: this leaves year-month-day of the form found, or two hyphens.
_PARTS = "-".join("".join(f"${{{part}{form}}}" for form in range(len(_FORMS))) for part in "ymd")
# What a cast to a date takes: one separator, and after the date nothing but a real time.
# What is none leaves the parts empty.
_CAST = rf"(?i)^\s*(\d{{4}})([-/ \\])(\d{{1,2}})\2(\d{{1,2}})(?:[ t]+(?:{_CLOCK}|24:00(?::00)?){_ZONE})?\s*\z|^[\s\S]*\z"


def parse_date(text: Column) -> Column:
    """A complete date in one of the written forms, else NULL.

    Forms, with an optional weekday before and an optional time after: `May 15, 2003`, `May 15 2003`,
    `15 May 2003`, `15th May, 2003`, `2003-05-15`, `2003/05/15`, `15/05/2003`, `15.05.2003`,
    `15-05-2003`, `15/05/03`; month names short or long. One pattern reads the text once and leaves year,
    month and day, which are completed and cast once: no row costs an exception, as trying one date
    pattern after the other would. The missing markers are none of the forms and so give NULL as well;
    `unread` tells the two apart.
    """
    parts = F.split(F.regexp_replace(F.lower(strip_all(text)), _TEXT, _PARTS), "-")
    return F.array_join(F.transform(parts, _completed), "-").try_cast("date")


def _completed(part: Column, place: Column) -> Column:
    """Year, month or day (places 0, 1, 2) in ISO form: two digits of a year from 69 on are of the last century,
    a month's name becomes its number, and there is no year 0."""
    year = F.when(part == "0000", "none").when(F.length(part) == 2, F.concat(F.when(part >= "69", "19").otherwise("20"), part))
    month = F.when(part >= "a", (F.instr(F.lit("".join(fixed.MONTHS_SHORT)), part) + 2) / 3)
    return F.when(place == 0, F.coalesce(year, part)).when(place == 1, F.coalesce(month.cast("int").cast("string"), part)).otherwise(part)


def cast_date(text: Column) -> Column:
    """Cast ISO text to a date as SQL does: `2003-5-1`, `2003/05/01` and `2003 5 1` are dates, also with a
    time behind them; anything else behind them, another order or a partial date gives NULL. The pattern reads
    the text once."""
    return F.regexp_replace(text, _CAST, "$1-$3-$4").try_cast("date")


def unread(text: Column, date: Column) -> Column:
    """Whether a text that says something was not read as a date."""
    return date.isNull() & ~F.lower(strip_all(text)).isin(fixed.MISSING_MARKERS)


def season_date(season: Column) -> Column:
    """The first day of a season, NULL unless the season is a plain year."""
    return F.make_date(season_year(season), F.lit(fixed.SEASON_MONTH), F.lit(fixed.SEASON_DAY))


def season_key(season: Column) -> Column:
    """The YYYYMMDD key of the first day of a season, NULL unless the season is a plain year."""
    return season_year(season) * 10000 + (fixed.SEASON_MONTH * 100 + fixed.SEASON_DAY)


def date_key(date: Column) -> Column:
    """The YYYYMMDD key of a date."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)
