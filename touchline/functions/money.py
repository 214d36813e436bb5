"""Money texts to whole currency units."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline import fixed
from touchline.functions.numbers import cast_match
from touchline.functions.text import strip_all


def parse_money(text: Column) -> Column:
    """`€12.50m` becomes 12500000; a text that is not one number with a unit becomes NULL.

    The missing markers hold no digit, so the pattern rejects them too. `rint` rounds halves
    to the even neighbour: `0.5` gives 0 and `1.5` gives 2.
    """
    value = strip_all(text)
    number = cast_match(F.translate(value, ",", "."), fixed.MONEY_PATTERN, "double")
    unit = F.lower(F.regexp_extract(value, fixed.MONEY_PATTERN, 2))
    factors = F.create_map(*[F.lit(part) for part in chain(*fixed.MONEY_UNITS.items())])
    return F.rint(number * F.try_element_at(factors, unit)).try_cast("bigint")
