"""URL texts: normal form and the addresses of dependent pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline import fixed
from touchline.functions.text import blank_to_null, strip_all

# Scheme, host, the path (group 1), parameters of its last part, query or fragment. Nothing is
# given back once matched, so a URL without a path does not match at all and stays whole.
_URL = (
    r"^(?:[A-Za-z][A-Za-z0-9+.\-]*+:)?+(?://[^/?#]*+)?+"
    r"((?:[^?#;]++|;(?=[^?#]*/))++)(?:;[^?#]*+)?+(?:[?#].*)?$"
)


def normalize_path(url: Column) -> Column:
    """Only the path of a URL, with a leading slash; blank gives NULL.

    Scheme, host, query, fragment and the parameters of the last path part go. Where no
    path is left, the text itself stands in.
    """
    text = blank_to_null(F.translate(strip_all(url), "\t\r\n", ""))
    return F.regexp_replace(F.regexp_replace(text, _URL, "$1"), "^(?!/)", "/")


def _base(base_url: str) -> Column:
    return F.lit(base_url.rstrip("/"))


def page_url(href: Column, base_url: str) -> Column:
    """A link made absolute: site paths get the base in front, other links stay."""
    return F.when(href.startswith("/"), F.concat(_base(base_url), href)).otherwise(href)


def player_page_url(href: Column, base_url: str, path: str) -> Column:
    """The address of another page of a player, from the link to the player's profile."""
    url = F.concat(_base(base_url), href)
    return F.replace(url, F.lit(fixed.PROFILE_PATH), F.lit(path))


def with_season(url: Column, season: Column) -> Column:
    """Add the season parameter to a URL; a missing or empty season changes nothing."""
    joint = F.when(F.contains(url, F.lit("?")), F.lit("&")).otherwise(F.lit("?"))
    extended = F.concat(url, joint, F.lit(fixed.SEASON_PARAMETER + "="), season)
    return F.when(F.coalesce(season, F.lit("")) == "", url).otherwise(extended)


def player_id(href: Column) -> Column:
    """The number of a player in a link, NULL if it has none."""
    return blank_to_null(F.regexp_extract(href, fixed.PLAYER_ID_PATTERN, 1))


def api_url(href: Column, base_url: str, entity: str) -> Column:
    """The payload address of a player; NULL for a link without a player number."""
    return F.concat(_base(base_url), F.lit(fixed.API_PATHS[entity]), player_id(href))


def league_code(href: Column) -> Column:
    """The code at the end of a competition link, NULL if it has none."""
    return blank_to_null(F.regexp_extract(href, fixed.LEAGUE_CODE_PATTERN, 1))
