"""Dimension builders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.dates import cast_date, season_date
from touchline.functions.text import strip_spaces
from touchline.operators.collapse import date_feed, date_spine
from touchline.operators.keys import append_members, dense_key, first_per_key
from touchline.operators.lookups import lookup, missing_members, project, require, with_hot_keys


def _numbered(rows: DataFrame, id_col: str) -> DataFrame:
    """Key rows by link. Exact copies become one row; rows that differ under one link stay,
    ordered by their other columns, for the audit to report."""
    return dense_key(rows.distinct(), rows.columns, id_col, kind="int")


def dim_competition(competitions: DataFrame) -> DataFrame:
    """Competitions with a link, numbered by it."""
    rows = project(require(competitions, "href"), {
        "href": F.col("href"), "competition_name": F.col("name"),
        "country": F.col("country"), "season": F.col("season"),
    })
    return _numbered(rows, "competition_id")


def dim_club(clubs: DataFrame, competitions: DataFrame) -> DataFrame:
    """Clubs with link and name, numbered by link; an unknown competition gives a NULL id."""
    columns = ("href", "name", "competition_href", "squad_size", "avg_age", "total_market_value")
    rows, hot = with_hot_keys(require(clubs, "href", "name").select(*columns), "clubs", "competition_href")
    rows = lookup(
        rows, competitions, "competition_href", "href", {"competition_id": "competition_id"}, how="left", hot=hot
    )
    rows = project(rows, {
        "href": F.col("href"), "club_name": F.col("name"), "competition_id": F.col("competition_id"),
        "squad_size": F.col("squad_size"), "avg_age": F.col("avg_age"),
        "total_market_value": F.col("total_market_value"),
    })
    return _numbered(rows, "club_id")


def dim_player(players: DataFrame) -> DataFrame:
    """Players, one row per link (the least name first, NULL last), numbered by link."""
    rows = project(require(players, "href"), {
        "href": F.col("href"), "name": F.col("name"), "date_birth": cast_date(F.col("dob")),
        "nationality": F.col("nationality"), "position": F.col("position"), "foot": F.col("foot"),
        "height_cm": F.col("height_cm"),
    })
    order = [F.col(name).asc_nulls_last() for name in rows.columns if name != "href"]
    return dense_key(first_per_key(rows, ["href"], order), ["href"], "player_id", kind="int")


def stub_competitions(appearances: DataFrame, competitions: DataFrame) -> DataFrame:
    """Rows for competition names that only appearances know."""
    names = missing_members(appearances.select("competition"), competitions, "competition_name")
    names = names.withColumnRenamed("competition", "competition_name")
    return append_members(competitions, names, "competition_name", "competition_id")


def stub_clubs(transfers: DataFrame, clubs: DataFrame, trim_names: bool = False) -> DataFrame:
    """Rows for club names that only transfers know.

    A name is compared as written and stored trimmed, so a padded spelling of a known club
    gives a second club of that name. `trim_names` compares it trimmed instead.
    """
    name = F.explode(F.array("from_club", "to_club")).alias("club_name")
    names = require(transfers.select(name), "club_name")
    if trim_names:
        names = names.select(strip_spaces(F.col("club_name")).alias("club_name"))
    names = missing_members(names, clubs, "club_name")
    names = names.select(strip_spaces(F.col("club_name")).alias("club_name")).distinct()
    return append_members(clubs, names, "club_name", "club_id")


def dim_date(
    appearances: DataFrame, injuries: DataFrame, transfers: DataFrame, market_values: DataFrame,
    players: DataFrame,
) -> DataFrame:
    """Every date that a fact refers to. Births are not among them."""
    season = F.col("season")

    def texts(rows: DataFrame, *names: str, season=None) -> DataFrame:
        return date_feed(rows, [F.col(name) for name in names], season, cast_date)

    return date_spine([
        date_feed(appearances, [season], season, season_date),
        texts(injuries, "from", "until", season=season),
        texts(transfers, "date", season=season),
        texts(market_values, "date"),
        texts(players, "joined", "contract_until"),
    ])
