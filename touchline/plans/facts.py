"""Fact builders.

A fact is first collapsed on its natural keys; then the ids are looked up, by the counted rows of the
dimensions (see `operators.lookups.sized`). The rows are dealt by player, once, for both collapsing and the lookup of the player. Where sketches of the key
columns show a player that outgrows a partition, the rows are collapsed before they are dealt, which
combines repeats before any row moves and spreads a hot player over all of that player's dates; the
collapsed rows are written, and values that outgrow a partition are spread over several groups (see
`operators.collapse.collapse_near`, `operators.lookups.with_hot_keys`). The order is free because a
natural key maps to one id, or a repeated name to several.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.dates import cast_date, date_key, season_key
from touchline.functions.text import strip_spaces
from touchline.operators.collapse import collapse_near
from touchline.operators.keys import first_per_key
from touchline.operators.lookups import bridge, lookup, lookup_roles, require, with_hot_keys
from touchline.plans.jobs import together


def _with_player(rows: DataFrame, players: DataFrame, hot: DataFrame | None) -> DataFrame:
    return lookup(rows, players, "player_href", "href", {"player_id": "player_id"}, hot=hot)


def fact_stats(
    appearances: DataFrame, raw_players: DataFrame, players: DataFrame, clubs: DataFrame, competitions: DataFrame,
) -> DataFrame:
    """Season stats by player, listed club and competition.

    Stats name no club: each club that lists the player gets a row, past seasons included. The
    clubs are attached after that, so that they do not multiply the rows that have to be collapsed.
    """
    rows = appearances.select(
        "player_href", "competition", season_key(F.col("season")).alias("date_id"),
        "appearances", "goals", "assists", "yellow_cards", "red_cards",
        F.col("minutes").alias("minutes_played"),
    )
    rows = require(rows, "player_href", "competition", "date_id")
    counts = ["appearances", "goals", "assists", "yellow_cards", "red_cards", "minutes_played"]

    def collapsed() -> tuple[DataFrame, DataFrame | None]:
        keys = ["player_href", "competition", "date_id"]
        return collapse_near(rows, keys, dict(zip(counts, counts)), "player_href", ["competition"])

    def bridged() -> DataFrame:
        return bridge(raw_players, "href", players, "player_id", "club_href", clubs, "club_id")

    (rows, hot), listed = together(appearances.sparkSession, collapsed, bridged)
    ids = {"player_id": "player_id", "club_id": "club_id"}
    rows = lookup(rows, listed, "player_href", "href", ids, hot=hot).drop("player_href")
    rows = lookup(
        rows, competitions, "competition", "competition_name", {"competition_id": "competition_id"}, hot=hot
    )
    return rows.select("player_id", "club_id", "competition_id", "date_id", *counts)


def fact_injury(injuries: DataFrame, players: DataFrame) -> DataFrame:
    """Injuries by player, first and last day; both days must be given."""
    days = ["start_date_id", "end_date_id"]
    rows = require(injuries, "from", "until", "player_href").select(
        "player_href",
        date_key(cast_date(F.col("from"))).alias("start_date_id"),
        date_key(cast_date(F.col("until"))).alias("end_date_id"),
        "injury", "days_out", "games_missed",
    )
    rows, hot = collapse_near(
        rows, ["player_href", *days], {"days_out": "days_out", "games_missed": "games_missed"}, "player_href",
        pick={"injury_type": "injury"},
    )
    rows = _with_player(rows, players, hot)
    return rows.select("player_id", *days, "injury_type", "days_out", "games_missed")


def fact_transfer(
    transfers: DataFrame, players: DataFrame, clubs: DataFrame, trim_names: bool = False,
) -> DataFrame:
    """Transfers by player, both clubs and day.

    Clubs are found by name as written; a padded name finds none and its row is dropped,
    unless `trim_names` trims it first.
    """
    def name(column: str):
        return strip_spaces(F.col(column)) if trim_names else F.col(column)

    rows = require(transfers, "date", "player_href", "from_club", "to_club").select(
        "player_href", name("from_club").alias("from_club_name"), name("to_club").alias("to_club_name"),
        date_key(cast_date(F.col("date"))).alias("date_id"), "market_value", "fee",
    )
    names = ["from_club_name", "to_club_name", "date_id"]
    rows, hot = collapse_near(
        rows, ["player_href", *names], {"market_value": "market_value", "transfer_fee": "fee"},
        "player_href", ["from_club_name", "to_club_name"],
    )
    roles = {"from_club_id": "from_club_name", "to_club_id": "to_club_name"}
    rows = lookup_roles(_with_player(rows, players, hot), clubs, roles, "club_name", "club_id", hot)
    return rows.select(
        "player_id", "from_club_id", "to_club_id", "date_id", "from_club_name", "to_club_name",
        "market_value", "transfer_fee",
    )


def fact_market_value(market_values: DataFrame, players: DataFrame) -> DataFrame:
    """The highest value of a player on each day."""
    rows = require(market_values, "date", "player_href").select(
        "player_href", date_key(cast_date(F.col("date"))).alias("date_id"), "market_value"
    )
    rows, hot = collapse_near(rows, ["player_href", "date_id"], {"market_value": "market_value"}, "player_href")
    return _with_player(rows, players, hot).select("player_id", "date_id", "market_value")


def fact_contract(raw_players: DataFrame, players: DataFrame, clubs: DataFrame) -> DataFrame:
    """The latest contract of each player at each listed club; both days must be given."""
    rows = require(raw_players, "joined", "contract_until", "href", "club_href").select(
        F.col("href").alias("player_href"), "club_href",
        date_key(cast_date(F.col("joined"))).alias("joined_date_id"),
        date_key(cast_date(F.col("contract_until"))).alias("contract_until_id"),
    )
    latest = [F.col(name).desc_nulls_last() for name in ("joined_date_id", "contract_until_id")]
    rows = first_per_key(rows, ["player_href", "club_href"], latest)
    rows, hot = with_hot_keys(rows, "contracts", "player_href", "club_href")
    rows = _with_player(rows, players, hot)
    rows = lookup(rows, clubs, "club_href", "href", {"club_id": "club_id"}, hot=hot)
    return rows.select("player_id", "club_id", "joined_date_id", "contract_until_id")
