"""Fixed schemas of the raw entities, the JSON payloads and the star tables."""

from __future__ import annotations

from pyspark.sql import types as T

_STRING, _INT, _LONG, _DOUBLE, _DATE = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType(),
)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Raw entities, one JSON object per line. Dates stay text: casting them is a step of the load.
RAW = {
    "competitions": _schema(
        type=_STRING, name=_STRING, country=_STRING, season=_STRING, href=_STRING,
    ),
    "clubs": _schema(
        type=_STRING, name=_STRING, href=_STRING, competition_href=_STRING,
        squad_size=_INT, avg_age=_DOUBLE, total_market_value=_LONG,
    ),
    "players": _schema(
        type=_STRING, name=_STRING, href=_STRING, club_href=_STRING, dob=_STRING, age=_INT,
        nationality=_STRING, position=_STRING, foot=_STRING, height_cm=_INT,
        joined=_STRING, contract_until=_STRING, market_value=_LONG,
    ),
    "appearances": _schema(
        type=_STRING, player_href=_STRING, competition=_STRING, season=_STRING,
        appearances=_INT, goals=_INT, assists=_INT, yellow_cards=_INT,
        second_yellow_cards=_INT, red_cards=_INT, minutes=_INT,
    ),
    "injuries": _schema(
        **{
            "type": _STRING, "player_href": _STRING, "season": _STRING, "injury": _STRING,
            "from": _STRING, "until": _STRING, "days_out": _INT, "games_missed": _INT,
        }
    ),
    "transfers": _schema(
        type=_STRING, player_href=_STRING, date=_STRING, season=_STRING,
        from_club=_STRING, to_club=_STRING, market_value=_LONG, fee=_LONG,
    ),
    "market_values": _schema(
        type=_STRING, player_href=_STRING, date=_STRING, market_value=_LONG, club_name=_STRING,
    ),
}

ENTITIES = list(RAW)

# Date texts of the raw entities.
DATE_TEXTS = {
    "players": ["dob", "joined", "contract_until"], "injuries": ["from", "until"], "transfers": ["date"],
    "market_values": ["date"],
}

# Star tables in load order.
STAR = {
    "dim_competition": _schema(
        competition_id=_INT, href=_STRING, competition_name=_STRING, country=_STRING, season=_STRING,
    ),
    "dim_club": _schema(
        club_id=_INT, href=_STRING, club_name=_STRING, competition_id=_INT,
        squad_size=_INT, avg_age=_DOUBLE, total_market_value=_LONG,
    ),
    "dim_player": _schema(
        player_id=_INT, href=_STRING, name=_STRING, date_birth=_DATE, nationality=_STRING,
        position=_STRING, foot=_STRING, height_cm=_INT,
    ),
    "dim_date": _schema(
        date_id=_INT, date=_DATE, season=_STRING, year=_INT, month=_INT, day=_INT,
    ),
    "fact_stats": _schema(
        player_id=_INT, club_id=_INT, competition_id=_INT, date_id=_INT, appearances=_INT,
        goals=_INT, assists=_INT, yellow_cards=_INT, red_cards=_INT, minutes_played=_INT,
    ),
    "fact_injury": _schema(
        player_id=_INT, start_date_id=_INT, end_date_id=_INT, injury_type=_STRING,
        days_out=_INT, games_missed=_INT,
    ),
    "fact_transfer": _schema(
        player_id=_INT, from_club_id=_INT, to_club_id=_INT, date_id=_INT,
        from_club_name=_STRING, to_club_name=_STRING, market_value=_LONG, transfer_fee=_LONG,
    ),
    "fact_market_value": _schema(player_id=_INT, date_id=_INT, market_value=_LONG),
    "fact_contract": _schema(player_id=_INT, club_id=_INT, joined_date_id=_INT, contract_until_id=_INT),
}

PRIMARY_KEYS = {
    "dim_competition": ["competition_id"],
    "dim_club": ["club_id"],
    "dim_player": ["player_id"],
    "dim_date": ["date_id"],
    "fact_stats": ["player_id", "club_id", "competition_id", "date_id"],
    "fact_injury": ["player_id", "start_date_id", "end_date_id"],
    "fact_transfer": ["player_id", "from_club_id", "to_club_id", "date_id"],
    "fact_market_value": ["player_id", "date_id"],
    "fact_contract": ["player_id", "club_id", "joined_date_id"],
}

UNIQUE_COLUMNS = {
    "dim_competition": ["href"], "dim_club": ["href"], "dim_player": ["href"], "dim_date": ["date"],
}

# Key columns are NOT NULL by their key; these are the further columns that must be filled.
REQUIRED_COLUMNS = {
    "dim_club": ["club_name"],
    "dim_player": ["href"],
    "dim_date": ["date"],
    "fact_stats": PRIMARY_KEYS["fact_stats"],
    "fact_injury": PRIMARY_KEYS["fact_injury"],
    "fact_transfer": PRIMARY_KEYS["fact_transfer"],
    "fact_market_value": PRIMARY_KEYS["fact_market_value"],
    "fact_contract": ["player_id", "club_id", "joined_date_id", "contract_until_id"],
}

# child table -> {child column: (parent table, parent column)}
FOREIGN_KEYS = {
    "dim_club": {"competition_id": ("dim_competition", "competition_id")},
    "fact_stats": {
        "player_id": ("dim_player", "player_id"),
        "club_id": ("dim_club", "club_id"),
        "competition_id": ("dim_competition", "competition_id"),
        "date_id": ("dim_date", "date_id"),
    },
    "fact_injury": {
        "player_id": ("dim_player", "player_id"),
        "start_date_id": ("dim_date", "date_id"),
        "end_date_id": ("dim_date", "date_id"),
    },
    "fact_transfer": {
        "player_id": ("dim_player", "player_id"),
        "from_club_id": ("dim_club", "club_id"),
        "to_club_id": ("dim_club", "club_id"),
        "date_id": ("dim_date", "date_id"),
    },
    "fact_market_value": {
        "player_id": ("dim_player", "player_id"),
        "date_id": ("dim_date", "date_id"),
    },
    "fact_contract": {
        "player_id": ("dim_player", "player_id"),
        "club_id": ("dim_club", "club_id"),
        "joined_date_id": ("dim_date", "date_id"),
        "contract_until_id": ("dim_date", "date_id"),
    },
}

# Names that facts are joined by; a repeated name fans the join out.
JOINED_NAMES = {"dim_competition": "competition_name", "dim_club": "club_name"}

# One page after extraction. `direct` tells rows that are children of a tbody from deeper ones.
PAGE_FEATURES = (
    "struct<h1_first: string, h1_all: string, country_text: string, country_alt: string,"
    " competition_season: string, stats_season: string, season_options: array<string>,"
    " tables: array<struct<rows: array<struct<direct: boolean, main_href: string, any_href: string,"
    " main_text: string, cells: array<string>>>>>,"
    " info_labels: array<string>, info_values: array<string>, value_parts: array<string>>"
)
