"""A small star, by hand: about every awkward row the load has to decide on."""

COMPETITIONS = [
    ("/gb1", "Premier League", "England", "2025"),
    ("/es1", "LaLiga", "Spain", "2025"),
    (None, "No link", None, None),
]
CLUBS = [  # name, href, competition_href, squad_size, avg_age, total_market_value
    ("City", "/city", "/gb1", 27, 26.0, 1_310_000_000),
    ("Madrid", "/madrid", "/es1", 24, 25.5, None),
    ("Lost", "/lost", "/unknown", None, None, None),
    ("Twin", "/twin-a", "/gb1", None, None, None),
    ("Twin", "/twin-b", "/es1", None, None, None),
    (None, "/nameless", "/gb1", 1, 1.0, 1),
    ("No link", None, "/gb1", 1, 1.0, 1),
]
PLAYERS = [  # name, href, club_href, dob, joined, contract_until
    ("Bo", "/p/bo", "/city", "2000-07-21", "2022-07-01", "2034-06-30"),
    ("Ann", "/p/ann", "/madrid", "not a day", "2021-07-01", "2025-06-30"),
    ("Ann", "/p/ann", "/city", "not a day", "2023-01-15", "2026-06-30"),   # on two clubs
    ("Aaa", "/p/bo", "/city", "1999-01-01", "2024-07-01", "2030-06-30"),   # same link, least name
    (None, "/p/zed", "/nowhere", "2001-02-03", "2020-07-01", None),         # unknown club
    ("No link", None, "/city", None, None, None),
]
APPEARANCES = [  # player_href, competition, season, appearances, goals, assists, yellow, 2nd, red, minutes
    ("/p/bo", "Premier League", "2025", 30, 22, 7, 1, None, None, 2509),
    ("/p/bo", "Premier League", "2025", 31, 20, None, 2, 1, None, 2400),    # repeated row
    ("/p/bo", "Cup", "2025", 3, None, None, None, None, None, 199),         # unknown competition
    ("/p/ann", "LaLiga", "2024", 10, 1, 1, 0, 0, 0, 900),
    ("/p/bo", "LaLiga", "25/26", 1, 1, 1, 1, 1, 1, 1),                      # season is no year
    ("/p/ghost", "Premier League", "2023", 1, 1, 1, 1, 1, 1, 1),            # unknown player
    ("/p/zed", "Abroad League", "2025", 1, 1, 1, 1, 1, 1, 1),               # player of an unknown club
    ("/p/bo", None, "2025", 1, 1, 1, 1, 1, 1, 1),
]
INJURIES = [  # player_href, season, injury, from, until, days_out, games_missed
    ("/p/bo", "25/26", "Knock", "2026-02-26", "2026-03-01", 4, 1),
    ("/p/bo", "25/26", "Bruise", "2026-02-26", "2026-03-01", 3, None),      # repeated row
    ("/p/bo", "24/25", None, "2025-01-01", "2025-01-05", None, None),       # all measures NULL
    ("/p/ann", "24/25", "Flu", "2025-02-01", None, 9, 2),                   # no end
    ("/p/ghost", "24/25", "Flu", "2025-02-02", "2025-02-03", 1, 1),
]
TRANSFERS = [  # player_href, date, season, from_club, to_club, market_value, fee
    ("/p/bo", "2022-07-01", "22/23", "Dortmund", "City", 150, 60),
    ("/p/bo", "2022-07-01", "22/23", "Dortmund", "City", 140, 75),          # repeated row
    ("/p/bo", "2019-12-29", "19/20", " City ", "Dortmund", 1, 1),           # padded name of a known club
    ("/p/ann", "2018-01-01", "17/18", "Twin", "Madrid", 5, None),           # two clubs of this name
    ("/p/ann", None, "17/18", "Madrid", "City", 1, 1),
    ("/p/ann", "2017-01-01", "16/17", None, "Youth", 1, 1),
]
MARKET_VALUES = [  # player_href, date, market_value, club_name
    ("/p/bo", "2016-12-18", 200, "Bryne"),
    ("/p/bo", "2016-12-18", 300, "Bryne"),
    ("/p/ann", "2017-05-05", None, None),
    ("/p/ann", None, 1, None),
    ("/p/ghost", "2015-05-05", 9, None),
]


def entities(spark):
    """The rows above in the raw schemas."""
    from touchline import schemas

    def build(name, columns, rows):
        shaped = []
        for row in rows:
            given = dict(zip(columns.split(), row))
            shaped.append(tuple(given.get(field) for field in schemas.RAW[name].fieldNames()))
        return spark.createDataFrame(shaped, schemas.RAW[name])

    return {
        "competitions": build("competitions", "href name country season", COMPETITIONS),
        "clubs": build("clubs", "name href competition_href squad_size avg_age total_market_value", CLUBS),
        "players": build("players", "name href club_href dob joined contract_until", PLAYERS),
        "appearances": build(
            "appearances",
            "player_href competition season appearances goals assists yellow_cards second_yellow_cards "
            "red_cards minutes",
            APPEARANCES,
        ),
        "injuries": build("injuries", "player_href season injury from until days_out games_missed", INJURIES),
        "transfers": build("transfers", "player_href date season from_club to_club market_value fee", TRANSFERS),
        "market_values": build("market_values", "player_href date market_value club_name", MARKET_VALUES),
    }
