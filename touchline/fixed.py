"""Site vocabulary that has to be spelled exactly so for results to be right.

Nothing here is logic. Word lists, labels, CSS names, path parts and patterns are kept
together so that one can see at a glance what the engine takes as given.
"""

# The competitions a crawl starts from when no other seeds are given.
SEED_HREFS = [
    "/premier-league/startseite/wettbewerb/GB1",
    "/laliga/startseite/wettbewerb/ES1",
    "/serie-a/startseite/wettbewerb/IT1",
    "/bundesliga/startseite/wettbewerb/L1",
    "/ligue-1/startseite/wettbewerb/FR1",
    "/campeonato-brasileiro-serie-a/startseite/wettbewerb/BRA1",
]

# Money: optional prefix, one number, optional unit.
MONEY_PATTERN = r"(?i)^[^\d\-.,]*(\d+(?:[.,]\d+)?)\s*(bn|m|k)?$"
MONEY_UNITS = {"": 1.0, "k": 1e3, "m": 1e6, "bn": 1e9}

# Month names as written on pages.
MONTHS_SHORT = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
MONTHS_LONG = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]

MONTH_ALIASES = ["sept"]
WEEKDAYS = "mon|monday|tue|tues|tuesday|wed|wednesday|thu|thur|thurs|thursday|fri|friday|sat|saturday|sun|sunday"

# Texts that stand for a missing value.
MISSING_MARKERS = ["-", "", "n/a", "?", "unknown"]

# A season starts on this day of its year.
SEASON_MONTH, SEASON_DAY = 7, 1

# URL path parts.
PROFILE_PATH = "/profil/spieler/"
STATS_PATH = "/leistungsdaten/spieler/"
INJURIES_PATH = "/verletzungen/spieler/"
LEAGUE_PATH = "/wettbewerb/"
CLUB_PATH = "/verein/"
PLAYER_ID_PATTERN = r"/spieler/(\d+)"
LEAGUE_CODE_PATTERN = r"/wettbewerb/(\w+)$"
SEASON_PARAMETER = "saison"
API_PATHS = {
    "transfers": "/ceapi/transferHistory/list/",
    "market_values": "/ceapi/marketValueDevelopment/graph/",
}

# CSS names read from pages.
ITEM_TABLE_CLASS = "items"
MAIN_LINK_CLASS = "hauptlink"
HEADER_CLUB_CLASS = "data-header__club"
HEADER_FLAG_CLASS = "data-header__box__flag"
HEADER_VALUE_CLASS = "data-header__market-value-wrapper"
INFO_BOX_CLASS = "info-table"
INFO_LABEL_CLASS = "info-table__content--regular"
INFO_VALUE_CLASS = "info-table__content--bold"
COMPETITION_SEASON_SELECT = "saison_id"
STATS_SEASON_SELECT = "saison"

# Labels of the player info box.
LABEL_BIRTH = "Date of birth/Age:"
LABEL_HEIGHT = "Height:"
LABEL_CITIZENSHIP = "Citizenship:"
LABEL_POSITION = "Position:"
LABEL_FOOT = "Foot:"
LABEL_JOINED = "Joined:"
LABEL_CONTRACT = "Contract expires:"

# Patterns inside player texts.
JERSEY_PATTERN = r"^#\d+\s*"
BIRTH_PATTERN = r"(\d{1,2}/\d{1,2}/\d{4})(?:\s*\((\d+)\))?"
HEIGHT_PATTERN = r"(\d+)[,.](\d+)\s*m"
