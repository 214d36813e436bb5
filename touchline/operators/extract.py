"""Page features and API payloads to typed entity rows: column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline import fixed, schemas
from touchline.functions.dates import parse_date
from touchline.functions.money import parse_money
from touchline.functions.numbers import first_integer, parse_count, parse_decimal
from touchline.functions.profile import birth_age, birth_date, height_cm
from touchline.functions.text import blank_to_null, drop_jersey_number, squeeze, strip_all
from touchline.functions.urls import normalize_path


def _entity(rows: DataFrame, name: str, values: dict[str, Column]) -> DataFrame:
    """Shape rows to a raw entity's schema; dates become ISO text."""
    return rows.select(
        *[values[field.name].cast(field.dataType).alias(field.name) for field in schemas.RAW[name]]
    )


def _own_path() -> Column:
    """The parent's link, or the page's own address where the parent has none."""
    return F.coalesce(normalize_path(F.col("href")), normalize_path(F.col("url")))


def _cell(position: int) -> Column:
    """A cell of the current row by position from 0; NULL in a row that is too short."""
    return F.try_element_at(F.col("row.cells"), F.lit(position + 1))


def _table_rows(pages: DataFrame, *carry: Column) -> DataFrame:
    """The rows of the first item table of each page, as column `row`."""
    first = F.try_element_at(F.col("features.tables"), F.lit(1))
    return pages.select(*carry, F.explode(first["rows"]).alias("row"))


def competition_rows(pages: DataFrame) -> DataFrame:
    """One competition per page. Input: `href` (of the seed), `url`, `features`."""
    feature = F.col("features")
    country = F.coalesce(feature["country_text"], feature["country_alt"])
    return _entity(pages, "competitions", {
        "type": F.lit("competition"),
        "name": blank_to_null(strip_all(feature["h1_first"])),
        "country": blank_to_null(strip_all(country)),
        "season": feature["competition_season"],
        "href": _own_path(),
    })


def club_rows(pages: DataFrame) -> DataFrame:
    """The clubs listed on competition pages. Input: `href` (of the competition), `url`, `features`."""
    rows = _table_rows(pages, _own_path().alias("competition_href")).where("row.direct")
    rows = rows.withColumn("href", normalize_path(F.col("row.main_href")))
    rows = rows.where(F.col("href").isNotNull() & (F.col("row.main_text") != ""))
    return _entity(rows, "clubs", {
        "type": F.lit("club"),
        "name": strip_all(F.col("row.main_text")),
        "href": F.col("href"),
        "competition_href": F.col("competition_href"),
        "squad_size": parse_decimal(_cell(2), "int"),
        "avg_age": parse_decimal(_cell(3), "double"),
        "total_market_value": parse_money(_cell(6)),
    })


def info_pairs(labels: Column, values: Column) -> Column:
    """Labels and values paired by position up to the shorter list; blank labels drop out."""
    shorter = F.least(F.size(labels), F.size(values))
    paired = F.arrays_zip(
        F.slice(labels, 1, shorter).alias("label"), F.slice(values, 1, shorter).alias("value")
    )
    cleaned = F.transform(
        paired,
        lambda pair: F.struct(squeeze(pair["label"]).alias("label"), squeeze(pair["value"]).alias("value")),
    )
    return F.filter(cleaned, lambda pair: pair["label"].isNotNull())


def info_value(pairs: Column, label: str) -> Column:
    """The value of a label, NULL if absent; of a repeated label, the last."""
    return F.try_element_at(F.filter(pairs, lambda pair: pair["label"] == label), F.lit(-1))["value"]


def player_rows(pages: DataFrame) -> DataFrame:
    """One player per profile page. Input: `href` (of the player), `club_href`, `url`, `features`."""
    feature = F.col("features")
    info = F.col("info")
    pages = pages.withColumn("info", info_pairs(feature["info_labels"], feature["info_values"]))
    # The texts become columns of their own first, so that each is looked up once.
    texts = pages.select(
        "href", "club_href", "url",
        feature["h1_all"].alias("heading"),
        F.array_join(F.transform(feature["value_parts"], strip_all), "").alias("value"),
        info_value(info, fixed.LABEL_BIRTH).alias("birth"),
        info_value(info, fixed.LABEL_HEIGHT).alias("height"),
        info_value(info, fixed.LABEL_CITIZENSHIP).alias("citizenship"),
        info_value(info, fixed.LABEL_POSITION).alias("position"),
        info_value(info, fixed.LABEL_FOOT).alias("foot"),
        info_value(info, fixed.LABEL_JOINED).alias("joined"),
        info_value(info, fixed.LABEL_CONTRACT).alias("contract"),
    )
    return _entity(texts, "players", {
        "type": F.lit("player"),
        "name": drop_jersey_number(squeeze(F.col("heading"))),
        "href": F.coalesce(F.col("href"), normalize_path(F.col("url"))),
        "club_href": F.col("club_href"),
        "dob": birth_date(F.col("birth")),
        "age": birth_age(F.col("birth")),
        "nationality": F.col("citizenship"),
        "position": F.col("position"),
        "foot": F.col("foot"),
        "height_cm": height_cm(F.col("height")),
        "joined": parse_date(F.col("joined")),
        "contract_until": parse_date(F.col("contract")),
        "market_value": parse_money(F.col("value")),
    })


def appearance_rows(pages: DataFrame) -> DataFrame:
    """Stats per competition. Input: `href` (of the player), `url`, `season` (NULL: as shown), `features`."""
    season = F.coalesce(blank_to_null(F.col("season")), F.col("features.stats_season"))
    rows = _table_rows(pages, _own_path().alias("player_href"), season.alias("season"))
    rows = rows.where((F.size("row.cells") >= 9) & (_cell(1) != ""))
    counts = [
        "appearances", "goals", "assists", "yellow_cards", "second_yellow_cards", "red_cards", "minutes",
    ]
    return _entity(rows, "appearances", {
        "type": F.lit("appearance"),
        "player_href": F.col("player_href"),
        "competition": _cell(1),
        "season": F.col("season"),
        **{name: parse_count(_cell(position)) for position, name in enumerate(counts, start=2)},
    })


def injury_rows(pages: DataFrame) -> DataFrame:
    """Injuries. Input: `href` (of the player), `url`, `features`."""
    rows = _table_rows(pages, _own_path().alias("player_href")).where(F.size("row.cells") >= 6)
    return _entity(rows, "injuries", {
        "type": F.lit("injury"),
        "player_href": F.col("player_href"),
        "season": blank_to_null(_cell(0)),
        "injury": blank_to_null(_cell(1)),
        "from": parse_date(_cell(2)),
        "until": parse_date(_cell(3)),
        "days_out": first_integer(_cell(4)),
        "games_missed": first_integer(_cell(5)),
    })


def _payload_entries(payloads: DataFrame, field: str) -> DataFrame:
    """(player_href, entry): the elements of the payload's array `field`, as VARIANT.

    A body that is no JSON, or whose field is no array, gives no rows; an element that is no object is none
    of the entries.
    """
    entries = F.try_variant_get(F.try_parse_json("body"), f"$.{field}", "array<variant>")
    objects = F.filter(entries, lambda entry: F.schema_of_variant(entry).startswith("OBJECT"))
    return payloads.select(normalize_path(F.col("href")).alias("player_href"), F.explode(objects).alias("entry"))


def _field(path: str, kind: str = "string") -> Column:
    """A field of the entry as `kind`, NULL if it is absent or cannot be one. Each field is read by itself, so one
    of another type costs that field and neither its entry nor the payload. Objects and arrays are no texts."""
    value = F.try_variant_get("entry", f"$.{path}", kind)
    found = F.schema_of_variant(F.try_variant_get("entry", f"$.{path}", "variant"))
    return F.when(~found.rlike("^(OBJECT|ARRAY)"), value) if kind == "string" else value


def transfer_rows(payloads: DataFrame) -> DataFrame:
    """Transfers from API payloads. Input: `href` (of the player), `body`. Bad JSON gives no rows."""
    return _entity(_payload_entries(payloads, "transfers"), "transfers", {
        "type": F.lit("transfer"),
        "player_href": F.col("player_href"),
        "date": parse_date(F.coalesce(blank_to_null(_field("dateUnformatted")), _field("date"))),
        "season": _field("season"),
        "from_club": _field("from.clubName"),
        "to_club": _field("to.clubName"),
        "market_value": parse_money(_field("marketValue")),
        "fee": parse_money(_field("fee")),
    })


def market_value_rows(payloads: DataFrame) -> DataFrame:
    """Value history from API payloads. Input: `href` (of the player), `body`. Bad JSON gives no rows."""
    return _entity(_payload_entries(payloads, "list"), "market_values", {
        "type": F.lit("market_value"),
        "player_href": F.col("player_href"),
        "date": parse_date(_field("datum_mw")),
        "market_value": _field("y", "bigint"),
        "club_name": _field("verein"),
    })
