"""Pages and payloads to entity rows."""

import json
import re
import time
from datetime import date

import pytest
import sample_pages
from pyspark.sql import functions as F

from touchline.operators import extract, frontier
from touchline.plans import crawl
from touchline.sources.pages import page_features_of, with_page_features

BASE = "https://site.example"
COMPETITION_HREF = "/premier-league/startseite/wettbewerb/GB1"
CLUB_HREF = "/manchester-city/startseite/verein/281"
PLAYER_HREF = "/erling-haaland/profil/spieler/418560"


@pytest.fixture(scope="module")
def page(spark):
    def build(body, href, **columns):
        rows = spark.createDataFrame([(href, BASE + (href or "/own/path"), body)], "href STRING, url STRING, body STRING")
        for name, value in columns.items():
            rows = rows.withColumn(name, F.lit(value).cast("string"))
        return with_page_features(rows, "body")

    return build


def dicts(df):
    return [row.asDict() for row in df.collect()]


def test_competition(page):
    (row,) = dicts(extract.competition_rows(page(sample_pages.COMPETITION, COMPETITION_HREF)))
    assert row == {
        "type": "competition", "name": "Premier League", "country": "England", "season": "2025",
        "href": COMPETITION_HREF,
    }


def test_competition_falls_back(page):
    body = '<h1>  </h1><img class="data-header__box__flag" alt=" Spain ">'
    (row,) = dicts(extract.competition_rows(page(body, None)))
    assert row == {
        "type": "competition", "name": None, "country": "Spain", "season": None, "href": "/own/path",
    }


def test_clubs(page):
    rows = dicts(extract.club_rows(page(sample_pages.COMPETITION, COMPETITION_HREF)))
    assert [row["href"] for row in rows] == [CLUB_HREF, "/arsenal/startseite/verein/11"]
    first, second = rows
    assert first["competition_href"] == COMPETITION_HREF
    assert (first["squad_size"], first["avg_age"], first["total_market_value"]) == (27, 26.0, 1_310_000_000)
    assert second["name"] == "Arsenal & Co"
    assert (second["squad_size"], second["avg_age"], second["total_market_value"]) == (None, 25.4, None)


def test_club_name_is_the_first_text_of_any_main_link(page):
    (first, _) = dicts(extract.club_rows(page(sample_pages.COMPETITION, COMPETITION_HREF)))
    assert first["name"] == "Manchester City"  # the first link holds a picture only


def test_squad_links(page):
    squad = page(sample_pages.SQUAD, CLUB_HREF)
    rows = dicts(frontier.profile_frontier(squad, BASE + "/"))
    assert [row["href"] for row in rows] == [PLAYER_HREF, "/phil-foden/profil/spieler/406635"]
    assert {row["club_href"] for row in rows} == {CLUB_HREF}
    assert rows[0]["url"] == BASE + PLAYER_HREF


def test_player(page):
    (row,) = dicts(extract.player_rows(page(sample_pages.PLAYER, PLAYER_HREF, club_href=CLUB_HREF)))
    assert row == {
        "type": "player", "name": "Erling Haaland", "href": PLAYER_HREF, "club_href": CLUB_HREF,
        "dob": "2000-07-21", "age": 25, "nationality": "Norway", "position": "Attack - Centre-Forward",
        "foot": "left", "height_cm": 195, "joined": "2022-07-01", "contract_until": "2034-06-30",
        "market_value": None,
    }


def test_player_value(page):
    body = '<a class="data-header__market-value-wrapper"><span>€</span><span>200.00</span><span>m</span><p>x</p></a>'
    (row,) = dicts(extract.player_rows(page(body, PLAYER_HREF, club_href=CLUB_HREF)))
    assert row["market_value"] == 200_000_000
    assert row["name"] is None


def test_appearances(page):
    rows = dicts(extract.appearance_rows(page(sample_pages.STATS, PLAYER_HREF, season=None)))
    assert [row["competition"] for row in rows] == ["Premier League", "EFL Cup"]
    league, cup = rows
    assert league["season"] == "2025" and league["player_href"] == PLAYER_HREF
    assert (league["appearances"], league["goals"], league["assists"], league["minutes"]) == (30, 22, 7, 2509)
    assert (league["yellow_cards"], league["red_cards"]) == (1, None)
    assert (cup["goals"], cup["assists"], cup["appearances"], cup["minutes"]) == (None, None, 3, 199)
    named = dicts(extract.appearance_rows(page(sample_pages.STATS, PLAYER_HREF, season="2020")))
    assert {row["season"] for row in named} == {"2020"}


def test_season_fan_out(page):
    pages = page(sample_pages.STATS, PLAYER_HREF)
    (row,) = dicts(frontier.season_frontier(pages, BASE))
    assert row["season"] == "2024"
    assert row["url"] == BASE + "/erling-haaland/leistungsdaten/spieler/418560?saison=2024"


def test_injuries(page):
    first, second = dicts(extract.injury_rows(page(sample_pages.INJURIES, PLAYER_HREF)))
    assert first == {
        "type": "injury", "player_href": PLAYER_HREF, "season": "25/26", "injury": "Knock",
        "from": "2026-02-26", "until": "2026-03-01", "days_out": 4, "games_missed": 1,
    }
    assert second["injury"] is None and second["until"] is None and second["days_out"] is None


def test_payloads(spark):
    def payload(body):
        return spark.createDataFrame([(PLAYER_HREF, body)], "href STRING, body STRING")

    first, second = dicts(extract.transfer_rows(payload(sample_pages.TRANSFERS)))
    assert first == {
        "type": "transfer", "player_href": PLAYER_HREF, "date": "2022-07-01", "season": "22/23",
        "from_club": "Dortmund", "to_club": "Manchester City", "market_value": 150_000_000,
        "fee": 60_000_000,
    }
    assert (second["date"], second["from_club"], second["fee"]) == ("2019-12-29", None, None)
    values = dicts(extract.market_value_rows(payload(sample_pages.MARKET_VALUES)))
    assert values[0] == {
        "type": "market_value", "player_href": PLAYER_HREF, "date": "2016-12-18",
        "market_value": 200_000, "club_name": "Bryne FK",
    }
    assert values[1]["date"] is None and values[1]["market_value"] is None
    for bad in ("<html>", "", "{}", '{"transfers": ['):
        assert dicts(extract.transfer_rows(payload(bad))) == []
        assert dicts(extract.market_value_rows(payload(bad))) == []


def test_a_field_of_another_type_costs_that_field_alone(spark):
    def read(rows, bodies):
        """The entries of each body, all bodies in one job."""
        asked = [(f"/p/{number}", body) for number, body in enumerate(bodies)]
        found = {href: [] for href, _ in asked}
        for row in dicts(rows(spark.createDataFrame(asked, "href STRING, body STRING"))):
            found[row.pop("player_href")].append(row)
        return list(found.values())

    whole = {
        "from": {"clubName": "A"}, "to": {"clubName": "[B] {x}"}, "date": "01/07/2020", "season": "20/21",
        "marketValue": "€1.00m", "fee": "€5k",
    }
    columns = dict(zip(whole, ("from_club", "to_club", "date", "season", "market_value", "fee")))
    cases = [(name, odd) for name in whole for odd in ([1], {"x": 1}, None, True)]
    lists = [[7, whole | {name: odd}, [], "x", whole] for name, odd in cases]
    found = read(extract.transfer_rows, [json.dumps({"transfers": entries}) for entries in lists])
    good = found[0][1]
    assert good["to_club"] == "[B] {x}" and None not in good.values()
    for (name, odd), got in zip(cases, found):
        # A plain value is its own text, but no club, date or sum can be read from it.
        lost = "true" if odd is True and name == "season" else None
        assert got == [good | {columns[name]: lost}, good]

    entry = {"datum_mw": "01/07/2020", "y": 12, "verein": "A"}
    columns = {"datum_mw": "date", "y": "market_value", "verein": "club_name"}
    cases = [(name, odd) for name in entry for odd in ([1], {"x": 1}, None)] + [("y", "much"), ("y", "13"), ("y", 12)]
    found = read(extract.market_value_rows, [json.dumps({"list": [entry | {name: odd}]}) for name, odd in cases])
    good = found[-1][0]
    for (name, odd), got in zip(cases, found):
        assert got == [good | {columns[name]: {"13": 13, 12: 12}.get(odd) if name == "y" and isinstance(odd, (str, int)) else None}]
    assert not any(read(extract.market_value_rows, ['{"list": {"y": 1}}', '{"list": 5}', '{"list": null}', "[]", "5", None]))


def test_broken_markup():
    feature = page_features_of(
        '<table class="items"><tbody><tr><td>a<td>b <!-- c --> d</b></div><tr><td>1 < 2 &amp; 3</table>'
        '<table class=items><tr><td>no body</td></tr></table>'
    )
    assert [[row["cells"] for row in table["rows"]] for table in feature["tables"]] == [
        [["a", "b  d"], ["1 < 2 & 3"]], [],
    ]
    assert page_features_of(None)["tables"] == [] and page_features_of("")["h1_first"] is None


def test_nested_table_counts_for_the_outer_row():
    feature = page_features_of(
        '<table class="items"><tbody><tr><td>x<table><tr><td>in</td></tr></table></td><td>y</td></tr></tbody></table>'
    )
    (table,) = feature["tables"]
    assert [(row["direct"], row["cells"]) for row in table["rows"]] == [
        (True, ["xin", "in", "y"]), (False, ["in"]),
    ]


@pytest.fixture(scope="module")
def site(spark):
    bodies = {
        COMPETITION_HREF: sample_pages.COMPETITION,
        CLUB_HREF: sample_pages.SQUAD,
        "/arsenal/startseite/verein/11": sample_pages.SQUAD,
        PLAYER_HREF: sample_pages.PLAYER,
        "/erling-haaland/leistungsdaten/spieler/418560": sample_pages.STATS,
        "/erling-haaland/leistungsdaten/spieler/418560?saison=2024": sample_pages.STATS_2024,
        "/erling-haaland/verletzungen/spieler/418560": sample_pages.INJURIES,
        "/ceapi/transferHistory/list/418560": sample_pages.TRANSFERS,
        "/ceapi/marketValueDevelopment/graph/418560": sample_pages.MARKET_VALUES,
        "/unrelated": "<h1>no parent</h1>",
    }
    rows = [(BASE + path, body) for path, body in bodies.items()]
    return spark.createDataFrame(rows, "url STRING, body STRING")


@pytest.fixture(scope="module")
def seeds(spark):
    hrefs = [COMPETITION_HREF, "/laliga/startseite/wettbewerb/ES1", COMPETITION_HREF]
    return spark.createDataFrame([("competition", href) for href in hrefs], "type STRING, href STRING")


def test_whole_crawl(site, seeds):
    entities = crawl.extract_entities(site, seeds, BASE + "/")
    counts = {name: df.count() for name, df in entities.items()}
    assert counts == {
        "competitions": 1, "clubs": 2, "players": 1, "appearances": 3, "injuries": 2,
        "transfers": 2, "market_values": 2,
    }
    # Listed by two clubs, fetched once: the first club by link wins.
    assert entities["players"].first().club_href == "/arsenal/startseite/verein/11"
    seasons = {(r.competition, r.season) for r in entities["appearances"].collect()}
    assert seasons == {("Premier League", "2025"), ("EFL Cup", "2025"), ("FA Cup", "2024")}


def test_crawl_of_one_club(site, seeds):
    entities = crawl.extract_entities(site, seeds, BASE, league="GB1", club=CLUB_HREF)
    assert [row.href for row in entities["clubs"].collect()] == [CLUB_HREF]
    assert entities["players"].first().club_href == CLUB_HREF
    with pytest.raises(ValueError):
        crawl.extract_entities(site, seeds, BASE, club=CLUB_HREF)


def test_pages_to_published_star(spark, site, seeds, tmp_path):
    from touchline.sources.star import read_star

    out = str(tmp_path / "star")
    counts = crawl.run(spark, site, seeds, BASE, out)
    assert counts == {
        "dim_competition": 3, "dim_club": 3, "dim_player": 1, "dim_date": counts["dim_date"],
        "fact_stats": 3, "fact_injury": 1, "fact_transfer": 1, "fact_market_value": 1, "fact_contract": 1,
    }
    stats = read_star(spark, out)["fact_stats"].where("minutes_played = 2509").first()
    assert (stats.date_id, stats.appearances, stats.goals) == (20250701, 30, 22)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_repeated_pages_count_once(spark, site, seeds, tmp_path):
    old = spark.createDataFrame(
        [(BASE + CLUB_HREF, "<h1>no squad yet</h1>", "2024-01-01"), (BASE + PLAYER_HREF, "<h1>Old</h1>", None)],
        "url STRING, body STRING, fetched STRING",
    )
    fetched = site.withColumn("fetched", F.lit("2025-01-01"))
    twice = fetched.unionByName(fetched).unionByName(old)
    wanted = {name: df.count() for name, df in crawl.extract_entities(site, seeds, BASE).items()}
    entities = crawl.extract_entities(twice, seeds, BASE)
    assert {name: df.count() for name, df in entities.items()} == wanted
    assert entities["players"].first().name != "Old"
    crawl.run(spark, twice, seeds, BASE, str(tmp_path / "star"))  # no repeated link breaks the load
    one = frontier.one_page_per_url(site.unionByName(site))  # without a fetch time: the least body
    assert one.count() == site.count()
    league = crawl.extract_entities(twice, seeds, BASE, league="GB1")
    assert league["clubs"].count() == 2


def test_hops_read_their_kind_and_features_only(site, seeds):
    pages = crawl._Site(site, whole=True)
    hops = {
        "/wettbewerb/GB1": ("/wettbewerb/", crawl._HEADING), "/verein/281": ("/verein/", crawl._TABLES),
        "/profil/spieler/418560": ("/profil/spieler/", crawl._PROFILE),
        "/verletzungen/spieler/418560": ("/verletzungen/spieler/", crawl._TABLES),
    }
    for address, (path, features) in hops.items():
        addresses = site.select("url").where(F.col("url").contains(address))
        plan = plan_of(pages.pages_of(addresses, path, features))
        assert "Contains(kind" in plan or "contains(kind" in plan.lower()
        schema = plan.split("ReadSchema: ")[1].split("\n")[0]
        assert features[0] in schema and ("info_labels" in schema) == ("info_labels" in features)
    assert not crawl.sure_path(site.select("url"), "/verein/")


def test_a_crawl_without_seeds_starts_from_the_built_in_ones(site):
    assert crawl.extract_entities(site, None, BASE)["competitions"].count() == 1


@pytest.mark.parametrize("broken", [
    "<a ", '<a b="x ', "<a '>\" ", '<a "<b \'>', "<!--", "<script>", "<", "<tbody><tr><td>", "<tbody></tbody><tr>", "<h1><i>",
    "<td class='hauptlink'><a>",
])
def test_broken_pages_take_linear_time(broken):
    start = time.perf_counter()
    for box in ("", "<table class=items>"):
        page_features_of(box + broken * (2_000_000 // len(broken)))
    assert time.perf_counter() - start < 40


def test_batches_are_bounded_whatever_the_session_says(spark, page):
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "1g")
    try:
        with pytest.raises(ValueError, match="maxBytesPerBatch"):
            page("<h1>x</h1>", "/a")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "64m")


def test_selections(spark, seeds):
    assert crawl.select_league(seeds, "ES1").count() == 1
    with pytest.raises(crawl.UnknownSelection, match="XYZ.*ES1, GB1"):
        crawl.select_league(seeds, "XYZ")
    clubs = spark.createDataFrame([(CLUB_HREF, "A"), ("/x", "B")], "href STRING, name STRING")
    assert crawl.select_club(clubs, CLUB_HREF).first().name == "A"
    with pytest.raises(crawl.UnknownSelection, match="nowhere"):
        crawl.select_club(clubs, "/nowhere/verein/9")


def test_direct_frontier(spark):
    parents = spark.createDataFrame(
        [("/a",), ("",), (None,), ("https://other.example/b",)], "href STRING"
    )
    got = [row.url for row in frontier.direct_frontier(parents, BASE + "/").collect()]
    assert got == [BASE + "/a", "https://other.example/b"]


def test_dates_are_iso_text(page):
    row = extract.injury_rows(page(sample_pages.INJURIES, PLAYER_HREF)).first()
    assert date.fromisoformat(row["from"]) == date(2026, 2, 26)


SOUND = [
    "<table class='items x'><tbody><tr><td class=hauptlink>a &amp; b<a HREF=\"/x?a=1&amp;b\">l<b>m</b></a><TD>2<tr><td>3</table>",
    "<h1>One <b>two</b></h1 ><p>x<p>y<select name=saison><option value=3 selected>a<option value='4'>b</select><br/>end > ",
    "<li>a</td><table class=\"items\"><tr><th>h<td>c</li></tr><tr><td/>d</table></script x>", "no markup", "",
]
OTHER = ["<a\"x\">", "<a<b>", "<!-- <td> -->", "<script>if (a < b)<td></script>", "<option value='>'>", "a < b", "<a b='", "<td"]


def test_sound_pages_are_split_in_one_step_and_read_the_same(monkeypatch):
    from touchline.sources import pages

    searched, search = [], pages._Page._search
    monkeypatch.setattr(pages._Page, "_search", lambda page, html: (searched.append(html), search(page, html))[1])
    split = [page_features_of(html) for html in SOUND]
    assert searched == []
    mixed = [page_features_of(html + odd + html) for html in SOUND for odd in OTHER]
    assert len(searched) == len(mixed)
    monkeypatch.setattr(pages, "_SOUND_TAG", re.compile("(x)(x)(x)^"))  # splits nothing
    assert split == [page_features_of(html) for html in SOUND]
    assert split[0]["tables"][0]["rows"][0] == {
        "direct": True, "main_href": "/x?a=1&b", "any_href": "/x?a=1&b", "main_text": "l", "cells": ["a & blm", "2"],
    }


def test_features_become_columns_as_arrow_would_make_them():
    import pyarrow as pa

    from touchline.sources import pages

    text, row = pa.string(), {"direct": pa.bool_(), "main_href": pa.string(), "cells": pa.list_(pa.string())}
    table = pa.struct([pa.field("rows", pa.list_(pa.struct(row.items())))])
    kind = pa.struct([("h1_first", text), ("tables", pa.list_(table)), ("info_labels", pa.list_(text))])
    for found in ([page_features_of(html) for html in [*SOUND, *OTHER]], []):
        assert pages._column(found, kind).to_pylist() == pa.array(found, kind).to_pylist()
