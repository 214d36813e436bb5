"""Scalar functions, case by case."""

from datetime import date

from touchline.functions import dates, money, numbers, profile, text, urls


def check(evaluate, function, cases):
    assert evaluate(function, list(cases)) == list(cases.values())


def test_money_values(evaluate):
    check(evaluate, money.parse_money, {
        "€12.50m": 12_500_000, "€1m": 1_000_000, "€800k": 800_000, "€50k": 50_000,
        "€120.00m": 120_000_000, "€1.31bn": 1_310_000_000, "€2bn": 2_000_000_000,
        "$12.50m": 12_500_000, "12.50m": 12_500_000, "€12,50m": 12_500_000,
        "Loan fee: €2m": 2_000_000, "  €3 M ": 3_000_000, " €3m ": 3_000_000,
        "0.5": 0, "1.5": 2, "2.5": 2, "7": 7,
    })


def test_money_missing_or_not_a_value(evaluate):
    check(evaluate, money.parse_money, {
        "-": None, "": None, None: None, "N/A": None, "?": None, "Unknown": None,
        "€1,234,567": None, "€-5m": None, "free transfer": None, "€5m extra": None,
        "99999999999999999999bn": None,
    })


def test_dates(evaluate):
    check(evaluate, dates.parse_date, {
        "May 15, 2003": date(2003, 5, 15), "Jan 1, 2000": date(2000, 1, 1),
        "Dec 31, 1999": date(1999, 12, 31), "2003-05-15": date(2003, 5, 15),
        "15/05/2003": date(2003, 5, 15), "15.05.2003": date(2003, 5, 15),
        "1.7.2003": date(2003, 7, 1), "15-05-2003": date(2003, 5, 15),
        "may 5, 2003": date(2003, 5, 5), "September 5, 2003": date(2003, 9, 5),
        "15 May 2003": date(2003, 5, 15), "15 march 2003": date(2003, 3, 15),
        "  2003-5-1 ": date(2003, 5, 1),
        "May 15 2003": date(2003, 5, 15), "15 May, 2003": date(2003, 5, 15), "Sat, 15 May 2003": date(2003, 5, 15),
        "2003/05/15": date(2003, 5, 15), "15/05/03": date(2003, 5, 15), "15.05.99": date(1999, 5, 15),
        "Sept 5, 2003": date(2003, 9, 5), "15th May 2003": date(2003, 5, 15), "May 1st, 2003": date(2003, 5, 1),
        "2022-07-01T00:00:00+02:00": date(2022, 7, 1), "2022-07-01 00:00:00": date(2022, 7, 1),
        "2022-07-01T23:59:59.123Z": date(2022, 7, 1), "Jul. 1, 2022": date(2022, 7, 1),
        "Thursday 3 June 2004": date(2004, 6, 3), "05/15/2003": date(2003, 5, 15), "1/7/68": date(2068, 7, 1),
        "15 May 2003, 10:30": date(2003, 5, 15), "15-May-2003": date(2003, 5, 15),
        "05/15/03": date(2003, 5, 15), "2003-Sep-05": date(2003, 9, 5), "29.02.00": date(2000, 2, 29),
        "1st of sept, 2003t10:30": date(2003, 9, 1), "DECEMBER 31 1999 23:59:59.9 +0200": date(1999, 12, 31),
    })


def test_dates_missing_or_partial(evaluate):
    check(evaluate, dates.parse_date, {
        "-": None, "": None, None: None, "unknown": None, "May 2003": None, "2003": None,
        "Feb 30, 2003": None, "31/02/2003": None, "15/05.2003": None, "Foo 5, 2003": None,
        "0000-01-01": None, "32/01/2003": None, "03-May-15": None, "Sept. 2003": None, "29.02.99": None,
        "2003-05-15 x": None, "x 2003-05-15": None, "2003-05-15\n2003-05-16": None, "Mayor 5, 2003": None,
    })


def test_paths(evaluate):
    check(evaluate, urls.normalize_path, {
        "https://www.site.example/foo/bar": "/foo/bar", "https://www.site.example/foo/bar?x=1": "/foo/bar",
        "http://site.example/foo/bar": "/foo/bar", "/foo/bar": "/foo/bar", "/foo/bar?x=1": "/foo/bar",
        "/foo/bar#anchor": "/foo/bar", "  /foo/bar  ": "/foo/bar", "": None, None: None, "  ": None,
        "foo/bar": "/foo/bar", "//host/foo": "/foo", "https://h": "/https://h", "?x=1": "/?x=1",
        "/a;p=1/b;q=2": "/a;p=1/b", "/foo bar/ü": "/foo bar/ü", "mailto:a@b": "/a@b",
    })


def test_decimals(evaluate):
    check(evaluate, lambda c: numbers.parse_decimal(c, "int"), {
        "27": 27, " 27 ": 27, "-": None, "": None, None: None, "1,000": None, "26.0": None, "x": None,
        "-3": -3, "99999999999": None,
    })
    check(evaluate, lambda c: numbers.parse_decimal(c, "double"), {
        "26.0": 26.0, "26,4": 26.4, "1,000": 1.0, "1,000.5": None, "-": None, "27": 27.0, "1e2": 100.0,
    })


def test_counts(evaluate):
    check(evaluate, numbers.parse_count, {
        "2.509'": 2509, "1,234": 1234, "30": 30, "-": None, "": None, None: None, "3 games": None,
        " 7 ": 7,
    })


def test_first_integer(evaluate):
    check(evaluate, numbers.first_integer, {
        "4 days": 4, "1.234": 1, "none": None, "": None, None: None, "99999999999": None,
    })


def test_season_years_and_dates(evaluate):
    check(evaluate, numbers.season_year, {
        "2025": 2025, " 2025 ": 2025, "25/26": None, "25.6": None, "1e3": None, "": None, None: None,
    })
    check(evaluate, dates.season_date, {
        "2025": date(2025, 7, 1), "0": None, "25/26": None, None: None,
    })


def test_season_key(evaluate):
    check(evaluate, dates.season_key, {"2025": 20250701, "26": 260701, "0": None, "25/26": None, None: None})


def test_unread_dates_are_told_from_missing_ones(evaluate):
    check(evaluate, lambda c: dates.unread(c, dates.parse_date(c)), {
        "May 15, 2003": False, "-": False, " N/A ": False, "": False, "unknown": False, "?": False, None: None,
        "May 2003": True, "31/02/2003": True, "soon": True, "2022-07-01 25:00": True,
    })


def test_cast_date_off_plain_iso(evaluate):
    check(evaluate, dates.cast_date, {
        "2023/5/1": date(2023, 5, 1), "2023 5 1": date(2023, 5, 1), "2023\\5\\1": date(2023, 5, 1),
        " 2023-01-01 \n": date(2023, 1, 1), "2023-01-01 10:00": date(2023, 1, 1), "2023-01-01T10:00:00Z": date(2023, 1, 1),
        "2023-01-01 10:00:00.123 +02:00": date(2023, 1, 1), "2023/5/1 10:00:00": date(2023, 5, 1),
        "2023-1-1 zzz": None, "2023-1-1zzz": None, "2023-5/1": None, "2023-01-01 25:00:00": None, "2023-01-01 10": None,
        "2023-01-01 10:61:00": None, "20230101": None, "2023-13-1": None, "2023-02-30": None, "2023-001-01": None,
        "2023-01-01T": None, "2023-1-1.": None, "+2023-01-01": None, "2023-01-01 24:00:00": date(2023, 1, 1), None: None,
    })


def test_cast_date_and_key(evaluate):
    check(evaluate, dates.cast_date, {
        "2023-05-01": date(2023, 5, 1), "2023-5-1": date(2023, 5, 1), "2023": None, "2023-5": None,
        "2023-02-30": None, "01/02/2023": None, None: None,
    })
    check(evaluate, lambda c: dates.date_key(dates.cast_date(c)), {
        "2023-05-01": 20230501, "x": None, None: None,
    })


def test_text(evaluate):
    check(evaluate, text.strip_all, {"  a b\t\n": "a b", "": "", None: None, "\x1ca\x1f": "a"})
    check(evaluate, text.squeeze, {" a \n  b ": "a b", " \t": None, "": None, None: None})
    check(evaluate, text.strip_spaces, {"  a b ": "a b", "\ta": "\ta", None: None})
    check(evaluate, text.drop_jersey_number, {"#9 Ann Lee": "Ann Lee", "Ann #9": "Ann #9", "#9": ""})


def test_profile_texts(evaluate):
    check(evaluate, profile.birth_date, {
        "21/07/2000 (25)": date(2000, 7, 21), "born 1/2/1999": date(1999, 2, 1), "n/a": None, None: None,
    })
    check(evaluate, profile.birth_age, {"21/07/2000 (25)": 25, "21/07/2000": None, "(25)": None})
    check(evaluate, profile.height_cm, {
        "1,95 m": 195, "1.80m": 180, "1,9 m": 109, "1,123 m": 100, "195 cm": None, "": None, None: None,
    })


def test_dependent_addresses(evaluate):
    base = "https://site.example/"
    profile_href = "/ann-lee/profil/spieler/418560"
    check(evaluate, lambda c: urls.page_url(c, base), {
        "/foo": "https://site.example/foo", "https://other.example/x": "https://other.example/x",
    })
    check(evaluate, lambda c: urls.api_url(c, base, "transfers"), {
        profile_href: "https://site.example/ceapi/transferHistory/list/418560",
        "/fc/startseite/verein/131": None, "": None, None: None,
    })
    check(evaluate, lambda c: urls.api_url(c, base, "market_values"), {
        profile_href: "https://site.example/ceapi/marketValueDevelopment/graph/418560",
    })
    check(evaluate, lambda c: urls.with_season(urls.player_page_url(c, base, "/leistungsdaten/spieler/"), c), {
        None: None,
    })


def test_season_parameter(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(
        [(1, "/p", "2024"), (2, "/p?x=1", "2024"), (3, "/p", None), (4, "/p", "")],
        "i INT, url STRING, season STRING",
    )
    got = rows.select(urls.with_season(F.col("url"), F.col("season")).alias("u"), "i").orderBy("i").collect()
    assert [row.u for row in got] == ["/p?saison=2024", "/p?x=1&saison=2024", "/p", "/p"]
