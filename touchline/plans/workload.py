"""The registered queries: every operator over the given tables.

The given tables hold no sports rows, so the raw entities are derived from them, whole:
suppliers play competitions, parts clubs, customers players, line items appearances and
injuries, orders transfers and values. Awkward cases (unknown players, padded names, second
listings, seasons that are no year) come from column values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions import dates, money, numbers, profile, text, urls
from touchline.operators import audit, extract, frontier, keys, lookups
from touchline.operators.collapse import collapse, date_feed, date_spine, table_counts
from touchline.plans import dims, facts
from touchline.plans.jobs import together
from touchline.plans.crawl import extract_entities
from touchline.plans.crawl import run as crawl_site
from touchline.plans.load import build_star, land, load
from touchline.sources.entities import (
    default_seeds, read_entities, read_entity, read_seeds, split_malformed, write_entity,
)
from touchline.sources.pages import with_page_features
from touchline.sources.scratch import materialize, scratch_folder
from touchline.sources.star import read_star

BASE_URL = "https://site.example/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(*parts) -> Column:
    """Join literals and columns to one text; a NULL part gives NULL."""
    return F.concat(*[part.cast("string") if isinstance(part, Column) else F.lit(part) for part in parts])


def _day(column: str) -> Column:
    return F.to_date(column).cast("string")


def _floor(column: str) -> Column:
    return F.floor(F.col(column)).cast("bigint")


# --- raw entities -------------------------------------------------------------------------


def _competition_href(key: Column) -> Column:
    return _text("/s/startseite/wettbewerb/S", key)


def _club_href(key: Column) -> Column:
    return _text("/c/startseite/verein/", key)


def _player_href(key: Column) -> Column:
    return _text("/p/profil/spieler/", key)


def _as_entity(rows: DataFrame, entity: str, /, **values: Column) -> DataFrame:
    return rows.select(*[
        values.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
        for field in schemas.RAW[entity]
    ])


def _any_form(day: Column, key: Column) -> Column:
    """An ISO date as one of five texts that a cast takes, by key."""
    form = F.pmod(key, F.lit(5))
    return (
        F.when(form == 1, F.replace(day, F.lit("-"), F.lit("/"))).when(form == 2, F.replace(day, F.lit("-"), F.lit(" ")))
        .when(form == 3, _text(day, " 10:30:00")).when(form == 4, _text(day, "T10:30")).otherwise(day)
    )


def raw_competitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers; every tenth has the name of the one before it."""
    named = F.col("s_suppkey") - F.when(F.col("s_suppkey") % 10 == 0, 1).otherwise(0)
    return _as_entity(
        table(spark, sf_dir, "supplier"), "competitions", type=F.lit("competition"),
        name=_text("Supplier#", F.lpad(named.cast("string"), 9, "0")), country=_text("Country ", F.col("s_nationkey")), season=F.lit("2025"),
        href=_competition_href(F.col("s_suppkey")),
    )


def raw_clubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_entity(
        table(spark, sf_dir, "part"), "clubs", type=F.lit("club"), name=_text("Club ", F.col("p_partkey")),
        href=_club_href(F.col("p_partkey")), competition_href=_competition_href(F.col("p_size")),
        squad_size=F.col("p_size"), avg_age=F.col("p_retailprice"), total_market_value=_floor("p_retailprice"),
    )


def raw_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer, and customers of one segment a second time with another club."""
    customers = table(spark, sf_dir, "customer")
    nation, building = F.col("c_nationkey"), F.col("c_mktsegment") == "BUILDING"
    listings = F.when(building, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = customers.withColumn("again", F.explode(listings))
    club = F.when(F.col("again") == 1, nation.cast("bigint")).otherwise(F.col("c_custkey"))
    return _as_entity(
        rows, "players", type=F.lit("player"),
        name=_text(F.col("c_name"), F.when(F.col("again") == 1, F.lit(" II")).otherwise(F.lit(""))),
        href=_player_href(F.col("c_custkey")), club_href=_club_href(club),
        dob=F.when(F.col("c_acctbal") < 0, F.lit("unknown")).otherwise(_text(
            nation + 1960, "-5-", nation + 1, F.when(F.col("c_custkey") % 7 == 3, F.lit(" zzz")).otherwise(F.lit("")),
        )),
        nationality=_text("Nation ", nation), position=F.col("c_mktsegment"),
        foot=F.when(F.col("c_acctbal") > 5000, F.lit("left")), height_cm=nation + 170,
        joined=_any_form(_text(nation + 2000 + F.col("again"), "-07-01"), F.col("c_custkey")),
        contract_until=F.when(
            F.col("c_acctbal") >= 0, _any_form(_text(nation + 2005, "-06-30"), F.col("c_custkey"))
        ),
    )


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])


def raw_appearances(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _text("Supplier#", F.lpad(F.col("l_suppkey").cast("string"), 9, "0"))
    cup = _text("Cup ", F.col("l_suppkey"))
    return _as_entity(
        _order_lines(spark, sf_dir), "appearances", type=F.lit("appearance"),
        player_href=_player_href(F.col("o_custkey")),
        competition=F.when(F.col("l_returnflag") == "R", cup).otherwise(known),
        season=F.when(F.col("l_tax") == 0, F.lit("25/26")).otherwise(F.year("l_shipdate").cast("string")),
        appearances=F.col("l_linenumber"), goals=F.col("l_quantity"),
        assists=F.when(F.col("l_discount") > 0, F.round(F.col("l_discount") * 100)),
        yellow_cards=F.col("l_linenumber"), minutes=_floor("l_extendedprice"),
    )


def raw_injuries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_entity(
        _order_lines(spark, sf_dir), "injuries",
        **{
            "type": F.lit("injury"), "player_href": _player_href(F.col("o_custkey")),
            "season": F.year("o_orderdate").cast("string"), "injury": F.col("l_returnflag"),
            "from": _any_form(_day("o_orderdate"), F.col("o_orderkey")),
            "until": F.when(F.col("l_linestatus") == "F", _any_form(_day("l_shipdate"), F.col("l_orderkey"))),
            "days_out": F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")),
            "games_missed": F.col("l_linenumber"),
        },
    )


def raw_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders; one priority class belongs to players that no squad lists."""
    status, customer = F.col("o_orderstatus"), F.col("o_custkey")
    to_club = (
        F.when(status == "F", _text("Club ", customer + 1))
        .when(status == "O", _text("  Padded ", F.col("o_orderpriority"), " "))
        .otherwise(_text("Abroad ", customer))
    )
    listed = F.col("o_orderpriority") != "5-LOW"
    return _as_entity(
        table(spark, sf_dir, "orders"), "transfers", type=F.lit("transfer"),
        player_href=F.when(listed, _player_href(customer)).otherwise(_text("/x/profil/spieler/", customer)),
        date=_any_form(_day("o_orderdate"), F.col("o_orderkey")), season=F.date_format(F.to_date("o_orderdate"), "yy/MM"),
        from_club=F.when(F.col("o_orderpriority") != "1-URGENT", _text("Club ", customer)), to_club=to_club,
        market_value=_floor("o_totalprice"), fee=F.floor(F.col("o_totalprice") / 2),
    )


def raw_market_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_entity(
        table(spark, sf_dir, "orders"), "market_values", type=F.lit("market_value"),
        player_href=_player_href(F.col("o_custkey")),
        date=F.when(F.col("o_orderstatus") != "P", _day("o_orderdate")), market_value=_floor("o_totalprice"),
    )


def raw_entities(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    builders = {
        "competitions": raw_competitions, "clubs": raw_clubs, "players": raw_players,
        "appearances": raw_appearances, "injuries": raw_injuries, "transfers": raw_transfers,
        "market_values": raw_market_values,
    }
    return {name: build(spark, sf_dir) for name, build in builders.items()}


# --- the star -----------------------------------------------------------------------------


def dim_competition(spark, sf_dir):
    return dims.dim_competition(raw_competitions(spark, sf_dir))


def dim_club(spark, sf_dir):
    return dims.dim_club(raw_clubs(spark, sf_dir), dim_competition(spark, sf_dir))


def dim_player(spark, sf_dir):
    return dims.dim_player(raw_players(spark, sf_dir))


def stub_competitions(spark, sf_dir):
    return dims.stub_competitions(raw_appearances(spark, sf_dir), dim_competition(spark, sf_dir))


def stub_clubs(spark, sf_dir):
    return dims.stub_clubs(raw_transfers(spark, sf_dir), dim_club(spark, sf_dir))


def dim_date(spark, sf_dir):
    raw = raw_entities(spark, sf_dir)
    return dims.dim_date(*[raw[n] for n in ("appearances", "injuries", "transfers", "market_values", "players")])


def fact_stats(spark, sf_dir):
    appearances, listed = raw_appearances(spark, sf_dir), raw_players(spark, sf_dir)
    competitions, players = together(
        spark, lambda: dim_competition(spark, sf_dir), lambda: dim_player(spark, sf_dir)
    )
    stubs, clubs = together(
        spark, lambda: dims.stub_competitions(appearances, competitions),
        lambda: dims.dim_club(raw_clubs(spark, sf_dir), competitions),
    )
    return facts.fact_stats(appearances, listed, players, clubs, competitions.unionByName(stubs))


def fact_injury(spark, sf_dir):
    return facts.fact_injury(raw_injuries(spark, sf_dir), dim_player(spark, sf_dir))


def fact_transfer(spark, sf_dir):
    transfers = raw_transfers(spark, sf_dir)
    clubs, players = together(spark, lambda: dim_club(spark, sf_dir), lambda: dim_player(spark, sf_dir))
    clubs = clubs.unionByName(dims.stub_clubs(transfers, clubs))
    return facts.fact_transfer(transfers, players, clubs)


def fact_market_value(spark, sf_dir):
    return facts.fact_market_value(raw_market_values(spark, sf_dir), dim_player(spark, sf_dir))


def fact_contract(spark, sf_dir):
    clubs, players = together(spark, lambda: dim_club(spark, sf_dir), lambda: dim_player(spark, sf_dir))
    return facts.fact_contract(raw_players(spark, sf_dir), players, clubs)


def _star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return build_star(land(raw_entities(spark, sf_dir)), lambda name, df: materialize(df, name))


def star_counts(spark, sf_dir):
    return table_counts(_star(spark, sf_dir))


def star_audit(spark, sf_dir):
    """All rules of the star; every count is 0, and one row stands for each rule."""
    return audit.audit_star(_star(spark, sf_dir))


def _published(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    out = scratch_folder(spark, "star")
    load(spark, raw_entities(spark, sf_dir), out)
    return read_star(spark, out)


def published_star(spark, sf_dir):
    """The whole load, from raw rows to the published tables, counted as a reader finds them."""
    return table_counts(_published(spark, sf_dir))


def _said(star: dict[str, DataFrame]) -> DataFrame:
    """Every row of every table as a text; ages in hundredths."""
    def said(df: DataFrame) -> Column:
        values = {"avg_age": F.round(F.col("avg_age") * 100).cast("bigint")} if "avg_age" in df.columns else {}
        texts = [F.coalesce(values.get(name, F.col(name)).cast("string"), F.lit("~")) for name in df.columns]
        return F.concat_ws("|", *texts)

    return _all([df.select(F.lit(name).alias("table_name"), said(df).alias("said")) for name, df in star.items()])


def published_rows(spark, sf_dir):
    """The whole load, and every row of every table as a reader finds it."""
    return _said(_published(spark, sf_dir))


def loaded_files(spark, sf_dir):
    """From entity files to the star: seven folders of JSON lines, one of them with lines that break off, read,
    loaded, published, and every row as a reader finds it; the broken lines are counted in the report."""
    folder, out = scratch_folder(spark, "files"), scratch_folder(spark, "star")
    raw = raw_entities(spark, sf_dir)
    together(spark, *[lambda name=name, df=df: write_entity(df, folder, name) for name, df in raw.items()])
    broken = table(spark, sf_dir, "region").select(_text('{"name": "', F.col("r_name")).alias("value"))
    broken.write.mode("append").text(f"{folder}/clubs.jsonl")
    report = load(spark, folder, out, bad_lines="skip")
    star = read_star(spark, out)
    notes = [(name, f"{rule}: {n}") for (name, rule), n in sorted(report.notes.items()) if rule == "malformed lines"]
    counted = [(name, f"rows: {n}") for name, n in report.items()]
    return _said(star).unionByName(spark.createDataFrame([*notes, *counted], "table_name string, said string"))


def crawled_star(spark, sf_dir):
    """From fetched pages to the star: the whole crawl and load, and every row as a reader finds it."""
    out = scratch_folder(spark, "star")
    seeds = table(spark, sf_dir, "part").select(_competition_href(F.col("p_partkey")).alias("href"))
    crawl_site(spark, _site(spark, sf_dir), seeds, BASE_URL, out)
    return _said(read_star(spark, out))


def unread_dates(spark, sf_dir):
    """Date texts of the raw entities that are no date."""
    return audit.unread_dates(raw_entities(spark, sf_dir))


def entity_files(spark, sf_dir):
    """Transfers written as JSON lines and read back."""
    folder = scratch_folder(spark, "files")
    write_entity(raw_transfers(spark, sf_dir), folder, "transfers")
    return read_entity(spark, folder, "transfers")


def seed_rows(spark, sf_dir):
    """A seed per supplier, written as JSON lines and read back, and the built-in seeds."""
    folder = scratch_folder(spark, "files")
    seeds = table(spark, sf_dir, "supplier").select(
        F.lit("competition").alias("type"), _competition_href(F.col("s_suppkey")).alias("href")
    )
    write_entity(seeds, folder, "seeds")
    return read_seeds(spark, f"{folder}/seeds.jsonl").unionByName(default_seeds(spark))


def parent_lines(spark, sf_dir):
    """A club per part as a JSON line, every tenth broken off: the good rows and the bad lines."""
    folder = scratch_folder(spark, "files")
    name = _text('{"name": "Club ', F.col("p_partkey"), '", "squad')
    rest = _text('_size": "', F.col("p_size"), '", "new": 1}')
    line = F.when(F.col("p_partkey") % 10 == 0, name).otherwise(_text(name, rest))
    table(spark, sf_dir, "part").select(F.explode(F.array(line, F.lit(" "))).alias("value")).write.text(f"{folder}/clubs.jsonl")
    good, bad = split_malformed(spark, folder, "clubs")
    return _all([
        good.select(F.lit("good").alias("kind"), F.col("name").alias("said"), "squad_size"),
        bad.select(F.lit("bad").alias("kind"), F.col("line").alias("said"), F.lit(None).cast("int").alias("squad_size")),
    ])


def missing_sources(spark, sf_dir):
    """Two of seven entities as files, the others absent or empty: the rows that each one gives."""
    folder = scratch_folder(spark, "files")
    write_entity(raw_clubs(spark, sf_dir), folder, "clubs")
    write_entity(table(spark, sf_dir, "customer").select(F.col("c_name").alias("name")), folder, "players")
    write_entity(table(spark, sf_dir, "region").where("r_regionkey < 0").select("r_name"), folder, "injuries")
    return table_counts(read_entities(spark, folder)).select(F.col("table_name").alias("entity"), F.col("n_rows").alias("n"))


# --- single operators ---------------------------------------------------------------------


def dense_key(spark, sf_dir):
    """Number the orders by day and key: an order key over the largest dimension-like table."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return keys.dense_key(orders, ["o_orderdate", "o_orderkey"], "order_id").select("o_orderkey", "order_id")


def left_lookup(spark, sf_dir):
    """Suppliers with the nation of their key; every fifth nation is asked for by a key that none has."""
    key = F.col("s_nationkey")
    suppliers = table(spark, sf_dir, "supplier").withColumn("asked", F.when(key % 5 == 1, -1).otherwise(key))
    rows = lookups.lookup(
        suppliers, table(spark, sf_dir, "nation"), "asked", "n_nationkey", {"n_name": "n_name"}, "left"
    )
    return rows.select("s_suppkey", "s_name", "n_name")


def salted_lookup(spark, sf_dir):
    """Events with their user's name; users that outgrow a partition are spread over several groups."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    events, hot = lookups.with_hot_keys(events, "events", "user_id")
    rows = lookups.lookup(
        events, table(spark, sf_dir, "customer"), "user_id", "c_custkey", {"c_name": "c_name"}, hot=hot
    )
    return rows.select("event_id", "c_name")


def first_per_key(spark, sf_dir):
    """The first event of each user."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    rows = keys.first_per_key(events, ["user_id"], [F.col("ts"), F.col("event_id")])
    return rows.select("user_id", "event_id", "event_type")


def latest_per_key(spark, sf_dir):
    """The latest order of each customer and status."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderdate", "o_orderkey")
    latest = [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").desc()]
    rows = keys.first_per_key(orders, ["o_custkey", "o_orderstatus"], latest)
    return rows.select("o_custkey", "o_orderstatus", "o_orderkey")


def stub_members(spark, sf_dir):
    """Customers named by orders but known under that name in one segment only, numbered after them."""
    other = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("")).otherwise(F.lit("other "))
    known = table(spark, sf_dir, "customer").select(_text(other, F.col("c_custkey")).alias("name"))
    known = keys.dense_key(known, ["name"], "member_id")
    names = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("name"))
    missing = lookups.missing_members(names, known, "name")
    return keys.append_members(known, missing, "name", "member_id").select("member_id", "name")


def daily_value(spark, sf_dir):
    """The highest order of each known customer on each day."""
    players = dims.dim_player(raw_players(spark, sf_dir)).select("player_id", "href", "name")
    values = facts.fact_market_value(raw_market_values(spark, sf_dir), players)
    return lookups.lookup(values, players, "player_id", "player_id", {"name": "name"}).select(
        "name", "date_id", "market_value"
    )


def highest_value(spark, sf_dir):
    """The highest value ever per player: the smallest whole query from raw rows to an answer."""
    players = dims.dim_player(raw_players(spark, sf_dir))
    values = facts.fact_market_value(raw_market_values(spark, sf_dir), players)
    best = collapse(values, ["player_id"], {"highest_value": "market_value"})
    return lookups.lookup(best, players, "player_id", "player_id", {"name": "name"}).select(
        "player_id", "name", "highest_value"
    )


def collapse_lines(spark, sf_dir):
    """Line items by part and supplier: largest measures, one repeatable flag."""
    lines = table(spark, sf_dir, "lineitem")
    return collapse(
        lines, ["l_partkey", "l_suppkey"], {"quantity": "l_quantity", "price": "l_extendedprice"},
        {"flag": "l_returnflag"},
    )


def bridged_lines(spark, sf_dir):
    """The largest line per nation and part, through the orders' customers as a link table."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    links = orders.select(F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("customer_key"))
    near = orders.select(F.col("o_orderkey").alias("order_key"), "o_orderpriority")
    far = customers.select(F.col("c_custkey").alias("order_key"), "c_nationkey")
    pairs = lookups.bridge(
        links, "order_key", near, "o_orderpriority", "customer_key", far, "c_nationkey", dim_key="order_key"
    )
    rows = lookups.lookup(lines, pairs, "l_orderkey", "order_key", {"nation": "c_nationkey", "priority": "o_orderpriority"})
    return collapse(rows, ["nation", "priority", "l_partkey"], {"quantity": "l_quantity"})


def role_lookup(spark, sf_dir):
    """Customer and supplier nation of every line: one dimension in two roles."""
    lines = _order_lines(spark, sf_dir).select("l_suppkey", "o_custkey", "l_quantity")
    rows = lookups.lookup(lines, table(spark, sf_dir, "supplier"), "l_suppkey", "s_suppkey", {"from_key": "s_nationkey"})
    rows = lookups.lookup(rows, table(spark, sf_dir, "customer"), "o_custkey", "c_custkey", {"to_key": "c_nationkey"})
    rows = collapse(rows, ["from_key", "to_key"], {"quantity": "l_quantity"})
    roles = {"from_name": "from_key", "to_name": "to_key"}
    rows = lookups.lookup_roles(rows, table(spark, sf_dir, "nation"), roles, "n_nationkey", "n_name")
    return rows.select("from_name", "to_name", "quantity")


def date_table(spark, sf_dir):
    """Every day of orders, shipments and events, with the least priority ordered on it."""
    orders, lines, events = (table(spark, sf_dir, name) for name in ("orders", "lineitem", "events"))
    return date_spine([
        date_feed(orders, [F.to_date("o_orderdate")], F.col("o_orderpriority")),
        date_feed(lines, [F.to_date("l_shipdate")]),
        date_feed(events, [F.to_date("ts")]),
    ])


def season_dates(spark, sf_dir):
    """Season texts from event properties, some of them no year."""
    events = table(spark, sf_dir, "events")
    number = F.regexp_extract("props", r"(\d+)", 1)
    season = (
        F.when(F.col("event_type") == "error", _text("25/", number))
        .when(F.col("event_type") == "click", _text(" ", number.cast("int") + 1990, " "))
        .otherwise(_text(number.cast("int") + 1990))
    )
    rows = events.select("event_id", season.alias("season"))
    rows = rows.select("event_id", dates.season_date(F.col("season")).alias("starts"))
    return lookups.require(rows, "starts").withColumn("date_id", dates.date_key(F.col("starts")))


def load_counts(spark, sf_dir):
    names = [
        "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
        "embeddings", "pages", "benchmark", "labels", "conversations",
    ]
    return table_counts({name: table(spark, sf_dir, name) for name in names})


def audit_keys(spark, sf_dir):
    """Key rules over raw tables, among them ones that do not hold."""
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    checks = [
        audit.primary_key(table(spark, sf_dir, "orders"), "orders", ["o_orderkey"]),
        audit.primary_key(lines, "lineitem", ["l_orderkey", "l_linenumber"]),
        audit.unique(parts, "part", "p_partkey"),
        audit.unique(parts.withColumn("p_name", F.nullif("p_name", F.lit("red plate"))), "part", "p_name"),
        audit.ambiguous_names(table(spark, sf_dir, "supplier"), "supplier", "s_name"),
        audit.ambiguous_names(table(spark, sf_dir, "events"), "events", "event_type"),
    ]
    return _all(checks)


def audit_filled(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.nullif("l_discount", F.lit(0.0)).alias("discount"), F.nullif("l_returnflag", F.lit("R")).alias("flag"),
        F.col("l_quantity").alias("quantity"),
    )
    return audit.not_null(lines, "lineitem", ["discount", "flag", "quantity"])


def audit_references(spark, sf_dir):
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    solvent = customers.select(F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("c_custkey"))
    events, lines = table(spark, sf_dir, "events"), table(spark, sf_dir, "lineitem")
    return _all([
        audit.foreign_key(orders, "orders", "o_custkey", customers, "c_custkey", "customer"),
        audit.foreign_key(orders, "orders", "o_custkey", solvent, "c_custkey", "solvent customer"),
        audit.foreign_key(events, "events", "user_id", solvent, "c_custkey", "solvent customer"),
        audit.foreign_key(lines, "lineitem", "l_orderkey", orders, "o_orderkey", "orders"),
    ])


def _all(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


# --- texts --------------------------------------------------------------------------------


def parse_money(spark, sf_dir):
    orders, key, priority = table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.col("o_orderpriority")
    written = (
        F.when(priority == "1-URGENT", _text("€", key, "k"))
        .when(priority == "2-HIGH", _text("Loan fee: €", key, ",50m"))
        .when(priority == "3-MEDIUM", _text(" $", key, ".25 BN "))
        .when(priority == "5-LOW", _text(key, ".5"))
        .otherwise(F.when(F.col("o_orderstatus") == "F", F.lit("-")).otherwise(_text("€", key, "m extra")))
    )
    return orders.select("o_orderkey", money.parse_money(written).alias("value"))


def parse_date(spark, sf_dir):
    """Order dates in thirteen written forms, a partial one and a missing marker, by key."""
    orders = table(spark, sf_dir, "orders")
    forms = [
        "MMM d, yyyy", "yyyy-MM-dd", "dd/MM/yyyy", "d.M.yyyy", "MMM d yyyy", "d MMM, yyyy", "EEE, d MMM yyyy", "yyyy/MM/dd",
        "dd/MM/yy", "MMMM d, yyyy", "yyyy-MM-dd'T'HH:mm:ss'+02:00'", "yyyy-MM-dd HH:mm:ss", "d'th' MMMM yyyy", "MMM yyyy",
    ]
    written, day = F.lit(" N/A "), F.to_date("o_orderdate").cast("timestamp")
    for number, form in enumerate(forms):
        written = F.when(F.col("o_orderkey") % 15 == number, F.date_format(day, form)).otherwise(written)
    rows = orders.select("o_orderkey", written.alias("text"), dates.parse_date(written).alias("day"))
    return rows.select(
        "o_orderkey", "day", dates.date_key(F.col("day")).alias("date_id"),
        dates.unread(F.col("text"), F.col("day")).alias("unread"),
    )


def parse_numbers(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    dash = F.col("l_returnflag") == "R"
    grouped = F.translate(F.format_number(_floor("l_extendedprice"), 0), ",", ".")
    quantity = F.replace(F.col("l_quantity").cast("string"), F.lit("."), F.lit(","))
    return lines.select(
        "l_orderkey", "l_linenumber",
        numbers.parse_count(F.when(dash, F.lit(" - ")).otherwise(_text(grouped, "'"))).alias("minutes"),
        numbers.parse_decimal(quantity, "double").alias("decimal"),
        numbers.parse_decimal(quantity, "int").alias("whole"),
        numbers.parse_decimal(_text(" ", F.col("l_linenumber")), "int").alias("line"),
        numbers.first_integer(_text("about ", F.col("l_linenumber"), ".5 days")).alias("days"),
    )


def info_box(spark, sf_dir):
    """Label and value lists made from customer columns, read as a player's info box."""
    customers = table(spark, sf_dir, "customer")
    nation = F.col("c_nationkey")
    labels = F.array(*[F.lit(label) for label in (
        "Height:", " \t", "Foot:", "Date of birth/Age:", " Foot:  ", "Citizenship:", "Outfitter:",
    )])
    values = F.array(
        _text("1,", nation + 70, " m"), F.lit("taken by the blank label"), F.lit("right"),
        _text(nation + 1, "/05/", nation + 1970, " (", nation + 20, ")"),
        F.nullif("c_mktsegment", F.lit("BUILDING")), _text("  Nation \n ", nation),
    )
    pairs = extract.info_pairs(F.col("labels"), F.col("values"))
    rows = customers.select("c_custkey", "c_name", "c_nationkey", labels.alias("labels"), values.alias("values"))
    rows = rows.withColumn("info", pairs)

    def value(label: str) -> Column:
        return extract.info_value(F.col("info"), label)

    return rows.select(
        "c_custkey", profile.height_cm(value("Height:")).alias("height_cm"), value("Foot:").alias("foot"),
        profile.birth_date(value("Date of birth/Age:")).alias("dob"),
        profile.birth_age(value("Date of birth/Age:")).alias("age"),
        value("Citizenship:").alias("nationality"), value("Outfitter:").alias("outfitter"),
        text.drop_jersey_number(_text("#", nation, "  ", F.col("c_name"))).alias("name"),
    )


# --- addresses ----------------------------------------------------------------------------


def normalize_url(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", urls.normalize_path(F.col("url")).alias("path"))


def direct_frontier(spark, sf_dir):
    """Links of secure pages as they are, of others as site paths."""
    pages = table(spark, sf_dir, "pages")
    path = urls.normalize_path(F.col("url"))
    parents = pages.select("page_id", F.when(F.col("url").startswith("https:"), F.col("url")).otherwise(path).alias("href"))
    return frontier.direct_frontier(parents, BASE_URL).select("page_id", "url")


def player_frontier(spark, sf_dir):
    """The four leaf pages of every player, and a season's stats page."""
    players = table(spark, sf_dir, "customer").select(
        _player_href(F.col("c_custkey")).alias("href"), (F.col("c_nationkey") + 2000).cast("string").alias("season")
    )
    stats = frontier.stats_frontier(players, BASE_URL)
    # Every fourth link has no number, so there is nothing to ask the API for.
    key = F.regexp_extract("href", r"(\d+)$", 1).cast("bigint")
    unnumbered = F.when(key % 4 == 0, _text("/p/profil/spieler/x", key)).otherwise(F.col("href"))
    asked = players.withColumn("href", unnumbered)
    kinds = {
        "stats": stats,
        "season": stats.withColumn("url", urls.with_season(F.col("url"), F.col("season"))),
        "injuries": frontier.injuries_frontier(players, BASE_URL),
        "transfers": frontier.api_frontier(asked, BASE_URL, "transfers"),
        "market_values": frontier.api_frontier(asked, BASE_URL, "market_values"),
    }
    return _all([df.select(F.lit(kind).alias("kind"), "href", "url") for kind, df in kinds.items()])


def _seeds(spark, sf_dir):
    """One seed per page, its code the page's language."""
    language = F.upper(F.regexp_extract("url", r"//[^/]+/(\w+)/", 1))
    return table(spark, sf_dir, "pages").select("page_id", _text("/startseite/wettbewerb/", language).alias("href"))


def league_filter(spark, sf_dir):
    return frontier.league_seeds(_seeds(spark, sf_dir), "EN").select("page_id", "href")


def league_codes(spark, sf_dir):
    return frontier.league_codes(_seeds(spark, sf_dir))


def club_filter(spark, sf_dir):
    return frontier.club_rows_of(raw_clubs(spark, sf_dir), "/c/startseite/verein/7").select("href", "name")


def page_links(spark, sf_dir):
    return frontier.page_links(table(spark, sf_dir, "pages"), "page_id", "html")


def link_parents(spark, sf_dir):
    """Every link target once, with the first page that has it."""
    links = frontier.page_links(table(spark, sf_dir, "pages"), "page_id", "html")
    found = links.select("page_id", F.col("href").alias("url")).distinct()
    return frontier.one_parent_per_url(found, "page_id").select("url", "page_id")


def page_parent(spark, sf_dir):
    """Parents joined to their fetched pages by address."""
    pages = table(spark, sf_dir, "pages")
    parents = pages.select(F.col("page_id").alias("parent_id"), F.col("url").alias("href"))
    found = frontier.with_pages(frontier.direct_frontier(parents, BASE_URL), pages.select("url", "page_id"))
    return found.select("parent_id", "page_id", "url")


def _dealt(spark, sf_dir, name: str, key: str) -> DataFrame:
    """The rows of a table, dealt over the shuffle partitions by key: each becomes a page of many times
    its size, and a table of a few megabytes would be one task's."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return table(spark, sf_dir, name).repartition(partitions, key)


# --- extraction ---------------------------------------------------------------------------


def competition_rows(spark, sf_dir):
    """Headings of the given pages, read as competition pages."""
    pages = table(spark, sf_dir, "pages").select(F.lit(None).cast("string").alias("href"), "url", "html")
    return extract.competition_rows(with_page_features(pages, "html"))


def competition_pages(spark, sf_dir):
    """A league page per part: the country as text or as a flag, and the season that is selected."""
    parts, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    country = (
        F.when(key % 3 == 0, _text('<div class="data-header__club"><a href="#"> ', F.col("p_brand"), " </a></div>"))
        .when(key % 3 == 1, _text('<img class="data-header__box__flag" alt="Flag ', F.col("p_size"), '">'))
        .otherwise(F.lit(""))
    )
    season = F.when(key % 2 == 0, _text('<option value="', F.col("p_size") + 2000, '" selected>x')).otherwise(F.lit(""))
    body = _text(
        "<h1> ", F.col("p_name"), "</h1>", country, '<select name="saison_id"><option value="1999">y', season, "</select>"
    )
    pages = parts.select(_competition_href(key).alias("href"), F.lit("http://x/").alias("url"), body.alias("body"))
    return extract.competition_rows(with_page_features(pages, "body"))


def _row(*cells) -> Column:
    return _text("<tr>", *[part for cell in cells for part in ("<td>", cell, "</td>")], "</tr>")


def _item_table(*rows: Column) -> Column:
    return _text('<p>intro<table class="responsive items"><tbody>', *rows, "</table>")


def _link(href: Column, shown: Column) -> Column:
    return _text('<td class="hauptlink x"><a href="', href, '">', shown, "</a>")


def club_rows(spark, sf_dir):
    """One competition page per part, with two clubs and a row that is none."""
    parts, key = _dealt(spark, sf_dir, "part", "p_partkey"), F.col("p_partkey")
    body = _item_table(
        _text(
            "<tr><td>", _link(_text("https://site.example/club/", key, "?s=1"), F.col("p_name")),
            "<td>", F.col("p_size"), "<td>", F.col("p_size"), ",5<td>-<td>-<td>&euro;", F.col("p_size"), ".25m",
        ),
        _text("<tr><td>", _link(_text("/second/", key), _text(" R &amp; D ", F.col("p_brand"))), "<td>-"),
        _row("no", "link"),
    )
    pages = parts.select(_competition_href(key).alias("href"), _text("http://x/", key).alias("url"), body.alias("body"))
    return extract.club_rows(with_page_features(pages, "body"))


def squad_links(spark, sf_dir):
    """One squad page per part with three listings of two players; each player once, first club wins."""
    parts, size = _dealt(spark, sf_dir, "part", "p_partkey"), F.col("p_size")
    body = _text(
        _item_table(
            _text("<tr>", _link(_text("https://site.example/a/profil/spieler/", size, "#t"), F.lit("A"))),
            _text("<tr>", _link(_text("/a/profil/spieler/", size), F.lit("A again"))),
        ),
        _item_table(
            _text("<tr>", _link(_text("/b/profil/spieler/", F.col("p_partkey")), F.lit("B"))),
            _text("<tr>", _link(F.lit("/news"), F.lit("news"))),
        ),
    )
    pages = parts.select(_club_href(F.col("p_partkey")).alias("href"), body.alias("body"))
    listed = frontier.profile_frontier(with_page_features(pages, "body"), BASE_URL)
    return frontier.one_parent_per_url(listed, "club_href").select("club_href", "href", "url")


def _info(label: str, *value) -> Column:
    """A line of the info box."""
    return _text(
        '<span class="info-table__content info-table__content--regular">', label, "</span>",
        '<span class="info-table__content info-table__content--bold"><a>', *value, "</a></span>",
    )


def player_rows(spark, sf_dir):
    """One profile page per customer."""
    customers, nation = _dealt(spark, sf_dir, "customer", "c_custkey"), F.col("c_nationkey")
    body = _text(
        "<h1><span>#", nation, "</span> x <strong>", F.col("c_name"), " <b>Jr</b></strong></h1>",
        '<a class="data-header__market-value-wrapper"><span>€</span><span>', nation + 1, ".50</span><span>m</span><p>now</p></a>",
        '<div class="info-table">',
        _info("Date of birth/Age:", nation + 1, "/05/", nation + 1970, " (", nation + 20, ")"),
        _info("Height:", "1,", nation + 70, "&nbsp;m"), _info("Citizenship:", " Nation  ", nation),
        _info("Position:", F.col("c_mktsegment")), _info("Foot:", "right"), _info("Foot:", "left"),
        _info("Joined:", "Jul 1, ", nation + 2000), _info("Contract expires:", "30.06.", nation + 2005), "</div>",
    )
    key = F.col("c_custkey")
    pages = customers.select(
        _player_href(key).alias("href"), _club_href(nation).alias("club_href"), F.lit("http://x/").alias("url"),
        body.alias("body"),
    )
    return extract.player_rows(with_page_features(pages, "body")).drop("type")


def _stats_pages(spark, sf_dir) -> DataFrame:
    """One stats page per order: a season choice and a table of two competitions."""
    orders, key = _dealt(spark, sf_dir, "orders", "o_orderkey"), F.col("o_orderkey")
    year = F.year("o_orderdate")
    body = _text(
        '<select name="saison"><option value="">all<option value="', year, '" selected>x<option value="', year - 1,
        '">y<option value="', year - 2, '">z</select>',
        _item_table(
            _row("", _text("<a>League</a> ", F.col("o_orderstatus")), key, "-", "7", "1", "-", "-", _text("1.", year, "'")),
            _row("", F.col("o_orderpriority"), "3", key, "-", "-", "4", "2", "199'"),
            _row("", " ", "3", "3", "3", "3", "3", "3", "3"), _row("too", "short"),
        ),
    )
    pages = orders.select(_player_href(key).alias("href"), F.lit("http://x/").alias("url"), body.alias("body"))
    return with_page_features(pages, "body")


def appearance_rows(spark, sf_dir):
    pages = _stats_pages(spark, sf_dir).withColumn("season", F.lit(None).cast("string"))
    return extract.appearance_rows(pages).drop("type")


def season_pages(spark, sf_dir):
    """Every season of every stats page; every third link has a parameter already."""
    key = F.regexp_extract("href", r"(\d+)$", 1).cast("bigint")
    tab = F.when(key % 3 == 0, F.lit("?tab=1")).otherwise(F.lit(""))
    pages = _stats_pages(spark, sf_dir).withColumn("href", F.concat("href", tab))
    return frontier.season_frontier(pages, BASE_URL).select("href", "season", "url")


def injury_rows(spark, sf_dir):
    """One injuries page per order."""
    orders, key = _dealt(spark, sf_dir, "orders", "o_orderkey"), F.col("o_orderkey")
    day = F.date_format(F.to_date("o_orderdate"), "MMM d, yyyy")
    body = _item_table(
        _row("25/26", F.col("o_orderpriority"), day, "-", _text(key, " days"), "1"),
        _row("", "", "-", day, "?", "-"), _row("short"),
    )
    pages = orders.select(_player_href(key).alias("href"), F.lit("http://x/").alias("url"), body.alias("body"))
    return extract.injury_rows(with_page_features(pages, "body")).drop("type")


def transfer_rows(spark, sf_dir):
    """One payload per order with three transfers and an element that is none; cancelled-like orders have a broken
    payload. In the third transfer one field is of another type than it should be, by key."""
    orders, key, day = _dealt(spark, sf_dir, "orders", "o_orderkey"), F.col("o_orderkey"), F.to_date("o_orderdate")
    texts = {"season": '"22/23"', "marketValue": '"€1.00m"', "fee": '"-"', "date": '"02/01/2020"'}
    whole = [f'"{name}": {text}' for name, text in texts.items()] + ['"to": {"clubName": "To"}', '"from": {"clubName": "From"}']
    odd = ['"season": {"id": 22}', '"marketValue": [1]', '"fee": {}', '"date": false', '"to": "To"', '"from": {"clubName": ["From"]}']
    mixed = F.lit(None).cast("string")
    for at in range(len(odd)):
        fields = ", ".join(odd[at] if at == other else field for other, field in enumerate(whole))
        mixed = F.when(key % len(odd) == at, fields).otherwise(mixed)
    whole = _text(
        '{"transfers": [{"from": {"clubName": "Club ', key, '"}, "to": null, "date": "x", "dateUnformatted": "',
        F.date_format(day, "yyyy-MM-dd"), '", "season": "22/23", "marketValue": "€', key, '.50m", "fee": "-"}, ',
        '{"to": {"clubName": "', F.col("o_orderpriority"), '"}, "dateUnformatted": "", "date": "',
        F.date_format(day, "dd/MM/yyyy"), '", "fee": "€', key, 'k"}, "none", {', mixed, "}]}",
    )
    body = F.when(F.col("o_orderstatus") == "P", F.lit("<html>")).otherwise(whole)
    return extract.transfer_rows(orders.select(_player_href(key).alias("href"), body.alias("body"))).drop("type")


def market_value_rows(spark, sf_dir):
    """One payload per event with a value history of three entries; errors have a broken payload.
    In the third entry one field is of another type than it should be, by key."""
    events = _dealt(spark, sf_dir, "events", "event_id").select("event_id", "user_id", "event_type", "ts")
    key = F.col("event_id")
    odd = F.element_at(F.array(*[F.lit(entry) for entry in (
        '{"datum_mw": 20200102, "y": 5, "verein": "Club"}',
        '{"datum_mw": "02/01/2020", "y": "much", "verein": "Club"}',
        '{"datum_mw": "02/01/2020", "y": 5, "verein": {"id": 5}}',
    )]), (F.pmod(key, F.lit(3)) + 1).cast("int"))
    whole = _text(
        '{"list": [{"x": 1, "datum_mw": "', F.date_format(F.to_date("ts"), "dd/MM/yyyy"), '", "y": ', key,
        ', "verein": "', F.col("event_type"), '"}, {"datum_mw": "-", "y": null}, ', odd, "]}",
    )
    body = F.when(F.col("event_type") == "error", F.lit('{"list": [')).otherwise(whole)
    href = _player_href(F.col("user_id"))
    return extract.market_value_rows(events.select(href.alias("href"), body.alias("body"))).drop("type")


def _site(spark, sf_dir) -> DataFrame:
    """A site of pages: a competition and a club per part, five pages and payloads per customer."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    part, size, customer, nation = (F.col(c) for c in ("p_partkey", "p_size", "c_custkey", "c_nationkey"))

    def page(rows: DataFrame, path: Column, body: Column) -> DataFrame:
        return rows.select(_text(BASE_URL.rstrip("/"), path).alias("url"), body.alias("body"))

    def stats(competition: str, season: int, other: int) -> Column:
        return _text(
            f'<select name="saison"><option value="{season}" selected>a<option value="{other}">b</select>',
            _item_table(_row("", competition, nation, "1", "-", "-", "-", "-", "90")),
        )

    stats_path = _text("/p/leistungsdaten/spieler/", customer)
    profile = page(customers, _player_href(customer), _text(
        "<h1><b>", F.col("c_name"), '</b></h1><div class="info-table">', _info("Joined:", "Jul 1, ", nation + 2000),
        _info("Contract expires:", "30.06.", nation + 2005), "</div>",
    ))
    later = F.lit("2025-06-02").cast("timestamp")
    site = _all([
        page(parts, _competition_href(part), _text(
            "<h1>", F.col("p_name"), "</h1>",
            _item_table(_text("<tr><td>", _link(_club_href(part), _text("Club ", part)))),
        )),
        page(parts, _club_href(part), _item_table(
            _text("<tr>", _link(_player_href(part), F.lit("own"))),
            _text("<tr>", _link(_player_href(size), F.lit("shared"))),
        )),
        profile,
        profile,  # fetched twice
        page(customers, stats_path, stats("League", 2025, 2024)),
        page(customers, _text(stats_path, "?saison=2024"), stats("Cup", 2024, 2025)),
        page(customers, _text("/p/verletzungen/spieler/", customer), _item_table(
            _row("25/26", "Knock", _text(nation + 1, "/05/2025"), _text(nation + 1, "/06/2025"), "4 days", "1"),
        )),
        page(customers, _text("/ceapi/transferHistory/list/", customer), _text(
            '{"transfers": [{"from": {"clubName": "Club ', nation + 1, '"}, "to": {"clubName": "Club ', nation,
            '"}, "date": "01/07/2020", "fee": "€', customer, 'k"}]}',
        )),
        page(customers, _text("/ceapi/marketValueDevelopment/graph/", customer), _text(
            '{"list": [{"datum_mw": "01/07/2020", "y": ', customer, "}]}",
        )),
    ]).withColumn("fetched", later)
    # Each club's page was fetched before, when it listed nobody.
    older = page(parts, _club_href(part), F.lit("<h1>soon</h1>")).withColumn("fetched", later - F.expr("interval 1 day"))
    return site.unionByName(older)


def crawl(spark, sf_dir):
    """A whole site from its seeds to all entities: every row's parent and what it says."""
    seeds = table(spark, sf_dir, "part").select(_competition_href(F.col("p_partkey")).alias("href"))
    entities = extract_entities(_site(spark, sf_dir), seeds, BASE_URL)
    shown = {
        "competitions": ("href", F.col("name")),
        "clubs": ("competition_href", F.col("href")),
        "players": ("club_href", _text(F.col("href"), " ", F.col("name"))),
        "appearances": ("player_href", _text(F.col("competition"), " ", F.col("season"), " ", F.col("appearances"))),
        "injuries": ("player_href", F.col("from")),
        "transfers": ("player_href", _text(F.col("to_club"), " ", F.col("date"))),
        "market_values": ("player_href", _text(F.col("date"), " ", F.col("market_value"))),
    }
    return _all([
        entities[name].select(F.lit(name).alias("entity"), F.col(parent).alias("parent"), said.alias("said"))
        for name, (parent, said) in shown.items()
    ])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        dim_competition, dim_club, dim_player, stub_competitions, stub_clubs, dim_date, fact_stats,
        fact_injury, fact_transfer, fact_market_value, fact_contract, star_counts, star_audit,
        published_star, published_rows, loaded_files, crawled_star, unread_dates, entity_files, seed_rows, parent_lines, missing_sources, dense_key, left_lookup, salted_lookup, first_per_key, latest_per_key, stub_members, daily_value,
        highest_value, collapse_lines, bridged_lines, role_lookup, date_table, season_dates, load_counts,
        audit_keys, audit_filled, audit_references, parse_money, parse_date, parse_numbers, info_box,
        normalize_url, direct_frontier, player_frontier, league_filter, league_codes, club_filter,
        page_links, link_parents, page_parent, competition_rows, competition_pages, club_rows, squad_links, player_rows,
        appearance_rows, season_pages, injury_rows, transfer_rows, market_value_rows, crawl,
    )
}
