"""Fetched pages to the seven raw entities, hop by hop from the seeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import fixed
from touchline.operators import extract, frontier
from touchline.plans.load import LoadReport, load
from touchline.sources.entities import default_seeds
from touchline.sources.pages import with_page_features
from touchline.sources.scratch import materialize, scratch_job

_PAYLOADS = "/ceapi/"
_KINDS = {
    path: path.split("/")[1]
    for path in (fixed.LEAGUE_PATH, fixed.CLUB_PATH, fixed.PROFILE_PATH, fixed.STATS_PATH, fixed.INJURIES_PATH)
}
# The features that each hop reads.
_HEADING = ("h1_first", "country_text", "country_alt", "competition_season")
_TABLES = ("tables",)
_PROFILE = ("h1_all", "info_labels", "info_values", "value_parts")
_STATS = ("tables", "stats_season", "season_options")


class UnknownSelection(LookupError):
    """The league or club asked for is not in its table."""


def select_league(seeds: DataFrame, code: str) -> DataFrame:
    """The seeds of one league; raises, naming the choices, if there is none."""
    chosen = frontier.league_seeds(seeds, code)
    if chosen.isEmpty():
        codes = frontier.league_codes(seeds).orderBy("code").collect()  # of the seeds that were typed in
        listed = ", ".join(row.code for row in codes)
        raise UnknownSelection(f"league {code!r} is not among the seeds; choices: {listed}")
    return chosen


def select_club(clubs: DataFrame, href: str) -> DataFrame:
    """One club of the league; raises if there is none."""
    chosen = frontier.club_rows_of(clubs, href)
    if chosen.isEmpty():
        raise UnknownSelection(f"club {href!r} is not among the clubs of the league")
    return chosen


def _kind(url: Column) -> Column:
    """The known paths that an address holds, as one name: `page`, `page-profil`, ..."""
    names = [F.when(F.contains(url, F.lit(path)), F.lit(name)) for path, name in _KINDS.items()]
    return F.concat_ws("-", F.lit("page"), *names)


class _Site:
    """The fetched pages, ready to be joined to the addresses of a hop.

    Each address has one page, the one fetched last. For a whole crawl every HTML page is parsed
    once and stored by kind, so that a hop reads its own kind and features, not everything. For a
    selection, few pages are wanted: a hop writes its addresses, sends a Bloom filter of them to the
    pages, joins what passes and parses what it found.
    """

    def __init__(self, pages: DataFrame, whole: bool):
        pages = frontier.one_page_per_url(pages)
        is_payload = F.contains("url", F.lit(_PAYLOADS))
        self.payloads = pages.where(is_payload).select("url", "body")
        self.html = pages.where(~is_payload).select("url", "body", _kind(F.col("url")).alias("kind"))
        self.whole = whole
        if whole:
            self.html = materialize(with_page_features(self.html, "body"), "features", "kind")

    def pages_of(self, addresses: DataFrame, path: str, features: tuple[str, ...]) -> DataFrame:
        """The parsed pages of a hop, each with its parent's columns.

        If every address holds `path`, other kinds of pages are left unread.
        """
        html = self.html
        if sure_path(addresses, path):
            html = html.where(F.col("kind").contains(_KINDS[path]))
        wanted = [F.col(f"features.{name}") for name in features]
        if self.whole:  # only these columns of the stored pages are read
            html = html.select("url", F.struct(*wanted).alias("features"))
            return frontier.with_pages(addresses, html)
        addresses, html = frontier.wanted_pages(addresses, html.drop("kind"))
        parsed = with_page_features(frontier.with_pages(addresses, html), "body")
        return parsed.withColumn("features", F.struct(*wanted))

    def payloads_of(self, addresses: DataFrame, entity: str) -> DataFrame:
        """The payloads of an entity, whose addresses all hold its path; other entities' are not moved."""
        payloads = self.payloads.where(F.contains("url", F.lit(fixed.API_PATHS[entity])))
        if not self.whole:
            addresses, payloads = frontier.wanted_pages(addresses, payloads)
        return frontier.with_pages(addresses, payloads)


def sure_path(addresses: DataFrame, path: str) -> bool:
    """Whether all addresses hold the path, so that other kinds of pages can be left unread."""
    return addresses.where(~F.contains("url", F.lit(path))).isEmpty()


def extract_entities(
    pages: DataFrame, seeds: DataFrame | None, base_url: str, league: str | None = None,
    club: str | None = None,
) -> dict[str, DataFrame]:
    """All seven entities from `pages(url, body)`, optionally with `fetched`, and `seeds(href)`.

    competitions -> clubs -> players -> appearances, injuries, transfers, market values; each
    hop joins the addresses of its parents to the pages. Without seeds the built-in ones are used.
    The parents of later hops are written, so a hop does not repeat those before it.
    """
    if club and not league:
        raise ValueError("a club can only be chosen together with its league")
    if seeds is None:
        seeds = default_seeds(pages.sparkSession)
    if league:
        seeds = select_league(seeds, league)
    site = _Site(pages, whole=not league)

    def linked(parents: DataFrame) -> DataFrame:
        return frontier.direct_frontier(parents.select("href").distinct(), base_url)

    leagues = site.pages_of(linked(seeds), fixed.LEAGUE_PATH, _HEADING)
    competitions = materialize(extract.competition_rows(leagues), "competitions")
    leagues = site.pages_of(linked(competitions), fixed.LEAGUE_PATH, _TABLES)
    clubs = materialize(extract.club_rows(leagues), "clubs")
    if club:
        clubs = select_club(clubs, club)

    squads = site.pages_of(linked(clubs), fixed.CLUB_PATH, _TABLES)
    profiles = frontier.one_parent_per_url(frontier.profile_frontier(squads, base_url), "club_href")
    profiles = materialize(profiles, "profiles")
    found = site.pages_of(profiles, fixed.PROFILE_PATH, _PROFILE)
    players = materialize(extract.player_rows(found), "players")

    listed = players.select("href")
    shown = site.pages_of(frontier.stats_frontier(listed, base_url), fixed.STATS_PATH, _STATS)
    others = site.pages_of(frontier.season_frontier(shown, base_url), fixed.STATS_PATH, _STATS)
    stats = shown.withColumn("season", F.lit(None).cast("string")).unionByName(others)
    injuries = site.pages_of(frontier.injuries_frontier(listed, base_url), fixed.INJURIES_PATH, _TABLES)

    def api(entity: str) -> DataFrame:
        return site.payloads_of(frontier.api_frontier(listed, base_url, entity), entity)

    return {
        "competitions": competitions,
        "clubs": clubs,
        "players": players,
        "appearances": extract.appearance_rows(stats),
        "injuries": extract.injury_rows(injuries),
        "transfers": extract.transfer_rows(api("transfers")),
        "market_values": extract.market_value_rows(api("market_values")),
    }


def run(
    spark: SparkSession, pages: DataFrame, seeds: DataFrame | None, base_url: str, out: str,
    league: str | None = None, club: str | None = None, strict: bool = True,
) -> LoadReport:
    """From fetched pages to the published star; returns the load report."""
    with scratch_job(spark):
        return load(spark, extract_entities(pages, seeds, base_url, league, club), out, strict)
