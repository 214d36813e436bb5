"""Which page belongs to which parent row: address tables, and the join to fetched pages.

A frontier is a table of parent columns plus `url`. Fetching is not part of the engine;
`pages(url, body)` holds what was fetched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline import fixed
from touchline.functions import urls
from touchline.operators.bloom import BloomFilter
from touchline.operators.keys import first_per_key
from touchline.sources.scratch import materialize, watched


def _linked(parents: DataFrame) -> DataFrame:
    return parents.where(F.col("href") != "")


def direct_frontier(parents: DataFrame, base_url: str) -> DataFrame:
    """The page each parent links to; parents without a link are dropped."""
    return _linked(parents).withColumn("url", urls.page_url(F.col("href"), base_url))


def stats_frontier(players: DataFrame, base_url: str) -> DataFrame:
    """The stats page of each player."""
    url = urls.player_page_url(F.col("href"), base_url, fixed.STATS_PATH)
    return _linked(players).withColumn("url", url)


def injuries_frontier(players: DataFrame, base_url: str) -> DataFrame:
    """The injuries page of each player."""
    url = urls.player_page_url(F.col("href"), base_url, fixed.INJURIES_PATH)
    return _linked(players).withColumn("url", url)


def api_frontier(players: DataFrame, base_url: str, entity: str) -> DataFrame:
    """The payload address of each player whose link holds a player number."""
    return players.withColumn("url", urls.api_url(F.col("href"), base_url, entity)).dropna(subset=["url"])


def season_frontier(stats_pages: DataFrame, base_url: str) -> DataFrame:
    """One further stats page per season offered on a player's stats page, the shown one excluded.

    Input: `href` and the page's `features`. Adds `season` and `url`.
    """
    shown = F.col("features.stats_season")
    others = F.filter(
        "features.season_options", lambda season: (season != "") & ~season.eqNullSafe(shown)
    )
    pages = _linked(stats_pages).select("href", F.explode(others).alias("season"))
    base = urls.player_page_url(F.col("href"), base_url, fixed.STATS_PATH)
    return pages.withColumn("url", urls.with_season(base, F.col("season")))


def profile_frontier(squad_pages: DataFrame, base_url: str) -> DataFrame:
    """One profile page per player listed on a squad page, each once per page.

    Input: the club's `href` and the page's `features`. Output: `club_href`, `href`, `url`.
    Repeats on a page are dropped inside its row, so nothing is shuffled.
    """
    links = F.flatten(
        F.transform(
            "features.tables",
            lambda table: F.transform(table["rows"], lambda row: row["any_href"]),
        )
    )
    profiles = F.filter(links, lambda href: F.contains(href, F.lit(fixed.PROFILE_PATH)))
    paths = F.array_distinct(F.transform(profiles, urls.normalize_path))
    players = squad_pages.select(F.col("href").alias("club_href"), F.explode(paths).alias("href"))
    return players.withColumn("url", F.concat(F.lit(base_url.rstrip("/")), F.col("href")))


def one_parent_per_url(frontier: DataFrame, parent: str) -> DataFrame:
    """Each address once, with its first parent in the order of the `parent` column."""
    rest = [F.col(name).asc_nulls_last() for name in frontier.columns if name not in ("url", parent)]
    return first_per_key(frontier, ["url"], [F.col(parent).asc_nulls_last(), *rest])


def page_links(pages: DataFrame, id_col: str, html: str) -> DataFrame:
    """Every link of a page in document order: (id_col, position from 0, href)."""
    hrefs = F.regexp_extract_all(html, F.lit(r'<a\s[^>]*?href="([^"]*)"'), F.lit(1))
    return pages.select(id_col, F.posexplode(hrefs).alias("position", "href"))


def one_page_per_url(pages: DataFrame) -> DataFrame:
    """Each address with one page: the one fetched last (where `pages` has the column `fetched`), then
    the least body.

    Only the addresses are counted; a Bloom filter of those that occur twice or more is sent to the pages,
    however many they are. What it rules out stays where it is; the rest, repeated pages and fewer than one
    in 200 of the others, moves by address, one page per address and task.
    """
    counted = pages.groupBy("url").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("url")
    repeated = materialize(counted, "repeated-urls", watch={"found": F.count(F.lit(1))})
    found = watched(repeated)["found"]
    if not found:
        return pages
    order = [F.col("body").asc_nulls_last()]
    if "fetched" in pages.columns:
        order.insert(0, F.col("fetched").desc_nulls_last())
    marked = BloomFilter(repeated, "url", found).mark(pages, "url", "_repeated")
    alone, same = marked.where("not _repeated").drop("_repeated"), marked.where("_repeated").drop("_repeated")
    return alone.unionByName(first_per_key(same, ["url"], order))


def wanted_pages(addresses: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The addresses, written, and the pages that a Bloom filter of them lets pass: pages that nobody asks for are
    not moved by the join that follows, whichever way it goes."""
    written = materialize(addresses, "addresses", watch={"found": F.count(F.lit(1))})
    held = BloomFilter(written, "url", watched(written)["found"])
    return written, held.mark(pages, "url", "_wanted").where("_wanted").drop("_wanted")


def with_pages(frontier: DataFrame, pages: DataFrame) -> DataFrame:
    """Parents joined to their fetched pages; an address that was not fetched is dropped.

    Both sides are sorted and merged. Spark would go by the size of their files, and those are packed: pages that
    take 10 MB there are hundreds of MB on the driver once they are broadcast.
    """
    return frontier.join(pages.hint("merge"), "url")


def league_seeds(seeds: DataFrame, code: str) -> DataFrame:
    """The seeds whose link ends in the league code."""
    return seeds.where(F.col("href").endswith(fixed.LEAGUE_PATH + code))


def league_codes(seeds: DataFrame) -> DataFrame:
    """The league codes that seeds offer, each once."""
    codes = seeds.select(urls.league_code(F.col("href")).alias("code"))
    return codes.dropna().distinct()


def club_rows_of(clubs: DataFrame, href: str) -> DataFrame:
    """The club with exactly this link."""
    return clubs.where(F.col("href") == href)
