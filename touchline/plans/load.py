"""The load: raw entities to a complete, audited, published star."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from touchline import schemas
from touchline.operators.audit import audit_names, audit_sources, audit_star, malformed_lines, unread_dates
from touchline.plans import dims, facts
from touchline.plans.jobs import together
from touchline.sources.entities import read_entities, read_good_lines
from touchline.sources.scratch import is_written, materialize, scratch_job
from touchline.sources.star import StarWriter


class ConstraintError(ValueError):
    """The star breaks a rule; the previous one stays published."""


def build_star(raw: dict[str, DataFrame], keep: Callable[[str, DataFrame], DataFrame]) -> dict[str, DataFrame]:
    """All nine tables. `keep(name, df)` stores a finished table and returns it as read back,
    so that keys are computed once, whatever reads them later."""

    spark = raw["players"].sparkSession

    def competitions_and_clubs() -> list[DataFrame]:
        seeded = dims.dim_competition(raw["competitions"])

        def competitions() -> DataFrame:
            stubs = dims.stub_competitions(raw["appearances"], seeded)
            return keep("dim_competition", seeded.unionByName(stubs))

        def clubs() -> DataFrame:
            listed = dims.dim_club(raw["clubs"], seeded)
            return keep("dim_club", listed.unionByName(dims.stub_clubs(raw["transfers"], listed)))

        return together(spark, competitions, clubs)

    def players() -> DataFrame:
        return keep("dim_player", dims.dim_player(raw["players"]))

    def dates() -> DataFrame:
        feeds = ("appearances", "injuries", "transfers", "market_values", "players")
        return keep("dim_date", dims.dim_date(*[raw[name] for name in feeds]))

    (competition, club), player, date = together(spark, competitions_and_clubs, players, dates)
    star = {"dim_competition": competition, "dim_club": club, "dim_player": player, "dim_date": date}
    builders = {
        "fact_stats": lambda: facts.fact_stats(raw["appearances"], raw["players"], player, club, competition),
        "fact_injury": lambda: facts.fact_injury(raw["injuries"], player),
        "fact_transfer": lambda: facts.fact_transfer(raw["transfers"], player, club),
        "fact_market_value": lambda: facts.fact_market_value(raw["market_values"], player),
        "fact_contract": lambda: facts.fact_contract(raw["players"], player, club),
    }

    def store(name: str) -> Callable[[], DataFrame]:
        return lambda: keep(name, builders[name]())

    star.update(zip(builders, together(spark, *[store(name) for name in builders])))
    return star


def land(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Write the entities as Parquet, where that is not done yet: JSON is parsed once, and each later
    step scans only the columns it needs."""
    spark = next(iter(raw.values())).sparkSession
    writes = [(lambda df=df: df) if is_written(df) else partial(materialize, df, name) for name, df in raw.items()]
    return dict(zip(raw, together(spark, *writes)))


class LoadReport(dict):
    """Table -> row count in load order, and in `notes` what did not stop the load but should be known:
    (table_name, rule) -> number of malformed lines, unread dates and ambiguous names."""

    notes: dict[tuple[str, str], int]


def load(
    spark: SparkSession, sources: str | dict[str, DataFrame], out: str, strict: bool = True,
    bad_lines: str = "raise",
) -> LoadReport:
    """Build the star from a folder of entity files (or from DataFrames) and publish it in `out`.

    `strict` raises ConstraintError on the first broken rule and leaves the star published before
    untouched. Lines that are no JSON end the load, or with `bad_lines="skip"` are left out and counted.
    """
    writer = StarWriter(spark, out)
    with scratch_job(spark):
        try:
            bad: dict[str, DataFrame] = {}
            if not isinstance(sources, str):
                raw = sources
            elif bad_lines == "skip":
                raw, bad = read_good_lines(spark, sources)
            else:
                raw = read_entities(spark, sources)
            raw = land({name: raw[name] for name in schemas.ENTITIES})
            star = build_star(raw, writer.write)
            if strict:
                _raise_if_broken(raw, star, writer.nulls)
            notes = unread_dates(raw).unionByName(audit_names(star))
            if bad:
                notes = notes.unionByName(malformed_lines(bad))
            noted = notes.where("n_violations > 0").collect()  # one row per rule
        except BaseException:
            writer.discard()
            raise
    writer.publish()
    report = LoadReport((name, writer.rows[name]) for name in star)
    report.notes = {(row.table_name, row.rule): row.n_violations for row in noted}
    return report


def _raise_if_broken(raw: dict[str, DataFrame], star: dict[str, DataFrame], nulls: dict[str, dict[str, int]]) -> None:
    findings = audit_sources(raw).unionByName(audit_star(star, nulls)).where("n_violations > 0")
    broken = [f"{row.table_name}: {row.rule} ({row.n_violations})" for row in findings.collect()]
    if broken:  # one row per rule
        raise ConstraintError("; ".join(sorted(broken)))
