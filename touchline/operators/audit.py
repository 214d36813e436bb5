"""Constraint audits. Each yields rows (table_name, rule, n_violations)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions.dates import cast_date, unread
from touchline.operators.lookups import sized
from touchline.sources.scratch import rows_of


def _finding(df: DataFrame, table: str, rule: str, violations) -> DataFrame:
    return df.agg(violations.cast("bigint").alias("n_violations")).select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "n_violations"
    )


def repeated_keys(df: DataFrame, table: str, keys: list[str], rule: str) -> DataFrame:
    """How many key values occur more than once. NULL keys are exempt."""
    counts = df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return _finding(counts, table, rule, F.count_if(F.col("n") > 1))


def primary_key(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    return repeated_keys(df, table, keys, f"primary key ({', '.join(keys)})")


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    return repeated_keys(df, table, [column], f"unique {column}")


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Rows with a NULL, per column, in one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    per_column = counts.select(
        F.explode(
            F.array(
                *[F.struct(F.lit(f"not null {name}").alias("rule"), F.col(name).alias("n")) for name in columns]
            )
        ).alias("finding")
    )
    return per_column.select(
        F.lit(table).alias("table_name"), F.col("finding.rule").alias("rule"),
        F.col("finding.n").alias("n_violations"),
    )


def foreign_key(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_key: str, parent_table: str
) -> DataFrame:
    """Child rows whose key the parent does not hold; NULL keys are exempt.

    Keys are counted first, so a hot key reaches the join as one row.
    """
    counts = child.dropna(subset=[column]).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_key).alias("_known"))
    orphans = counts.join(sized(known, rows_of(parent)), counts[column] == known["_known"], "left_anti")
    rule = f"foreign key {column} -> {parent_table}"
    return _finding(orphans, table, rule, F.coalesce(F.sum("n"), F.lit(0)))


def ambiguous_names(dim: DataFrame, table: str, column: str) -> DataFrame:
    """Names held by more than one row; facts joined by such a name fan out. A report, not a rule."""
    return repeated_keys(dim, table, [column], f"ambiguous {column}")


def _key_rules(star: dict[str, DataFrame]) -> list[tuple[str, str, list[str]]]:
    """(table, rule, key columns) of all primary and unique keys."""
    rules = []
    for table in star:
        columns = schemas.PRIMARY_KEYS[table]
        rules.append((table, f"primary key ({', '.join(columns)})", columns))
        rules += [(table, f"unique {column}", [column]) for column in schemas.UNIQUE_COLUMNS.get(table, [])]
    return rules


def _all_keys(star: dict[str, DataFrame]) -> DataFrame:
    """Repeated keys of every table, each counted in its own types, all in one job."""
    return reduce(
        DataFrame.unionByName,
        [repeated_keys(star[table], table, columns, rule) for table, rule, columns in _key_rules(star)],
    )


def _all_references(star: dict[str, DataFrame]) -> DataFrame:
    """Orphans of every foreign key: one scan of each column, one shuffle by (rule, id) and one join in all.

    Rules, parents and ids are numbers, and each (rule, id) is counted once, so a hot id reaches the join as one row.
    """
    rules = [
        (table, column, parent) for table, references in schemas.FOREIGN_KEYS.items()
        for column, (parent, _) in references.items()
    ]
    parents = sorted({target for references in schemas.FOREIGN_KEYS.values() for target in references.values()})
    places = {parent: place for place, (parent, _) in enumerate(parents)}
    wanted = [
        star[table].select(
            F.lit(number).alias("rule"), F.lit(places[parent]).alias("parent"), F.col(column).cast("bigint").alias("id")
        ).dropna(subset=["id"])
        for number, (table, column, parent) in enumerate(rules)
    ]
    held = [
        star[parent].select(F.lit(places[parent]).alias("parent"), F.col(key).cast("bigint").alias("id"))
        for parent, key in parents
    ]
    counts = reduce(DataFrame.unionByName, wanted).groupBy("rule", "parent", "id").agg(F.count(F.lit(1)).alias("n"))
    known = sized(reduce(DataFrame.unionByName, held), sum(rows_of(star[parent]) for parent, _ in parents))
    orphans = counts.join(known, ["parent", "id"], "left_anti")
    sums = orphans.agg(*[
        F.coalesce(F.sum(F.when(F.col("rule") == number, F.col("n"))), F.lit(0)).cast("bigint").alias(f"n{number}")
        for number in range(len(rules))
    ])
    listed = [
        F.struct(F.lit(table).alias("table_name"), F.lit(f"foreign key {column} -> {parent}").alias("rule"),
                 F.col(f"n{number}").alias("n_violations"))
        for number, (table, column, parent) in enumerate(rules)
    ]
    return sums.select(F.inline(F.array(*listed)))


def audit_star(star: dict[str, DataFrame], nulls: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """Every rule of the star, one row each.

    Keys are counted table by table in their own types; all references share one aggregation and
    one join. Everything is one job, whatever the number of rules. NULLs that were counted while the
    tables were written, `nulls` = {table: {column: n}}, are not counted again.
    """
    if nulls is None:
        filled = [not_null(star[table], table, columns) for table, columns in schemas.REQUIRED_COLUMNS.items()]
    else:
        found = [
            (table, f"not null {column}", nulls[table][column])
            for table, columns in schemas.REQUIRED_COLUMNS.items() for column in columns
        ]
        spark = next(iter(star.values())).sparkSession
        filled = [spark.createDataFrame(found, "table_name string, rule string, n_violations bigint")]
    return reduce(DataFrame.unionByName, [_all_keys(star), _all_references(star), *filled])


def audit_sources(raw: dict[str, DataFrame]) -> DataFrame:
    """Links that must be unique in the raw tables, because their dimensions are not de-duplicated."""
    clubs = raw["clubs"].dropna(subset=["name"])
    return unique(raw["competitions"], "competitions", "href").unionByName(unique(clubs, "clubs", "href"))


def audit_names(star: dict[str, DataFrame]) -> DataFrame:
    """Repeated names in the dimensions that facts join by name."""
    return reduce(
        DataFrame.unionByName,
        [ambiguous_names(star[table], table, column) for table, column in schemas.JOINED_NAMES.items()],
    )


def unread_dates(raw: dict[str, DataFrame]) -> DataFrame:
    """Date texts of the raw tables that say something but are no date. A report, not a rule."""
    found = []
    for table, columns in schemas.DATE_TEXTS.items():
        counts = raw[table].agg(
            *[F.count_if(unread(F.col(f"`{name}`"), cast_date(F.col(f"`{name}`")))).alias(name) for name in columns]
        )
        listed = [
            F.struct(F.lit(table).alias("table_name"), F.lit(f"unread date {name}").alias("rule"),
                     F.col(f"`{name}`").alias("n_violations"))
            for name in columns
        ]
        found.append(counts.select(F.inline(F.array(*listed))))
    return reduce(DataFrame.unionByName, found)


def malformed_lines(bad: dict[str, DataFrame]) -> DataFrame:
    """Lines that are no JSON, by entity. A report, not a rule."""
    return reduce(
        DataFrame.unionByName,
        [_finding(lines, table, "malformed lines", F.count(F.lit(1))) for table, lines in bad.items()],
    )
