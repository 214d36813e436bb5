"""Aggregations: repeated rows to one row per grain, dates to a date table, table counts."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.dates import date_key
from touchline.operators.keys import dense_key
from touchline.operators.lookups import sized, sketched, with_hot_keys
from touchline.sources.scratch import materialize, rows_of


def collapse(
    df: DataFrame, keys: list[str], largest: dict[str, str], pick: dict[str, str] | None = None
) -> DataFrame:
    """One row per `keys`: the maximum of each measure and one repeatable value of each label.

    `largest` and `pick` map new names to columns of df. A measure without any value stays
    NULL. `pick` takes the least value, one legal choice where any is allowed. Spark can take the
    minimum of a text only by sorting all rows, so they are collapsed with their labels as further keys
    first, in one pass; labels are then numbered in their order from that written remainder, and a second
    aggregation takes the least number. Both hold keys and numbers alone, in hash tables on both sides of
    the shuffle.
    """
    rows = _by_labels(df, keys, largest, pick or {})
    return _least_labels(materialize(rows, "collapsed"), keys, largest, pick) if pick else rows


def collapse_with_hot_keys(
    df: DataFrame, keys: list[str], largest: dict[str, str], columns: list[str], pick: dict[str, str] | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """`collapse`, and the hot values of some key columns (see `lookups.with_hot_keys`): the collapsed rows
    are written once, and sketched by the tasks that write them."""
    rows, hot = with_hot_keys(_by_labels(df, keys, largest, pick or {}), "collapsed", *columns)
    return (_least_labels(rows, keys, largest, pick) if pick else rows), hot


def collapse_near(
    df: DataFrame, keys: list[str], largest: dict[str, str], near: str, others: list[str] | None = None,
    pick: dict[str, str] | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """`collapse` of rows that are joined by `near`, one of the keys, next; and the hot values of the columns by
    which they are joined then and later.

    The rows are dealt by `near` alone, once: collapsing and the next join find them where they are, and nothing
    is written in between. Labels are numbered from the column of labels and become numbers before the rows move.
    Where a value of `near` outgrows a partition, the rows are collapsed before they are dealt, as in
    `collapse_with_hot_keys`, which combines repeats map-side and spreads that value.
    """
    pick, others = pick or {}, others or []
    df, hot = sketched(df, "rows", near, *others)
    if hot is not None and not hot.where(F.col("column") == near).isEmpty():
        return collapse_with_hot_keys(df, keys, largest, [near, *others], pick)
    rows, taken, numbered = df, [F.max(old).alias(new) for new, old in largest.items()], {}
    for new, old in pick.items():
        labels = numbered[new] = _numbered_labels(df, old)
        rows = _with_numbers(rows, labels, old, new)
        taken.append(F.min(f"_{new}").alias(f"_{new}"))
    rows = rows.repartition(near).groupBy(*keys).agg(*taken)
    return _with_names(rows, numbered).select(*keys, *pick, *largest), hot


def _by_labels(df: DataFrame, keys: list[str], largest: dict[str, str], pick: dict[str, str]) -> DataFrame:
    """The measures by keys and labels."""
    labels = [F.col(old).alias(f"_of_{new}") for new, old in pick.items()]
    return df.groupBy(*keys, *labels).agg(*[F.max(old).alias(new) for new, old in largest.items()])


def _least_labels(df: DataFrame, keys: list[str], largest: dict[str, str], pick: dict[str, str]) -> DataFrame:
    """The rows of `_by_labels`, written, by keys alone."""
    picked, numbered = [], {}
    for new in pick:
        labels = numbered[new] = _numbered_labels(df, f"_of_{new}")
        df = _with_numbers(df, labels, f"_of_{new}", new)
        picked.append(F.min(f"_{new}").alias(f"_{new}"))
    rows = df.groupBy(*keys).agg(*picked, *[F.max(new).alias(new) for new in largest])
    return _with_names(rows, numbered).select(*keys, *numbered, *largest)


def _numbered_labels(df: DataFrame, column: str) -> DataFrame:
    """(_label, _number): the texts of a column, numbered in their order."""
    return dense_key(df.select(F.col(column).alias("_label")).dropna().distinct(), ["_label"], "_number")


def _with_numbers(rows: DataFrame, labels: DataFrame, column: str, new: str) -> DataFrame:
    """The numbers of labels beside their texts, as `_new`."""
    rows = rows.join(sized(labels, rows_of(labels)), rows[column] == labels["_label"], "left")
    return rows.withColumnRenamed("_number", f"_{new}").drop("_label")


def _with_names(rows: DataFrame, numbered: dict[str, DataFrame]) -> DataFrame:
    """The texts of labels in place of their numbers."""
    for new, labels in numbered.items():
        names = labels.select(F.col("_label").alias(new), F.col("_number").alias("_of"))
        rows = rows.join(sized(names, rows_of(labels)), rows[f"_{new}"] == names["_of"], "left").drop(f"_{new}", "_of")
    return rows


def date_feed(
    df: DataFrame, dates: list[Column], season: Column | None = None, read: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """The (date, season) pairs a table contributes; several date columns cost one scan.

    With `read`, `dates` are texts that it reads as dates. There are few different ones, so they are made
    distinct before: a text is read once per task, not once per row.
    """
    season = F.lit(None).cast("string") if season is None else season
    feed = df.select(F.explode(F.array(*dates)).alias("date"), season.alias("season"))
    feed = feed.where(F.col("date").isNotNull())
    if read is None:
        return feed
    texts = feed.groupBy("date", "season").agg(F.count(F.lit(1)).alias("_n"))
    # The condition on the count keeps Spark from testing the date before the texts are distinct.
    day = F.when(F.col("_n") > 0, read(F.col("date")))
    return texts.select(day.alias("date"), "season").where(F.col("date").isNotNull())


def date_spine(feeds: list[DataFrame]) -> DataFrame:
    """One row per date of any feed, with its key, parts and the least season named with it.

    The pairs are made distinct first: that is a hash aggregation with nothing but keys, which
    shrinks any feed to days x seasons before the shuffle. The minimum of a text, which Spark
    can only aggregate by sorting, then sees that small remainder.
    """
    pairs = reduce(DataFrame.unionByName, feeds).distinct()
    days = pairs.groupBy("date").agg(F.min("season").alias("season"))
    date = F.col("date")
    return days.select(
        date_key(date).alias("date_id"), "date", "season",
        F.year(date).alias("year"), F.month(date).alias("month"), F.dayofmonth(date).alias("day"),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """The load report: (position, table_name, n_rows), one row per table, in one job."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(position).alias("position"), F.lit(name).alias("table_name"), "n_rows"
        )
        for position, (name, table) in enumerate(tables.items())
    ]
    return reduce(DataFrame.unionByName, counts)
