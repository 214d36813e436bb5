"""Key lookups: facts to dimensions, bridges, roles and missing members."""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.sources.scratch import materialize, rows_of, settled, watched


def project(df: DataFrame, mapping: dict[str, Column]) -> DataFrame:
    """Select columns under new names."""
    return df.select(*[column.alias(name) for name, column in mapping.items()])


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Keep the rows in which all the columns are filled."""
    return df.where(reduce(and_, [F.col(name).isNotNull() for name in columns]))


# Values that a sketch of a key column holds for each partition, besides a base: its counts are exact up to
# so many different values, and beyond that too great by a small share of a partition at most.
_HELD_PER_PARTITION, _HELD_BASE = 16, 10_000


def _heavy(spark: SparkSession, columns: tuple[str, ...]) -> dict[str, Column]:
    """A mergeable sketch of the most frequent values of each column; NULL can be one of them."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = min(_HELD_BASE + _HELD_PER_PARTITION * partitions, 1_000_000)
    return {name: F.expr(f"approx_top_k(cast(`{name}` as string), {min(partitions + 2, held)}, {held})") for name in columns}


def _spread(spark: SparkSession, columns: tuple[str, ...], seen: dict) -> list[tuple[str, str, int]]:
    """(column, value, ways) of the values that outgrow a partition's fair share of the rows."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = []
    for name in columns:
        for item in seen.get(name) or ():
            share = item["count"] * partitions / seen["_rows"]
            if share > 1 and item["item"] is not None:
                found.append((name, item["item"], math.ceil(4 * share)))
    return found


def hot_keys(df: DataFrame, *columns: str) -> DataFrame:
    """(column, value, ways): the values of key columns that outgrow a partition's fair share.

    A value is hot if it has more rows than one shuffle partition would get of all rows; it is to be
    spread over groups of about a quarter of that share, which hash evenly enough. So no more values
    of a column than there are partitions can be hot, and the table may be sent to every task. The
    columns are read in one pass that moves sketches only. Values are compared as texts. For rows that
    are written anyway, `with_hot_keys` takes no pass at all.
    """
    taken = [F.count(F.lit(1)).alias("_rows"), *[value.alias(name) for name, value in _heavy(df.sparkSession, columns).items()]]
    seen = df.agg(*taken).first().asDict()  # one row, of bounded size
    return df.sparkSession.createDataFrame(_spread(df.sparkSession, columns, seen), _HOT)


def with_hot_keys(df: DataFrame, name: str, *columns: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows, written, and the hot values of their key columns (as `hot_keys` gives them), None if there
    are none: the tasks that write the rows sketch them on the way."""
    table = materialize(df, name, watch=_heavy(df.sparkSession, columns))
    hot = _spread(df.sparkSession, columns, watched(table))
    return table, df.sparkSession.createDataFrame(hot, _HOT) if hot else None


def sketched(df: DataFrame, name: str, *columns: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows, written unless they are no more than a scan, and the hot values of their key columns as found in
    a sample of these columns, None if there are none.

    For work that only chooses its way by them and gives the same rows whatever they are: sketching every row costs
    more than collapsing it, and a value that outgrows a partition stands out in a sample.
    """
    df = settled(df, name)
    hot = hot_keys(df.select(*columns).sample(_SAMPLED, seed=1), *columns)
    return df, None if hot.isEmpty() else hot


_SAMPLED = 1 / 16


_HOT = "column string, value string, ways int"

# What a row of a key and an id, links of some length among them, takes in the hash table of a broadcast.
_BROADCAST_ROW = 256


def sized(side: DataFrame, rows: int) -> DataFrame:
    """One side of a join, by the number of its rows: sent to every task where they stay within Spark's limit for
    that (`spark.sql.autoBroadcastJoinThreshold`), sorted and merged where they do not.

    Spark goes by the size of the files, and those are packed: a table of links that takes 5 MB there is a
    hash table of 200 MB on the driver, for each join that runs at the time.
    """
    most = side.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return F.broadcast(side) if rows * _BROADCAST_ROW <= most else side.hint("merge")


def lookup(
    df: DataFrame,
    dim: DataFrame,
    fk: str,
    key: str,
    take: dict[str, str],
    how: str = "inner",
    hot: DataFrame | None = None,
    source: str | None = None,
) -> DataFrame:
    """Join `dim` on `df.fk = dim.key` and add `take` = {new column: dim column}.

    A dimension of few rows is broadcast, larger ones are sorted and merged (see `sized`). With `hot` (see `hot_keys`; `source` is the column's name there, if not `fk`) the rows
    of hot values are spread over their groups, and the dimension's rows of those values repeated
    for each; all other rows keep one group.
    """
    side = dim.select(
        F.col(key).alias("_key"), *[F.col(old).alias(new) for new, old in take.items()]
    )
    if hot is None:
        return df.join(sized(side, rows_of(dim)), df[fk] == side["_key"], how).drop("_key")

    # No more rows than there are partitions.
    hot = F.broadcast(hot.where(F.col("column") == (source or fk)).select(F.col("value").alias("_hot"), "ways"))
    ways = F.coalesce("ways", F.lit(1))
    left = df.join(hot, df[fk].cast("string") == F.col("_hot"), "left")
    left = left.select(*[df[name] for name in df.columns], F.pmod(F.xxhash64(*df.columns), ways).cast("int").alias("_group"))
    side = side.join(hot, side["_key"].cast("string") == F.col("_hot"), "left").select(
        *side.columns, F.explode(F.sequence(F.lit(0), ways - 1)).alias("_side_group")
    )
    matches = (left[fk] == side["_key"]) & (left["_group"] == side["_side_group"])
    return left.join(sized(side, rows_of(dim)), matches, how).drop("_key", "_group", "_side_group")


def lookup_roles(
    df: DataFrame, dim: DataFrame, roles: dict[str, str], key: str, id_col: str, hot: DataFrame | None = None,
) -> DataFrame:
    """Look up one dimension several times: `roles` = {new id column: key column of df}."""
    for new, fk in roles.items():
        df = lookup(df, dim, fk, key, {new: id_col}, hot=hot)
    return df


def bridge(
    links: DataFrame, link_key: str, near: DataFrame, near_id: str, link_fk: str, far: DataFrame,
    far_id: str, dim_key: str = "href",
) -> DataFrame:
    """Resolve a link table to ids of both ends: one row (link_key, near_id, far_id) per link.

    Facts that know only the near end join this once instead of the link table and two
    dimensions, and repeated links are dropped before they can fan out. The rows are written, so that
    their number is known to that join.
    """
    pairs = require(links.select(link_key, link_fk), link_key, link_fk).distinct()
    pairs, hot = with_hot_keys(pairs, "links", link_key, link_fk)
    pairs = lookup(pairs, near, link_key, dim_key, {near_id: near_id}, hot=hot)
    pairs = lookup(pairs, far, link_fk, dim_key, {far_id: far_id}, hot=hot)
    return materialize(pairs.select(link_key, near_id, far_id), "bridge", watch={})


def missing_members(names: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """The names (one column) that the dimension does not hold, each once."""
    known = require(dim.select(F.col(key).alias("_known")), "_known").distinct()
    column = names.columns[0]
    # The condition on the count keeps Spark from joining the names before they are distinct.
    wanted = require(names, column).groupBy(column).agg(F.count(F.lit(1)).alias("_n")).where("_n > 0")
    return wanted.join(sized(known, rows_of(dim)), wanted[column] == known["_known"], "left_anti").select(column)
