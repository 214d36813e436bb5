"""Surrogate keys and first-row-per-key selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.sources.scratch import materialize, rows_of, settled, with_rows

# monotonically_increasing_id() holds the partition above this bit and the row number below it.
_ROW_BITS = 33


def dense_key(
    df: DataFrame, order_by: list[str], id_col: str, offset: Column | int = 0, kind: str = "bigint"
) -> DataFrame:
    """Number rows offset+1 .. offset+n in the order of `order_by` (NULL last), as `kind`.

    The same numbers as `row_number() over (order by ...)`, whose unpartitioned window would
    pull the table into one task. Here the rows are range-partitioned and sorted in place,
    each keeps its (slice, row) position, and the slice sizes (one row per partition) give
    each slice its first number. The positions are written before they are counted, since a
    second run of the range sampling could cut the slices elsewhere. The sampling reads the rows once
    more, so anything dearer than a scan is written before it: joins and aggregations run once.

    `order_by` must be unique together; then the numbers do not depend on the partitioning
    and equal values cannot pile up in one slice.
    """
    ordering = [F.col(name).asc_nulls_last() for name in order_by]
    placed = materialize(
        settled(df, f"{id_col}-rows").repartitionByRange(*ordering)
        .sortWithinPartitions(*ordering)
        .withColumn("_place", F.monotonically_increasing_id()),
        id_col, watch={},
    )
    part = F.shiftright("_place", _ROW_BITS)
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))

    sizes = placed.groupBy(part.alias("_part")).agg((F.max(row) + 1).alias("_size"))
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))

    offset = F.lit(offset) if isinstance(offset, int) else offset
    number = (offset + F.col("_start") + row + 1).cast(kind)
    numbered = (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")  # one row per partition of the sort
        .select(number.alias(id_col), *df.columns)
    )
    return with_rows(numbered, rows_of(placed))


def max_id(dim: DataFrame, id_col: str) -> Column:
    """The largest id of a table, 0 for an empty one, as a scalar subquery."""
    return dim.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("max_id")).scalar()


def append_members(dim: DataFrame, names: DataFrame, name_col: str, id_col: str) -> DataFrame:
    """Stub rows of a dimension for new names, numbered by name after its largest id.

    `names` holds one column, `name_col`, without repeats. All other attributes are NULL.
    """
    numbered = dense_key(
        names, [name_col], id_col, max_id(dim, id_col), dim.schema[id_col].dataType.simpleString()
    )
    return numbered.select(
        *[
            F.col(field.name) if field.name in (id_col, name_col)
            else F.lit(None).cast(field.dataType).alias(field.name)
            for field in dim.schema
        ]
    )


def first_per_key(df: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """The first row of each key in the given order, which should be total.

    Planned as a group limit before and after the shuffle, so a hot key sends one row per
    map task, whatever its size.
    """
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order_by)))
    return ranked.where("_rank = 1").drop("_rank")
