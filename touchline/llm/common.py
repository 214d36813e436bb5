"""Helpers of the text operators: Arrow batches, shipped code, vocabulary files, column names."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts handed to one step of a Python worker at a time; a longer text makes a step of its own.
SLICE_BYTES = 8 << 20

Columns = list[pa.Array]


def ship() -> None:
    """Executors get this folder's functions by value, so they need no installed copy."""
    cloudpickle.register_pickle_by_value(sys.modules[__package__])


def vocabulary(spark: SparkSession, path: str):
    """The bytes of a vocabulary file, read on the driver and broadcast: a file of a few MB that
    does not grow with the data. Executors need not see the path."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def texts_of(column: pa.Array) -> list[str]:
    """Python texts; null is the empty text, bytes that are not UTF-8 become U+FFFD."""
    try:
        return [text or "" for text in column.to_pylist()]
    except UnicodeDecodeError:
        return [raw.decode("utf-8", "replace") for raw in bytes_of(column)]


def bytes_of(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column; null is empty."""
    return [raw or b"" for raw in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about `most` bytes of `column`, one row at least."""
    start, size = 0, 0
    values = batch.column(column)
    if pa.types.is_list(values.type):
        sizes = pc.multiply(pc.list_value_length(values), 4)
    else:
        sizes = pc.binary_length(values)
    lengths = pc.fill_null(sizes, 0).to_pylist()
    for row, length in enumerate(lengths):
        if row > start and size + length > most:
            yield batch.slice(start, row - start)
            start, size = row, 0
        size += length
    if start < batch.num_rows:
        yield batch.slice(start)


def add_columns(
    df: DataFrame, column: str, schema: str, make: Callable[[], Callable[[pa.Array], Columns]],
    keep: list[str] | None = None, most: int = SLICE_BYTES,
) -> DataFrame:
    """Append the columns of `schema`, computed from `column` slice by slice in Python workers.

    A slice has about `most` bytes of the column. `make()` runs once per task and returns the function from an Arrow array to the new arrays.
    Columns of df pass through (those in `keep` only, if given); one that has the name of a new
    column, in any case, is replaced by it. Rows neither move nor change in number.
    """
    ship()
    fields = T._parse_datatype_string(schema).fields
    names = [field.name for field in fields]
    new = {name.lower() for name in names}
    kept = [name for name in (df.columns if keep is None else keep) if name.lower() not in new]
    source = df.select(*[f"`{name}`" for name in dict.fromkeys([*kept, column])])
    out = T.StructType([*[source.schema[name] for name in kept], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for part in slices(batch, column, most):
                columns = [part.column(name) for name in kept] + compute(part.column(column))
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *names])

    return source.mapInArrow(run, out)


def list_array(values: pa.Array, lengths) -> pa.Array:
    """A list array over consecutive runs of `values`."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def filled(df: DataFrame, name: str) -> Column:
    """A column with a value of its own type in place of null, to be told apart by a flag beside it."""
    kind = df.schema[name].dataType
    none = {T.StringType(): "", T.BinaryType(): b"", T.DateType(): "1970-01-01", T.BooleanType(): False}.get(kind, 0)
    return F.coalesce(F.col(f"`{name}`"), F.lit(none).cast(kind))


def unused(df: DataFrame, name: str) -> str:
    """A column name that df does not have yet."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
